"""Versions of tables that appear as a whole, and the lifecycle advanced by day."""

import time

import pytest
from pyspark.sql import functions as F

from boardtide import schema
from boardtide.operators.lifecycle import compute_lifecycle
from boardtide.plans import runs
from boardtide.sources import generations, lifecycle_store, snapshots, state
from boardtide.sources.generations import Conflict, Generations
from boardtide.sources.lifecycle_store import LifecycleStore
from tests.test_lifecycle import D, _random_history

ONE = "n bigint"


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], ONE)


def values(store, name, at=None):
    return sorted(r.n for r in store.read(name, ONE, at).collect())


def test_versions_replace_append_and_keep(spark, tmp_path):
    store = Generations(spark, str(tmp_path / "s"))
    assert store.current() is None and values(store, "a") == []
    assert store.publish({"a": frame(spark, 1), "b": frame(spark, 10)}, note="first") == 1
    first = store.current()
    assert store.publish({"a": frame(spark, 2)}, {"b": frame(spark, 11)}) == 2
    assert values(store, "a") == [2] and values(store, "b") == [10, 11]
    # the version before can still be read as a whole
    assert values(store, "a", first) == [1] and values(store, "b", first) == [10] and first["note"] == "first"
    store.publish({"b": frame(spark, 12)})
    left = {p.name.split("-")[0] for p in (tmp_path / "s" / "data").iterdir()}
    assert left == {"a", "b"} and len(list((tmp_path / "s" / "data").iterdir())) == 4
    assert values(store, "a") == [2] and values(store, "b") == [12]


def test_a_run_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    store = Generations(spark, str(tmp_path / "s"))
    store.publish({"a": frame(spark, 1), "b": frame(spark, 10)})
    write, calls = generations._write, []

    def dies(df, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("killed between two writes")
        write(df, path)

    monkeypatch.setattr(generations, "_write", dies)
    with pytest.raises(RuntimeError, match="killed"):
        store.publish({"a": frame(spark, 2), "b": frame(spark, 20)})
    assert values(store, "a") == [1] and values(store, "b") == [10] and store.current()["version"] == 1
    assert len(list((tmp_path / "s" / "data").iterdir())) == 2


def test_of_two_runs_one_fails(spark, tmp_path):
    store = Generations(spark, str(tmp_path / "s"))
    store.publish({"a": frame(spark, 1)})
    base = store.current()
    store.publish({"a": frame(spark, 2)}, base=base)
    with pytest.raises(Conflict):
        store.publish({"a": frame(spark, 3)}, base=base)
    assert values(store, "a") == [2] and not list((tmp_path / "s" / "drafts").glob("*[0-9a-f]"))


def test_sent_state_is_versioned(spark, tmp_path):
    path = str(tmp_path / "sent")
    assert state.read_sent(spark, path).count() == 0
    for key in ("k1", "k2"):
        state.write_sent(spark, path, state.read_sent(spark, path).unionByName(
            spark.createDataFrame([("c", key)], schema.SENT_STATE)))
    assert sorted(r.job_key for r in state.read_sent(spark, path).collect()) == ["k1", "k2"]


def put(spark, root, postings, outcomes, day):
    """The day's reads of every source that was read; a source without rows is an empty partition."""
    for source in {r[0] for r in postings + outcomes if r[1] == day}:
        rows = [r for r in postings if r[:2] == (source, day)]
        reads = [r for r in outcomes if r[:2] == (source, day)]
        empty = {n: F.lit(None) for n in schema.names(schema.POSTING)}
        df = spark.createDataFrame([(r[3], r[2]) for r in rows], "job_key string, firm_id string").select(*[
            F.col(n) if n in ("job_key", "firm_id") else empty[n].alias(n) for n in schema.names(schema.POSTING)])
        out = spark.createDataFrame([(r[2], source, r[3], r[4], "", None) for r in reads], schema.OUTCOME)
        snapshots.write_snapshot(spark, root, source, day, df, out)


def rows(df):
    return sorted(tuple(r) for r in df.select(*schema.names(schema.LIFECYCLE)).collect())


def replayed(spark, root):
    return rows(compute_lifecycle(*snapshots.read_history(spark, root), views=snapshots.view_calendar(spark, root)))


def test_day_by_day_equals_replay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lifecycle_store, "FOLDERS", 3)
    root, postings_outcomes = str(tmp_path / "raw"), _random_history(3)
    store = LifecycleStore(spark, root, str(tmp_path / "life"))
    assert store.update() is None and store.read().count() == 0
    full = []
    monkeypatch.setattr(LifecycleStore, "_replay", lambda self, *a, run=LifecycleStore._replay: (full.append(a[1]), run(self, *a)))
    for day in D[:6]:
        put(spark, root, *postings_outcomes, day)
        if snapshots.available_snapshots(spark, root):
            store.update()
            assert rows(store.read()) == replayed(spark, root)
    # only the first day was computed from history
    assert len(full) == 1
    assert len(store.versions.current()["tables"]["closed"]) <= 4
    # a partition that is replaced, or comes late, starts anew
    time.sleep(0.01)
    some = [("gh", D[2], "f1", "gh:late")], [("gh", D[2], "f1", True, 1)]
    put(spark, root, *some, D[2])
    store.update()
    assert len(full) == 2 and rows(store.read()) == replayed(spark, root)
    store.update()
    assert len(full) == 2


def test_a_day_reads_its_own_partitions(spark, tmp_path):
    root, history = str(tmp_path / "raw"), _random_history(3)
    for day in D[:4]:
        put(spark, root, *history, day)
    for df in snapshots.read_day(spark, root, D[3]):
        scan = df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "snapshot_date" in scan and "source" in scan
        assert {r.snapshot_date for r in df.select("snapshot_date").collect()} <= {D[3]}


def test_rebuild_that_dies_leaves_both_tables(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "raw"), str(tmp_path / "out")
    layout = "firm_id string, firm_name string, sector string, tier long, registry_ord int"
    reg = spark.createDataFrame([("acme", "Acme", "bank", 1, 0)], layout)
    al = spark.createDataFrame([], schema.ALIASES).withColumn("alias_ord", F.lit(0))
    ov = spark.createDataFrame([], "job_key string, job_family string")

    def day(n, date):
        posts = spark.createDataFrame(
            [(f"greenhouse:acme:{i}", "acme", "greenhouse", str(i), "Graduate Analyst", "https://a.com/1", "Singapore",
              "", date, "published", "", "", "{}") for i in range(n)], schema.POSTING)
        snapshots.write_snapshot(spark, root, "greenhouse", date, posts, spark.createDataFrame(
            [("acme", "greenhouse", True, n, "", None)], schema.OUTCOME))

    day(3, D[0])
    runs.rebuild(spark, root, out, reg, al, ov)
    assert runs.read_curated(spark, out).count() == 3
    day(2, D[1])
    write = generations._write

    def dies(df, path):
        if "/candidates-" in path:
            raise RuntimeError("killed")
        write(df, path)

    with monkeypatch.context() as patch:
        patch.setattr(generations, "_write", dies)
        with pytest.raises(RuntimeError, match="killed"):
            runs.rebuild(spark, root, out, reg, al, ov)
    assert {r.snapshot_date for r in runs.read_curated(spark, out).collect()} == {D[0]}
    assert runs.read_candidates(spark, out).count() == 0
    runs.rebuild(spark, root, out, reg, al, ov)
    assert {r.status for r in runs.read_curated(spark, out).collect()} == {"open"}
    assert {r.snapshot_date for r in runs.read_curated(spark, out).collect()} == {D[1]}
