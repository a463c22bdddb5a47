"""Lifecycle: the closed form against a plain replay, and the named cases."""

import datetime as dt
import random

import pytest

from boardtide.operators.lifecycle import advance_lifecycle, compute_lifecycle
from boardtide.sources import snapshots

D = [dt.date(2026, 8, 1) + dt.timedelta(days=i) for i in range(12)]
P_COLS = "source string, snapshot_date date, firm_id string, job_key string"
O_COLS = "source string, snapshot_date date, firm_id string, ok boolean, row_count long"


def replay(postings, outcomes):
    """The state machine of the specification, row by row."""
    views = sorted({(d, s) for s, d, *_ in postings} | {(d, s) for s, d, *_ in outcomes})
    firm = {}
    for s, d, f, k in sorted(postings, key=lambda r: (r[1], r[2])):
        firm[k] = f
    src = {k: s for s, d, f, k in postings}
    out = {}
    for d, s in views:
        here = {k for s2, d2, _, k in postings if (s2, d2) == (s, d)}
        outs = [o for o in outcomes if (o[0], o[1]) == (s, d)]
        ok = {o[2] for o in outs if o[3] and (o[4] or 0) > 0}
        if len(outs) == 1 and ok:
            ok |= {f for s2, d2, f, _ in postings if (s2, d2) == (s, d)}
        for k in here:
            r = out.setdefault(k, dict(first=d, status=None, times=0, gone=None))
            r["status"] = {None: "open", "closed": "reposted", "unknown": "open"}.get(
                r["status"], r["status"])
            r.update(last=d, times=r["times"] + 1, gone=None)
        for k, r in out.items():
            if k in here or src[k] != s:
                continue
            if firm[k] in ok:
                if r["status"] != "closed":
                    r["gone"] = d
                r["status"] = "closed"
            elif r["status"] == "open":
                r["status"] = "unknown"
    return {k: (r["first"], r["last"], r["status"], r["gone"], r["times"]) for k, r in out.items()}


def run(spark, postings, outcomes):
    rows = compute_lifecycle(spark.createDataFrame(postings, P_COLS),
                             spark.createDataFrame(outcomes, O_COLS)).collect()
    return {r.job_key: (r.first_seen, r.last_seen, r.status, r.disappeared_on, r.times_seen)
            for r in rows}


def events(pattern, source="gh", firm="f"):
    """P present, C absent on a readable board, U failed read, Z read but empty."""
    postings, outcomes = [], []
    for i, e in enumerate(pattern):
        if e == "P":
            postings.append((source, D[i], firm, "k"))
        outcomes.append((source, D[i], firm, e != "U", 0 if e in "UZ" else 5))
        outcomes.append((source, D[i], "other", True, 3))
    return postings, outcomes


@pytest.mark.parametrize("pattern,status,gone,times", [
    ("P", "open", None, 1), ("PP", "open", None, 2), ("PC", "closed", 1, 1),
    ("PU", "unknown", None, 1), ("PZ", "unknown", None, 1), ("PUP", "open", None, 2),
    ("PCP", "reposted", None, 2), ("PCPU", "reposted", None, 2), ("PCUC", "closed", 1, 1),
    ("PUC", "closed", 2, 1),
])
def test_named_patterns(spark, pattern, status, gone, times):
    got = run(spark, *events(pattern))["k"]
    assert got[2:] == (status, D[gone] if gone else None, times)
    assert got[0] == D[0]


def test_other_platform_leaves_a_key_alone(spark):
    p, o = events("P")
    p.append(("lever", D[1], "g", "k2"))
    o.append(("lever", D[1], "g", True, 1))
    assert run(spark, p, o)["k"][2] == "open"


def test_sweep_outcome_governs_present_firms_only(spark):
    p = [("mcf", D[0], "a", "k1"), ("mcf", D[0], "b", "k2"),
         ("mcf", D[0], "a", "k3"), ("mcf", D[1], "a", "k3")]
    good = [("mcf", D[0], "sweep", True, 3), ("mcf", D[1], "sweep", True, 1)]
    got = run(spark, p, good)
    assert got["k1"][2] == "closed" and got["k2"][2] == "unknown" and got["k3"][2] == "open"
    bad = [good[0], ("mcf", D[1], "sweep", False, 0)]
    assert run(spark, p, bad)["k1"][2] == "unknown"


def _random_history(seed):
    rnd = random.Random(seed)
    postings, outcomes = [], []
    for s in ("gh", "mcf"):
        for d in D:
            if rnd.random() < 0.2:
                continue
            for k in range(12):
                if rnd.random() < 0.4:
                    postings.append((s, d, f"f{k % 3}", f"{s}:{k}"))
            if s == "mcf":
                outcomes.append((s, d, "sweep", rnd.random() < 0.6, rnd.choice([0, 4])))
            else:
                for f in range(3):
                    if rnd.random() < 0.7:
                        outcomes.append((s, d, f"f{f}", rnd.random() < 0.5, rnd.choice([0, 4])))
    return postings, outcomes


def test_closed_form_equals_replay(spark):
    for seed in range(4):
        p, o = _random_history(seed)
        assert run(spark, p, o) == replay(p, o)


def test_day_by_day_fold_equals_closed_form(spark):
    p, o = _random_history(11)
    state = spark.createDataFrame([], "job_key string, first_seen date, last_seen date, "
                                  "status string, disappeared_on date, times_seen long, "
                                  "source string, firm_id string")
    for d in D[:6]:
        state = advance_lifecycle(
            state, spark.createDataFrame([r for r in p if r[1] == d], P_COLS),
            spark.createDataFrame([r for r in o if r[1] == d], O_COLS), d)
        state = spark.createDataFrame(state.collect(), state.schema)
    got = {r.job_key: (r.first_seen, r.last_seen, r.status, r.disappeared_on, r.times_seen)
           for r in state.collect()}
    assert got == replay([r for r in p if r[1] <= D[5]], [r for r in o if r[1] <= D[5]])


def _posting(spark, n, key="k"):
    return spark.createDataFrame(
        [(f"gh:f:{key}{i}", "f", "greenhouse", f"{key}{i}", "T", "https://x/1", None, None,
          None, None, None, None, '{"min_years": 1, "salary_min": 2.5}') for i in range(n)],
        "job_key string, firm_id string, source_platform string, external_id string, title string, "
        "apply_url string, location_raw string, description_text string, posted_date date, "
        "posted_date_basis string, department string, employment_type string, extra_json string")


def test_store_round_trip(spark, tmp_path):
    root = str(tmp_path / "raw")
    out = spark.createDataFrame([("f", "greenhouse", True, 2, "")],
                                "firm_id string, platform string, ok boolean, row_count long, error string")
    assert snapshots.latest_snapshot_date(spark, root) is None
    assert snapshots.read_snapshot(spark, root, "greenhouse", D[0]).count() == 0
    snapshots.write_snapshot(spark, root, "greenhouse", D[0], _posting(spark, 2), out)
    snapshots.write_snapshot(spark, root, "greenhouse", D[2], _posting(spark, 3), out)
    snapshots.write_snapshot(spark, root, "lever", D[1], _posting(spark, 1), out)
    (tmp_path / "raw" / "postings" / "source=lever" / "snapshot_date=oops").mkdir()
    assert snapshots.available_snapshots(spark, root) == [
        ("greenhouse", D[0]), ("greenhouse", D[2]), ("lever", D[1])]
    assert snapshots.platforms_on_disk(spark, root) == ["greenhouse", "lever"]
    assert snapshots.newest_partitions(spark, root, D[1]) == [("greenhouse", D[0]), ("lever", D[1])]
    assert snapshots.read_newest(spark, root).count() == 4
    assert snapshots.read_newest(spark, root, D[1]).count() == 3
    # a rerun without postings empties that partition only, and keeps the outcome
    snapshots.write_snapshot(spark, root, "greenhouse", D[0], _posting(spark, 0), out)
    assert snapshots.read_snapshot(spark, root, "greenhouse", D[0]).count() == 0
    assert snapshots.read_outcomes(spark, root, "greenhouse", D[0]).count() == 1
    row = snapshots.as_postings(snapshots.read_snapshot(spark, root, "lever", D[1])).first()
    assert row.location_raw == "" and row.extra.min_years == "1" and row.extra.salary_min == "2.5"
