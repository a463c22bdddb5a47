"""Dimensions, selections, sent state, packing, reports, and the runs end to end."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.operators import asof, packing, reports, select
from boardtide.plans import runs
from boardtide.sources import registry as dims, snapshots, state

HEAD = ("firm_id,firm_name,sector,tier,ats_platform,ats_token,ats_host,board_site,careers_url,"
        "robots_status,status,notes\n")
D = dt.date(2026, 8, 10)


def write(path, body):
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_registry_loads_and_counts(spark, tmp_path):
    path = write(tmp_path / "r.csv", HEAD + "acme , Acme Bank,bank,1,greenhouse,acme,,,,allowed,wired,\n"
                 ",,,,,,,,,,,\nbeta,Beta,quant,2,,,,,,,todo,\ngam,Gamma,quant,2,,,,,,unknown,,note\n")
    reg = dims.load_registry(spark, path)
    assert [r.firm_id for r in reg.orderBy("registry_ord").collect()] == ["acme", "beta", "gam"]
    assert [r.firm_id for r in dims.fetchable(reg).collect()] == ["acme"]
    assert dims.select_firms(reg, exclude=("greenhouse",)).count() == 0
    assert {r.status: r.firms for r in dims.counts_by(reg, "status").collect()} == {"wired": 1, "todo": 2}
    assert {r.ats_platform: r.firms for r in dims.counts_by(reg, "ats_platform").collect()} == {"greenhouse": 1}
    hits = spark.createDataFrame([("beta", "lever", "beta", "found"), ("acme", "lever", "x", "no")],
                                 "firm_id string, ats_platform string, ats_token string, note string")
    out = {r.firm_id: r for r in dims.upsert_registry(reg, hits).collect()}
    assert (out["beta"].status, out["beta"].ats_platform, out["beta"].notes) == ("wired", "lever", "found")
    assert out["acme"].ats_platform == "greenhouse" and out["gam"].notes == "note"
    sites = spark.createDataFrame([("acme", "workday", "t", "h", "s", "n")], "firm_id string, ats_platform "
                                  "string, ats_token string, ats_host string, board_site string, note string")
    assert {r.firm_id: r.board_site for r in dims.upsert_registry(
        reg, sites, force_platform="workday").collect()}["acme"] == "s"


def test_registry_reports_every_problem(spark, tmp_path):
    path = write(tmp_path / "r.csv", HEAD + "a b,X,s,1,,,,,,,todo,\nw1,X,s,1,,,,,,,wired,\n"
                 "w2,X,s,1,workday,t,,,,allowed,wired,\nw3,X,s,1,lever,t,,,,disallowed,wired,\n"
                 "w3,X,s,q,myspace,,,,,,todo,\n")
    with pytest.raises(ValueError) as err:
        dims.load_registry(spark, path)
    message = str(err.value)
    for part in ("alphanumeric slug", "wired requires a platform", "workday needs ats_host, board_site",
                 "robots disallow", "tier must be", "unknown platform myspace", "duplicate firm_id"):
        assert part in message, part


def test_aliases_overrides_subscriptions(spark, tmp_path):
    a = write(tmp_path / "a.csv", "alias_kind,alias_value,firm_id\nUEN, 1A ,acme\nname,Foo,\n")
    assert [tuple(r)[:3] for r in dims.load_aliases(spark, a).collect()] == [("uen", "1A", "acme")]
    assert dims.load_aliases(spark, str(tmp_path / "none.csv")).count() == 0
    o = write(tmp_path / "o.csv", "job_key,job_family,why\nk,legal,x\nk2,,x\nk,other,later\n")
    assert [tuple(r) for r in dims.load_overrides(spark, o).collect()] == [("k", "other")]
    s = write(tmp_path / "s.json", "\n".join([
        json.dumps({"chat_id": "1", "role_types": ["Entry level"], "groups": ["Legal"], "notified_keys": ["k"]}),
        json.dumps({"chat_id": "2", "role_types": [], "groups": ["Legal"]}),
        json.dumps({"chat_id": "3", "role_types": ["x"], "groups": ["y"], "active": False}), "{oops"]))
    subs = state.read_subscriptions(spark, s)
    assert subs.count() == 3
    assert [r.chat_id for r in state.active_subscriptions(subs).collect()] == ["1"]
    assert [tuple(r) for r in state.sent_keys(subs).collect()] == [("1", "k")]
    assert state.read_subscriptions(spark, str(tmp_path / "no.json")).count() == 0
    state.write_sent(spark, str(tmp_path / "sent"), state.sent_keys(subs))
    assert state.read_sent(spark, str(tmp_path / "sent")).count() == 1
    assert state.read_sent(spark, str(tmp_path / "nowhere")).count() == 0


def curated(spark, rows):
    base = dict(job_key="k", firm_id="f", firm_name="Firm", title="T", apply_url="https://x/1",
                is_singapore=True, status="open", job_family="legal", family_group="Legal", is_grad=True,
                is_internship=False, role_type="Entry level", posted_date=D, first_seen=D, snapshot_date=D,
                sector="s", source_platform="lever")
    full = [{**base, "job_key": f"k{i}", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names(schema.CURATED)) for r in full],
                                 schema.CURATED)


def subs(spark, *rows):
    return spark.createDataFrame([(c, r, g, None, True, []) for c, r, g in rows], schema.SUBSCRIPTIONS)


def test_base_filter_and_selection(spark):
    df = curated(spark, [{}, {"is_grad": False}, {"is_internship": True}, {"is_singapore": False},
                         {"status": "closed"}, {"status": "unknown"}])
    assert [r.job_key for r in select.notifiable(df).collect()] == ["k0"]
    df = curated(spark, [{"family_group": "Operations"}, {}, {"family_group": "Operations", "first_seen": None},
                         {"family_group": "Operations", "role_type": "Graduate role"}])
    assert select.select_new(df).count() == 3
    assert select.select_new(df, since=D - dt.timedelta(1)).count() == 2
    assert select.select_new(df, since=D).count() == 0
    assert select.select_new(df, groups=("Legal",)).count() == 1
    assert select.select_new(df, role_types=("Graduate role",)).count() == 1


def test_subscribers_and_sent_state(spark):
    df = curated(spark, [{}, {"family_group": "Operations"}, {"role_type": "Graduate role"}])
    s = subs(spark, ("1", ["Entry level"], ["Legal", "Operations"]), ("2", ["Graduate role"], ["Legal"]),
             ("3", ["Entry level"], ["People"]))
    matches = select.match_subscribers(select.notifiable(df), s)
    assert sorted((r.chat_id, r.job_key) for r in matches.collect()) == [("1", "k0"), ("1", "k1"), ("2", "k2")]
    assert {r.chat_id: r.matching for r in select.matching_counts(df, s).collect()} == {"1": 2, "2": 1, "3": 0}
    assert {(r.chat_id, r.roles) for r in select.firms_with_roles(df, s).collect()} == {("1", 2), ("2", 1)}
    sent = spark.createDataFrame([("1", "k0"), ("1", "gone")], schema.SENT_STATE)
    due = select.unsent(matches, sent)
    assert sorted((r.chat_id, r.job_key) for r in due.collect()) == [("1", "k1"), ("2", "k2")]
    after = select.record_sent(sent, due, df)
    assert sorted(tuple(r) for r in after.collect()) == [("1", "k0"), ("1", "k1"), ("2", "k2")]
    assert select.unsent(matches, after).count() == 0
    late = spark.createDataFrame([("1", "vanished")], schema.SENT_STATE)
    assert ("1", "vanished") in {tuple(r) for r in select.record_sent(sent, late, df).collect()}
    assert ("1", "vanished") not in {tuple(r) for r in select.record_sent_single(sent, late, df).collect()}


@pytest.mark.parametrize("n", [1, 5, 25, 60, 200])
def test_digest_is_packed_and_complete(spark, n):
    df = curated(spark, [{"title": f"Role & <{i}> " + "x" * 100, "apply_url": f"https://x/{i}?a=1&b=2",
                          "family_group": "Legal" if i % 3 else "Operations",
                          "posted_date": None if i % 5 == 0 else D - dt.timedelta(i),
                          "first_seen": None if i % 10 == 0 else D} for i in range(n)])
    both = df.withColumn("chat_id", F.lit("a")).unionByName(df.limit(2).withColumn("chat_id", F.lit("b")))
    out = packing.render_digest(both, D).orderBy("chat_id", "message_no").collect()
    a = [r.message for r in out if r.chat_id == "a"]
    assert [r.message_no for r in out if r.chat_id == "a"] == list(range(1, len(a) + 1))
    assert all(len(m) <= 4096 for m in a)
    joined = "\n".join(a)
    assert joined.count("• <a href=") == n and "a=1&amp;b=2" in joined and "<0>" not in joined
    assert a[0].startswith(f"<b>🎓 {n} new graduate role(s)</b> · 2026-08-10")
    for i, m in enumerate(a[1:], start=2):
        assert m.split("\n")[0].endswith(f"(cont. {i})") and m.split("\n")[2].startswith("<b>")
    assert ("date unknown" in joined)
    if n >= 25:
        assert joined.index("<b>Legal</b>") < joined.index("<b>Operations</b>")


def _greedy(lines, heading, limit):
    out, current, size = [], [], 0
    for line in [heading] + lines:
        if size + len(line) > limit and current:
            out.append("\n".join(current))
            current, size = [], 0
        current.append(line)
        size += len(line) + 1
    return out + ["\n".join(current)]


def test_reply_packing(spark, tmp_path):
    df = curated(spark, [{"job_key": f"k{i:03d}", "title": "T" * (i % 90)} for i in range(120)]).withColumn(
        "chat_id", F.lit("a"))
    out = packing.render_reply(df, "<b>H</b>", limit=500)
    lines = [f'• <a href="https://x/1">{("T" * (i % 90))[:80]}</a>\n  Firm · 2026-08-10' for i in range(120)]
    assert [r.message for r in out.orderBy("message_no").collect()] == _greedy(lines, "<b>H</b>", 500)
    packing.write_digest(out, str(tmp_path / "digest"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "digest").glob("part-*")))
    assert text.count("---") == out.count()


def test_dashboard_search_latest(spark):
    df = curated(spark, [{"posted_date": None, "first_seen": D}, {"posted_date": D - dt.timedelta(100)},
                         {"posted_date": D - dt.timedelta(5), "first_seen": D - dt.timedelta(9)},
                         {"job_family": "other", "family_group": "Other"}, {"title": "Quant Dev"}])
    view = select.dashboard(df, D, groups=("Legal",))
    assert {r.job_key: r.new for r in view.collect()} == {"k0": "🆕", "k2": "", "k4": "🆕"}
    assert {r.job_key for r in select.dashboard(df, D, families=("other",), groups=("Legal",)).collect()} == {"k3"}
    assert [r.job_key for r in view.orderBy(*select.dashboard_keys()).collect()] == ["k4", "k2", "k0"]
    h = reports.headline(view).first()
    assert (h.matching, h.new_rows, h.firms, h.families) == (3, 2, 1, 1)
    assert [r.job_key for r in select.search(df, "QUANT").collect()] == ["k4"]
    assert select.search(df, "fi.m", regex=True).count() == 5
    assert [select.clamp_limit(x) for x in ("7", "x", None, 0, 99)] == [7, 15, 15, 1, 50]
    assert [r.job_key for r in select.latest(df, 2).collect()] == ["k4", "k2"]
    assert [r.job_key for r in select.latest(df, 2, newest=True).collect()] == ["k3", "k4"]


def test_reports(spark):
    df = curated(spark, [{}, {"status": "closed"}, {"is_internship": True}, {"family_group": "Other", "job_family": "other"}])
    assert {r.status: r.postings for r in reports.status_counts(df).collect()} == {"open": 2, "closed": 1}
    fam = {r.job_family: (r.postings, r.group_postings) for r in reports.family_counts(df).collect()}
    assert fam == {"legal": (3, 3), "other": (1, 1)}
    assert {tuple(r) for r in reports.facets(df, ["status", "sector"]).collect()} == {
        ("status", "open"), ("status", "closed"), ("sector", "s")}
    out = spark.createDataFrame(
        [("gh", D, "a", True, 3, ""), ("gh", D, "b", False, 0, None), ("gh", D - dt.timedelta(1), "a", False, 0, "x"),
         ("lv", D, "a", False, 0, "boom"), ("as", D, "a", True, 0, "")],
        "source string, snapshot_date date, firm_id string, ok boolean, row_count long, error string")
    plats = spark.createDataFrame([("gh",), ("lv",), ("as",), ("wd",)], "source string")
    h = {r.source: r for r in reports.platform_health(out, plats).collect()}
    assert (h["gh"].firms_attempted, h["gh"].firms_ok, h["gh"].rows, h["gh"].failure_rate, h["gh"].broken) == (
        2, 1, 3, .5, False)
    assert h["lv"].broken and h["as"].broken and h["wd"].broken and h["wd"].snapshot_date is None
    fails = reports.read_failures(out)
    assert {tuple(r) for r in fails.collect()} == {("gh", "b", "unknown error"), ("lv", "a", "boom")}
    cand = spark.createDataFrame([("X", 3)], schema.CANDIDATES)
    counts = spark.createDataFrame([("wired", 4), ("todo", 2)], "status string, firms long")
    scores = spark.createDataFrame([(1.0, 0.5)], "precision double, family_accuracy double")
    text = reports.daily_report(D, reports.health_parts(
        reports.platform_health(out, plats), fails, cand, df, counts, scores))
    assert all(line in text.split("\n") for line in (
        "lv | a | boom", "X | 3", "wired | 4", "1.0 | 0.5", "graduate rows, open | 2")), text
    few = reports.daily_report(D, [("A", fails.orderBy("platform"), 1), ("B", fails.limit(0), 3)])
    assert "gh | b" in few and "lv" not in few and "... and 1 more" in few and "### B" not in few
    s = reports.ingest_summary(out).first()
    assert (s.postings, s.firms, s.failed) == (3, 5, 3)


def test_first_wins_and_newest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, o int, v string")
    assert {tuple(r) for r in asof.first_wins(df, ["k"], ["o"]).collect()} == {("a", 1, "y"), ("b", 3, None)}
    rows = spark.createDataFrame([("g", 1), ("g", 2), ("l", 1)], "source string, snapshot_date int")
    assert asof.newest_per_source(rows).count() == 2 and asof.newest_per_source(rows, 1).count() == 2


def test_runs_end_to_end(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "curated")
    reg = dims.load_registry(spark, write(tmp_path / "r.csv", HEAD +
                             "acme,Acme Bank,consulting,1,greenhouse,acme,,,,allowed,wired,\n"))
    job = lambda i, t, day: {"id": i, "title": t, "absolute_url": f"https://acme.com/{i}",
                             "location": {"name": "Singapore"}, "first_published": f"{day}T00:00:00Z"}

    def gh(jobs, ok=True):
        body = json.dumps({"jobs": jobs})
        return spark.createDataFrame([("acme", "acme", None, None, D, "list", 0, None, ok, "" if ok else "500",
                                       body if ok else None)], schema.LANDED)

    def mcf(jobs):
        return spark.createDataFrame([("x", None, None, None, D, "list", 0, "graduate", True, None,
                                       json.dumps({"results": jobs}))], schema.LANDED)
    portal = lambda u, title, name: {
        "uuid": u, "title": title, "hiringCompany": {"name": name, "uen": ""}, "minimumYearsExperience": 0,
        "salary": {"minimum": 4000}, "metadata": {"jobPostId": "P" + u, "jobDetailsUrl": "https://m/" + u,
                                                  "originalPostingDate": "2026-08-05"}}
    a, b = job(1, "Graduate Analyst", "2026-08-01"), job(2, "Associate", "2026-08-02")
    runs.ingest(spark, root, gh([a, b]), "greenhouse", D)
    runs.ingest(spark, root, gh([a]), "greenhouse", D + dt.timedelta(1))
    assert runs.ingest(spark, root, gh([], ok=False), "greenhouse", D + dt.timedelta(2)) == {
        "postings": 0, "firms": 1, "failed": 1}
    runs.ingest(spark, root, mcf([portal("u1", "Graduate Analysts", "ACME BANK PTE LTD"),
                                      portal("u2", "Legal Trainee", "ACME BANK SINGAPORE PTE LTD"),
                                      portal("u3", "Cook", "SMALL CAFE")]), "mcf", D)
    # the newest greenhouse partition is the failed read: it has no rows, and closes nothing
    ov = spark.createDataFrame([], "job_key string, job_family string")
    al = dims.load_aliases(spark, str(tmp_path / "none.csv"))
    assert runs.rebuild(spark, root, out, reg, al, ov) == D + dt.timedelta(2)
    rows = {r.job_key: r for r in runs.read_curated(spark, out).collect()}
    assert set(rows) == {"mcf:acme:u1", "mcf:acme:u2"}
    from boardtide.operators.lifecycle import compute_lifecycle
    life = {r.job_key: r for r in compute_lifecycle(*snapshots.read_history(spark, root)).collect()}
    assert life["greenhouse:acme:1"].status == "unknown" and life["greenhouse:acme:2"].status == "closed"
    # a readable board again: the portal row folds into its twin
    runs.ingest(spark, root, gh([a]), "greenhouse", D + dt.timedelta(2))
    runs.rebuild(spark, root, out, reg, al, ov)
    df = runs.read_curated(spark, out)
    assert df.schema == schema.CURATED
    rows = {r.job_key: r for r in df.collect()}
    one = rows["greenhouse:acme:1"]
    assert (one.status, one.firm_name, one.mcf_job_id, one.salary_min, one.grad_basis, one.role_type) == (
        "open", "Acme Bank", "Pu1", 4000.0, "route:programme", "Graduate programme")
    assert (one.first_seen, one.last_seen) == (D, D + dt.timedelta(2))
    two = rows["mcf:acme:u2"]
    assert (two.job_family, two.status, two.first_seen, two.is_singapore) == ("legal", "open", None, True)
    cand = runs.read_candidates(spark, out)
    assert runs.read_counters(spark, out) == {
        "kept": 2, "merged": 1, "candidates": 1, "graduate": sum(r.is_grad for r in rows.values())}
    assert [tuple(r) for r in cand.collect()] == [("SMALL CAFE", 1)]
    subs_df = subs(spark, ("1", list(fixed.SELECTABLE_ROLE_TYPES), ["Strategy & Consulting", "Legal"]))
    messages, sent = runs.serve(df, subs_df, state.read_sent(spark, str(tmp_path / "s0")), D)
    assert messages.count() == 1 and sent.count() == 2
    again, _ = runs.serve(df, subs_df, sent, D)
    assert again.count() == 0
    labels = spark.createDataFrame([], schema.LABELS)
    report = reports.daily_report(D, runs.health(snapshots.read_history(spark, root)[1], df, cand, reg, labels))
    assert "wired | 1" in report and "SMALL CAFE | 1" in report and "rows | 2" in report
