"""Robots verdicts, site names, board and tenant verification, best board, budgets."""

import pytest
from pyspark.sql import functions as F

from boardtide.functions import names
from boardtide.operators import boards, reports, robots

FILES = [
    ("t.example.com", 200, "User-agent: *\nDisallow: /talentcommunity/\nDisallow: /services/\n"),
    ("d.example.com", 200, "User-agent: *\nDisallow: /D_Careers/\n"),
    ("closed.example.com", 403, ""), ("none.example.com", 404, ""), ("err.example.com", 500, ""),
    ("m.example.com", 200, "# c\nUser-agent: a\nUser-agent: mybot\nAllow: /x/ok\nDisallow: /x # no\n\n"
     "User-agent: *\nDisallow: /\n"),
    ("dead.example.com", 200, "User-agent: *\n\nDisallow: /\n"),
    ("free.example.com", 200, "User-agent: *\nDisallow:\n"),
    ("enc.example.com", 200, "User-agent: *\nDisallow: /a%20b\n"),
]
VERDICTS = [
    ("https://t.example.com/talentcommunity/x", "allowed disallowed"),
    ("https://t.example.com/search/?q=", "allowed allowed"),
    ("https://d.example.com/wday/cxs/d/D_Careers/jobs", "allowed allowed"),
    ("https://d.example.com/D_Careers/job/x", "allowed disallowed"),
    ("https://closed.example.com/", "x disallowed"), ("https://none.example.com/", "x allowed"),
    ("https://err.example.com/", "x unknown"), ("https://nobody.example.com/", "x unknown"),
    ("https://m.example.com/anything", "x disallowed"), ("https://dead.example.com/z", "x allowed"),
    ("https://free.example.com/z", "x allowed"), ("https://enc.example.com/a b/c", "x disallowed"),
]


def test_verdicts(spark):
    files = spark.createDataFrame(FILES, "host string, status int, body string")
    pages = spark.createDataFrame([(u,) for u, _ in VERDICTS], "url string")
    got = {r.url: r for r in robots.admit(pages, files).collect()}
    for url, want in VERDICTS:
        assert got[url].verdict == want.split()[1], url
    assert got["https://err.example.com/"].may_fetch
    strict = robots.admit(pages, files, unknown_is_allowed=False)
    assert not strict.filter("verdict = 'unknown' and may_fetch").count()
    named = spark.createDataFrame([("https://m.example.com" + p,) for p in ("/x/ok/1", "/x/no", "/y")],
                                  "url string")
    out = {r.url[-4:]: r.verdict for r in robots.admit(named, files, agent="MyBot/1.0").collect()}
    assert out == {"ok/1": "allowed", "x/no": "disallowed", ".com/y"[-4:]: "allowed"}


SITES = [
    ("User-agent: *\nDisallow: /D_Careers/\nDisallow: /refreshFacet/\n", ["D_Careers"]),
    ("Sitemap: https://p.wd3.myworkdayjobs.com/Campus/siteMap.xml\n"
     "Sitemap: https://p.wd3.myworkdayjobs.com/Experienced/siteMap.xml\n\nUser-agent: *\n"
     "Disallow: /NonPublic/\nDisallow: /refreshFacet/\n", ["Campus", "Experienced", "NonPublic"]),
    ("User-agent: *\nAllow: /M_Jobs/\nDisallow: /M_Admin/\n", ["M_Jobs", "M_Admin"]),
    ("User-agent: *\nDisallow: /talentcommunity/\n", []), ("User-agent: *\nDisallow:\n", []),
    ("User-agent: *\nDisallow: /\n", []),
]


def test_site_names(spark):
    df = spark.createDataFrame([(b, i) for i, (b, _) in enumerate(SITES)], "body string, n int")
    for r in df.select("n", robots.site_candidates(F.col("body")).alias("s")).collect():
        assert r.s == SITES[r.n][1]


HIT = ("firm_id string, firm_name string, platform string, token string, total long, in_place long, "
       "board_name string, sample_url string, want boolean")
HITS = [
    ("mas", "Monetary Authority of Singapore", "greenhouse", "mas", 4, 0, "Midwest Applied Solutions", "", False),
    ("edb", "Singapore Economic Development Board", "greenhouse", "edbx", 19, 2, "EDB",
     "https://www.enterprisedb.com/careers/1", False),
    ("appliedmaterials", "Applied Materials", "ashby", "applied", 262, 0, "", "", False),
    ("arthurdlittle", "Arthur D. Little", "ashby", "arthur", 1, 0, "", "", False),
    ("jumptrading", "Jump Trading", "ashby", "jump", 3, 0, "", "", False),
    ("linkedin", "LinkedIn", "lever", "linkedin", 23, 0, "", "https://jobs.lever.co/linkedin/1", False),
    ("ambergroup", "Amber Group", "ashby", "amber", 22, 0, "", "", False),
    ("goldmansachs", "Goldman Sachs", "workable", "goldman-sachs", 0, 0, "Goldman Sachs", "", False),
    ("nea", "National Environment Agency", "greenhouse", "national", 7, 0, "NATIONAL", "", False),
    ("squarepoint", "Squarepoint Capital", "greenhouse", "squarepointcapital", 87, 0, "Squarepoint Capital", "", True),
    ("point72", "Point72", "greenhouse", "point72", 231, 0, "Point72 ", "", True),
    ("davinci", "Da Vinci Derivatives", "greenhouse", "davinciderivatives", 12, 0, "Da Vinci", "", True),
    ("govtech", "GovTech Singapore", "greenhouse", "govtech", 50, 0, "GovTech ", "", True),
    ("openai", "OpenAI", "ashby", "openai", 747, 27, "", "", True),
    ("janestreet", "Jane Street", "greenhouse", "janestreet", 230, 0, "",
     "https://www.janestreet.com/join-jane-street/apply/7", True),
]


def test_board_verification(spark):
    out = boards.verify_boards(spark.createDataFrame(HITS, HIT)).collect()
    assert len(out) == len(HITS)
    for r in out:
        assert r.verified == r.want, (r.firm_id, r.reason)


@pytest.mark.parametrize("name,tenant,total,want", [
    ("DBS Bank", "dbs", 266, True), ("Micron Technology", "micron", 878, True), ("Shell", "shell", 0, False),
    ("Morgan Stanley", "ms", 34, False), ("GIC", "globalinsurance", 500, False), ("Citi", "citi", 291, True),
])
def test_tenant_verification(spark, name, tenant, total, want):
    df = spark.createDataFrame([(name, tenant, total)], "firm_name string, tenant string, total long")
    assert boards.verify_tenants(df).first().verified == want


def test_tokens(spark):
    get = lambda c: spark.range(1).select(c.alias("t")).first().t
    assert get(names.tenant_tokens(F.lit("dbs"), F.lit("DBS Bank")))[0] == "dbs"
    assert all(len(t) >= 3 for t in get(names.board_tokens(F.lit("ge"), F.lit("GE"))))


def test_blocking_match_and_best(spark):
    firms = spark.createDataFrame([("openai", "OpenAI"), ("ge", "General Example")],
                                  "firm_id string, firm_name string")
    posts = spark.createDataFrame(
        [("ashby", "openai", i, "Singapore" if i < 2 else "London", "", "") for i in range(5)]
        + [("lever", "openai", 0, "London", "", ""), ("ashby", "generalexample", 0, "x", "", "")],
        "platform string, token string, posting_ord int, location string, board_name string, url string")
    census = boards.board_census(posts)
    hits = boards.verify_boards(boards.match_boards(firms, census)).withColumn("board_ord", F.lit(0))
    best = boards.best_board(hits).collect()
    assert [(b.firm_id, b.platform, b.total, b.in_place) for b in best] == [("openai", "ashby", 5, 2)]
    empty = spark.createDataFrame([("ashby", "openai", 0, 0, "", ""), ("ashby", "openaicampus", 3, 1, "", ""),
                                   ("ashby", "openaigrads", 9, 9, "", "")],
                                  "platform string, token string, total long, in_place long, "
                                  "board_name string, sample_url string")
    assert {r.token for r in boards.match_boards(firms, empty).collect()} == {"openai", "openaicampus"}
    sites = spark.createDataFrame(
        [("t", "Trafigura", "h", "t", "Puma_Careers", 9, 1, 0), ("t", "Trafigura", "h", "t", "TrafiguraSite", 5, 4, 1),
         ("u", "Unilever", "h", "u", "TMICC", 9, 0, 0), ("u", "Unilever", "h", "u", "Unilever_Early", 3, 0, 1)],
        "firm_id string, firm_name string, host string, tenant string, site string, total long, "
        "in_place long, site_ord int")
    assert {r.site for r in boards.best_site(sites).collect()} == {"TrafiguraSite", "Unilever_Early"}


def test_budget(spark):
    df = spark.createDataFrame([("a", i % 3, i) for i in range(50)] + [("b", 0, 0)],
                               "g string, p int, n int")
    out = reports.split_budget(df, ["g"], ["p", "n"], 20)
    assert out.count() == 51 and out.filter("in_budget").count() == 21
    inside = {(r.p, r.n) for r in out.filter("in_budget and g = 'a'").collect()}
    assert inside == set(sorted((i % 3, i) for i in range(50))[:20])
