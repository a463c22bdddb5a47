"""Similarity literals, employer resolution, and the title join against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from boardtide import schema
from boardtide.functions import names, similarity as S
from boardtide.operators import merge, resolve
from boardtide.operators.fuzzy_join import similar_titles

FIRMS = ["Enterprise Singapore", "ASML", "Macquarie", "ByteDance / TikTok", "Manulife",
         "Qube Research & Technologies", "GE", "Micron Technology"]
IDS = ["enterprisesg", "asml", "macquarie", "bytedance", "manulife", "qube", "ge", "micron"]


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(list(zip(IDS, FIRMS, range(8))),
                                 "firm_id string, firm_name string, registry_ord int")


@pytest.fixture(scope="module")
def aliases(spark):
    return spark.createDataFrame(
        [("uen", "200812345a", "enterprisesg", 0), ("name", "Odd Legal Pte Ltd", "ge", 1),
         ("name", "", "asml", 2)],
        "alias_kind string, alias_value string, firm_id string, alias_ord int")


def _dp_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_subsequence_length_and_literals():
    rnd = random.Random(1)
    for _ in range(400):
        a = "".join(rnd.choice("abcé ") for _ in range(rnd.randint(0, 70)))
        b = "".join(rnd.choice("abcé ") for _ in range(rnd.randint(0, 70)))
        assert S._lcs(a, b) == _dp_lcs(a, b)
    assert round(S._ratio("applied", "appliedmaterials")) == 61
    assert round(S._ratio("arthur", "arthurdlittle")) == 63
    assert round(S._ratio("jump", "jumptrading")) == 53
    assert S._token_set_ratio("national", "national environment agency") == 100
    assert S._token_set_ratio("", "x") == 0 and S._token_set_ratio("a", "b") == 0
    assert round(S._token_set_ratio("data analyst", "data analysts"), 2) == 96.0
    assert S._partial_ratio("dbs", "dbsgroup") == 100 and S._partial_ratio("ms", "xx") == 0


@pytest.mark.parametrize("employer,firm,basis", [
    ("HONG FOOD ENTERPRISE PTE. LTD.", None, "unmatched"),
    ("EMPOWER ENTERPRISE", None, "unmatched"),
    ("HEWLETT PACKARD ENTERPRISE SINGAPORE PTE. LTD.", None, "unmatched"),
    ("ST ENGINEERING ENTERPRISE DIGITAL PTE. LTD.", None, "unmatched"),
    ("GE GLOBAL", None, "unmatched"),
    ("MORE YOGURT PREMIUM PTE. LTD.", None, "unmatched"),
    ("ASML SINGAPORE PTE LTD", "asml", "exact-name"),
    ("BYTEDANCE PTE. LTD.", "bytedance", "exact-name"),
    ("MACQUARIE CAPITAL SECURITIES SINGAPORE PTE LTD", "macquarie", "fuzzy-name"),
    ("QUBE RESEARCH & TECHNOLOGIES SINGAPORE PTE. LTD.", "qube", "exact-name"),
    ("MICRON TECHNOLOGY OPERATIONS PTE. LTD.", "micron", "fuzzy-name"),
    ("ODD LEGAL", "ge", "alias:name"),
    ("  ", None, "no-employer-name"),
])
def test_resolution(spark, registry, aliases, employer, firm, basis):
    df = spark.createDataFrame([(employer, "")], "employer_name string, uen string")
    r = resolve.resolve_employers(df, registry, aliases).first()
    assert (r.firm_id, r.basis) == (firm, basis)


def test_number_alias_wins(spark, registry, aliases):
    df = spark.createDataFrame([("SOME NAME", " 200812345A ")], "employer_name string, uen string")
    r = resolve.resolve_employers(df, registry, aliases).first()
    assert (r.firm_id, r.basis) == ("enterprisesg", "alias:uen")


def test_denoise_is_one_sided(spark):
    r = spark.range(1).select(
        names.compact(F.lit("ASML SINGAPORE PTE LTD"), True).alias("a"),
        names.compact(F.lit("Enterprise Singapore")).alias("b"),
        names.denoise(F.lit("Foo Limited")).alias("c")).first()
    assert tuple(r) == ("asml", "enterprisesingapore", "foo")


def _titles(rnd, n):
    words = ["data", "analyst", "analysts", "engineer", "engineering", "senior", "graduate", "2026",
             "2027", "programme", "program", "software", "developer", "ai", "a", "database"]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))) for _ in range(n)]


def test_title_join_equals_all_pairs(spark):
    rnd = random.Random(3)
    left = [(rnd.choice("xy"), t) for t in _titles(rnd, 130)]
    right = [(rnd.choice("xy"), t) for t in _titles(rnd, 130)]
    for threshold in (88, 75):
        got = {(r.firm, r.title_left, r.title_right) for r in similar_titles(
            spark.createDataFrame(left, "firm string, t string"),
            spark.createDataFrame(right, "firm string, t string"), "firm", "t", threshold).collect()}
        want = {(f, a, b) for f, a in left for g, b in right
                if f == g and S._token_set_ratio(a, b) >= threshold}
        assert got == want


ROW = ("job_key string, firm_id string, source_platform string, external_id string, title string, "
       "apply_url string, posted_date date, employer_name string, post_id string, salary string")


def _postings(spark, rows):
    df = spark.createDataFrame(rows, ROW)
    blank = [F.col(c) if c in ("employer_name",) else
             (F.col("post_id") if c == "mcf_job_post_id" else F.col("salary") if c == "salary_min"
              else F.lit(None).cast("string")) for c in schema.names(schema.EXTRA)]
    return df.select(*[c for c in df.columns if c not in ("employer_name", "post_id", "salary")],
                     F.struct(*[b.alias(n) for b, n in zip(blank, schema.names(schema.EXTRA))])
                     .alias("extra"))


def test_merge(spark, registry, aliases):
    d = dt.date(2026, 8, 10)
    day = lambda n: d + dt.timedelta(days=n)
    rows = [
        ("greenhouse:asml:1", "asml", "greenhouse", "1", "Data Analyst", "https://a/1", d, None, None, None),
        ("greenhouse:asml:2", "asml", "greenhouse", "2", "Data Analyst", "https://a/2", day(30), None, None, None),
        ("greenhouse:asml:3", "asml", "greenhouse", "3", "Field Engineer", "https://a/3", None, None, None, None),
        ("mcf:asml-x:10", "asml-x", "mcf", "10", "DATA ANALYSTS", "https://m/10", day(14), "ASML SINGAPORE PTE LTD", "p10", "1"),
        ("mcf:asml-x:11", "asml-x", "mcf", "11", "Data Analyst (Graduate)", "https://m/11", None, "ASML PTE LTD", "p11", "2"),
        ("mcf:asml-x:12", "asml-x", "mcf", "12", "Data Analyst", "https://m/12", day(16), "ASML PTE LTD", "p12", "3"),
        ("mcf:asml-x:13", "asml-x", "mcf", "13", "Field Engineer", "https://m/13", day(99), "ASML PTE LTD", "p13", "4"),
        ("mcf:asml-x:14", "asml-x", "mcf", "14", "Data Analyst", "https://m/14", day(60), "ASML PTE LTD", "p14", "5"),
        ("mcf:yog:15", "yog", "mcf", "15", "Data Analyst", "https://m/15", d, "MORE YOGURT", "p15", "6"),
    ]
    m = merge.merge_sources(_postings(spark, rows), registry, aliases)
    folded = {r.external_id: r.twin_key for r in m.folded.collect()}
    assert folded == {"10": "greenhouse:asml:1", "11": "greenhouse:asml:1", "12": "greenhouse:asml:2",
                      "13": "greenhouse:asml:3"}
    kept = {r.job_key: r for r in m.postings.collect()}
    assert set(kept) == {"greenhouse:asml:1", "greenhouse:asml:2", "greenhouse:asml:3", "mcf:asml:14"}
    assert kept["mcf:asml:14"].raw_job_key == "mcf:asml-x:14"
    one = kept["greenhouse:asml:1"]
    assert (one.apply_url, one.extra.mcf_job_id, one.extra.mcf_url, one.extra.salary_min) == (
        "https://a/1", "p11", "https://m/11", "2")
    assert [tuple(r) for r in merge.summarise_candidates(m.candidates).collect()] == [("MORE YOGURT", 1)]
    assert m.resolutions.filter("basis = 'unmatched'").count() == 1


def test_a_hot_group_of_copies(spark):
    """One firm, one title, thousands of copies on both sides: every row finds the first twin."""
    n, d = 3000, dt.date(2026, 8, 10)
    boards = spark.range(n).select(
        F.lit("f").alias("firm_id"), F.lit("Data Analyst").alias("title"), F.lit(d).alias("posted_date"),
        F.format_string("k%05d", "id").alias("job_key"))
    portal = spark.range(n).select(
        F.lit("f").alias("firm_id"), F.lit("data analysts").alias("title"), F.lit(d).alias("posted_date"), "id")
    out = merge.find_twins(portal, boards, ["job_key"])
    assert out.count() == n and [r[0] for r in out.select("twin_key").distinct().collect()] == ["k00000"]
