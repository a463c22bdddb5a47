"""Scores as columns against the same scores in plain Python; best scores against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from boardtide.functions import similarity as S
from boardtide.operators import nearest, resolve
from boardtide.operators.fuzzy_join import similar_titles

WORDS = ["data", "analyst", "senior", "graduate", "é漢", "x", "engineer", "of", "2026"]


def _text(rng):
    kind = rng.random()
    if kind < 0.25:
        return "".join(rng.choice("abcé 🙂") for _ in range(rng.randint(0, 12)))
    if kind < 0.5:      # beyond one and two integers of bits
        return "".join(rng.choice("ab c") for _ in range(rng.randint(55, 150)))
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 8)))


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(1)
    rows = [(_text(rng), _text(rng)) for _ in range(1200)] + [("", ""), ("", "a"), (" ", "\t"), ("a" * 60, "a" * 60),
                                                             ("a" * 61, "a" * 61), ("ab" * 60, "ba" * 60)]
    return spark.createDataFrame(rows, "a string, b string").repartition(8).cache()


@pytest.mark.parametrize("name", ["ratio", "token_set_ratio", "partial_ratio"])
def test_columns_equal_plain_python(pairs, name):
    plain = getattr(S, f"_{name}")
    for r in pairs.select("a", "b", getattr(S, name)("a", "b").alias("s")).collect():
        assert r.s == pytest.approx(plain(r.a, r.b), abs=1e-9), r


def test_a_least_score_keeps_all_from_there_on(pairs):
    for least in (50, 88):
        for r in pairs.select("a", "b", S.token_set_ratio("a", "b", least).alias("s")).collect():
            want = S._token_set_ratio(r.a, r.b)
            assert r.s == pytest.approx(want, abs=1e-9) if want >= least else r.s < least


def test_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "a string, b string")
    for fn in (S.ratio, S.token_set_ratio, S.partial_ratio):
        assert [r.s for r in df.select(fn("a", "b").alias("s")).collect()] == [None] * 3


def test_titles_are_joined_without_python(spark):
    titles = spark.createDataFrame([("f", "data analyst"), ("f", "data analysts")], "firm string, title string")
    joined = similar_titles(titles, titles, "firm", "title", 88)
    assert "Python" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 4


def _names(rng, n):
    letters = "abcdefghiklmnoprstu0123"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    words = ["bank", "capital", "asia", "tech", "micro", "x", *made]
    return [" ".join(rng.choice(words) if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(6))
                     for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4]))) for _ in range(n)]


def test_best_scores_equal_all_pairs(monkeypatch):
    rng = random.Random(2)
    for cell in (4, 32):
        monkeypatch.setattr(nearest, "CELL", cell)
        known, asked = _names(rng, 400), _names(rng, 150) + [None, ""]
        found = nearest.NameIndex(known).best(asked)
        for name, (best, _) in zip(asked, found):
            assert best == max(math.floor(S._token_set_ratio(name or "", k)) for k in known)
        # the search ends long before every pair is scored
        assert sum(n for _, n in found) < 0.2 * len(known) * len(asked)
    assert nearest.NameIndex([]).best(["a"]) == [(0, 0)]


def test_blocks_change_nothing(spark):
    rng = random.Random(3)
    known = spark.createDataFrame([(k,) for k in _names(rng, 60)], "k string")
    asked = spark.createDataFrame([(i, n) for i, n in enumerate(_names(rng, 40))], "id int, name string")
    whole = {r.id: r.best_score for r in nearest.best_scores(spark, asked, "name", known, "k").collect()}
    parts = nearest.best_scores(spark, asked, "name", known, "k", block=15).collect()
    assert {r.id: r.best_score for r in parts} == whole and len(parts) == 40
    none = nearest.best_scores(spark, asked, "name", known.limit(0), "k").collect()
    assert {r.best_score for r in none} == {0} and len(none) == 40


def test_every_employer_has_a_score(spark):
    registry = spark.createDataFrame([("asml", "ASML", 0), ("micron", "Micron Technology", 1), ("ge", "GE", 2)],
                                     "firm_id string, firm_name string, registry_ord int")
    aliases = spark.createDataFrame([("name", "Odd Legal", "ge", 0)],
                                    "alias_kind string, alias_value string, firm_id string, alias_ord int")
    names = ["ODD LEGAL", "ASML SINGAPORE", "MICRON TECHNOLOGY OPERATIONS", "MICRO TECHNICS", "", "GE GLOBAL"]
    employers = spark.createDataFrame([(n, "") for n in names], "employer_name string, uen string")
    got = {r.employer_name: (r.basis, r.score) for r in resolve.resolve_employers(employers, registry, aliases).collect()}
    # "ge" is no brand: too short; the best of the others counts
    best = lambda n: max(math.floor(S._token_set_ratio(f, n)) for f in ("asml", "micron technology"))
    assert got == {"ODD LEGAL": ("alias:name", 0), "ASML SINGAPORE": ("exact-name", 0),
                   "MICRON TECHNOLOGY OPERATIONS": ("fuzzy-name", 100), "": ("no-employer-name", 0),
                   "MICRO TECHNICS": ("unmatched", best("micro technics")), "GE GLOBAL": ("unmatched", best("ge global"))}
    off = resolve.resolve_employers(employers, registry, aliases, unmatched=False)
    assert off.filter("basis = 'unmatched' AND score IS NOT NULL").isEmpty()


def test_blocks_are_searched_in_one_pass(spark):
    """A name keeps what it reached in one block, and all cores share the names."""
    rng = random.Random(4)
    known = spark.createDataFrame([(k,) for k in _names(rng, 60)], "k string")
    asked = spark.createDataFrame([(n,) for n in _names(rng, 40)], "name string").coalesce(1)
    found = nearest.best_scores(spark, asked, "name", known, "k", block=15)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    index = nearest.NameIndex(["alpha beta", "alpine gamma"])
    assert index.best(["alfa beta"], [99]) == [(99, 0)] and index.best(["alfa beta"])[0][1] > 0
