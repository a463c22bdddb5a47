"""Whitening against numpy's own decompositions and exact integers."""

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from boardtide.llm import queries, whitening

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n, rank", [(1, 1), (2, 2), (5, 5), (8, 3), (33, 33), (64, 40)])
def test_factor_and_jacobi_equal_the_eigenvalues(n, rank):
    rng = np.random.default_rng(n)
    b = rng.normal(size=(n, rank)) * 10.0 ** rng.integers(-4, 4, rank)
    a = b @ b.T
    factor = whitening.pivoted_cholesky(a)
    assert factor.shape[1] <= rank and np.abs(factor @ factor.T - a).max() <= 1e-13 * np.abs(a).max()
    # a triangle once the rows are in the order of the pivots
    values, vectors = whitening.one_sided_jacobi(factor)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * np.abs(a).max()
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:len(values)], rtol=1e-9, atol=1e-13 * np.abs(a).max())


def test_rounds_meet_every_pair_once():
    for n in range(0, 9):
        pairs = [(i, j) for a, b in whitening.rounds(n) for i, j in zip(a.tolist(), b.tolist())]
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]
        assert all(len({*a, *b}) == 2 * len(a) for a, b in whitening.rounds(n))


def test_sums_are_exact_for_large_entries():
    y = np.array([[2 ** 50 + 1, -3], [2 ** 51 - 1, 7]], np.int64)
    assert whitening.products(y) == [[int(sum(int(r[i]) * int(r[j]) for r in y)) for j in range(2)] for i in range(2)]
    assert whitening.column_sums(np.full((3000, 1), 2 ** 52)) == [3000 * 2 ** 52]
    x = whitening.scaled(pa.array([[1e300, -0.5 / 1024]], pa.list_(pa.float64())))
    assert x.tolist() == [[whitening.LARGEST, 99_999]]


def by_hand(rows, components=8):
    """What the operator should return, with exact sums and numpy's decomposition."""
    x = np.array([np.floor(1024 * np.array(v, float)).astype(int) + 100_000 for _, v in rows])
    n, sums = len(x), x.sum(0)
    y = x - sums / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(r, sums)) for r in x]
    return n, deviation, y @ vectors / np.sqrt(values), values / np.trace(cov)


def compare(got, rows):
    n, deviation, white, explained = by_hand(rows)
    held = defaultdict(list)
    for r in got:
        held[r.vec_id].append(r)
    assert len(got) == white.size and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    sign = None
    for (vec_id, _), d, w in zip(rows, deviation, white):
        parts = sorted(held[vec_id], key=lambda r: r.component)
        assert [r.component for r in parts] == list(range(1, white.shape[1] + 1))
        assert {int(r.deviation) for r in parts} == {d}
        mine = np.array([r.whitened for r in parts])
        sign = np.sign(mine * w) if sign is None else sign
        assert np.abs(mine - sign * w).max() < 1e-6
        assert np.allclose([r.explained for r in parts], explained, rtol=1e-10)


def test_query_equals_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert all(v is not None and all(c is not None and np.isfinite(c) for c in v) for _, v in rows)
    compare(queries.QUERIES["op12_whiten"](spark, SF).collect(), rows)


def test_what_takes_no_part(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=5) * [3, 1, 1, .5, .1]]) for i in range(60)]
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5),
           (104, [float("inf")] + [0.0] * 4), (105, [1.0, 2.0])]
    schema = "vec_id bigint, embedding array<float>, n int, v string, component double"
    spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in good + bad], schema).repartition(4).write.parquet(f"{tmp_path}/v")
    table = spark.read.parquet(f"{tmp_path}/v")
    compare(whitening.whiten(spark, table).collect(), good)
    assert len(whitening.whiten(spark, table, components=2).collect()) == 120
    # repeated rows count as often as they occur, null ids stay
    twice = whitening.whiten(spark, table.union(table.selectExpr("cast(null as bigint)", "embedding", "n", "v", "component")))
    got = twice.collect()
    assert {r.n for r in got} == {120} and sum(r.vec_id is None for r in got) == 60 * 5


def test_few_or_equal_vectors(spark, tmp_path):
    schema = "vec_id bigint, embedding array<double>"
    for name, rows, ranks in (("one", [(1, [1.0, 2.0])], 0), ("same", [(i, [1.0, 2.0]) for i in range(3)], 0),
                              ("line", [(i, [1.0 * i, 2.0 * i, 0.0]) for i in range(4)], 1), ("none", [], 0)):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        got = whitening.whiten(spark, spark.read.schema(schema).parquet(f"{tmp_path}/{name}")).collect()
        assert len(got) == ranks * len(rows)
        if ranks:
            assert got[0].explained == pytest.approx(1.0) and got[0].identity_error < 1e-12


def test_deviations_beyond_64_bits(spark, tmp_path):
    rows = [(i, [1e12 * (i - 1), 1.0]) for i in range(4)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").write.parquet(f"{tmp_path}/v")
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark, spark.read.parquet(f"{tmp_path}/v")).collect()}
    x = [[1024 * 10 ** 12 * (i - 1) + 100_000, 101_024] for i in range(4)]
    mean = [Fraction(sum(c), 4) for c in zip(*x)]
    assert got == {i: int(sum((4 * (c - m)) ** 2 for c, m in zip(x[i], mean))) for i in range(4)}
