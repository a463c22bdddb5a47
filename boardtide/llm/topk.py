"""Exact top-k by inner product without random access.

Every block of candidates is a set of lists, one per dimension, sorted by value.  For a query the
lists are read in step from their better end.  What was read gives each candidate a lower and an
upper score bound (an unread entry lies between the list's far end and the place reached).
Reading stops when no candidate outside the best k can reach the k-th lower bound; only the
candidates that still can get a final score.
"""

import numpy as np
from pyspark.sql import Window, functions as F

from boardtide.llm.common import Stage, with_row

BLOCK = 4096        # candidates per set of lists
QUERIES = 4096      # queries sent to the tasks at a time: the bound of what is broadcast
TOGETHER = 512      # queries that read the lists of a block together: bounds the matrices held
STEP = 64           # entries read from each list before the bounds are first looked at
FEW = 16            # reading stops when no more than 1 / FEW of the candidates are left
NO_FLOOR = -2 ** 62


def integers(vectors, scale=256):
    """row, vec_id, v: floor(scale * x) of every component; vectors that are null, empty, or hold
    a null or non-finite component take no part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    ok = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return with_row(vectors.select("vec_id", "embedding")).filter(ok).select(
        "row", "vec_id", F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def no_random_access(lists, q, k, floor):
    """Numbers of the candidates that may be among the best k, given that a score must be at
    least `floor`.  `lists` are (order, values): per dimension ascending."""
    return next(read_in_step(lists, np.asarray(q)[None, :], k, np.array([floor], np.int64)))[1]


def read_in_step(lists, queries, k, floors):
    """(number of the query, `no_random_access` of it) for all `queries`, a row each.

    All of them read the same lists to the same depths, from one end where the query is positive
    and from the other where it is negative, so that the bounds of all candidates are products of
    matrices.  A query leaves as soon as few candidates are left to it.
    """
    order, values = lists
    dims, n = order.shape
    if n <= k:
        yield from ((i, np.arange(n)) for i in range(len(queries)))
        return
    # as floats the products are those of a fast library, and exact below 2 ** 53
    size = dims * np.abs(values.astype(float)).max(initial=0) * np.abs(queries.astype(float)).max(initial=0)
    kind = float if size < 2 ** 50 else np.int64
    x, place = np.empty((dims, n), kind), np.empty((dims, n), np.int32)
    np.put_along_axis(x, order, values.astype(kind), axis=1)
    np.put_along_axis(place, order, np.arange(n, dtype=np.int32)[None, :], axis=1)
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    todo, best = np.arange(len(queries)), floors.astype(np.int64)
    for stop in depths(n):
        high, low = place >= n - stop, place < stop                 # what was read
        if (floors[todo] <= NO_FLOOR).any():        # a floor from earlier blocks is mostly better
            least = up[todo] @ np.where(high, x, values[:, :1]) + down[todo] @ np.where(low, x, values[:, -1:])
            best[todo] = np.maximum(best[todo], np.partition(least, n - k, axis=1)[:, n - k].astype(np.int64))
            del least
        most = (up[todo] @ np.where(high, x, values[:, n - stop, None])
                + down[todo] @ np.where(low, x, values[:, stop - 1, None]))
        alive = most >= best[todo, None]
        ends = alive.sum(axis=1) <= (n if stop == n else max(4 * k, n // FEW))
        for i in np.flatnonzero(ends):
            yield int(todo[i]), np.flatnonzero(alive[i])
        todo = todo[~ends]
        if not len(todo):
            return


def depths(n):
    """How many entries of each list of n were read when the bounds are looked at."""
    out, at = [], STEP
    while at < n // 2:
        out.append(at)
        at *= 4
    return [*out, *sorted({-(-n // 2), -(-3 * n // 4), n})]


def _search(shared, k, block):
    def run(batches):
        queries = shared.value
        # scores reached so far in this task: a bound for the blocks that follow
        tops = {i: [] for i in range(len(queries))}
        asked, held = {}, []
        for j, (_, _, q) in enumerate(queries):
            asked.setdefault(len(q), []).append(j)

        def flush():
            rows = np.array([h[0] for h in held], np.int64)
            ids = [h[1] for h in held]
            for width in {len(h[2]) for h in held} & set(asked):
                pick = np.array([i for i, h in enumerate(held) if len(h[2]) == width])
                x = np.array([held[i][2] for i in pick], np.int64).reshape(len(pick), width)
                order = np.argsort(x, axis=0, kind="stable").T
                values = np.take_along_axis(x.T, order, axis=1)
                for at in range(0, len(asked[width]), TOGETHER):
                    mine = asked[width][at:at + TOGETHER]
                    floors = np.array([
                        tops[j][k - 1][0] if len(tops[j]) >= k else NO_FLOOR for j in mine], np.int64)
                    qs = np.array([queries[j][2] for j in mine], np.int64).reshape(len(mine), width)
                    # one more than k: the query's own row may be among them
                    for i, alive in read_in_step((order, values), qs, k + 1, floors):
                        j = mine[i]
                        scores = x[alive] @ qs[i]
                        good = (scores >= floors[i]) & (rows[pick[alive]] != queries[j][0])
                        merged = tops[j] + [
                            (s, ids[p], r) for s, p, r in zip(
                                scores[good].tolist(), pick[alive[good]].tolist(),
                                rows[pick[alive[good]]].tolist(), strict=True)]
                        merged.sort(key=lambda f: (-f[0], f[1] is not None, f[1] or 0, f[2]))
                        tops[j] = merged[:k]
            held.clear()

        for batch in batches:
            for item in batch.to_pylist():
                held.append((item["row"], item["vec_id"], item["v"]))
                if len(held) >= block:
                    flush()
        if held:
            flush()
        import pyarrow as pa

        flat = [(queries[j][0], queries[j][1], c, s, r)
                for j, top in tops.items() for s, c, r in top]
        if flat:
            yield pa.RecordBatch.from_pydict(
                dict(zip(("query_row", "query_id", "vec_id", "score", "row"),
                         map(list, zip(*flat)), strict=True)),
                schema=pa.schema([(c, pa.int64()) for c in
                                  ("query_row", "query_id", "vec_id", "score", "row")]))
    return run


def top_k(spark, vectors, is_query, k=5, scale=256, block=BLOCK, queries=QUERIES):
    """query_id, rank, vec_id, score: each query's k best other rows, ties to smaller vec_id.

    `vectors` is a stored table.  Rows of one vec_id are rows of their own (a copy of the query is
    a candidate); among equal ids the earlier row is first.  Vectors of another width than the
    query's do not meet it.  Queries go to the tasks in slices of about `queries` rows, over which
    the driver loops; it never holds more than one slice.
    """
    stage = Stage(spark, "topk")
    v = stage.keep(integers(vectors, scale), "integers")
    asked = v.filter(is_query)
    parts = max(1, -(-asked.count() // queries))
    found = None
    for part in range(parts):
        mine = asked.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).collect()
        shared = spark.sparkContext.broadcast(
            [(r.row, r.vec_id, np.array(r.v, np.int64)) for r in mine])
        hits = stage.keep(v.mapInArrow(
            _search(shared, k, block),
            "query_row bigint, query_id bigint, vec_id bigint, score bigint, row bigint"),
            f"hits-{part}")
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
