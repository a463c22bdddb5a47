"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

A shingle weighs one, and one more each time its count in the document doubles.  It is a Poisson
process whose rate is its weight and whose arrivals fall on random slots of the signature; a slot
keeps the shingle that arrives first.  Two documents agree in a slot with their probability Jaccard
similarity, which is never below their weighted Jaccard similarity.  Arrivals later than the latest
slot cannot change it, which ends the process.
"""

import hashlib

import numpy as np
from pyspark.sql import Window, functions as F

from boardtide.llm.common import Stage, located, map_batches, numbered, rows_of, semi_by_row, with_marks
from boardtide.llm.components import components
from boardtide.llm.shingles import mix, shingles_of_all, words_of

SLOTS, ROWS = 384, 8       # 48 bands of 8: a pair of similarity 0.8 is missed once in 6,800
SIMILAR = 0.8


def weighted(elements):
    """The distinct `elements`, sorted, their weights, and a further element for each unit of weight
    beyond one: with these, weighted Jaccard similarity is that of plain sets."""
    items, counts = np.unique(elements, return_counts=True)
    weights, further, level = np.ones(len(items)), [np.zeros(0, np.uint64)], 1
    while (more := counts >> level > 0).any():
        weights += more
        with np.errstate(over="ignore"):
            further.append(mix(items[more] + np.uint64(level)))
        level += 1
    return items, weights, np.sort(np.concatenate(further))


def signatures(sets, slots=SLOTS):
    """The shingle that arrives first in each slot, a row per (elements, weights) of `sets`.  No
    elements: zeros.  All documents of a batch go through the process together."""
    best, held = np.full(len(sets) * slots, np.inf), np.zeros(len(sets) * slots, np.uint64)
    ids = np.concatenate([e for e, _ in sets] or [np.zeros(0, np.uint64)])
    rate = np.concatenate([w for _, w in sets] or [np.zeros(0)]).astype(float)
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    clock, step = np.zeros(len(ids)), 0
    while len(ids):
        n = min(max(1, 4096 // len(ids)), slots)         # draws at once, so that few elements go fast
        draw = np.arange(step, step + n, dtype=np.uint64)[None, :] * np.uint64(2)
        with np.errstate(over="ignore"):
            seed = ids[:, None] + draw * np.uint64(0x9E3779B97F4A7C15)
            unit = ((mix(seed) >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
            slot = (mix(seed + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(slots)).astype(np.int64)
        # summed one by one, so that times do not depend on the number of draws at once
        times = np.cumsum(np.c_[clock, -np.log(unit) / rate[:, None]], axis=1)[:, 1:]
        cell, flat = (owner[:, None] * slots + slot).ravel(), times.ravel()
        np.minimum.at(best, cell, flat)
        first = flat == best[cell]
        held[cell[first]] = np.repeat(ids, n)[first]
        on = times[:, -1] < best.reshape(-1, slots).max(axis=1)[owner]
        ids, rate, owner, clock, step = ids[on], rate[on], owner[on], times[on, -1], step + n
    return held.reshape(-1, slots)


def signature(elements, weights, slots=SLOTS):
    return signatures([(elements, weights)], slots)[0]


def bands(held, rows=ROWS):
    with np.errstate(over="ignore"):
        cut = held.reshape(-1, rows)
        out = np.arange(1, len(cut) + 1, dtype=np.uint64)
        for i in range(rows):
            out = mix(out + cut[:, i])
    return out.view(np.int64)


def sketch(docs, size=5, row=None):
    """row, doc_id, digest (of the lower-cased words), keys (bands), and the numbers of distinct
    shingles and of further ones (as of `weighted`).  The shingles themselves would be larger than
    the texts; `shingle_sets` has them of the few documents that are compared."""
    def run(batch):
        words = [words_of(text) for text in batch["text"]]
        sets = [weighted(x) for x in shingles_of_all(words, size)]
        held = signatures([(items, weights) for items, weights, _ in sets])
        return {
            "row": batch["row"], "doc_id": batch["doc_id"],
            "digest": [hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).digest() for w in words],
            "keys": [bands(h) if len(s[0]) else [] for h, s in zip(held, sets, strict=True)],
            "n_items": [len(s[0]) for s in sets], "n_further": [len(s[2]) for s in sets]}

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(
        rows_of(docs, row, "doc_id", "text"), run,
        f"row bigint, doc_id {kind}, digest binary, keys array<bigint>, n_items int, n_further int", 128)


def shingle_sets(texts, size=5):
    """row, items (distinct shingles) and further (as of `weighted`), both sorted, of `texts` (row, text)."""
    def run(batch):
        sets = [weighted(x) for x in shingles_of_all([words_of(text) for text in batch["text"]], size)]
        return {"row": batch["row"], "items": [s[0].view(np.int64) for s in sets],
                "further": [s[2].view(np.int64) for s in sets]}

    return map_batches(texts, run, "row bigint, items array<bigint>, further array<bigint>", 128)


def near_groups(spark, docs, size=5, similar=SIMILAR, stage=None, row=None):
    """One row per document: doc_id, class_id (doc_id of the row that stays), group_size, kept, row.

    Documents are linked when the Jaccard similarity of their distinct word shingles, or that of
    their weighted ones, is at least `similar`; classes are the connected components.  The first
    row of a class stays.  Texts that differ only in case or white space are one class, empty and
    null texts too.  Texts of fewer than `size` words are one shingle each; long ones are used
    whole.

    The members of a bucket are first checked against its first one.  Where a bucket then still
    holds members of several classes, all of these are checked that share one of their rarest
    shingles, without which they cannot be similar (`candidates`).  Pairs whose sizes rule out the
    similarity never meet their shingles, which are only made of documents in question.
    """
    stage = stage or Stage(spark, "near")
    own = row is None
    if own:
        docs, row = numbered(stage, docs.select("doc_id", "text"))
    texts = rows_of(docs, row, "text")
    all_rows = stage.keep(sketch(docs, size, row), "sketch")
    first = stage.keep(all_rows.groupBy("digest").agg(F.min("row").alias("rep")), "first")
    sizes = all_rows.select("row", F.struct("n_items", "n_further").alias("sizes"))

    def sets_of(rows, name):
        return stage.keep(shingle_sets(with_marks(texts, "row", rows, "asked").filter("asked").drop("asked"), size), name)

    # rows of one key meet once; only those of shared buckets go on
    bucket = Window.partitionBy("key")
    live = stage.keep(with_marks(all_rows.select("row", "keys"), "row", first.select(F.col("rep").alias("row")), "is_rep").filter(
        "is_rep").select("row", F.explode("keys").alias("key")).withColumn("hub", F.min("row").over(bucket)).withColumn(
            "last", F.max("row").over(bucket)).filter("hub < last").drop("last"), "live")
    pairs = live.filter("row <> hub").select("row", "hub").distinct()
    pairs = stage.keep(pairs.join(sizes, "row").join(
        sizes.select(F.col("row").alias("hub"), F.col("sizes").alias("hub_sizes")), "hub").filter(
            sizes_allow(F.col("sizes"), F.col("hub_sizes"), similar)).select("row", "hub"), "pairs-0")
    links = stage.keep(verify(pairs, sets_of(pairs.select("row").union(pairs.select("hub")), "sets-0"), similar).filter(
        "ok").select(F.col("row").alias("a"), F.col("hub").alias("b")), "links-0")
    stage.drop("sets-0")
    label_stage = Stage(spark, "near-links-0")
    label = components(label_stage, links)
    rest = live.select("key", "row").join(label, live.row == label.node, "left").select(
        "key", "row", F.coalesce("label", "row").alias("comp"))
    rest = stage.keep(rest.withColumn("least", F.min("comp").over(bucket)).withColumn(
        "most", F.max("comp").over(bucket)).filter("least < most").groupBy("row", "comp").agg(
            F.collect_list("key").alias("keys")), "rest")
    if not rest.isEmpty():
        sets = sets_of(rest, "sets-1")
        pairs = stage.keep(candidates(stage, rest, sets, similar), "pairs-1")
        more = verify(pairs, sets, similar).filter("ok").select(F.col("row").alias("a"), F.col("hub").alias("b"))
        more = stage.keep(links.union(more), "links-1")
        label_stage.drop()
        label_stage = Stage(spark, "near-links-1")
        label = components(label_stage, more)
    out = all_rows.select("row", "doc_id", "digest").join(first, "digest").join(
        label, F.col("rep") == label.node, "left").withColumn("rep", F.coalesce("label", "rep"))
    out = stage.keep(out.select("row", "doc_id", "rep"), "classes")
    for name in ["sketch", "first", "live", "rest", *["numbered"] * own, "prefixes",
                 *[f"{x}-{i}" for x in ("pairs", "links") for i in (0, 1)], "sets-1"]:
        stage.drop(name)
    label_stage.drop()
    classes = out.groupBy("rep").agg(
        F.max(F.when(F.col("row") == F.col("rep"), F.col("doc_id"))).alias("class_id"),
        F.count("*").alias("group_size"))
    return out.join(classes, "rep").select(
        "doc_id", "class_id", "group_size", (F.col("row") == F.col("rep")).alias("kept"), "row")


def candidates(stage, rest, sets, similar):
    """Pairs (row, hub) of `rest` (row, comp, keys) that share a key, are of different comps, and
    whose `sets` (row, items, further) can be similar.

    Of two sets of n and m elements that are similar, at least similar * (n + m) / (1 + similar) are
    common.  With elements in one order for all sets, the rarest first, the first common one has so
    many from it on in both sets.  So only the rarest shingles of a document are joined, and those
    that lie too far back in either set for the sizes of the two are left out: no pair is lost.
    Weighted sets count only where both documents have further elements; else the similarity of the
    weighted sets is not above that of the plain ones.
    """
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("items").alias("all")),
                    F.struct(F.lit(1).alias("kind"), F.concat("items", "further").alias("all")))
    held = sets.select("row", F.explode(F.when(F.size("further") > 0, kinds).otherwise(F.slice(kinds, 1, 1))).alias("s")).select(
        "row", "s.kind", F.size("s.all").alias("n"), F.explode("s.all").alias("item"))
    common = held.groupBy("kind", "item").agg(F.count("*").alias("df")).filter("df > 1")
    # elements of one document only come first and never meet
    own = Window.partitionBy("row", "kind")
    least = lambda n, m: similar / (1 + similar) * (n + m) - 1e-6
    prefixes = stage.keep(held.join(common, ["kind", "item"]).withColumn(
        "at", F.row_number().over(own.orderBy("df", "item")) - 1 + F.col("n") - F.count("*").over(own)).filter(
            F.col("n") - F.col("at") >= similar * F.col("n") - 1e-6).select("row", "kind", "n", "item", "at").join(
                rest, "row"), "prefixes")
    a, b = prefixes.alias("a"), prefixes.alias("b")
    c = lambda name: F.col(name)
    # of two documents the smaller one: the bound for its own size is the lowest it can meet
    b = b.filter(c("n") - c("at") >= least(c("n"), c("n")))
    return a.join(b, (c("a.kind") == c("b.kind")) & (c("a.item") == c("b.item")) & (c("a.comp") != c("b.comp")) & (
        F.struct("b.n", "b.row") < F.struct("a.n", "a.row")) & (
        c("a.n") - c("a.at") >= least(c("a.n"), c("b.n"))) & (c("b.n") - c("b.at") >= least(c("a.n"), c("b.n"))) & (
        F.arrays_overlap("a.keys", "b.keys"))).select(
            F.greatest("a.row", "b.row").alias("row"), F.least("a.row", "b.row").alias("hub")).distinct()


def sizes_allow(a, b, similar):
    """Whether sets of these sizes can be similar: the smaller is no less than that part of the larger."""
    enough = lambda x, y: F.least(x, y) >= similar * F.greatest(x, y)
    return enough(a.n_items, b.n_items) | enough(a.n_items + a.n_further, b.n_items + b.n_further)


def verify(pairs, sets, similar):
    """`pairs` (row, hub) with ok: whether plain or weighted similarity is enough.  `sets` has the
    shingles of all of them (row, items, further); both are stored tables."""
    x = sets.select("row", F.struct("items", "further").alias("x"))
    y = sets.join(pairs.select(F.col("hub").alias("row")).distinct(), "row", "left_semi").select(
        F.col("row").alias("hub"), F.struct("items", "further").alias("y"))
    both = F.size(F.array_intersect("x.items", "y.items"))
    more = both + F.size(F.array_intersect("x.further", "y.further"))
    plain = F.size("x.items") + F.size("y.items")
    enough = lambda common, total: common >= similar * (total - common)
    return pairs.join(x, "row").join(y, "hub").select(
        "row", "hub", (enough(both, plain) | enough(
            more, plain + F.size("x.further") + F.size("y.further"))).alias("ok"))


def drop_near(spark, docs):
    """`docs` (a stored table) with one document of each near-duplicate class."""
    stage = Stage(spark, "near")
    docs, row = located(stage, docs)
    return semi_by_row(docs, row, near_groups(spark, docs, stage=stage, row=row).filter("kept"))
