"""Cross-entropy difference of two n-gram models over one vocabulary.

The vocabulary is that of a public tokenizer.  Both models are bigrams of its ids, backed off to
unigrams by Dirichlet smoothing and to the uniform distribution over the vocabulary:
    p(b | a) = (c(a b) + MASS * p(b)) / (c(a) + MASS),   p(b) = (c(b) + 1) / (N + V)
The background counts every document, the target those documents `is_target` marks.  A document's
score is the mean over its ids of the target's loss minus the background's: lower is more like
the target.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from boardtide.llm.common import Stage, map_batches, numbered
from boardtide.llm.packing import token_bytes, tokenizer

MASS = 20.0
#: Ids of a block: documents that lie together, whose pairs are priced together.
BLOCK = 1 << 22
_CHUNKS = {}


def pairs_of(ids, start):
    """The key of each pair of neighbouring ids; `start` stands before the first one."""
    return np.concatenate([np.array([start], np.int64), ids[:-1]])[:len(ids)] * (start + 1) + ids


def encode(spark, docs, vocabulary, block=BLOCK):
    """(block, doc_id, ids, keys, ns, ts) of each document, and the size of the vocabulary.

    A block is a run of documents of one partition.  The pairs of a slice of documents, with how
    often they occur in it and how often in target documents, stand in the slice's first row.
    """
    with open(vocabulary, encoding="utf-8") as f:
        data = f.read()
    start = tokenizer(data, vocabulary).get_vocab_size()
    shared = spark.sparkContext.broadcast(data)
    at = {}

    def run(batch):
        from pyspark import TaskContext

        # a worker serves one task after the other
        task = TaskContext.get().taskAttemptId()
        if at.get("task") != task:
            at.update(task=task, block=TaskContext.get().partitionId() << 40, ids=0)
        found = [np.frombuffer(ids, "<u4").astype(np.int64) for ids in token_bytes(
            tokenizer(shared.value, vocabulary), batch["text"], _CHUNKS.setdefault(vocabulary, {}))]
        every = np.concatenate([pairs_of(ids, start) for ids in found])
        keys, where = np.unique(every, return_inverse=True)
        target = np.repeat(batch["target"], [len(ids) for ids in found]).astype(bool)
        none = [[]] * (len(found) - 1)
        out = {"block": [at["block"]] * len(found), "doc_id": batch["doc_id"],
               "ids": [ids.astype(np.int32) for ids in found], "keys": [keys, *none],
               "ns": [np.bincount(where, minlength=len(keys)), *none],
               "ts": [np.bincount(where[target], minlength=len(keys)), *none]}
        at["ids"] += len(every)
        if at["ids"] >= block:
            at.update(block=at["block"] + 1, ids=0)
        return out

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(
        docs.select("doc_id", "target", "text"), run,
        f"block bigint, doc_id {kind}, ids array<int>, keys array<bigint>, ns array<bigint>, "
        "ts array<bigint>", 512), start


def score(spark, docs, is_target, vocabulary, stage=None, block=BLOCK):
    """doc_id, n_tokens, target_loss, background_loss, score; natural logarithms per id.

    `is_target` is a boolean column over `docs` (null: no).  A text without ids has no losses
    (null) and a score of 0.  Without target documents the target model is uniform.  Repeated rows
    count as often as they occur.

    Pairs are counted by block before they move, and each block asks for the losses of a pair
    once, however many of its documents hold it.  Sums by id have a row per entry of the
    vocabulary at most, which bounds what is broadcast; `block` bounds what a worker holds.
    The texts that `labelled_target` stored in `stage` are removed once they are encoded.
    """
    stage = stage or Stage(spark, "lm")
    coded, start = encode(spark, docs.select(
        "doc_id", F.coalesce(is_target, F.lit(False)).alias("target"), "text"), vocabulary, block)
    rows = stage.keep(coded, "rows", "zstd")
    stage.drop("numbered")
    asked = stage.keep(rows.select("block", F.explode(F.arrays_zip("keys", "ns", "ts")).alias("p")).groupBy(
        F.col("p.keys").alias("key"), "block").agg(
            F.sum("p.ns").alias("n"), F.sum("p.ts").alias("t")), "asked", "zstd")
    grams = stage.keep(asked.groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "grams", "zstd")
    grams = grams.select("*", F.expr(f"key div {start + 1}").alias("a"), (F.col("key") % (start + 1)).alias("b"))
    total = grams.agg(F.sum("n"), F.sum("t")).first()
    sums = lambda by, *names: F.broadcast(grams.groupBy(by).agg(
        F.sum("n").alias(names[0]), F.sum("t").alias(names[1])))

    def loss(pair, first, one, mass):
        base = (one + 1.0) / F.lit(float((mass or 0) + start))
        return -F.log((pair + MASS * base) / (first + MASS))

    priced = grams.join(sums("a", "an", "at"), "a").join(sums("b", "bn", "bt"), "b").select(
        "key", loss(F.col("n"), F.col("an"), F.col("bn"), total[0]).alias("back"),
        loss(F.col("t"), F.col("at"), F.col("bt"), total[1]).alias("goal"))
    prices = asked.select("block", "key").join(priced.hint("shuffle_hash"), "key")

    def losses(docs, prices):
        """A document's sums; all documents of the block come with all pairs of the block."""
        keys, goal, back = (prices[c].to_numpy() for c in ("key", "goal", "back"))
        order = np.argsort(keys)
        keys, goal, back = keys[order], goal[order], back[order]
        ids = docs["ids"].combine_chunks()
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype(np.int64)
        sums = []
        for i, end in zip(ends[:-1], ends[1:], strict=True):
            at = np.searchsorted(keys, pairs_of(flat[i:end], start))
            sums.append((end - i, goal[at].sum(), back[at].sum()))
        n, goal, back = np.array(sums).T
        return pa.table([docs["doc_id"], pa.array(n.astype(np.int64)), goal, back],
                        names=["doc_id", "n_tokens", "goal", "back"])

    kind = dict(docs.dtypes)["doc_id"]
    found = rows.select("block", "doc_id", "ids").groupBy("block").cogroup(prices.groupBy("block")).applyInArrow(
        losses, f"doc_id {kind}, n_tokens bigint, goal double, back double")
    mean = lambda c: F.when(F.col("n_tokens") > 0, c / F.col("n_tokens"))
    return found.select(
        "doc_id", "n_tokens", mean(F.col("goal")).alias("target_loss"), mean(F.col("back")).alias("background_loss"),
        F.coalesce(mean(F.col("goal") - F.col("back")), F.lit(0.0)).alias("score"))


def labelled_target(docs, labels, stage=None):
    """`docs` with `__target`: whether labels call the document good and not toxic.

    Texts do not move to meet their labels: they are stored once with row numbers, ids alone are
    joined, and the rows found come back as bitmaps, a bit a document, which are broadcast.
    """
    stage = stage or Stage(docs.sparkSession, "lm")
    docs, row = numbered(stage, docs.select("doc_id", "text"))
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    place = F.col(row) + 1              # bitmaps count from 1
    bits = docs.select("doc_id", place.alias("place")).join(good, "doc_id", "left_semi").groupBy(
        F.bitmap_bucket_number("place").alias("__bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bits"))
    at = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.getbit(byte, F.pmod(at, F.lit(8))) == 1
    return docs.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("__bucket"), "left").select(
        "doc_id", "text", F.coalesce(set_, F.lit(False)).alias("__target"))
