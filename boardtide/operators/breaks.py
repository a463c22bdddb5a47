"""Where one reader's lines break into messages, found in parallel.

Greedy packing looks sequential: where a message ends depends on where it began.  But all that a
stretch of lines (a chunk) has to know of what came before is how far the open message reaches and
its number.  So every chunk is walked at once from each of the few lines a message can first break
at, which gives how many messages begin in it and how far the last one reaches.  These answers are
put together chunk by chunk, a few rows for each, and then every chunk knows what it begins with.

Prefix sums are range-partitioned: a running sum inside each range, and the totals of the ranges
before it.  No step holds a reader in one task, and lines' texts take no part in any.

A continuation's header holds its number, so its length depends on how many digits that has.
Chunks are answered for every number of digits; the few in which the digits become more are walked
once their own beginning is known.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, Window as W

from boardtide.session import broadcast_if_small

CHAT, NODE = "chat_id", ["chat_id", "idx"]
PIECE = [CHAT, "chunk"]
#: Lines of a chunk.
CHUNK = 20_000


def chunk_of(idx, limit):
    """The chunk a line is in.  A message has at most `limit` lines and one, so every chunk that is
    full has a break."""
    return F.floor(F.col(idx) / max(CHUNK, 2 * limit + 2)).alias("chunk")


def numbered_sums(stage, items, order, values, name):
    """`items` stored in `order` within chat_id, with `idx` (from 0) and for every (column, sum) of
    `values` the sum of the column over the rows before.

    Only what is read of it later moves again: without the sums, nothing does."""
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(items.repartitionByRange(parts, CHAT, *order).sortWithinPartitions(CHAT, *order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
    inside = W.partitionBy(CHAT, "_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(CHAT).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # a row per range and chat: at most so many per chat as there are ranges
    totals = ranged.groupBy(CHAT, "_part").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"), *[F.sum(c).alias(f"_{s}") for c, s in values])
    offsets = stage(totals.select(CHAT, "_part", "_first", *[
        F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in ("n", *[s for _, s in values])]),
        f"{name}-offsets")
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(s) for c, s in values])
    return local.join(broadcast_if_small(offsets), [CHAT, "_part"]).select(
        *items.columns, (F.col("_at") - F.col("_first") + F.col("_n")).cast("bigint").alias("idx"),
        *[(F.col(s) + F.col(f"_{s}")).cast("bigint").alias(s) for _, s in values])


def _reach(lines, limit, digits):
    """For each line, how far a message that begins with it reaches if its number has so many digits:
    the next one begins with the first line that ends beyond."""
    begin = lines["begin"].to_numpy()
    opening = np.where(lines["numbered"].to_numpy(), lines["more"].to_numpy() + digits, 0)
    return np.maximum(lines["end"].to_numpy(), limit + begin - opening)


def _answers(limit, most_digits):
    """For every line at which a chunk can first break and every number of digits: how many messages
    begin in the chunk and how far the last of them reaches."""
    def answer(key, lines):
        lines = lines.sort_values("idx")
        end, n = lines["end"].to_numpy(), len(lines)
        # a message from before reaches no further than this
        firsts = np.arange(min(n, np.searchsorted(end, lines["begin"].iloc[0] + limit, "right") + 1))
        out = []
        for digits in range(1, most_digits + 1):
            reach = _reach(lines, limit, digits)
            following = np.searchsorted(end, reach, "right")
            at, last, steps = firsts.copy(), firsts.copy(), np.zeros(len(firsts), np.int64)
            going = np.arange(len(firsts))
            while len(going):
                last[going] = at[going]
                steps[going] += 1
                at[going] = following[at[going]]
                going = going[at[going] < n]
            out.append(pd.DataFrame({"chat_id": key[0], "chunk": key[1], "digits": digits, "end": end[firsts],
                                     "steps": steps, "reach": reach[last]}))
        return pd.concat(out)
    return answer


def _follow(key, begun, answers):
    """What each chunk after the one begun with begins with, up to the first in which the number of
    the message gets one more digit, which is marked."""
    if not len(begun) or not len(answers):
        return pd.DataFrame([], columns=["chat_id", "chunk", "reach", "number", "stopped"])
    out, chunk = [], int(begun["chunk"].iloc[0])
    reach, number = int(begun["reach"].iloc[0]), int(begun["number"].iloc[0])
    by_chunk = {k: v for k, v in answers[answers["chunk"] >= chunk].groupby("chunk")}
    while chunk in by_chunk:
        digits, steps, next_reach = len(str(number + 1)), 0, reach
        own = by_chunk[chunk]
        own = own[own["digits"] == digits].sort_values("end")
        first = np.searchsorted(own["end"].to_numpy(), reach, "right")
        if first < len(own):
            steps, next_reach = int(own["steps"].iloc[first]), int(own["reach"].iloc[first])
        stopped = number + steps >= 10 ** digits
        out.append((key[0], chunk, reach, number, stopped))
        if stopped:
            break
        chunk, reach, number = chunk + 1, next_reach, number + steps
    return pd.DataFrame(out, columns=["chat_id", "chunk", "reach", "number", "stopped"])


def _walked(limit, whole):
    """The breaks of a chunk that knows what it begins with; or only what the next one begins with."""
    def walk(key, lines):
        lines = lines.sort_values("idx")
        idx, end = lines["idx"].to_numpy(), lines["end"].to_numpy()
        reach, number, found, by_digits = int(lines["_reach"].iloc[0]), int(lines["_number"].iloc[0]), [], {}
        while (at := int(np.searchsorted(end, reach, "right"))) < len(end):
            number += 1
            digits = len(str(number))
            if digits not in by_digits:
                by_digits[digits] = _reach(lines, limit, digits)
            reach = int(by_digits[digits][at])
            found.append((key[0], int(idx[at]), number))
        if whole:
            return pd.DataFrame(found, columns=["chat_id", "idx", "message_no"])
        return pd.DataFrame([(key[0], key[1] + 1, reach, number)], columns=["chat_id", "chunk", "reach", "number"])
    return walk


def find_breaks(stage, items, limit):
    """chat_id, idx, message_no: the first item of every message but the first.

    `items` is stored: chat_id, idx, begin (sizes of the items before, a line break each), end
    (begin + its own size), first (what a message 1 begins with), more (what a later message that
    begins at this item begins with, without its number's digits; null: nothing, nor a number).
    """
    chunks = items.select(*NODE, chunk_of("idx", limit), "begin", "end", F.col("more").isNotNull().alias("numbered"),
                          F.coalesce("more", F.lit(0)).alias("more"))
    top = items.agg(F.max("idx").alias("n")).first()["n"]
    answers = stage(chunks.groupBy(*PIECE).applyInPandas(
        _answers(limit, len(str((top or 0) + 2))),
        "chat_id string, chunk bigint, digits int, end bigint, steps bigint, reach bigint"), "answers")
    state = "chat_id string, chunk bigint, reach bigint, number bigint"

    def walked(states, whole, layout):
        known = states.select(*PIECE, F.col("reach").alias("_reach"), F.col("number").alias("_number"))
        return chunks.join(broadcast_if_small(known), PIECE).groupBy(*PIECE).applyInPandas(_walked(limit, whole), layout)

    at = stage(items.filter("idx = 0").select(
        CHAT, F.lit(0).cast("bigint").alias("chunk"), F.greatest(F.lit(limit) - F.col("first"), F.lit(-1)).cast("bigint")
        .alias("reach"), F.lit(1).cast("bigint").alias("number")), "chunks-start")
    states, n = at, 0
    # once for the first chunk and once for every digit that a number gets in a later one
    while not at.isEmpty():
        begun = stage(walked(at, False, state), f"chunks-begun-{n}")
        run = stage(begun.groupBy(CHAT).cogroup(answers.groupBy(CHAT)).applyInPandas(
            _follow, state + ", stopped boolean"), f"chunks-{n}")
        states = states.unionByName(run.drop("stopped"))
        at, n = run.filter("stopped").drop("stopped"), n + 1
    return walked(states, True, "chat_id string, idx bigint, message_no bigint")
