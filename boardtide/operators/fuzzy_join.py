"""Exact similarity join of titles within a block, without comparing all pairs.

Token-set similarity of at least `threshold` between titles p and a can only come about in two
ways, and each leaves a trace to join on:

* by shared tokens.  The score of the shared part against one whole title needs the shared
  tokens to cover threshold/(200-threshold) of that title's length.  So among its rarest
  tokens, the shortest list that is longer than the uncovered rest must hold a shared token
  (subsets are the case with nothing uncovered).
* by small edits between the differing parts.  k insertions and deletions keep at least
  (|p|+|a|)/2 + 1 - 1.5k of the padded character pairs, so both titles must agree on one pair
  among their rarest ones (prefix filtering over the distinct pairs).

Rarity is only an order; any order gives the same result, rarer-first gives the fewest
candidates.  All joins are equi-joins on (block, token) or (block, pair), which AQE can split
when one block is hot.
"""


from pyspark.sql import functions as F, Window as W

from boardtide.functions.similarity import one_if, token_set_ratio

LOWEST = 200 / 3
KEYS = ["block", "kind", "item"]


def _pairs(words):
    """Distinct padded character pairs of all words."""
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.substring(F.concat(F.lit(" "), w, F.lit(" ")), i, F.lit(2))))))


def _items(left, right, block, text):
    """One row per side, title and item, where an item is a token ("t") or a pair ("p")."""
    sides = left.select(F.lit(0).alias("side"), F.col(block).alias("block"), F.col(text).alias("title"))
    sides = sides.unionByName(right.select(
        F.lit(1).alias("side"), F.col(block).alias("block"), F.col(text).alias("title"))).distinct()
    words = F.array_sort(F.array_distinct(F.filter(
        F.split("title", r"(?U)[\s\x{1C}-\x{1F}]+"), lambda w: w != "")))
    titles = sides.withColumn("words", words).withColumn(
        "len", F.length(F.array_join("words", " "))).filter(F.size("words") > 0)
    titles = titles.withColumn("grams", _pairs(F.col("words")))
    row = lambda kind, item, size: F.struct(
        F.lit(kind).alias("kind"), item.alias("item"), size.alias("size"))
    return titles.select("side", "block", "title", "len", F.inline(F.concat(
        F.transform("words", lambda w: row("t", w, F.length(w) + 1)),
        F.transform("grams", lambda g: row("p", g, F.lit(1))))))


def _ranked(items, threshold):
    """Keep all tokens and the deciding pairs, with `rare` on those that must meet a partner."""
    freq = items.groupBy("kind", "item").agg(F.count("*").alias("freq"))
    order = W.partitionBy("side", "block", "title", "kind").orderBy("freq", "item")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edit = (100.0 - threshold) / 100.0
    # a partner keeps at least this share of a title's len + 1 pairs, plus one; a pair that
    # occurs m times is one item and counts for m, so len + 1 - kept + 1 distinct items suffice
    kept = F.ceil(F.lit((0.5 - 1.5 * edit) * 2 / (1 + edit)) * F.col("len") + 1 - 1e-9)
    # the rest that shared tokens may leave uncovered
    uncovered = F.lit(1 - threshold / (200.0 - threshold)) * F.col("len") + 1e-9
    rare = F.when(F.col("kind") == "t", F.col("before") <= uncovered).otherwise(
        F.col("before") <= F.col("len") + 1 - F.greatest(kept, F.lit(1)))
    return (items.join(freq, ["kind", "item"]).withColumn("before", before)
            .select("side", "block", "title", "kind", "item", rare.alias("rare"))
            .filter((F.col("kind") == "t") | F.col("rare")))


def similar_titles(left, right, block, text, threshold, stage=lambda df, name: df):
    """Distinct (block, title_left, title_right, score) with score >= threshold.

    `stage(df, name)` may store the ranked items, which several joins read.  Below LOWEST the edits
    allowed may leave no pair in common, so such a threshold is refused.
    """
    if threshold < LOWEST:
        raise ValueError(f"titles can be joined from a threshold of {LOWEST:.1f} on, not {threshold}")
    ranked = stage(_ranked(_items(left, right, block, text), threshold), "title_items")
    side = lambda n, name, keep: ranked.filter((F.col("side") == n) & keep).select(
        *KEYS, F.col("title").alias(name))
    rare = F.col("rare")
    # common x common is the one combination that never needs to meet
    met = side(0, "tl", rare).join(side(1, "tr", F.lit(True)), KEYS).select("block", "tl", "tr")
    met = met.unionByName(
        side(0, "tl", ~rare).join(side(1, "tr", rare), KEYS).select("block", "tl", "tr"))
    score = token_set_ratio("tl", "tr", threshold)
    return met.distinct().select("*", one_if(score, lambda s: s >= threshold).alias("score")).select(
        F.col("block").alias(block), F.col("tl").alias("title_left"),
        F.col("tr").alias("title_right"), "score")
