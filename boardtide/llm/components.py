"""Connected components by smallest labels and pointer jumping over stored tables."""

from pyspark.sql import functions as F


def components(stage, links):
    """node, label (the smallest node of its component) for every node of `links` (a, b).

    Each step takes the smallest label among neighbours and then jumps to that label's own label.
    Sums by node are pre-aggregated; a node with very many links is split by the skew join.
    """
    both = stage.keep(links.select("a", "b").union(links.select("b", "a")).distinct(), "both")
    labels = stage.keep(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels-0")
    total = lambda t: t.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
    before, step = total(labels), 0
    while True:
        step += 1
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = stage.keep(labels.join(near, labels.node == near.a, "left").select(
            "node", F.least("label", "near").alias("label")), f"lower-{step}")
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage.keep(lower.join(target, "label", "left").select(
            "node", F.coalesce("next", "label").alias("label")), f"labels-{step}")
        stage.drop(f"lower-{step}")
        stage.drop(f"labels-{step - 1}")
        now = total(labels)
        if now == before:
            stage.drop("both")
            return labels
        before = now
