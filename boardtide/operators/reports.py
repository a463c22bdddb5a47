"""Counts, facets, health and budgets: small results over large tables."""

from pyspark.sql import Observation, functions as F, Window as W

from boardtide import fixed
from boardtide.operators.asof import newest_per_source


def count_by(df, *columns, name="postings"):
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def status_counts(curated):
    """Eligible, non-internship rows per status."""
    return count_by(curated.filter(F.col("is_grad") & ~F.col("is_internship")), "status")


def family_counts(view):
    """Rows per family with the group total beside them, from one pass over the rows."""
    per_family = count_by(view, "family_group", "job_family")
    per_group = per_family.groupBy("family_group").agg(F.sum("postings").alias("group_postings"))
    return per_family.join(per_group, "family_group")


def headline(view):
    return view.agg(
        F.count("*").alias("matching"), F.count_if(F.col("new") != "").alias("new_rows"),
        F.countDistinct("firm_name").alias("firms"),
        F.countDistinct("job_family").alias("families"))


def facets(df, columns):
    """Distinct non-blank values of several columns as (facet, value), in one aggregation."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value"))
                                for c in columns]))
    return (df.select(pairs.alias("p")).select("p.facet", "p.value")
            .filter(F.coalesce(F.col("value"), F.lit("")) != "").distinct())


def platform_health(outcomes, platforms=None, threshold=fixed.BROKEN_THRESHOLD):
    """Newest read of each platform: firms tried, readable, rows, failure rate, broken flag.

    `platforms` (a frame with `source`) adds platforms that never wrote an outcome.
    """
    newest = newest_per_source(outcomes)
    out = newest.groupBy("source").agg(
        F.max("snapshot_date").alias("snapshot_date"), F.count("*").alias("firms_attempted"),
        F.count_if("ok").alias("firms_ok"), F.sum("row_count").alias("rows"))
    if platforms is not None:
        out = platforms.select("source").distinct().join(out, "source", "left").na.fill(
            0, ["firms_attempted", "firms_ok", "rows"])
    rate = F.coalesce(1.0 - F.try_divide(F.col("firms_ok"), F.col("firms_attempted")), F.lit(1.0))
    return out.withColumn("failure_rate", rate).withColumn(
        "broken", F.col("snapshot_date").isNull() | (F.col("failure_rate") >= threshold)
        | (F.col("rows") == 0))


def read_failures(outcomes):
    """Failed reads of each platform's newest day."""
    return newest_per_source(outcomes).filter(~F.col("ok")).select(
        F.col("source").alias("platform"), "firm_id",
        F.coalesce(F.nullif(F.col("error"), F.lit("")), F.lit("unknown error")).alias("error"))


def ingest_summary(outcomes):
    return outcomes.agg(F.sum("row_count").alias("postings"), F.count("*").alias("firms"),
                        F.count_if(~F.col("ok")).alias("failed"))


class RunCounters:
    """What a merge run kept, folded, left as candidates and found for graduates, observed while its
    two tables are written: the passes that write them count them.

    `portal_rows` is how many portal rows went in; those that are neither kept nor candidates were
    folded into a twin.
    """

    def __init__(self, portal_rows, portal=fixed.PORTAL_PLATFORM):
        self.portal_rows, self.portal = portal_rows, portal
        self._kept, self._left = Observation(), Observation()

    def curated(self, df):
        """`df` as it is; writing it counts it."""
        return df.observe(self._kept, F.count(F.lit(1)).alias("kept"), F.count_if("is_grad").alias("graduate"),
                          F.count_if(F.col("source_platform") == self.portal).alias("portal"))

    def candidates(self, df):
        return df.observe(self._left, F.coalesce(F.sum("postings"), F.lit(0)).alias("candidates"))

    def get(self):
        kept, left = self._kept.get, self._left.get
        return {"kept": kept["kept"], "graduate": kept["graduate"], "candidates": left["candidates"],
                "merged": self.portal_rows - left["candidates"] - kept["portal"]}


class ReadCounters:
    """`ingest_summary` observed while outcomes are written."""

    def __init__(self):
        self._seen = Observation()

    def outcomes(self, df):
        return df.observe(self._seen, F.coalesce(F.sum("row_count"), F.lit(0)).alias("postings"),
                          F.count(F.lit(1)).alias("firms"), F.count_if(~F.col("ok")).alias("failed"))

    def get(self):
        return dict(self._seen.get)


def top_per_group(df, group, order, k):
    """First `k` rows of each group in `order`.

    The rank filter lets Spark keep only k rows per group and task before the shuffle (window
    group limit), so a hot group ships k rows per task, not all of its rows.
    """
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def split_budget(df, group, order, k):
    """All rows with `in_budget`: true for the first `k` of each group in `order`.

    `order` lists ascending columns and ends in one that is unique within the group.  Only the
    top rows are ever ranked; their last one is the group's cut, and every row is compared with
    the cut of its group, so a hot group is never sorted whole in one task.
    """
    place = F.struct(*[F.col(c) for c in order])
    cut = (top_per_group(df.select(*group, *[c for c in order if c not in group]), group, order, k)
           .groupBy(*group).agg(F.max(place).alias("_cut")))
    return (df.join(cut, group, "left")
            .withColumn("in_budget", place <= F.col("_cut")).select(*df.columns, "in_budget"))


def curated_totals(curated):
    """measure, n: rows, graduate rows that are no internships, and these by status."""
    grads = F.col("is_grad") & ~F.col("is_internship")
    counts = curated.agg(F.count("*").alias("rows"), F.count_if(grads).alias("graduate rows"), *[
        F.count_if(grads & (F.col("status") == s)).alias(f"graduate rows, {s}") for s in fixed.STATUSES])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").alias("n")) for c in counts.columns])))


def daily_report(day, parts):
    """Report text of `parts`, (heading, DataFrame in order, rows to show): a table per part.

    The frames were reduced on the cluster.  A part that shows fewer rows than there are says how
    many more; empty parts are left out."""
    lines = [f"# Board reads of {day}"]
    for heading, df, shown in parts:
        rows = df.limit(shown + 1).collect()
        if not rows:
            continue
        cells = [[_cell(v) for v in r] for r in rows[:shown]]
        lines += ["", f"### {heading}", "", *(" | ".join(c) for c in [df.columns, ["---"] * len(df.columns), *cells])]
        if len(rows) > shown:
            lines += ["", f"... and {df.count() - shown} more"]
    return "\n".join(lines) + "\n"


def _cell(v):
    """One table cell: no line break or bar, nothing for null."""
    return "" if v is None else str(v).replace("|", "/").replace("\n", " ")


def health_parts(health, failures, candidates, curated, registry_counts, scores):
    """The parts of the daily report, each small: reads by source, failed reads, the registry by
    status, the classifier's scores, the curated table, employers outside the registry."""
    return [
        ("Reads by source", health.orderBy("source"), len(fixed.PLATFORMS) * 10),
        ("Failed reads, whose postings stay as they were", failures.orderBy("platform", "firm_id"), fixed.FAILURES_REPORTED),
        ("Firms of the registry", registry_counts.orderBy(F.desc("firms")), 100),
        ("Classifier on the labels", scores, 1),
        ("Curated table", curated_totals(curated), 100),
        ("Busiest employers outside the registry", candidates, fixed.CANDIDATES_REPORTED),
    ]
