"""Folding portal rows into the boards' own rows.

A portal row whose employer resolves to a firm looks for a twin: a row of that firm's own board
with a similar title and a date within the window.  The first such row (in board order) takes
the portal's salary and ids; its apply link is never touched.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from boardtide import fixed
from boardtide.functions import text
from boardtide.operators.fuzzy_join import similar_titles
from boardtide.operators.resolve import resolve_employers
from boardtide.session import broadcast_if_small

ANY, UNDATED = "any", "undated"


@dataclass(frozen=True)
class Merged:
    postings: DataFrame      # rows of the curated table
    candidates: DataFrame    # portal rows whose employer is not in the registry
    folded: DataFrame        # portal rows merged into a twin, with twin_key
    resolutions: DataFrame   # job_key, firm_id, basis, score of every portal row


def _as_is(df, name):
    return df


def _stored_side(df, name, stage):
    """A lookup side: stored first where there is a store, and broadcast if its count is small.

    Without a store the count would compute the side twice, so the planner is left to decide.
    """
    return df if stage is _as_is else broadcast_if_small(stage(df, name))


def find_twins(portal, boards, order, threshold=fixed.TITLE_MATCH_THRESHOLD,
               window=fixed.MERGE_WINDOW_DAYS, stage=_as_is):
    """Add `twin_key`: the first board row of the same firm with a similar title and close date.

    `portal` and `boards` carry firm_id, title, posted_date; `boards` also job_key and `order`.
    `stage(df, name)` may store the lookup, which is small and read more than once.
    Both sides shrink to distinct (firm, title, day) before they meet, titles are matched once
    per pair of distinct titles, and the date window becomes an equi-join on the day: a group of
    identical copies costs one row however large it is.
    """
    low = F.lower("title").alias("t")
    best = F.min(F.struct(*order, F.col("job_key").alias("twin_key"))).alias("best")
    by_day = boards.select("firm_id", low, "posted_date", "job_key", *[
        c for c in order if c != "job_key"]).groupBy("firm_id", "t", "posted_date").agg(best)
    by_day = stage(by_day, "board_days")
    dated = by_day.select("firm_id", F.col("t").alias("title_right"), F.coalesce(
        F.col("posted_date").cast("string"), F.lit(UNDATED)).alias("bucket"), "best")
    ever = (by_day.groupBy("firm_id", F.col("t").alias("title_right"))
            .agg(F.min("best").alias("best"))
            .select("firm_id", "title_right", F.lit(ANY).alias("bucket"), "best"))

    asked = stage(portal.select("firm_id", low, "posted_date").distinct(), "portal_days")
    pairs = similar_titles(asked.select("firm_id", "t"), by_day.select("firm_id", "t"),
                           "firm_id", "t", threshold, stage)
    days = F.transform(
        F.sequence(F.date_sub("posted_date", window), F.date_add("posted_date", window)),
        lambda d: d.cast("string"))
    buckets = F.when(F.col("posted_date").isNull(), F.array(F.lit(ANY))).otherwise(
        F.concat(F.array(F.lit(UNDATED)), days))
    twins = (asked.join(pairs.withColumnRenamed("title_left", "t"), ["firm_id", "t"])
             .select("firm_id", "t", "posted_date", "title_right",
                     F.explode(buckets).alias("bucket"))
             .join(dated.unionByName(ever), ["firm_id", "title_right", "bucket"])
             .groupBy("firm_id", "t", "posted_date").agg(F.min("best").alias("best"))
             .select(F.col("firm_id").alias("f"), "t", F.col("posted_date").alias("d"),
                     F.col("best.twin_key").alias("twin_key")))
    twins = _stored_side(twins, "twins", stage)
    match = ((F.col("firm_id") == F.col("f")) & (F.lower("title") == F.col("t"))
             & F.col("posted_date").eqNullSafe(F.col("d")))
    return portal.join(twins, match, "left").drop("f", "t", "d")


def enrich(boards, folded, order, stage=_as_is):
    """Copy salary and portal ids of the last folded portal row onto its twin."""
    copied = F.struct(
        F.coalesce("extra.mcf_job_post_id", F.lit("")).alias("mcf_job_id"),
        F.col("apply_url").alias("mcf_url"), F.col("extra.salary_min").alias("salary_min"),
        F.col("extra.salary_max").alias("salary_max"),
        F.coalesce("extra.salary_type", F.lit("")).alias("salary_type"))
    newest = (folded.groupBy(F.col("twin_key").alias("job_key"))
              .agg(F.max(F.struct(*order, copied.alias("copied"))).alias("last"))
              .select("job_key", F.col("last.copied").alias("_copied")))
    joined = boards.join(_stored_side(newest, "enrichment", stage), "job_key", "left")
    extra = F.col("extra")
    for name in ("mcf_job_id", "mcf_url", "salary_min", "salary_max", "salary_type"):
        extra = extra.withField(name, F.when(F.col("_copied").isNotNull(), F.col(
            f"_copied.{name}")).otherwise(F.col(f"extra.{name}")))
    return joined.withColumn("extra", extra).select(*boards.columns)


def merge_sources(postings, registry, aliases, order=("source_platform", "job_key"),
                  portal=fixed.PORTAL_PLATFORM, stage=_as_is, best_scores=False):
    """Split board and portal rows, resolve the portal's employers, fold duplicates together.

    The resolved names and the twins feed several branches; with `stage` they are computed once.
    `best_scores` also fills the score of portal rows whose employer matches no firm.

    A portal row without a twin is kept under the resolved firm, so its key changes; the key it
    was stored under stays in `raw_job_key`.
    """
    order = list(order)
    rows = postings.withColumn("raw_job_key", F.col("job_key"))
    boards = rows.filter(F.col("source_platform") != portal)
    sweep = rows.filter(F.col("source_platform") == portal).select(
        "*", F.coalesce("extra.employer_name", F.lit("")).alias("_employer"),
        text.strip(F.coalesce("extra.uen", F.lit(""))).alias("_uen"))

    known = _stored_side(resolve_employers(
        sweep.select(F.col("_employer").alias("employer_name"), F.col("_uen").alias("uen")),
        registry, aliases, unmatched=best_scores), "employers", stage)
    resolved = sweep.join(known.select(
        F.col("employer_name").alias("_employer"), F.col("uen").alias("_uen"),
        F.col("firm_id").alias("_firm"), "basis", "score"), ["_employer", "_uen"], "left")

    candidates = resolved.filter(F.col("_firm").isNull()).select(*rows.columns)
    owned = resolved.filter(F.col("_firm").isNotNull()).select(
        *[F.col("_firm").alias(c) if c == "firm_id" else F.col(c) for c in rows.columns])
    twinned = find_twins(owned, boards, order, stage=stage)
    folded = twinned.filter(F.col("twin_key").isNotNull())
    alone = twinned.filter(F.col("twin_key").isNull()).drop("twin_key").withColumn(
        "job_key", text.job_key("source_platform", "firm_id", "external_id"))
    return Merged(
        postings=enrich(boards, folded, order, stage).unionByName(alone),
        candidates=candidates, folded=folded,
        resolutions=resolved.select("job_key", F.col("_firm").alias("firm_id"), "basis", "score"))


def summarise_candidates(candidates, top=None, order=("job_key",)):
    """Employers outside the registry by number of postings, busiest first; with `top`, so many."""
    name = F.coalesce(text.none_if_empty("extra.employer_name"), F.col("firm_id"))
    ranked = (candidates.groupBy(name.alias("employer"))
              .agg(F.count("*").alias("postings"), F.min(F.struct(*order)).alias("_first"))
              .orderBy(F.desc("postings"), "_first"))
    return (ranked if top is None else ranked.limit(top)).select("employer", "postings")
