"""Posting lifecycle from dated snapshots.

A key is present (P), absent on a board that was read and not empty (C), or absent on a board
about which nothing is known (U).  Replaying P/C/U per key has a closed form:

* a C after the last P            -> closed, on the first such day
* else a C between first and last -> reposted
* else a view after the last P    -> unknown
* else                            -> open

so no key x day grid is built.  Per key the days seen are one array, per (source, firm) the
closable days are one array; both are bounded by the number of snapshot dates, whatever the
number of rows.
"""

from pyspark.sql import functions as F

from boardtide.session import broadcast_if_small

DAY = ["source", "snapshot_date"]


def closable_firms(postings, outcomes):
    """(source, snapshot_date, firm_id) whose absence of a key may be read as a closure.

    A firm counts when its read succeeded with rows and, where outcomes say so (`complete`), missed
    no part of the board.  Where a source reports a single outcome for the day (a sweep) and it is
    good, every firm present that day counts.
    """
    good = F.coalesce(F.col("ok") & (F.col("row_count") > 0), F.lit(False))
    if "complete" in outcomes.columns:
        good = good & F.coalesce("complete", F.lit(True))
    direct = outcomes.filter(good).select(*DAY, "firm_id")
    sweeps = (outcomes.groupBy(*DAY)
              .agg(F.count("*").alias("n"), F.bool_and(good).alias("good"))
              .filter((F.col("n") == 1) & F.col("good")).select(*DAY))
    present = (postings.select(*DAY, "firm_id")
               .join(broadcast_if_small(sweeps), DAY, "left_semi"))
    return direct.unionByName(present).distinct()


def _last_views(views):
    return views.groupBy("source").agg(F.max("snapshot_date").alias("last_view"))


def last_known_firm(postings):
    """The firm a key belonged to in its newest snapshot."""
    return (postings.groupBy("source", "job_key")
            .agg(F.max(F.struct("snapshot_date", "firm_id")).alias("newest"))
            .select("source", "job_key", F.col("newest.firm_id").alias("firm_id")))


def compute_lifecycle(postings, outcomes, keep=(), views=None):
    """job_key, first_seen, last_seen, status, disappeared_on, times_seen (+ `keep` columns).

    `views` lists the (source, snapshot_date) that were read.  A store knows them from its
    directories; without it they are taken from both frames.  The joins carry no hint: both
    right sides are aggregates whose size AQE knows before it picks the join.
    """
    if views is None:
        views = postings.select(*DAY).unionByName(outcomes.select(*DAY))
    closable = (closable_firms(postings, outcomes)
                .groupBy("source", "firm_id")
                .agg(F.collect_set("snapshot_date").alias("closable_days")))
    keys = (postings.groupBy("source", "job_key")
            .agg(F.collect_set("snapshot_date").alias("days"),
                 F.max(F.struct("snapshot_date", "firm_id")).alias("newest"))
            .select("source", "job_key", "days", F.col("newest.firm_id").alias("firm_id"),
                    F.array_min("days").alias("first_seen"),
                    F.array_max("days").alias("last_seen"),
                    F.size("days").cast("bigint").alias("times_seen")))
    later = F.filter("closable_days", lambda d: d > F.col("last_seen"))
    inside = F.filter("closable_days",
                      lambda d: (d > F.col("first_seen")) & (d < F.col("last_seen")))
    facts = (keys.join(closable, ["source", "firm_id"], "left")
             .join(_last_views(views), "source", "left")
             .select("source", "firm_id", "job_key", "first_seen", "last_seen", "times_seen",
                     "last_view",
                     F.array_min(later).alias("next_closable"),
                     (F.size(F.array_except(inside, F.col("days"))) > 0).alias("was_gone")))
    status = (F.when(F.col("next_closable").isNotNull(), "closed")
              .when(F.col("was_gone"), "reposted")
              .when(F.col("last_view") > F.col("last_seen"), "unknown")
              .otherwise("open"))
    return facts.select(
        "job_key", "first_seen", "last_seen", status.alias("status"),
        F.col("next_closable").alias("disappeared_on"), "times_seen", *keep)


def advance_lifecycle(state, postings, outcomes, date):
    """Fold one day of views into a stored lifecycle: cost follows the keys, not the history.

    `state` carries the lifecycle columns plus `source` and `firm_id`; `postings` and
    `outcomes` are that day's partitions.  Equal to `compute_lifecycle` over all days when
    applied in date order.
    """
    day = F.lit(date).cast("date")
    shut = (closable_firms(postings, outcomes).select("source", "firm_id").distinct()
            .withColumn("shut", F.lit(True)))
    viewed = (postings.select("source").unionByName(outcomes.select("source")).distinct()
              .withColumn("viewed", F.lit(True)))
    here = postings.groupBy("source", "job_key").agg(F.max("firm_id").alias("firm_now"))
    joined = (state.join(here, ["source", "job_key"], "full_outer")
              .withColumn("firm_id", F.coalesce("firm_now", "firm_id"))
              .join(shut, ["source", "firm_id"], "left")
              .join(broadcast_if_small(viewed), "source", "left"))
    present = F.col("firm_now").isNotNull()
    gone = ~present & F.col("viewed").isNotNull() & F.col("shut").isNotNull()
    unread = ~present & F.col("viewed").isNotNull() & F.col("shut").isNull()
    old = F.col("status")
    status = (F.when(present & old.isNull(), "open")
              .when(present & (old == "closed"), "reposted")
              .when(present & (old == "unknown"), "open")
              .when(gone, "closed")
              .when(unread & (old == "open"), "unknown")
              .otherwise(old))
    left_on = (F.when(present, F.lit(None).cast("date"))
               .when(gone & (old != "closed"), day).otherwise(F.col("disappeared_on")))
    return joined.select(
        "job_key", F.coalesce("first_seen", day).alias("first_seen"),
        F.when(present, day).otherwise(F.col("last_seen")).alias("last_seen"),
        status.alias("status"), left_on.alias("disappeared_on"),
        (F.coalesce("times_seen", F.lit(0)) + present.cast("bigint")).alias("times_seen"),
        "source", "firm_id")
