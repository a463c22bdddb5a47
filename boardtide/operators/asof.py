"""As-of selection on any table that carries a source and a date."""

from pyspark.sql import functions as F, Window as W


def newest_per_source(df, cutoff=None, source="source", date="snapshot_date", most=10_000):
    """Rows of each source's newest date at or before `cutoff`, each source on its own.

    The maxima, one row per source, are read first.  Up to `most` of them become a broadcast table,
    so that the base is filtered where it lies; beyond that the two are joined by key.
    """
    base = df if cutoff is None else df.filter(F.col(date) <= F.lit(cutoff))
    newest = base.groupBy(source).agg(F.max(date).alias(date))
    few = newest.limit(most + 1).collect()
    if len(few) <= most:
        newest = F.broadcast(df.sparkSession.createDataFrame(few, newest.schema))
    return base.join(newest, [source, date], "left_semi")


def first_wins(df, keys, order):
    """One row per key: the first in `order` (columns that end in a unique one).

    Ranking with a limit of one keeps a single row per key and task before the shuffle, so a
    hot key never ships its copies.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")
