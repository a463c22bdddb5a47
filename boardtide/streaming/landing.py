"""Incremental landing: new response files trigger a rebuild of the days they belong to.

The stream only says which (platform, day) got new responses.  Each such day is normalised
again from everything landed for it and replaces its partition, so a retried or split batch
gives the same store as one run over all files.
"""

import datetime as dt

from pyspark.sql import functions as F

from boardtide import schema
from boardtide.sources import snapshots
from boardtide.sources.payloads import normalise


def land_stream(spark, landing, root, platform, checkpoint, **options):
    """Start the landing query for one platform; it stops when all present files are in.

    `landing` is a folder of Parquet files in the landed layout.  The days touched by a batch
    are few (one per daily run), so collecting them is bounded by the calendar.
    """
    def rebuild(batch, _):
        days = [r[0] for r in batch.select("fetched_on").distinct().collect()]
        everything = batch.sparkSession.read.schema(schema.LANDED).parquet(landing)
        for day in sorted(d for d in days if isinstance(d, dt.date)):
            postings, outcomes = normalise(
                platform, everything.filter(F.col("fetched_on") == F.lit(day)), **options)
            snapshots.write_snapshot(batch.sparkSession, root, platform, day, postings, outcomes)

    return (spark.readStream.schema(schema.LANDED).parquet(landing)
            .writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
