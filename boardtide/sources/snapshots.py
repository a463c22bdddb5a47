"""The append-only snapshot store: two Parquet datasets partitioned by source and date.

    <root>/postings/source=<platform>/snapshot_date=<date>/
    <root>/outcomes/source=<platform>/snapshot_date=<date>/

Which partitions exist is answered from the directory listing, never by scanning data.
"""

import datetime as dt
import re

from pyspark.sql import functions as F, types as T

from boardtide import schema
from boardtide.functions import text

PARTITION = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("snapshot_date", T.DateType()),
])
_DIRECTORY = re.compile(r"source=([^/]+)/snapshot_date=(\d{4}-\d{2}-\d{2})/?$")


def _with_partition(s):
    return T.StructType(s.fields + PARTITION.fields)


def _fs(spark, path):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_exists(spark, path):
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_folder(spark, path):
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _partition_path(root, table, platform, date):
    return f"{root}/{table}/source={platform}/snapshot_date={date}"


def written_partitions(spark, root, table="postings", platform=None):
    """Sorted (platform, date, when its folder last changed); malformed names are ignored."""
    fs, p = _fs(spark, f"{root}/{table}/source={platform or '*'}/snapshot_date=*")
    found = set()
    for status in fs.globStatus(p) or []:
        hit = _DIRECTORY.search(status.getPath().toString())
        if hit and status.isDirectory():
            try:
                found.add((hit.group(1), dt.date.fromisoformat(hit.group(2)), status.getModificationTime()))
            except ValueError:
                continue
    return sorted(found)


def available_snapshots(spark, root, platform=None, table="postings"):
    """Sorted (platform, date) pairs on disk."""
    return [(p, d) for p, d, _ in written_partitions(spark, root, table, platform)]


def platforms_on_disk(spark, root):
    return sorted({p for p, _ in available_snapshots(spark, root)})


def latest_snapshot_date(spark, root):
    dates = [d for _, d in available_snapshots(spark, root)]
    return max(dates) if dates else None


def write_snapshot(spark, root, platform, date, postings, outcomes):
    """Replace one (platform, date) in both datasets; nothing else is touched.

    Outcomes are removed first and written last: a run that dies in between leaves postings
    without outcomes, which the lifecycle reads as "nothing known", never as closures.  Writing
    straight into the partition directory also clears it when there are no postings.
    """
    delete_folder(spark, _partition_path(root, "outcomes", platform, date))
    schema.conform(postings, schema.POSTING).write.mode("overwrite").parquet(
        _partition_path(root, "postings", platform, date))
    schema.conform(outcomes, schema.OUTCOME).write.mode("overwrite").parquet(
        _partition_path(root, "outcomes", platform, date))


def write_snapshots(spark, root, postings, outcomes):
    """Write many (source, snapshot_date) partitions in one job per dataset.

    `rebalance` lets AQE split a partition that holds most of the rows and merge tiny ones, so a
    hot source-day is not written by one task.  Partitions that have outcomes but no postings
    any more are emptied explicitly, since a dynamic overwrite would leave the old rows.
    """
    parts = [f.name for f in PARTITION.fields]

    def write(df, layout, table):
        cols = [F.col(c) for c in parts]
        (schema.conform(df, _with_partition(layout)).hint("rebalance", *cols)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(f"{root}/{table}"))

    seen = outcomes.select(*parts).distinct().join(
        postings.select(*parts).distinct(), parts, "left_anti")
    for row in seen.toLocalIterator():
        delete_folder(spark, _partition_path(root, "postings", row[0], row[1]))
    write(postings, schema.POSTING, "postings")
    write(outcomes, schema.OUTCOME, "outcomes")


def _read(spark, root, table, layout):
    layout = _with_partition(layout)
    if not folder_exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(f"{root}/{table}")


def read_history(spark, root):
    """All partitions of both datasets: (postings, outcomes)."""
    return (_read(spark, root, "postings", schema.POSTING),
            _read(spark, root, "outcomes", schema.OUTCOME))


def view_calendar(spark, root):
    """(source, snapshot_date) of every partition of either dataset, from the listing alone."""
    pairs = set(available_snapshots(spark, root)) | set(
        available_snapshots(spark, root, table="outcomes"))
    return spark.createDataFrame(sorted(pairs), PARTITION)


def _only(df, pairs):
    wanted = F.lit(False)
    for platform, date in pairs:
        wanted = wanted | ((F.col("source") == platform) & (F.col("snapshot_date") == F.lit(date)))
    return df.filter(wanted)


def read_snapshot(spark, root, platform, date):
    """Postings of one partition; typed and empty when it does not exist."""
    return _only(_read(spark, root, "postings", schema.POSTING), [(platform, date)])


def read_outcomes(spark, root, platform, date):
    return _only(_read(spark, root, "outcomes", schema.OUTCOME), [(platform, date)])


def read_day(spark, root, date):
    """One day of all platforms, (postings, outcomes), from the partitions of that day alone."""
    return tuple(_only(_read(spark, root, table, layout), [
        (p, d) for p, d in available_snapshots(spark, root, table=table) if d == date])
        for table, layout in (("postings", schema.POSTING), ("outcomes", schema.OUTCOME)))


def newest_partitions(spark, root, cutoff=None, table="postings"):
    """Newest partition at or before `cutoff`, for each platform on its own."""
    newest = {}
    for platform, date in available_snapshots(spark, root, table=table):
        if cutoff is None or date <= cutoff:
            newest[platform] = max(date, newest.get(platform, date))
    return sorted(newest.items())


def read_newest(spark, root, cutoff=None, table="postings"):
    """As-of scan.  The partitions are known from the listing, so the scan is pruned statically."""
    layout = schema.POSTING if table == "postings" else schema.OUTCOME
    return _only(_read(spark, root, table, layout),
                 newest_partitions(spark, root, cutoff, table))


def as_postings(df):
    """Rehydrate stored rows: null text becomes empty, `extra_json` gains its typed form."""
    out = df
    for c in ("location_raw", "description_text", "department", "employment_type"):
        out = out.withColumn(c, text.blank_to_empty(c))
    return (out.withColumn("posted_date_basis", text.none_if_empty("posted_date_basis"))
            .withColumn("extra", F.from_json(F.coalesce("extra_json", F.lit("{}")), schema.EXTRA)))
