"""Session helpers: settings the operators rely on, and size-checked broadcasting."""

import tempfile
import uuid

from pyspark.sql import SparkSession, functions as F

# A side is only broadcast after it was counted and found to be at most this many rows.
BROADCAST_ROWS = 200_000


def build_session(master=None, shuffle_partitions=None, app="boardtide"):
    """A session with the settings the engine assumes.  `master` only for tests and benches."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # rule matching and scoring cost far more than their bytes suggest, so small partitions
        # are merged only down to the number of cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_root(spark):
    """The shared folder the cluster names; a temporary one only where none is set (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="boardtide-")
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def broadcast_if_small(df, max_rows=BROADCAST_ROWS):
    """Hint a broadcast only when a bounded count proves the side is small.

    The count stops at `max_rows + 1` rows, so a large side costs a short scan and is then left
    to the planner (shuffle join with AQE skew handling).  Nothing is dropped either way.
    """
    few = df.select(F.lit(1).alias("one")).limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def table_stage(spark):
    """A `stage(df, name)` that writes `df` to the shared folder and reads it back.

    The stored table survives the loss of executors, and branches that share it do not compute
    it again.
    """
    base = f"{checkpoint_root(spark)}/stage-{uuid.uuid4().hex}"

    def stage(df, name):
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    stage.folder = base
    return stage
