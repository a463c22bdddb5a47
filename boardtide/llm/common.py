"""Helpers of the operators: stored intermediate tables, row numbers, Arrow batch mapping."""

import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from boardtide.session import checkpoint_root
from boardtide.sources.snapshots import delete_folder


class Stage:
    """Intermediate tables in the folder named by `spark.checkpoint.dir`.

    A stored table survives the loss of executors, cuts the lineage, and freezes values that
    depend on the order of rows (row numbers, integer names).
    """

    #: Whether shuffle files go as soon as the query that wrote them has ended.
    CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark, name):
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df, name, codec="snappy", clean=False):
        """`df` stored and read back.  `clean`: the shuffle files of the write do not outlast it."""
        before = self.spark.conf.get(self.CLEAN, None)
        if clean:
            self.spark.conf.set(self.CLEAN, "true")
        try:
            df.write.option("compression", codec).parquet(f"{self.base}/{name}")
        finally:
            if clean:
                self.spark.conf.unset(self.CLEAN) if before is None else self.spark.conf.set(self.CLEAN, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, name=""):
        """Remove a table that nothing lazy reads any more; without a name, all of them."""
        delete_folder(self.spark, f"{self.base}/{name}".rstrip("/"))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row(df, name="row"):
    """A number per row, needed because ids may repeat or be null.  Good for one scan only: how a
    table is split, and so the numbers, depends on the executors of the moment.  Where rows meet
    their numbers again, use `numbered`."""
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(stage, df):
    """`df` stored once with a number per row, and the number's column, one that `df` lacks."""
    row = free_name(df, "row")
    return stage.keep(with_row(df, row), "numbered", "zstd"), row


def located(stage, docs):
    """`docs`, a stored table, with a number per row, and the number's column.

    The number is the place of a row in its file, after the file's place among the sorted names; it
    is the same in every scan, so texts are not stored again.  What is not read from files has no
    places and is stored by `numbered`.
    """
    row = free_name(docs, "row")
    path = free_name(docs, "path")
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return numbered(stage, docs)
    names = sorted(r[0] for r in placed.select(path).distinct().collect())
    files = docs.sparkSession.createDataFrame(list(enumerate(names)), f"file bigint, {path} string")
    file = free_name(placed, "file")
    return placed.join(F.broadcast(files.withColumnRenamed("file", file)), path).withColumn(
        row, F.shiftleft(file, 36) + F.col(row)).drop(path, file), row


def free_name(df, name):
    """`name`, lengthened until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def semi_by_row(docs, row, kept):
    """The rows of `docs` whose number in `row` is in the column `row` of `kept`, without it."""
    return with_marks(docs, row, kept, "__kept").filter("__kept").drop(row, "__kept")


def with_marks(docs, row, marked, name):
    """`docs` with a boolean `name`: whether the number in `row` is in the column `row` of `marked`.

    The rows of `docs` do not move: the numbers come as bitmaps, a bit a document, which are
    broadcast.
    """
    place = F.col(row) + 1              # bitmaps count from 1
    bits = marked.select(F.bitmap_bucket_number(F.col("row") + 1).alias("__bucket"), (F.col("row") + 1).alias(
        "__place")).repartition("__bucket").groupBy("__bucket").agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__bits"))
    at = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.getbit(byte, F.pmod(at, F.lit(8))) == 1
    return docs.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("__bucket"), "left").withColumn(
        name, F.coalesce(set_, F.lit(False))).drop("__bucket", "__bits")


def rows_of(docs, row, *columns):
    """row and `columns` of `docs`; the number is in the column `row`, or given now if that is None."""
    return (with_row(docs.select(*columns)) if row is None else
            docs.select(F.col(row).alias("row"), *columns)).select("row", *columns)


def map_batches(df, fn, schema, chunk=512):
    """`fn(dict of lists) -> dict of lists` over slices of Arrow batches of at most `chunk` rows.

    Small slices bound what a Python worker holds when texts are long.
    """
    def run(batches):
        arrow = None
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                out = fn(batch.slice(at, chunk).to_pydict())
                arrow = arrow or pa.schema([(f.name, _arrow_type(f.dataType)) for f in fields])
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    from pyspark.sql import types as T

    fields = T.StructType.fromDDL(schema).fields
    return df.mapInArrow(run, schema)


def _arrow_type(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
