"""Exact dedup by deterministic block naming.  DataFrame functions only.

Each text is cut into blocks of a fixed number of code points.  The distinct blocks of the corpus
are sorted and numbered: equal blocks get one integer name, different blocks different ones.  Then
adjacent names are paired, the distinct pairs are sorted and numbered, and so on, until every
document has a single name.  Two texts are equal exactly when block count and name are equal.

Between the two steps of a level a block travels as a 64-bit key and not as text.  Keys that stand
for more than one block are found by counting, and their rows are named by the text itself, so no
result depends on the key being free of collisions.
"""

from pyspark.sql import functions as F

from boardtide.llm.common import Stage, located, numbered, semi_by_row

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 4096


def ascii_lower(text):
    """Lower-case A-Z only; the fast path serves texts without other letters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def blocks_of(text, size=BLOCK):
    """Array of normalised blocks; one empty block for an empty or null text."""
    cut = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.size(cut) == 0, F.array(F.lit(""))).otherwise(F.transform(cut, ascii_lower))


def number(distinct, *order):
    """Sort and number distinct rows.  Stored before use, which fixes the numbers."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def identities(spark, docs, size=BLOCK, key=F.xxhash64, stage=None, row=None):
    """(row, doc_id, text_sha256, n_blocks, name): equal (n_blocks, name) means equal texts.

    `row` is the column of `docs` with its rows' numbers; without one they are numbered here.  A null text counts as empty; ids may
    repeat or be null.  The digest is a result column only and decides nothing.
    """
    stage = stage or Stage(spark, "blocks")
    if row is None:
        docs, row = numbered(stage, docs.select("doc_id", "text"))
    cut = docs.select(
        F.col(row).alias("row"), "doc_id", blocks_of(F.col("text"), size).alias("blocks"))
    rows = stage.keep(cut.select(
        "row", "doc_id", F.sha2(F.array_join("blocks", ""), 256).alias("text_sha256"),
        F.size("blocks").alias("n_blocks"),
        F.transform("blocks", lambda b: key(b)).alias("keys")), "rows")
    cells = cut.select("row", F.posexplode("blocks").alias("pos", "block")).withColumn(
        "key", key(F.col("block")))
    named = stage.keep(number(
        cells.select("key", "block").distinct(), "key", "block").select("key", "name"), "names")
    clash = stage.keep(named.groupBy("key").count().filter("count > 1").select("key"), "clash")
    placed = rows.select("row", "n_blocks", F.posexplode("keys").alias("pos", "key"))
    if clash.isEmpty():
        level = placed.join(named, "key").select("row", "n_blocks", "pos", "name")
    else:
        shared = cells.join(clash, "key", "left_semi")
        exact = stage.keep(number(
            shared.select("key", "block").distinct(), "key", "block").withColumn(
                "name", -1 - F.col("name")), "exact")
        level = (placed.join(clash, "key", "left_anti").join(named, "key")
                 .select("row", "n_blocks", "pos", "name")
                 .unionByName(shared.join(exact, ["key", "block"])
                              .join(rows.select("row", "n_blocks"), "row")
                              .select("row", "n_blocks", "pos", "name")))
    level = stage.keep(level, "level-0")
    most = rows.agg(F.max("n_blocks")).first()[0] or 1
    done, width, step = [level.filter("n_blocks = 1").select("row", "name")], 1, 0
    while width < most:
        width, step = 2 * width, step + 1
        pairs = stage.keep(
            level.filter(F.col("n_blocks") > width // 2)
            .groupBy("row", "n_blocks", F.shiftright("pos", 1).alias("pos")).agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                # a last block without a neighbour: no name is as small as this
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))),
                           F.lit(-2**63)).alias("right")), f"pairs-{step}")
        names = stage.keep(number(
            pairs.select("left", "right").distinct(), "left", "right"), f"names-{step}")
        level = stage.keep(pairs.join(names, ["left", "right"]).select(
            "row", "n_blocks", "pos", "name"), f"level-{step}")
        done.append(level.filter(F.col("n_blocks") <= width).select("row", "name"))
    name = done[0]
    for more in done[1:]:
        name = name.unionByName(more)
    return rows.select("row", "doc_id", "text_sha256", "n_blocks").join(name, "row")


def exact_groups(spark, docs, size=BLOCK, key=F.xxhash64, stage=None, row=None):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and row.

    Of equal texts the row with the largest doc_id stays (null is smallest; of repeated ids one
    row stays).  An empty table gives no rows.
    """
    stage = stage or Stage(spark, "blocks")
    ident = stage.keep(identities(spark, docs, size, key, stage, row), "identities")
    keep = ident.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
    return ident.join(keep, ["n_blocks", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"), "text_sha256", "row")


def drop_copies(spark, docs, size=BLOCK):
    """`docs` (a stored table) without exact copies, all columns kept."""
    stage = Stage(spark, "blocks")
    docs, row = located(stage, docs)
    return semi_by_row(docs, row, exact_groups(spark, docs, size, stage=stage, row=row).filter("kept"))
