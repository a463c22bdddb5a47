"""Packing with breaks found in parallel equals packing line by line."""

import random

import pytest
from pyspark.sql import functions as F

from boardtide.operators import breaks, packing
from boardtide.session import table_stage

def order():
    return [F.asc_nulls_last("family_group"), F.desc_nulls_last("posted_date"), F.asc("job_key")]

LAYOUT = ("chat_id string, family_group string, posted_date date, job_key string, header string, "
          "group_line string, line string")


def readers(spark, repeat, seed):
    rng, rows = random.Random(seed), []
    for chat, n in (("one", 1), ("few", 7), ("many", 900), ("wide", 40), ("odd", 120)):
        for i in range(n):
            group = rng.choice(["A", "B", "C", None]) if chat == "odd" else f"g{i * 4 // n}"
            size = {"wide": rng.choice([5, 400]), "many": rng.randint(0, 60)}.get(chat, rng.randint(0, 30))
            rows.append((chat, group, None, f"k{i:05d}", f"head of {chat}",
                         f"\n<b>{group}</b>" if repeat and group else None, f"{i}:" + "x" * size))
    rows.append(("nolines?", "A", None, "k", "h" * 300, "\n<b>A</b>" if repeat else None, "line"))
    return spark.createDataFrame(rows, LAYOUT).repartition(5)


# all readers, or the long one alone, in parallel
@pytest.mark.parametrize("repeat, limit, long_reader", [(True, 150, 0), (False, 25, 500)])
def test_parallel_equals_line_by_line(spark, repeat, limit, long_reader):
    lines = readers(spark, repeat, limit)
    plain = packing._pack_streamed(lines, order(), limit, repeat).collect()
    got = packing._pack(lines, order(), limit, repeat, long_reader).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))
    numbers = [r.message_no for r in plain if r.chat_id == "many"]
    assert max(numbers) > 100 and sorted(numbers) == list(range(1, len(numbers) + 1))


def test_sums_do_not_depend_on_ranges(spark):
    rng = random.Random(5)
    rows = [(c, i, rng.randint(0, 9)) for c in "ab" for i in range(500)] + [("c", 0, 4)]
    df = spark.createDataFrame(rows, "chat_id string, at int, size int").repartition(7)
    got = {(r.chat_id, r.at): (r.idx, r.begin) for r in breaks.numbered_sums(
        table_stage(spark), df, ["at"], [("size", "begin")], "t").collect()}
    for c in "abc":
        own, total = sorted((i, s) for x, i, s in rows if x == c), 0
        for place, (i, s) in enumerate(own):
            assert got[c, i] == (place, total)
            total += s


def test_one_reader_fills_many_tasks(spark):
    """One reader's lines are summed in as many ranges as there are partitions."""
    items = spark.range(20_000).select(F.lit("a").alias("chat_id"), F.col("id").alias("at"), F.lit(40).alias("wide"))
    stage = table_stage(spark)
    stored = stage(breaks.numbered_sums(stage, items, ["at"], [("wide", "begin")], "r").withColumn(
        "end", F.col("begin") + 39).withColumn("first", F.lit(10)).withColumn("more", F.lit(20)), "s")
    ranges = spark.read.parquet(f"{stage.folder}/r").groupBy("_part").count().collect()
    assert len(ranges) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in ranges) < 5000
    found = breaks.find_breaks(stage, stored, 1000).collect()
    assert sorted(r.message_no for r in found) == list(range(2, len(found) + 2)) and len(found) > 800


@pytest.mark.parametrize("repeat, limit", [(True, 60), (False, 25)])
def test_messages_go_on_over_chunks(spark, monkeypatch, repeat, limit):
    """Numbers get more digits within chunks and messages lie on both sides of a chunk's end."""
    monkeypatch.setattr(breaks, "CHUNK", 52)
    lines = readers(spark, repeat, limit + 1)
    plain = packing._pack_streamed(lines, order(), limit, repeat).collect()
    got = packing._pack(lines, order(), limit, repeat, 0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))


def test_little_is_stored_and_texts_move_twice(spark):
    """What is stored does not grow with the rounds of a search, and breaks are found without texts."""
    lines, stored = readers(spark, True, 9).filter("chat_id = 'many'"), {}
    keep = table_stage(spark)

    def stage(df, name):
        out = keep(df, name)
        stored[name] = out.count(), out.columns
        return out

    packing._pack_parallel(stage, lines, order(), 150, True).collect()
    assert sum(n for n, _ in stored.values()) < 5 * lines.count()
    assert sorted(k for k, (_, columns) in stored.items() if {"text", "message"} & set(columns)) == ["groups", "parts", "ranged"]
