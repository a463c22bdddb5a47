"""Operators and pipeline on small tables: brute force, and nulls, ties, empties, odd columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from boardtide.llm import (
    block_naming, bpe, common, compact_windows, crf, cross_entropy, mincut, packing, pii, prob_minhash, queries,
    topk)

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = " ".join(f"shared{i}" for i in range(60))
LONG = " ".join(f"long{i % 977}x{i}" for i in range(9000))
TEXTS = [
    None, "", "  ", "Same text HERE", "same text here", "same text here", "one",
    " ".join(f"near{i}" for i in range(100)), " ".join(f"near{i}" for i in range(99)) + " other",
    "first " * 3 + PASSAGE + " tail a b", "another start entirely " + PASSAGE + " with other end",
    "Mail a.b@c.org and +1 (504) 555-2652, 240.56.125.154 or 999.1.1.1, card 4111 1111 1111 1111.",
    "key token = \"cf1d64a9a4cd9723e1f4eafc27395915e6868ffa\" é漢 x@y.z", LONG, LONG,
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    rows = [(i, t, "en", "s", len(t or ""), 7, "x", 1.0) for i, t in enumerate(TEXTS)]
    rows += [(None, "null id", None, None, None, None, None, None), rows[5]]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                "row int, name string, __row double").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "empty.parquet")
    docs.limit(0).write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def test_empty_tables(spark, empty):
    labels = empty.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert block_naming.exact_groups(spark, empty).count() == 0
    assert prob_minhash.near_groups(spark, empty).count() == 0
    assert pii.redact(spark, empty).count() == 0
    assert packing.pack_documents(spark, empty, VOCABULARY).count() == 0
    assert crf.keep_good(spark, empty, labels).count() == 0
    assert compact_windows.repeats(spark, empty).count() == 0
    assert cross_entropy.score(
        spark, cross_entropy.labelled_target(empty, labels), F.col("__target"), VOCABULARY).count() == 0
    assert mincut.extract(spark, empty.select(
        F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"))).count() == 0
    assert bpe.encode_documents(spark, empty, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN).count() == 0


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("size, key", [(4096, F.xxhash64), (3, F.xxhash64), (3, lambda b: F.length(b).cast("bigint"))])
def test_exact_groups(spark, docs, size, key):
    if size == 3:
        docs = docs.filter("coalesce(length(text), 0) < 300")
    rows = [(r.doc_id, lower(r.text)) for r in docs.select("doc_id", "text").collect()]
    best, count = {}, Counter(t for _, t in rows)
    for d, t in rows:
        best[t] = d if t not in best or (d is not None and d > best[t]) else best[t]
    got = block_naming.exact_groups(spark, docs, size, key).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == sorted(
        (str(d), str(best[t]), count[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in rows)
    assert sum(r.kept for r in got) == len(best)


def test_near_groups(spark, docs):
    got = prob_minhash.near_groups(spark, docs).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.class_id if r.class_id is not None else "null"].add(r.doc_id)
    assert {0, 1, 2} in groups.values() and {3, 4, 5} in groups.values() and {7, 8} in groups.values()
    # 9 and 10 share 56 of their 68 shingles
    assert {13, 14} in groups.values() and {9, 10} in groups.values() and {6} in groups.values()
    assert sum(r.kept for r in got) == len(groups) and len(got) == len(TEXTS) + 2
    assert prob_minhash.drop_near(spark, docs).columns == docs.columns


def test_near_groups_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        w = (r.text or "").lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(min(1, len(w)), len(w) - 4))}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                top[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.doc_id: r.class_id for r in prob_minhash.near_groups(spark, docs).collect()}
    pairs = lambda of: {(a, b) for a in sets for b in sets if a < b and of(a) == of(b)}
    assert pairs(got.__getitem__) == pairs(find)


def test_shingles_are_made_of_compared_documents_only(spark, docs, monkeypatch):
    met, make = set(), prob_minhash.shingle_sets

    def watch(texts, size):
        met.update(r.text for r in texts.select("text").collect())
        return make(texts, size)

    monkeypatch.setattr(prob_minhash, "shingle_sets", watch)
    assert "items" not in prob_minhash.sketch(docs).columns
    groups = {r.doc_id: r.group_size for r in prob_minhash.near_groups(spark, docs).collect()}
    assert met == set(TEXTS[7:11]) and groups[7] == groups[8] == 2


def test_near_groups_link_what_matches_the_first_with_what_does_not(spark, tmp_path, monkeypatch):
    base = [f"drift{i}" for i in range(120)]
    drift = lambda *ends: " ".join(base[sum(ends):] + [f"{i}end{e}" for e in ends for i in range(e)])
    # 0 and 1 are near, 1 and 2 are near, 0 and 2 are not
    texts = [drift(), drift(10), drift(10, 10), "far away " + drift(60)]
    path = f"{tmp_path}/d"
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(path)
    # one bucket only
    monkeypatch.setattr(prob_minhash, "bands", lambda held: np.ones(1, np.int64))
    got = {r.doc_id: r.class_id for r in prob_minhash.near_groups(spark, spark.read.parquet(path)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3}


def test_near_groups_check_few_pairs_of_a_bucket_of_unlike_members(spark, tmp_path, monkeypatch):
    random = np.random.default_rng(1)
    base, texts = [f"base{i}" for i in range(120)], []
    for i in range(60):
        words = list(base)
        for at in random.choice(120, int(random.integers(1, 12)), replace=False):
            words[at] = f"edit{random.integers(4)}"
        texts.append(" ".join(words + ["again and again and so on"] * int(random.integers(0, 4))))
    path = f"{tmp_path}/d"
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(path)
    # one bucket only
    monkeypatch.setattr(prob_minhash, "bands", lambda held: np.ones(1, np.int64))
    checked, check = [], prob_minhash.verify

    def watch(pairs, sets, similar):
        checked.extend(pairs.collect())
        return check(pairs, sets, similar)

    monkeypatch.setattr(prob_minhash, "verify", watch)
    got = {r.doc_id: r.class_id for r in prob_minhash.near_groups(spark, spark.read.parquet(path)).collect()}
    plain, full = [], []
    for t in texts:
        w = t.split()
        items, _, further = prob_minhash.weighted(np.array([zlib.crc32(" ".join(w[i:i + 5]).encode())
                                                            for i in range(len(w) - 4)], np.uint64))
        plain.append(set(items.tolist()))
        full.append(plain[-1] | set(further.tolist()))
    like = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    top = list(range(60))
    for a in range(60):
        for b in range(a):
            if like(plain[a], plain[b]) or like(full[a], full[b]):
                top = [min(top[a], top[b]) if t in (top[a], top[b]) else t for t in top]
    assert got == dict(enumerate(top)) and 1 < len(set(top)) < 59
    assert len(checked) < 300           # 1,770 pairs meet in the bucket


def test_located_rows_keep_their_numbers_and_texts_are_not_stored(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/d"
    for i in range(3):
        spark.createDataFrame([(f"text {i}", i, "x"), ("same", None, "y")], "text string, row int, path string").coalesce(
            1).write.mode("append").parquet(path)
    docs = spark.read.parquet(path)
    stage = common.Stage(spark, "located")
    one, row = common.located(stage, docs)
    two, again = common.located(stage, docs)
    place = lambda df, r: {(x["text"], x["row"], x[r]) for x in df.repartition(5).collect()}
    assert row == again not in docs.columns and place(one, row) == place(two, again)
    assert len({x[2] for x in place(one, row)}) == 6 and one.drop(row).columns == docs.columns
    marks = one.filter("text = 'same'").select(F.col(row).alias("row"))
    got = common.semi_by_row(one, row, marks)
    assert got.columns == docs.columns and [r.text for r in got.collect()] == ["same"] * 3
    assert common.semi_by_row(one, row, marks.limit(0)).count() == 0

    kept, keep = [], common.Stage.keep
    monkeypatch.setattr(common.Stage, "keep", lambda self, df, name, *a: kept.append(name) or keep(self, df, name, *a))
    docs = docs.withColumnRenamed("row", "doc_id")
    for drop in (block_naming.drop_copies, prob_minhash.drop_near):
        # the word "text" and a digit are one shingle a document
        assert sorted(r.text for r in drop(spark, docs).collect()) == ["same", "text 0", "text 1", "text 2"]
    assert kept and "numbered" not in kept
    # rows that are not read from files are stored with their numbers
    rows = spark.createDataFrame([(1, "a b"), (2, "A  b"), (3, "c")], "doc_id bigint, text string")
    assert sorted(r.text.lower() for r in prob_minhash.drop_near(spark, rows).collect())[1] == "c"
    assert "numbered" in kept


def luhn(d):
    s = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(v - 9 if v > 9 else v for v in s) % 10 == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data_equals_plain_search(spark, docs, tmp_path):
    odd = ["a@b.c_d@e.f", "a@b@c.d.e", "1.2.3.4.5.6.7.8", "00001.2.3.255 x 1.2.3.256", "+1 2 3456789 +12", "1-2 3--4",
           "漢字 é z.z@q.w 🙂 a@b.cd", "4111-1111-1111-1111 4111 1111 1111 1112", "a" * 5000 + "@b", "7" * 30000, "@.@.@"]
    spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    for table in (spark.read.parquet(f"{tmp_path}/d"), docs):
        texts = Counter((r.doc_id, ",".join(plain_spans(r.text))) for r in table.select("doc_id", "text").collect())
        got = pii.find_spans(spark, table).select(
            "doc_id", pii.span_text(F.filter("all", lambda s: s["base"])).alias("s")).collect()
        assert Counter((r.doc_id, r.s) for r in got) == texts


def test_redaction(spark, docs):
    out = {r.doc_id: r for r in pii.redact(spark, docs).collect()}
    assert out[11].text == "Mail [EMAIL] and [PHONE], [IP] or 999.1.1.1, card [CARD]."
    assert out[11].n_chars == len(out[11].text) and out[0].text is None and out[13].text == LONG
    assert "x@y.z" not in out[12].text and "é漢" in out[12].text


def test_stages_do_not_depend_on_how_the_table_is_split(spark, tmp_path):
    texts = [f"mail u{i % 20}@b.org " + f"text{i % 20} " * 8 for i in range(40)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8).write.parquet(
        f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    stages = {"exact": lambda: block_naming.drop_copies(spark, docs), "near": lambda: prob_minhash.drop_near(spark, docs),
              "private": lambda: pii.redact(spark, docs), "quality": lambda: crf.keep_good(spark, docs, labels, 0)}
    wrong = set()
    for name, fn in stages.items():
        out = fn()
        # what a stage decided is stored; fewer executors at the time it is applied
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            got = {r.doc_id: r.text for r in out.collect()}
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        ok = {"exact": lambda: set(got) == set(range(20, 40)),
              "near": lambda: sorted(i % 20 for i in got) == list(range(20)),
              "private": lambda: all("@" not in x for x in got.values()) and len(got) == 40,
              "quality": lambda: len(got) == 40}[name]()
        if not ok:
            wrong.add(name)
    assert not wrong


def test_packing(spark, docs):
    tok = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        for i, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at:at + 2048]
            want[r.doc_id, i, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    got = packing.pack_documents(spark, docs, VOCABULARY).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_with_ids_packs_lengths_only(spark, docs, monkeypatch):
    seen, plain = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda spark, pieces, *a: seen.append(pieces.columns) or plain(spark, pieces, *a))
    got = packing.pack_documents(spark, docs, VOCABULARY, with_ids=True).collect()
    assert seen == [["row", "piece", "length"]]     # ids went through the packing tasks, 80 MB a batch
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    bare = packing.pack_documents(spark, docs, VOCABULARY).collect()
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(tuple(r[n] for n in names) for r in bare)


def test_passages(spark, docs):
    got = {r.doc_id: r.spans for r in compact_windows.repeats(spark, docs).collect()}
    assert set(got) == {8, 10, 14}      # the first holder of a passage is not reported
    s = got[10][0]
    assert (s.start, s.end, s.other_id, s.other_start) == (3, 63, 9, 3)


def test_passages_leave_no_windows_behind(spark, tmp_path):
    texts = [f"{i} " * (i + 1) + PASSAGE + f" end{i}" * i for i in range(12)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(path)
    stage = common.Stage(spark, "windows")
    clean = spark.conf.get(stage.CLEAN, None)
    got = compact_windows.find_passages(spark, spark.read.parquet(path), stage=stage).collect()
    assert {r.doc_id for r in got} == set(range(1, 12))
    left = {p.name.split("-")[0] for p in Path(stage.base.removeprefix("file://")).iterdir()}
    assert left == {"classes", "found"}     # texts' shingles, windows, buckets and spans stayed
    assert spark.conf.get(stage.CLEAN, None) == clean


def spans_of(spark, path, texts):
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(path))
    return {r.doc_id: [tuple(s) for s in r.spans]
            for r in compact_windows.repeats(spark, spark.read.parquet(str(path))).collect()}


def test_passages_whose_windows_have_other_first_holders(spark, tmp_path):
    items = compact_windows.shingles(PASSAGE.split(), 5)
    filler = lambda name, n: [f"{name}{i}" for i in range(n)]
    lures, h = [], 0
    while h < compact_windows.HASHES:
        hashed = lambda x: compact_windows.mix(x ^ compact_windows.mix(np.uint64(h + 1)))
        at = int(hashed(items).argmin())
        for k in range(1000):
            lure = filler(f"u{h}x{k}a", 30) + PASSAGE.split()[at:at + 5] + filler(f"u{h}x{k}b", 30)
            if int(hashed(compact_windows.shingles(lure, 5)).argmin()) == 30:
                break
        lures.append(lure)
        h += 1
    # unrelated documents hold every smallest shingle first
    tail = [" ".join(filler("p", 9)) + " " + PASSAGE, PASSAGE + " " + " ".join(filler("q", 7))]
    got = spans_of(spark, tmp_path / "a", [" ".join(x) for x in lures] + tail)
    assert got == {9: [(0, 60, 8, 9)]}
    # the first holder has them in other places too
    got = spans_of(spark, tmp_path / "b", [" ".join(sum(lures, [])) + " " + tail[0], tail[1]])
    assert (0, 60, 0, 65 * 8 + 9) in got[1]


def test_passages_that_go_on_after_a_common_one(spark, tmp_path):
    more = " ".join(f"more{i}" for i in range(12))
    got = spans_of(spark, tmp_path / "a", [
        "a b " + PASSAGE + " c", "d " + PASSAGE + " e", "f " + PASSAGE + " " + more, PASSAGE + " " + more + " g"])
    assert (1, 61, 0, 2) in got[1] and (1, 61, 0, 2) in got[2] and (0, 72, 2, 1) in got[3]


def test_passages_that_go_on_after_a_common_one_and_another_word(spark, tmp_path):
    more = " ".join(f"more{i}" for i in range(12))
    got = spans_of(spark, tmp_path / "a", [
        "a b " + PASSAGE + " c", "d " + PASSAGE + " e", "f " + PASSAGE + " this " + more, PASSAGE + " that " + more + " g",
        more + " yes " + PASSAGE, "h " + more + " no " + PASSAGE])
    # the word beside the common passage differs, the words behind it do not
    assert (0, 60, 0, 2) in got[3] and (0, 73, 2, 1) in got[3] and (1, 74, 4, 0) in got[5]


def test_every_exact_repeat_lies_in_a_passage(spark, tmp_path):
    rng = random.Random(8)
    line = [f"line{i}" for i in range(11)]
    blocks = [[f"w{b}x{i}" for i in range(rng.choice([15, 35, 60, 90]))] for b in range(12)] + [line, line, ["the"] * 70]
    texts = []
    for d in range(60):
        words = []
        for b in range(rng.randint(1, 5)):
            words += [f"own{d}x{b}x{i}" for i in range(rng.choice([0, 1, 20]))] + rng.choice(blocks)[rng.choice([0, 0, 7]):]
        texts.append(words)
    got = spans_of(spark, tmp_path / "a", [" ".join(x) for x in texts])
    seen, missed, held = set(), [], 0
    for d, words in enumerate(texts):
        mine = [tuple(words[i:i + 50]) for i in range(len(words) - 49)]
        inside = {i for start, end, *_ in got.get(d, []) for i in range(start, end)}
        for i, passage in enumerate(mine):
            held += passage in seen
            missed += [(d, i)] * (passage in seen and not inside.issuperset(range(i, i + 50)))
        seen.update(mine)
    assert held > 500 and not missed


def test_windows_are_those_of_the_tree():
    def tree(values, left, right, narrow):
        if right - left + 1 < narrow:
            return []
        at = left + int(values[left:right + 1].argmin())
        return [(left, at, right)] + tree(values, left, at - 1, narrow) + tree(values, at + 1, right, narrow)

    rng = np.random.default_rng(3)
    for _ in range(200):
        lens = rng.integers(0, 90, 4)
        values = rng.integers(0, rng.choice([1, 2, 9, 2 ** 60]), lens.sum()).astype(np.uint64)
        last, narrow = np.cumsum(lens) - 1, int(rng.integers(1, 20))
        first = last - lens + 1
        got = compact_windows.windows_of_all(values, first, last, narrow)
        assert sorted(zip(*(x.tolist() for x in got))) == sorted(
            w for a, b in zip(first.tolist(), last.tolist()) for w in tree(values, a, b, narrow))


def test_shared_lines_alone_make_no_neighbours_seek_each_other():
    line = [f"line{i}" for i in range(11)]
    seeking = []
    for d in range(2):
        words = [f"own{d}x{i}" for i in range(60)] + line + [f"own{d}y{i}" for i in range(60)]
        items = compact_windows.shingles(words, 5)
        at = np.arange(60, 67)
        key = np.arange(7)                      # as if every hash had its smallest shingle in the line
        n, mixed, place, seeks = compact_windows.neighbours(
            items, key, np.zeros(7, int), at, np.full(7, len(items) - 1), [], 46, 0.8, 4)
        seeking.append((set(mixed[seeks].tolist()), set(mixed.tolist())))
    assert seeking[0][1] & seeking[1][1] and not seeking[0][0] & seeking[1][1] and not seeking[1][0] & seeking[0][1]


def test_passages_with_a_word_inserted_and_one_deleted(spark, tmp_path):
    words = PASSAGE.split()
    more, less = " ".join(words[:30] + ["new"] + words[30:]), " ".join(words[:30] + words[31:])
    both = " ".join(words[:20] + ["new"] + words[20:40] + words[41:])
    got = spans_of(spark, tmp_path / "a", ["a b " + PASSAGE, "c " + more + " d e", "f g h " + less, both + " i"])
    assert (1, 62, 0, 2) in got[1] and (3, 62, 0, 2) in got[2] and (0, 60, 0, 2) in got[3]
    for n in range(3):
        assert compact_windows.chain(np.arange(9), np.delete(np.arange(9), n + 3), 0, 0, 2).tolist() == [
            [i, i - (i > n + 3)] for i in range(9) if i != n + 3]


def test_cross_entropy(spark, docs):
    some = docs.filter("doc_id < 13")
    tok = Tokenizer.from_file(VOCABULARY)
    rows = [(r.doc_id, tok.encode(r.text or "", add_special_tokens=False).ids)
            for r in some.select("doc_id", "text").collect()]
    target = {3, 9}
    size = tok.get_vocab_size()

    def model(texts):
        one = Counter(w for t in texts for w in t)
        two = Counter(p for t in texts for p in zip([None, *t], t))
        ahead = Counter(a for t in texts for a in [None, *t][:len(t)])
        total = sum(one.values())
        return lambda a, b: -math.log((two[a, b] + 20 * (one[b] + 1) / (total + size)) / (ahead[a] + 20))

    back, goal = model([t for _, t in rows]), model([t for d, t in rows if d in target])
    mean = lambda m, t: sum(m(a, b) for a, b in zip([None, *t], t)) / len(t)
    for r in cross_entropy.score(spark, some, F.col("doc_id").isin(*target), VOCABULARY).collect():
        t = dict(rows)[r.doc_id]
        assert r.n_tokens == len(t)
        assert abs(r.score - (mean(goal, t) - mean(back, t) if t else 0)) < 1e-9


def test_texts_stay_where_they_are_for_their_labels(spark, tmp_path):
    rows = [(i if i % 11 else None, f"text {i}") for i in range(40_000)] + [(3, "again")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0), None if i % 2 else int(i % 5 == 0)) for i in range(39_000)] + [(3, 1, 0), (None, 1, 0)],
        "doc_id bigint, quality int, toxic int")
    good = {i for i in range(39_000) if i % 3 == 0 and (i % 2 or i % 5)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)         # as if there were very many
    try:
        marked = cross_entropy.labelled_target(spark.read.parquet(f"{tmp_path}/d"), labels)
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert min(plan.find("BroadcastHashJoin"), plan.find("Join")) > 0
        assert plan.find("BroadcastHashJoin") < plan.find("SortMergeJoin")
        got = [(r.doc_id, r.text, r["__target"]) for r in marked.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got, key=str) == sorted(((i, t, i in good) for i, t in rows), key=str)


def test_top_k(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(120)]
    rows[7], rows[8], rows[9] = (7, None), (8, [1.0, None] + [0.0] * 6), (9, [float("nan")] * 8)
    rows[50] = (50, rows[0][1])
    rows[10] = (10, [float("inf")] * 8)
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3).write.parquet(f"{tmp_path}/v")
    v = {i: np.floor(256 * np.float64(np.float32(e))).astype(int) for i, e in rows if i not in (7, 8, 9, 10)}
    want = []
    for q in (i for i in v if i % 50 == 0):
        best = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q))[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    for block, slice_ in ((4096, 4096), (16, 1)):
        got = topk.top_k(spark, spark.read.parquet(f"{tmp_path}/v"), F.col("vec_id") % 50 == 0,
                         block=block, queries=slice_).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    none = spark.read.parquet(f"{tmp_path}/v").filter("vec_id < 0")
    assert topk.top_k(spark, none, F.col("vec_id") % 50 == 0).count() == 0


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op4_line_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    field = crf.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect() if field.score(r.text) >= 0.3}
    last = {lower(t): d for d, t in sorted(kept.items())}
    kept = {d: t for t, d in last.items()}
    got = {r.doc_id for r in out}
    assert got <= set(kept)
    words = lambda t: t.split()
    sets = {d: {tuple(w[i:i + 5]) for w in [words(t)] for i in range(max(min(1, len(w)), len(w) - 4))} for d, t in kept.items()}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    assert not [1 for a in got for b in got if a < b and near(a, b)]
    reach = set(got)
    while True:
        more = {d for d in set(kept) - reach if any(near(d, x) for x in reach)}
        if not more:
            break
        reach |= more
    assert reach == set(kept)
    assert all(r.length == len(r.ids) for r in out)
