"""SentencePiece encoding and decoding against the library."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from boardtide.llm import piece_bpe, queries

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return piece_bpe.Coder(piece_bpe.load_pieces(MODEL))


def numbers(ids):
    return list(map(int, ids.split(","))) if ids else []


def test_equals_the_library_on_odd_texts(model, coder):
    rng = random.Random(11)
    pieces = [p for p, _, kind in piece_bpe.load_pieces(MODEL) if kind == piece_bpe.NORMAL]
    texts = ["", " ", "  ", "a" * 3000, "▁▁ a", "\x00ࠀ퟿", "<s></s><unk><0x41>", "é漢字 🙂\r\n\t  x",
             "x" * 1000 + " " * 500 + "tail", "éﬁ", " \x85\xa0　"]
    texts += ["".join(rng.choice(pieces).replace("▁", rng.choice(" ▁")) if rng.random() < 0.7
                      else rng.choice("\n a漢🙂é") for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    for t in texts:
        ids = coder.encode(t)
        assert numbers(ids) == model.encode(t), t
        assert coder.decode(ids) == model.decode(model.encode(t)).encode()


def test_decodes_any_ids_as_the_library(model, coder):
    rng = random.Random(12)
    for _ in range(500):
        ids = [rng.randrange(0, 32000) if rng.random() < 0.5 else rng.randrange(0, 300) for _ in range(rng.randint(0, 12))]
        assert coder.decode(",".join(map(str, ids))) == model.decode(ids).encode(), ids


def test_prefix_table_equals_merging():
    rng = random.Random(13)
    for _ in range(200):
        letters = "ab" if rng.random() < 0.5 else "abc"
        # pieces of random ranks, some of which no merge reaches, some of equal score
        names = {"".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(0, 12))}
        table = piece_bpe.PrefixTable({p: -float(rng.randint(0, 6)) for p in names})
        for _ in range(10):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
            assert table.tokens(text) == table.merged(text)
            # the table's entries are the last tokens of the prefixes' own encodings
            assert table.last_tokens(text)[1:] == [table.merged(text[:i + 1])[-1] for i in range(len(text))]


def test_little_memory_changes_nothing(coder, monkeypatch):
    text = "Some words of a text, some of them again, and more words of a text."
    monkeypatch.setattr(piece_bpe, "MEMORY", 3)
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 4)
    monkeypatch.setattr(piece_bpe, "PAIRS", 5)
    small = piece_bpe.Coder(piece_bpe.load_pieces(MODEL))
    for _ in range(3):
        assert small.encode(text) == coder.encode(text)


def test_a_vocabulary_that_goes_on_after_spaces():
    pieces = [("<unk>", 0.0, piece_bpe.UNKNOWN), ("a", 0.0, piece_bpe.NORMAL), ("▁", 0.0, piece_bpe.NORMAL),
              ("a▁", -1.0, piece_bpe.NORMAL), ("a▁a", -2.0, piece_bpe.NORMAL)]
    c = piece_bpe.Coder(pieces)
    assert c.encode("a a a") == "2,3,4" and c.encode("aa?! a") == "2,1,1,0,2,1"
    assert c.decode("2,3,4") == b"a a a" and c.decode("") == b""


def expected(model, text):
    ids = model.encode(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(model.decode(ids).encode()).hexdigest())


def test_query_equals_the_library(spark, model):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op13_piece_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(model, texts[r.doc_id])


def test_nulls_repeats_long_texts_and_odd_columns(spark, tmp_path, model):
    rows = [(1, None, 5), (2, "", 5), (3, "word " * 40000, 5), (4, "z" * 100_000, 5), (None, "null id", 5), (6, "twice", 5), (6, "twice", 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int").selectExpr(
        "*", "text AS ids", "1 AS decoded_sha256").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    got = piece_bpe.encode_documents(spark, docs, MODEL).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter(
        (i, *expected(model, t)) for i, t, _ in rows)
    assert all(len(r.ids) == r.n_tokens and r.ids == model.encode(dict((a, b) for a, b, _ in rows)[r.doc_id] or "") for r in got)
    assert piece_bpe.encode_documents(spark, docs.limit(0), MODEL).count() == 0
