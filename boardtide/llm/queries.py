"""Queries of the operators over the generic tables, and the SQL of those SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from boardtide.llm import (
    block_naming, bpe, compact_windows, crf, cross_entropy, mincut, packing, piece_bpe, pii, prob_minhash, spelling,
    topk, whitening)
from boardtide.llm.common import Stage, located, table

QUERIES, CHECKS = {}, {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn
    return keep


@query("op3_pack_sequences")
def op3(spark, sf_dir):
    return packing.pack_documents(
        spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op5_top_k", """
  WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
      list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM pairs)
  SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op5(spark, sf_dir):
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_byte_bpe")
def op6(spark, sf_dir):
    return bpe.encode_documents(
        spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, with_ids=False)


@query("op9_exact_dedup", """
  WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  n AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
  SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM n""")
def op9(spark, sf_dir):
    return block_naming.exact_groups(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op2_near_dedup")
def op2(spark, sf_dir):
    stage = Stage(spark, "near")
    docs, row = located(stage, table(spark, sf_dir, "documents"))
    return prob_minhash.near_groups(spark, docs, stage=stage, row=row).select(
        "doc_id", "class_id", "group_size", "kept")


@query("op7_personal_data")
def op7(spark, sf_dir):
    found = pii.find_spans(spark, table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.span_text(F.filter("all", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.span_text(F.col("all")).alias("spans"))


@query("op4_line_quality")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    field = crf.train(docs, table(spark, sf_dir, "labels"))
    return crf.scores(spark, docs, field).select(
        "doc_id", crf.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= crf.THRESHOLD).cast("int").alias("predicted"))


@query("op1_main_text")
def op1(spark, sf_dir):
    return mincut.extract(spark, table(spark, sf_dir, "pages"))


@query("op8_repeated_passages")
def op8(spark, sf_dir):
    return compact_windows.repeats(spark, table(spark, sf_dir, "documents"))


@query("op10_lm_scores")
def op10(spark, sf_dir):
    stage = Stage(spark, "lm")
    docs = cross_entropy.labelled_target(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), stage)
    return cross_entropy.score(
        spark, docs, F.col("__target"), public_tokenizers.path("word_bpe_49k.json"), stage)


@query("op13_piece_bpe")
def op13(spark, sf_dir):
    return piece_bpe.encode_documents(
        spark, table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query("op12_whiten")
def op12(spark, sf_dir):
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").cast("bigint"))


# The check hashes with the 16 remainders of CRC-32, a half byte at a time, and compares words with
# letters beyond ASCII written as other signs, as its edit distance goes by bytes.
_REMAINDERS = []
for _i in range(16):
    for _ in range(4):
        _i = _i >> 1 ^ 0xEDB88320 * (_i & 1)
    _REMAINDERS.append(_i)
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c not in "'\\")[:64]


@query("op11_spelling", f"""
  WITH RECURSIVE d AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents),
  low AS (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM d GROUP BY ALL),
  hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
        THEN [unicode(c) & 15, unicode(c) >> 4]
        ELSE [unicode(c) >> 6 & 15, 12, unicode(c) & 15, 8 + (unicode(c) >> 4 & 3)] END))),
      lambda c, b: xor(c >> 4, {_REMAINDERS}[(xor(c, b) & 15) + 1]))) AS h
    FROM low WHERE length(run) >= 6),
  words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
  w AS (SELECT *, translate(word, '{"".join(map(chr, range(0xC0, 0x100)))}', '{_SIGNS}') AS plain FROM words),
  near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM w a JOIN w b ON abs(length(a.word) - length(b.word)) <= 1 AND a.word <> b.word
    WHERE levenshtein(a.plain, b.plain) = 1),
  ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
      row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other COLLATE "binary") AS place FROM near),
  forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
      CASE WHEN other_n >= 5 * words.n THEN other END AS form,
      CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1),
  chains AS (
    SELECT word, word AS root, form AS up FROM forms
    UNION ALL SELECT chains.word, forms.word, forms.form FROM chains JOIN forms ON chains.up = forms.word)
  SELECT forms.word, form, root, n, n_near, form_n
  FROM forms JOIN chains ON forms.word = chains.word AND up IS NULL""")
def op11(spark, sf_dir):
    return spelling.variants(spark, table(spark, sf_dir, "documents"))
