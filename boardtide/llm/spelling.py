"""Spelling variants by reduced-alphabet generation.

The letters of a word are hashed to a few symbols.  Two words that differ by one edit have reduced
words that are equal or differ by one edit, so every word generates the whole one-edit
neighbourhood of its reduced word and meets the reduced vocabulary there.  The few symbols keep the
neighbourhood small; what meets by chance is told apart on the words themselves.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from boardtide.llm.common import Stage
from boardtide.llm.shingles import mix

#: Symbols that letters are reduced to: more give larger neighbourhoods and fewer chance meetings.
SYMBOLS = 10
SHORTEST, SEEN, RATIO, SLIP = 6, 5, 5, 199
#: Keys generated at a time.
SLICE = 1 << 19

_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_counts(docs, shortest=SHORTEST, seen=SEEN):
    """word, n of the words with at least `shortest` code points and `seen` occurrences."""
    # runs that are too short stay so
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))).alias("run"))
    low = F.translate("run", _A_Z, _A_Z.lower())
    hashed = runs.select("id", low.alias("run")).withColumn(
        "h", F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8"))).withColumn(
        "at", (F.col("h") % F.length("run")).cast("int"))
    word = F.when(F.col("h") % SLIP == 0, F.concat(
        F.col("run").substr(F.lit(1), F.col("at")), F.col("run").substr(F.col("at") + 2, F.length("run")))
    ).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).filter(F.length("word") >= shortest)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= seen))


def reduced(word, symbols):
    return (mix(np.frombuffer(word.encode("utf-32-le"), "<u4")) % np.uint64(symbols)).astype(np.uint64)


class Neighbours:
    """Hashes of words of one length L over 1..symbols: of the words, and of all their distinct
    one-edit neighbours.  The hash of a string is that of its two halves put together."""

    def __init__(self, words):
        self.words = words = words + np.uint64(1)
        count, n = words.shape
        self.power = np.ones(n + 2, np.uint64)
        self.before = np.zeros((count, n + 1), np.uint64)      # of the first i symbols
        self.after = np.zeros((count, n + 1), np.uint64)       # of the symbols from i on
        with np.errstate(over="ignore"):
            for i in range(n + 1):
                self.power[i + 1] = self.power[i] * _BASE
            for i in range(n):
                self.before[:, i + 1] = self.before[:, i] * _BASE + words[:, i]
                j = n - 1 - i
                self.after[:, j] = words[:, j] * self.power[i] + self.after[:, j + 1]

    def own(self):
        return mix(self.before[:, -1] + np.uint64(self.words.shape[1]))

    def edited(self, i, symbols):
        """Keys, and which of them count, of the edits at place i: deleting its symbol, replacing it
        by every other, inserting every symbol before it.  Edits with the same result count once."""
        n = self.words.shape[1]
        here = self.words[:, i:i + 1] if i < n else np.zeros((len(self.words), 1), np.uint64)
        letters = np.arange(1, symbols + 1, dtype=np.uint64)[None, :]
        with np.errstate(over="ignore"):
            # before the same symbol, the insertion is that after it
            keys = [mix(self.before[:, i:i + 1] * self.power[n - i + 1] + letters * self.power[n - i]
                        + self.after[:, i:i + 1] + np.uint64(n + 1))]
            count = [letters != here]
            if i < n:
                keys.append(mix(self.before[:, i:i + 1] * self.power[n - i] + letters * self.power[n - i - 1]
                                + self.after[:, i + 1:i + 2] + np.uint64(n)))
                count.append(letters != here)
                keys.append(mix(self.before[:, i:i + 1] * self.power[n - i - 1] + self.after[:, i + 1:i + 2]
                                + np.uint64(n - 1)))
                # of a run of equal symbols the last one is deleted
                count.append(self.words[:, i + 1:i + 2] != here if i + 1 < n else np.ones_like(here, bool))
        return np.hstack(keys), np.hstack(count)


def _by_length(batch, symbols):
    """(row numbers, reduced words) of a batch's words, a group per length, few letters at a time."""
    groups = {}
    for i, w in enumerate(batch):
        groups.setdefault(len(w), []).append(i)
    for n, rows in groups.items():
        step = max(1, SLICE // (n + 1))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            yield np.array(some), np.array([reduced(batch[i], symbols) for i in some]).reshape(len(some), n)


def neighbourhood(batch, symbols):
    """(row numbers, keys) of all one-edit neighbours of the reduced words, and of these themselves."""
    for rows, words in _by_length(batch, symbols):
        near = Neighbours(words)
        held, size = [(rows, near.own())], len(rows)
        for i in range(words.shape[1] + 1):
            keys, count = near.edited(i, symbols)
            held.append((np.repeat(rows, count.sum(1)), keys[count]))
            size += len(held[-1][1])
            if size >= SLICE:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held)))


def near_words(spark, stage, words, symbols=SYMBOLS):
    """word, other, other_n for every two words that differ by one edit, both ways round.

    `words` (word, n, id) is stored, ids differ.  Neighbourhoods travel as pairs of integers; only
    what meets in a key is looked up, so long words are not written out for each of their edits.
    """
    def own(batches):
        for batch in batches:
            texts, keys = batch.column("word").to_pylist(), np.zeros(batch.num_rows, np.uint64)
            for rows, some in _by_length(texts, symbols):
                keys[rows] = Neighbours(some).own()
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), batch.column("word"), batch.column("n")], ["key", "other", "other_n"])

    def near(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for rows, keys in neighbourhood(batch.column("word").to_pylist(), symbols):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(ids[rows])], ["key", "id"])

    vocabulary = words.select("word", "n").mapInArrow(own, "key bigint, other string, other_n bigint")
    edits = words.select("word", "id").mapInArrow(near, "key bigint, id bigint")
    met = edits.join(vocabulary, "key").join(words.select("id", "word", "n"), "id")
    return met.filter(F.levenshtein("word", "other", 1) == 1).select("id", "word", "n", "other", "other_n")


def follow(stage, links):
    """word, up for each row of `links` (word, up), with up the last word of its chain.

    Every step doubles what a row has covered; a word's n is a fifth of its form's, so chains are
    as short as the logarithm of the largest count."""
    step = 0
    while True:
        far = links.select(F.col("word").alias("up"), F.col("up").alias("further"))
        step += 1
        links = stage.keep(links.select("word", "up").join(far, "up", "left").select(
            "word", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), f"links-{step}")
        if step > 2:
            stage.drop(f"links-{step - 2}")
        if links.filter("moved").isEmpty():
            return links


def variants(spark, docs, symbols=SYMBOLS, shortest=SHORTEST, seen=SEEN, ratio=RATIO):
    """word, form, root, n, n_near, form_n for every word of the texts (see `word_counts`).

    form is the near word of largest n (ties: the smallest), if that is `ratio` times the word's
    own; root is the end of the chain of forms, the word itself where it has no form.

    A null text has no words; a null doc_id counts as an empty one where runs are hashed; repeated
    rows count as often as they occur; words of any length are whole; an empty table gives no rows;
    columns other than doc_id and text are ignored.
    """
    stage = Stage(spark, "spelling")
    words = stage.keep(word_counts(docs, shortest, seen).withColumn("id", F.monotonically_increasing_id()), "words")
    # a chance equality of two keys of one word would show a pair twice
    pairs = near_words(spark, stage, words, symbols).dropDuplicates(["id", "other"])
    best = pairs.groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    forms = stage.keep(words.join(best, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n")), "forms")
    roots = follow(stage, forms.filter("form IS NOT NULL").select("word", F.col("form").alias("up")))
    return forms.join(roots.select("word", "up"), "word", "left").select(
        "word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")
