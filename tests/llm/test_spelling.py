"""Spelling variants: neighbourhoods and whole results against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from boardtide.llm import spelling


def edits(w, symbols):
    out = {w}
    for i in range(len(w) + 1):
        out |= {w[:i] + (c,) + w[i:] for c in range(symbols)}
        if i < len(w):
            out |= {w[:i] + w[i + 1:]} | {w[:i] + (c,) + w[i + 1:] for c in range(symbols)}
    return out


@pytest.mark.parametrize("slice_size", [1 << 19, 7])
def test_neighbourhoods_are_whole_and_distinct(monkeypatch, slice_size):
    monkeypatch.setattr(spelling, "SLICE", slice_size)
    rng, symbols = random.Random(4), 3
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)] + ["aaaa", "abab"]

    def key(symbols_of_word):
        if not symbols_of_word:
            return int(spelling.mix(np.uint64(0)))
        return int(spelling.Neighbours(np.array([symbols_of_word], np.uint64)).own()[0])

    got = Counter()
    for rows, keys in spelling.neighbourhood(words, symbols):
        got.update(zip(rows.tolist(), keys.tolist()))
    want = {(i, key(e)) for i, w in enumerate(words)
            for e in edits(tuple(spelling.reduced(w, symbols).tolist()), symbols)}
    assert set(got) == want and set(got.values()) == {1}


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, near = {}, {}
    for w in n:
        others = [o for o in n if distance_one(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], near[w], n.get(form[w])))
    return out


LONG = "loöng" * 600


def rows_of_words():
    rng = random.Random(9)
    words = ["colour", "colours", "couleur", "Ärgerüber", "abcdefgh", LONG, "straßenbahn"]
    rows = []
    for w in words:
        variants = [(w, 400)] + [(w[:i] + c + w[i + j:], rng.choice([3, 5, 6, 40, 90]))
                                 for i in range(min(6, len(w))) for j in (0, 1) for c in ("", "é", "x") if (c, j) != ("", 0)]
        if w is LONG:
            variants = [(w, 30), (w[:2000] + w[2001:], 5), (w + "q", 6), (w[1:] + "q", 5)]
        for v, times in variants:
            for i in range(times):
                rows.append((rng.randint(0, 50), v.upper() if i % 7 == 0 and v.isascii() else v))
    # a chain of forms, and ties
    for w, times in (("chains", 2000), ("chainss", 300), ("chainsst", 50), ("chainsstu", 5), ("tiesab", 50), ("tiesac", 50), ("tiesad", 7)):
        rows += [(None if i % 50 == 0 else i, w) for i in range(times)]
    return [(d, " ".join([t, "short", "4" + t + "5", "×÷"])) for d, t in rows] + [
        (7, None), (8, ""), (9, "no runs: 123 Āā"), (None, None)] + [(10, " ".join(["repeat"] * 9000))]


@pytest.mark.parametrize("symbols", [2, 10])
def test_equals_brute_force(spark, tmp_path, symbols):
    rows = rows_of_words()
    spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n int, word string").selectExpr(
        "*", "1 AS id", "2 AS key").repartition(5).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    got = spelling.variants(spark, docs, symbols=symbols)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    want = by_hand(rows)
    assert len(got) == len(want) and set(got) == want
    assert any(LONG[:10] in w and f for w, f, *_ in got) and any(f is not None and r != f for _, f, r, *_ in got)
    assert spelling.variants(spark, docs.limit(0), symbols=symbols).count() == 0
