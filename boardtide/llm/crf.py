"""Document quality by a linear-chain conditional random field over lines.

Every line has a label, good or bad.  Its emission reads features of the line and its two
neighbours, transitions tie neighbours together.  In training all lines carry their document's
label.  Forward-backward marginals, weighted by line length, give the share of good text, which a
logistic map fitted on the same rows turns into the score.
"""

import re
from itertools import pairwise

import numpy as np
from pyspark.sql import functions as F

from boardtide.llm.common import Stage, located, map_batches, rows_of, semi_by_row

#: Labelled rows the field is fitted on at most: those with the smallest hash of their id.
FIT_ROWS = 3_000
THRESHOLD = 0.3
_WORD = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_DIGITS = re.compile(r"[0-9]+")
_ODD = re.compile(r"[^\w\s.,;:!?'\"()-]+")
_MARKS = re.compile(r"[.,;:!?'\"()-]+")
_SHOUT = re.compile(r"[!?]{2,}")
WIDTH = 16


def line_features(line):
    """Shares and sizes of one line."""
    n = len(line) or 1
    words = _WORD.findall(line)
    w = len(words) or 1
    share = lambda p: len("".join(p.findall(line))) / n
    letters, odd = share(_LETTERS), share(_ODD)
    return (
        1.0, min(n, 2000) / 500, letters, share(_UPPER) / max(letters, 0.05), share(_DIGITS), odd,
        share(_MARKS), len(_SHOUT.findall(line)) / w, line.count("|") / w, len(set(words)) / w,
        min(20.0, n / w) / 10, float(not line.strip()), float(w < 4),
        float(line[-1:] in ".!?\"'"), min(1.0, 10 * odd), sum(map(str.isupper, words)) / w)


def document_matrix(text):
    """(lines x 3 * WIDTH features, lengths): each line's own and its neighbours' features."""
    lines = (text or "").split("\n")
    own = np.array([line_features(x) for x in lines])
    edge = np.zeros((1, WIDTH))
    return (np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])]),
            np.array([len(x) + 1.0 for x in lines]))


def marginals(emit, turn):
    """P(good) per line and the expected transitions, for one chain.

    `emit` are the log odds of good per line, `turn` the 2 x 2 transition scores.  Probabilities
    are rescaled at each line, so that long chains do not underflow.
    """
    n = len(emit)
    local = np.column_stack([1 / (1 + np.exp(emit)), 1 / (1 + np.exp(-emit))])
    t = np.exp(turn - turn.max())
    (t00, t01), (t10, t11) = t.tolist()
    ahead, a0, a1 = [], 0.5, 0.5
    e = local.tolist()
    for i in range(n):
        p0, p1 = (a0 * t00 + a1 * t10, a0 * t01 + a1 * t11) if i else (1.0, 1.0)
        a0, a1 = p0 * e[i][0], p1 * e[i][1]
        z = a0 + a1
        a0, a1 = a0 / z, a1 / z
        ahead.append((a0, a1))
    behind, b0, b1 = [(1.0, 1.0)] * n, 1.0, 1.0
    for i in range(n - 2, -1, -1):
        x0, x1 = e[i + 1][0] * b0, e[i + 1][1] * b1
        b0, b1 = t00 * x0 + t01 * x1, t10 * x0 + t11 * x1
        z = b0 + b1
        b0, b1 = b0 / z, b1 / z
        behind[i] = (b0, b1)
    a, b = np.array(ahead), np.array(behind)
    both = a * b
    good = both[:, 1] / both.sum(axis=1)
    if n == 1:
        return good, np.zeros((2, 2))
    pair = a[:-1, :, None] * t[None] * (local[1:] * b[1:])[:, None, :]
    return good, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


class Field:
    def __init__(self, weights, turn, mean, spread, map_):
        self.weights, self.turn, self.mean, self.spread, self.map = weights, turn, mean, spread, map_

    def share(self, x, lengths):
        emit = np.clip(((x - self.mean) / self.spread) @ self.weights[:-1] + self.weights[-1], -30, 30)
        good, _ = marginals(emit, self.turn)
        return float(good @ lengths / lengths.sum())

    def score(self, text):
        return self.calibrated(self.share(*document_matrix(text)))

    def calibrated(self, share):
        x = np.log((share + 1e-3) / (1 - share + 1e-3))
        return float(1 / (1 + np.exp(-(self.map[0] * x + self.map[1]))))


def fit(texts, labels, rounds=120, rate=0.1, ridge=1e-3):
    """A Field from texts and 0/1 labels.  Without rows, a field that scores every text 0.5."""
    size = 3 * WIDTH
    if not len(texts):
        return Field(np.zeros(size + 1), np.zeros((2, 2)), np.zeros(size), np.ones(size), (0.0, 0.0))
    docs = [document_matrix(t) for t in texts]
    y = np.asarray(labels, float)
    rows = np.concatenate([np.full(len(lengths), i) for i, (_, lengths) in enumerate(docs)])
    x = np.vstack([m for m, _ in docs])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - mean) / spread
    target = y[rows]
    # both labels count alike, and so do documents of few and of many lines
    per_line = (1 / np.array([len(lengths) for _, lengths in docs]))[rows]
    weight = per_line * np.where(target == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    bounds = np.flatnonzero(np.r_[True, np.diff(rows) != 0, True])
    w, turn = np.zeros(size + 1), np.zeros((2, 2))
    seen = np.zeros((2, 2))
    for a, b in pairwise(bounds):
        seen[int(target[a]), int(target[a])] += weight[a] * (b - a - 1)
    m1, m2 = np.zeros(size + 5), np.zeros(size + 5)
    for step in range(1, rounds + 1):
        emit = np.clip(x @ w[:-1] + w[-1], -30, 30)
        good, pairs = np.empty(len(emit)), np.zeros((2, 2))
        for a, b in pairwise(bounds):
            good[a:b], p = marginals(emit[a:b], turn)
            pairs += p * weight[a]
        err = (good - target) * weight
        grad = np.concatenate([err @ x + ridge * w[:-1], [err.sum()],
                               (pairs - seen + 10 * ridge * turn).ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad ** 2
        move = rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-9)
        w, turn = w - move[:-4], turn - move[-4:].reshape(2, 2)
    field = Field(w, turn, mean, spread, (1.0, 0.0))
    s = np.array([field.share(m, lengths) for m, lengths in docs])
    s = np.log((s + 1e-3) / (1 - s + 1e-3))
    a, b = 1.0, 0.0
    for _ in range(3000):
        p = 1 / (1 + np.exp(-(a * s + b)))
        a, b = a - 0.1 * ((p - y) * s).mean(), b - 0.1 * (p - y).mean()
    field.map = (max(a, 1e-3), b)
    return field


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs, labels, fit_rows=FIT_ROWS):
    """A field fitted on at most `fit_rows` labelled rows outside the held-out fold."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("quality").alias("quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.max("text").alias("text"), F.max("quality").alias("quality")).orderBy("doc_id").collect()
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def scores(spark, docs, field, row=None):
    """row, doc_id, score.  A null text is an empty one, which is one empty line."""
    shared = spark.sparkContext.broadcast(field)

    def run(batch):
        model = shared.value
        return {"row": batch["row"], "doc_id": batch["doc_id"],
                "score": [model.score(t) for t in batch["text"]]}

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(rows_of(docs, row, "doc_id", "text"), run,
                       f"row bigint, doc_id {kind}, score double", 128)


def keep_good(spark, docs, labels, threshold=THRESHOLD):
    """`docs` (a stored table) without the documents that score below `threshold`."""
    docs, row = located(Stage(spark, "quality"), docs)
    return semi_by_row(docs, row, scores(
        spark, docs, train(docs, labels), row).filter(F.col("score") >= threshold))
