"""The best token-set score a name reaches among many names, without scoring every pair.

Two things bound a score from above without a subsequence.  The shared words alone give one of its
parts exactly, and an inverted index of words finds them.  The rest cannot cover more characters
than both names have in common, counted letter by letter.  Names of like length and letters lie in
cells with the largest counts of any member; cells, and the members of the cells opened, are
visited in falling order of that bound, and the search ends where no bound exceeds the best score.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from boardtide.functions.similarity import _token_set_ratio

#: Names that are sent to the workers at a time, names of a cell, and names searched for together.
BLOCK, CELL, GROUP = 20_000, 32, 50_000


class NameIndex:
    def __init__(self, names):
        kept = sorted({" ".join(sorted(set(n.split()))) for n in names} - {""},
                      key=lambda n: (len(n) // 4, "".join(sorted(n.replace(" ", ""))), n))
        self.names = kept
        self.size = np.array([len(n) for n in kept], np.int64)
        self.words = np.array([n.count(" ") + 1 for n in kept], np.int64)
        # a column per letter and how often it occurs: "two e" holds where there are two or more
        self.place = {}
        held = [self._letters(n, grow=True) for n in kept]
        # integers, as products of floats would start threads of their own in every worker
        self.has = np.zeros((len(kept), len(self.place)), np.int16)
        for i, places in enumerate(held):
            self.has[i, places] = 1
        self.starts = np.arange(0, len(kept), CELL)
        if kept:
            self.cell_has = np.maximum.reduceat(self.has, self.starts, axis=0)
            self.cell_size = np.minimum.reduceat(self.size, self.starts)
        lists = {}
        for i, n in enumerate(kept):
            for w in n.split():
                lists.setdefault(w, []).append(i)
        self.lists = {w: np.array(v) for w, v in lists.items()}
        # a word's shortest name, and whether it is a name by itself
        self.alone = {w: (self.size[v].min(), (self.words[v] == 1).any()) for w, v in self.lists.items()}

    def _letters(self, name, grow=False):
        seen, out = {}, []
        for c in name.replace(" ", ""):
            seen[c] = seen.get(c, 0) + 1
            key = c, seen[c]
            if grow:
                self.place.setdefault(key, len(self.place))
            if key in self.place:
                out.append(self.place[key])
        return out

    def _shared(self, words, size):
        """The best score by shared words alone; 100 if one name's words are all in the other."""
        known = [w for w in words if w in self.lists]
        if not known:
            return 0
        if len(known) == 1:
            shortest, whole = self.alone[known[0]]
            if whole or len(words) == 1:
                return 100
            s = np.int64(len(known[0]))
            other = min(size, shortest) - s
            return math.floor(100.0 * (1 - other / (2 * s + other)) + 1e-9)
        count, s = np.zeros(len(self.names), np.int64), np.zeros(len(self.names), np.int64)
        for w in known:
            count[self.lists[w]] += 1
            s[self.lists[w]] += len(w) + 1
        if (count == len(words)).any() or (count == self.words).any():
            return 100
        ids = np.flatnonzero(count)
        s = s[ids] - 1
        other = np.minimum(size, self.size[ids]) - s       # one space and the differing words
        return math.floor((100.0 * (1 - other / (2 * s + other))).max() + 1e-9)

    def best(self, names, reached=None):
        """(best score rounded down, names scored) of each name; 0 where nothing is alike.  A name
        that `reached` a score elsewhere keeps it unless a better one is here."""
        reached = [0] * len(names) if reached is None else reached
        texts = [sorted(set((n or "").split())) for n in names]
        if not self.names:
            return [(r, 0) for r in reached]
        has = np.zeros((len(texts), len(self.place)), np.int16)
        for i, words in enumerate(texts):
            has[i, self._letters(" ".join(words))] = 1
        common = has @ self.cell_has.T
        out = []
        for i, words in enumerate(texts):
            size = len(" ".join(words))
            out.append(self._search(words, size, has[i], common[i], reached[i]) if words else (reached[i], 0))
        return out

    def _search(self, words, size, has, common, reached):
        best, scored, name = max(reached, self._shared(words, size)), 0, " ".join(words)
        above = 200.0 * (common + len(words) - 1) / (size + self.cell_size)
        cells = np.flatnonzero(above >= best + 1 - 1e-9)
        cells = cells[np.argsort(-above[cells], kind="stable")]
        at, wide = 0, 1
        # ever more cells at a time, as the best score soon rules most of them out
        while at < len(cells) and above[cells[at]] >= best + 1 - 1e-9:
            opened = cells[at:at + wide]
            rows = (self.starts[opened[above[opened] >= best + 1 - 1e-9], None] + np.arange(CELL)).ravel()
            rows = rows[rows < len(self.names)]
            spaces = np.minimum(self.words[rows], len(words)) - 1
            bound = 200.0 * (self.has[rows] @ has + spaces) / (size + self.size[rows])
            near = np.flatnonzero(bound >= best + 1 - 1e-9)
            for k in near[np.argsort(-bound[near], kind="stable")]:
                if bound[k] < best + 1 - 1e-9:
                    break
                scored += 1
                best = max(best, math.floor(_token_set_ratio(name, self.names[rows[k]])))
            at, wide = at + wide, 4 * wide
        return best, scored


def best_scores(spark, asked, name, known, known_name, block=BLOCK):
    """`asked` with `best_score`, the highest score of `name` among `known_name`, rounded down, and
    `names_scored`, how many names were compared for it.

    `known` is a dimension.  Its distinct names go to the workers in blocks of about `block`, of
    which the driver holds one at a time; a task takes GROUP of its names at a time through one
    block after the other, so what was reached in one shortens the search in the next.
    A null name scores 0.
    """
    names = known.select(F.col(known_name).alias("n")).filter("n <> ''").distinct()
    blocks = max(1, -(-names.count() // block))
    layout = f"{asked.schema.simpleString()[7:-1]}, best_score bigint, names_scored bigint"
    shared = []
    for b in range(blocks):
        some = names.filter(F.pmod(F.xxhash64("n"), F.lit(blocks)) == b) if blocks > 1 else names
        shared.append(spark.sparkContext.broadcast([r.n for r in some.collect()]))

    def run(batches):
        indexes = {}

        def searched(group):
            found = [(0, 0)] * sum(g.num_rows for g in group)
            texts = [n for g in group for n in g.column(name).to_pylist()]
            for b in range(blocks):
                index = indexes.pop(b, None) or NameIndex(shared[b].value)
                if blocks == 1:
                    indexes[b] = index
                for at in range(0, len(texts), 256):
                    more = index.best(texts[at:at + 256], [s for s, _ in found[at:at + 256]])
                    found[at:at + 256] = [(s, n + m) for (_, n), (s, m) in zip(found[at:at + 256], more)]
            at = 0
            for g in group:
                own = found[at:at + g.num_rows]
                at += g.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*g.columns, pa.array([s for s, _ in own], pa.int64()), pa.array([n for _, n in own], pa.int64())],
                    [*g.schema.names, "best_score", "names_scored"])

        group = []
        for batch in batches:
            group.append(batch)
            if sum(g.num_rows for g in group) >= GROUP:
                yield from searched(group)
                group = []
        if group:
            yield from searched(group)

    # a name costs far more than its bytes, so all cores share them evenly
    return asked.repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, layout)
