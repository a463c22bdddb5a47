"""Sum-of-squares packing of tokenised documents into sequences of a fixed size.

A piece goes where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest.  A full sequence counts for nothing.  Pieces are shared out by a hash over
partitions whose number grows with the input; each partition packs its own pieces, largest first,
and holds one counter per gap and the numbers of its open sequences only.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from boardtide.llm.common import Stage, map_batches, with_row

SIZE = 2048
#: Pieces per partition.  More waste less (each partition leaves a few open sequences).
SHARE = 20_000
_TOKENIZERS, _CHUNKS, _WORD_ENDS = {}, {}, {}
_BLANK = re.compile(r"[\t\n\r]")
_WORDS = re.compile(r"[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")


def tokenizer(data, tag):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    if tag not in _TOKENIZERS:
        _TOKENIZERS[tag] = Tokenizer.from_str(data)
    return _TOKENIZERS[tag]


def token_bytes(tok, texts, known, limit=500_000):
    """The ids of each text as little-endian 32-bit integers.

    No token spans white space, so a text has the ids of its chunks between blanks, one after the
    other.  `known` remembers those of chunks already met; it is emptied beyond `limit`.
    """
    if len(known) > limit:
        known.clear()
    known[""] = b""                                    # between two blanks
    cut = [_BLANK.sub(" ", t).split(" ") if t else [] for t in texts]
    held = [list(map(known.get, chunks)) for chunks in cut]
    gaps = [[i for i, ids in enumerate(row) if ids is None] for row in held]
    new = list({chunks[i] for chunks, gap in zip(cut, gaps, strict=True) for i in gap})
    plain = [c for c in new if c.isalpha() or c.isascii() and c.isprintable() and "'" not in c and "<" not in c]
    if (found := plain_bytes(tok, plain)) is not None:
        known.update(zip(plain, found, strict=True))
        new = [c for c in new if c not in known]
    for chunk, found in zip(new, tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
        known[chunk] = np.array(found.ids, "<u4").tobytes()
    for row, chunks, gap in zip(held, cut, gaps, strict=True):
        for i in gap:
            row[i] = known[chunks[i]]
    return [b"".join(row) for row in held]


def plain_bytes(tok, chunks):
    """The ids of each of `chunks`, letters or printable ASCII without apostrophes or angle brackets,
    from one call.

    To the tokenizer a run of letters, a digit and a run of other signs are a word each, and the
    last id of a word is of a token that ends words.  None if the words found are not as many.  A
    chunk of letters beyond ASCII counts as one; it can only be more to the tokenizer, never less.
    """
    if id(tok) not in _WORD_ENDS:
        suffix = getattr(tok.model, "end_of_word_suffix", None)
        ends = np.zeros(tok.get_vocab_size(), bool)
        ends[[i for t, i in tok.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        _WORD_ENDS[id(tok)] = ends
    ids = np.array(tok.encode_batch_fast([" ".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
    ends = np.flatnonzero(_WORD_ENDS[id(tok)][ids]) + 1
    words = np.cumsum([1 if c.isalpha() else len(_WORDS.findall(c)) for c in chunks], dtype=np.int64)
    if not len(chunks) or len(ends) != words[-1] or ends[-1] != len(ids):
        return None
    data, at = ids.tobytes(), [0, *(4 * ends[words - 1]).tolist()]
    return [data[a:b] for a, b in zip(at, at[1:], strict=False)]


def tokenise(spark, docs, vocabulary, end_id=0, size=SIZE, with_ids=False):
    """Pieces of at most `size` ids: doc_id, row, piece, start, length, ids_crc32 (and ids).

    The ids of a document are those of its text and then `end_id`; a null text counts as empty.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)["doc_id"]
    end = np.array([end_id], "<u4").tobytes()

    def run(batch):
        tok = tokenizer(shared.value, vocabulary)
        out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32")}
        if with_ids:
            out["ids"] = []
        found = token_bytes(tok, batch["text"], _CHUNKS.setdefault(vocabulary, {}))
        for doc, row, ids in zip(batch["doc_id"], batch["row"], found, strict=True):
            ids = np.frombuffer(ids + end, "<u4")
            for i, at in enumerate(range(0, len(ids), size)):
                cut = ids[at:at + size]
                found = (doc, row, i, at, len(cut), zlib.crc32(cut.tobytes()))
                for name, value in zip(out, found, strict=False):
                    out[name].append(value)
                if with_ids:
                    out["ids"].append(cut.view("<i4"))
        return out

    ids = ", ids array<int>" if with_ids else ""
    return map_batches(
        with_row(docs.select("doc_id", "text")).select("doc_id", "row", "text"), run,
        f"doc_id {kind}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint{ids}")


class Packer:
    """Sum-of-squares choice.  `open[g]` are the open sequences with a gap of g."""

    def __init__(self, size):
        self.size, self.open, self.made = size, [[] for _ in range(size)], 0
        self.count = np.zeros(size + 1, np.int64)      # count[0] stays 0: full ones do not count

    def place(self, length):
        """(sequence, offset) of a piece of `length` tokens."""
        size, count = self.size, self.count
        if length >= size:
            self.made += 1
            return self.made - 1, 0
        # from gap g to g - length, half the change of the sum of squares: N(g-length) - N(g) + 1;
        # a gap that is filled only loses its own square: -N(g) + 1/2
        gaps = np.arange(length, size)
        change = np.where(count[length:size] > 0,
                          2 * (count[:size - length] - count[length:size]) + 2, 4 * size + 2 ** 40)
        change[0] -= change[0] < 2 ** 40
        best = int(change.argmin())                    # ties: the smallest gap
        if change[best] < 2 * count[size - length] + 1:
            gap = int(gaps[best])
            sequence = self.open[gap].pop()
            count[gap] -= 1
        else:
            gap, sequence = size, self.made
            self.made += 1
        if gap > length:
            self.open[gap - length].append(sequence)
            count[gap - length] += 1
        return sequence, size - gap


def pack(spark, pieces, size=SIZE, share=SHARE):
    """`pieces` (a stored table with row, piece, length) with sequence_id and offset.

    Offsets are gapless from 0 in each sequence.  An empty table gives no rows.
    """
    n = max(4, -(-pieces.count() // share))
    schema = pieces.withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn(
        "offset", F.lit(0).cast("bigint")).schema

    def run(batches):
        from pyspark import TaskContext

        packer, base = Packer(size), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.place(x) for x in batch.column("length").to_pylist()]
            for i, name in enumerate(("sequence_id", "offset")):
                batch = batch.append_column(name, pa.array(
                    [p[i] + (base if i == 0 else 0) for p in placed], pa.int64()))
            yield batch

    return (pieces.repartition(n, F.xxhash64("row", "piece"))
            .sortWithinPartitions(F.desc("length"), "row", "piece").mapInArrow(run, schema))


def pack_documents(spark, docs, vocabulary, size=SIZE, with_ids=False):
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, row (and ids).

    Only lengths are packed: a batch of 10,000 pieces with their ids would be 80 MB, several times
    over in each task.  The ids meet their places by a join.
    """
    pieces = Stage(spark, "pieces").keep(
        tokenise(spark, docs, vocabulary, size=size, with_ids=with_ids), "pieces")
    if not with_ids:
        return pack(spark, pieces, size)
    placed = pack(spark, pieces.select("row", "piece", "length"), size).drop("length")
    return pieces.join(placed, ["row", "piece"]).select(*pieces.columns, "sequence_id", "offset")
