"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary answers in one probe whether a whole
pre-token is in the vocabulary.  Tier two: a pre-token that is not is merged from its bytes, held
in a doubly linked list, by a heap of candidate merges ordered by (rank, place).
"""

import base64
import hashlib
import heapq
from array import array

import regex
import xxhash

from boardtide.llm.common import map_batches

#: Distinct pre-tokens a worker remembers; beyond it the memory is emptied, never the work.
MEMORY = 400_000
_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of distinct byte strings to 0..n-1, by levels.

    A key that is alone in its slot of a level stays there; the others go on to the next level,
    which has another seed.  The taken slots of all levels, counted through, are the hash values.
    A stored copy of the key tells members from strangers.
    """

    def __init__(self, keys, room=2):
        self.levels, self.keys, self.values = [], [], array("l")
        left = list(enumerate(keys))
        while left:
            size = room * len(left) + 1
            taken = array("l", [-1]) * size            # -1 free, -2 contested, else one key's place
            places = [xxhash.xxh3_64_intdigest(k, len(self.levels)) % size for _, k in left]
            for i, p in enumerate(places):
                taken[p] = i if taken[p] == -1 else -2
            for p, i in enumerate(taken):
                if i >= 0:
                    taken[p] = len(self.keys)
                    self.values.append(left[i][0])
                    self.keys.append(left[i][1])
            self.levels.append(taken)
            left = [item for item, p in zip(left, places, strict=True) if taken[p] == -2]

    def get(self, key):
        """The key's number, or -1 if it is no member."""
        for seed, taken in enumerate(self.levels):
            at = taken[xxhash.xxh3_64_intdigest(key, seed) % len(taken)]
            if at >= 0:
                return self.values[at] if self.keys[at] == key else -1
            if at == -1:
                return -1
        return -1


def load_ranks(path):
    """Token bytes in the order of their ranks, from a rank file (base64 and rank per line)."""
    with open(path, "rb") as lines:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines)]
    pairs.sort()
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0..n-1")
    return [t for _, t in pairs]


class Coder:
    def __init__(self, tokens, pattern):
        self.tokens = tokens
        self.hash = PerfectHash(tokens)
        self.ranks = {t: i for i, t in enumerate(tokens)}      # of parts that merge; most are strangers
        self.split = regex.compile(pattern).findall
        self.memory = {}

    def merge(self, piece):
        """Ids of a byte string by merging the lowest rank first, leftmost on ties."""
        rank, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))          # where the part that begins here ends
        before = list(range(-1, n - 1))      # where the part before begins
        alive = bytearray(b"\1" * n)
        heap = []
        for i in range(n - 1):
            if (r := rank(piece[i:i + 2])) is not None:
                heap.append((r, i, i + 1, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            # stale unless both parts still have the extent they had when it was pushed
            if not alive[i] or end[i] != mid or not alive[mid] or end[mid] != stop:
                continue
            alive[mid] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[stop]))
            if (j := before[i]) >= 0 and (r := rank(piece[j:stop])) is not None:
                heapq.heappush(heap, (r, j, i, stop))
        out, i = [], 0
        while i < n:
            out.append(rank(piece[i:end[i]]))
            i = end[i]
        return out

    def piece_ids(self, piece):
        whole = self.hash.get(piece)
        return [whole] if whole >= 0 else self.merge(piece)

    def encode(self, text):
        """Ids as little-endian unsigned 32-bit integers."""
        pieces, memory = self.split(text), self.memory
        if len(memory) > MEMORY:
            memory.clear()
        for piece in set(pieces).difference(memory):
            ids = array("I", self.piece_ids(piece.encode("utf-8")))
            memory[piece] = ids.tobytes()
        return b"".join(map(memory.__getitem__, pieces))

    def decode(self, ids):
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


_CODERS = {}


def coder(tokens, pattern, tag):
    """One coder per worker and vocabulary; its tables and memory serve all its batches."""
    if tag not in _CODERS:
        _CODERS[tag] = Coder(tokens, pattern)
    return _CODERS[tag]


def encode_documents(spark, docs, rank_file, pattern, with_ids=True):
    """doc_id, n_tokens, ids (optional), digests of ids and of the bytes decoded from them.

    A null text counts as empty: no ids, the digest of no bytes.  Repeated rows give repeated
    results.  The vocabulary is read once on the driver and sent to the workers; its size is the
    file's, whatever the corpus.
    """
    shared = spark.sparkContext.broadcast(load_ranks(rank_file))
    tag = f"{rank_file}:{hash(pattern)}"

    def run(batch):
        c = coder(shared.value, pattern, tag)
        out = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if with_ids:
            out["ids"] = []
        for text in batch["text"]:
            ids = c.encode(text or "")
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode(ids)).hexdigest())
            if with_ids:
                out["ids"].append(array("I", ids).tolist())
        return out

    kind = dict(docs.dtypes)["doc_id"]
    ids = ", ids array<int>" if with_ids else ""
    return map_batches(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{ids}")
