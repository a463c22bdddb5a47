"""SentencePiece BPE encoding by a prefix table, and decoding.

Every prefix of a text has one encoding, and that of a longer prefix goes on from that of a shorter
one, so it is enough to know each prefix's last token.  An automaton over the vocabulary names the
tokens that end at a place.  Exactly one of them is compatible with the last token of the prefix
before it: the pair, merged on its own, stays that pair.  The ids are read from the table backwards.
"""

import codecs
import hashlib
import re

import ahocorasick
import sentencepiece

from boardtide.llm.common import map_batches

SPACE = "▁"
#: Runs a worker remembers, and the longest it remembers; longer ones are worked out each time.
MEMORY, REMEMBERED = 800_000, 48
#: Remembered pair tests.
PAIRS = 1_000_000

NORMAL, BYTE, CONTROL, UNKNOWN = range(4)

# the library replaces an undecodable byte at a time
codecs.register_error("each_byte", lambda error: ("�", error.start + 1))


def load_pieces(path):
    """(piece, score, kind) by id.  Models that rewrite texts, other than writing spaces as U+2581
    and putting one in front, or that hold unused pieces are refused."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = " Ａ é  éﬁ\t"
    if model.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
        raise ValueError("the model rewrites texts")
    kinds = ((model.is_unused, None), (model.is_byte, BYTE), (model.is_control, CONTROL), (model.is_unknown, UNKNOWN))
    pieces = []
    for i in range(model.get_piece_size()):
        kind = next((k for test, k in kinds if test(i)), NORMAL)
        if kind is None:
            raise ValueError("the model has unused pieces")
        pieces.append((model.id_to_piece(i), model.get_score(i), kind))
    return pieces


class PrefixTable:
    """The encoding of a string whose single characters are always tokens, known or not."""

    def __init__(self, scores):
        """`scores`: piece to score; of all neighbours that form a piece, the one with the highest
        score merges first, the leftmost of equals."""
        self.scores, self.pairs = scores, {}
        self.found = ahocorasick.Automaton()
        for piece in scores:
            if len(piece) > 1:
                self.found.add_word(piece, piece)
        if len(self.found):
            self.found.make_automaton()

    def merged(self, text):
        """Tokens of a short string, merge by merge."""
        parts = list(text)
        while len(parts) > 1:
            options = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not options:
                break
            _, i = min(options)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, before, token):
        """Whether `token` follows `before` ("": nothing) in the encoding of the two."""
        key = before, token
        if key not in self.pairs:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merged(before + token) == ([before, token] if before else [token])
        return self.pairs[key]

    def last_tokens(self, text):
        """The last token of every prefix; "" of the empty one.  Linear in the text: tokens that
        end at one place are at most as many as the longest piece has characters."""
        last = [""]
        matches = self.found.iter(text) if len(self.found) else iter(())
        match = next(matches, None)
        for end, char in enumerate(text):
            token = char
            while match is not None and match[0] == end:
                if token is char and self.compatible(last[end + 1 - len(match[1])], match[1]):
                    token = match[1]
                match = next(matches, None)
            last.append(token)
        return last

    def tokens(self, text):
        last, at, out = self.last_tokens(text), len(text), []
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]


class Coder:
    """Encodes to ids written in decimal and joined by commas, and decodes them."""

    def __init__(self, pieces):
        known = [(i, p, s) for i, (p, s, kind) in enumerate(pieces) if kind == NORMAL]
        self.ids = {p: str(i) for i, p, _ in known}
        self.table = PrefixTable({p: s for _, p, s in known})
        self.bytes = {int(p[1:-1], 16): str(i) for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next((str(i) for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), None)
        self.surface, self.spaced = {}, set()
        for i, (p, _, kind) in enumerate(pieces):
            self.surface[str(i)] = {
                NORMAL: p.replace(SPACE, " ").encode(), CONTROL: b"", UNKNOWN: " ⁇ ".encode(),
                BYTE: bytes([int(p[1:-1], 16)]) if kind == BYTE else b""}[kind]
            if kind == NORMAL and p.startswith(SPACE):
                self.spaced.add(str(i))
        # no merge crosses two characters that no piece holds side by side: a text is cut before its
        # spaces, if no piece goes on with one, and around characters that are in no piece; not where
        # unknown neighbours must meet
        inside = {c for _, p, _ in known if len(p) > 1 for c in p} - {SPACE}
        word = "[" + re.escape("".join(sorted(inside))) + "]" if inside else "(?!)"
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for _, p, _ in known)
        self.cut = re.compile("(?s).+" if crossing or not self.bytes else f"(?s){SPACE}+{word}*|{word}+|.").findall
        self.memory = {}

    def run_ids(self, run):
        out = []
        for token in self.table.tokens(run):
            if token in self.ids:
                out.append(self.ids[token])
            elif self.bytes:
                out.extend(map(self.bytes.__getitem__, token.encode()))
            # neighbours the vocabulary lacks are one unknown id
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return ",".join(out)

    def encode(self, text):
        if not text:
            return ""
        runs, memory = self.cut(SPACE + text.replace(" ", SPACE)), self.memory
        if len(memory) > MEMORY:
            memory.clear()
        long = {}
        for run in set(runs).difference(memory):
            (memory if len(run) <= REMEMBERED else long)[run] = self.run_ids(run)
        if long:
            return ",".join([long[r] if r in long else memory[r] for r in runs])
        return ",".join(map(memory.__getitem__, runs))

    def decode(self, ids):
        """Bytes of the decoded text in UTF-8."""
        ids = ids.split(",") if ids else []
        out = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.surface[i]), None)
        return out[first in self.spaced:].decode("utf-8", "each_byte").encode()


_CODERS = {}


def coder(pieces, tag):
    """One coder per worker and vocabulary; its tables and memory serve all its batches."""
    if tag not in _CODERS:
        _CODERS[tag] = Coder(pieces)
    return _CODERS[tag]


def encode_documents(spark, docs, model_file, with_ids=True):
    """doc_id, n_tokens, ids (optional), digests of the ids and of the text decoded from them.

    Equals the library's `encode` and `decode` without begin or end ids and sampling.  A null text
    counts as empty: no ids, digests of nothing.  A null doc_id stays null, repeated rows give
    repeated results, an empty table gives none, other columns are ignored.  A text of any length
    without a space takes time and memory in proportion to its length.  The vocabulary is read
    once on the driver and sent to the workers; its size is the file's, whatever the corpus.
    """
    shared = spark.sparkContext.broadcast(load_pieces(model_file))

    def run(batch):
        c = coder(shared.value, model_file)
        out = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if with_ids:
            out["ids"] = []
        for text in batch["text"]:
            ids = c.encode(text)
            out["n_tokens"].append(ids.count(",") + 1 if ids else 0)
            out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode(ids)).hexdigest())
            if with_ids:
                out["ids"].append(list(map(int, ids.split(","))) if ids else [])
        return out

    kind = dict(docs.dtypes)["doc_id"]
    ids = ", ids array<int>" if with_ids else ""
    return map_batches(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{ids}")
