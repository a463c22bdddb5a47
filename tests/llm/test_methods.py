"""The methods alone, against brute force on small inputs."""

import itertools
import random

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
import base64

from boardtide.llm import bpe, compact_windows, crf, mincut, packing, pii, prob_minhash, topk
from boardtide.llm.shingles import shingles, word_hashes


def test_perfect_hash_is_minimal_and_knows_strangers():
    keys = [f"k{i}".encode() for i in range(3000)]
    h = bpe.PerfectHash(keys)
    assert len(h.keys) == len(keys) and [h.get(k) for k in keys] == list(range(3000))
    assert h.get(b"stranger") == -1


def test_bpe_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    c = bpe.Coder(bpe.load_ranks(path), public_tokenizers.PATTERN)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    rng = random.Random(5)
    texts = ["", " ", "a" * 3000, "naïve — 漢字 🙂 don't  \n\n x", "aaabaaab" * 50] + [
        "".join(rng.choice("abcdé 1!\n漢") for _ in range(200)) for _ in range(30)]
    for t in texts:
        ids = c.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(t)
        assert c.decode(ids) == t.encode()


def test_min_cut_is_the_cheapest_labelling():
    rng = random.Random(1)
    for _ in range(40):
        n = rng.randint(1, 8)
        a, b = [rng.random() * 3 for _ in range(n)], [rng.random() * 3 for _ in range(n)]
        edges = [(i, i + 1, rng.random()) for i in range(n - 1)] + [
            (i, j, rng.random()) for i in range(n) for j in range(i + 2, n) if rng.random() < 0.3]

        def cost(lab):
            return sum(b[i] if lab[i] else a[i] for i in range(n)) + sum(
                w for i, j, w in edges if lab[i] != lab[j])

        best = min(cost(lab) for lab in itertools.product([True, False], repeat=n))
        assert abs(cost(mincut.min_cut(a, b, edges)) - best) < 1e-6


def test_main_text_of_pages():
    html = ("<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
            "<header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></ul></nav>"
            "<div class='ad'>Buy this now.</div><article><header><h1>Head &amp; line</h1></header>"
            "<p><b>First\n  part.<br><p>Second &lt;part&gt;.</p><form><input><button>Go</button></form>"
            "<div class='comments'><p>A reader says something long about it all.</p></div></article>"
            "<aside>Side</aside><footer>&copy; x</footer></body></html>")
    assert mincut.main_text(html) == "Head & line\nFirst part.\nSecond <part>."
    assert mincut.main_text(None) == mincut.main_text("") == mincut.main_text("<p> </p>") == ""
    assert mincut.main_text("<p>One two three four five six.</p>") == "One two three four five six."


def test_main_text_without_end_of_head_and_of_formulas():
    for begin in ("<html><head><title>T</title><meta charset=utf-8><body>", "<head><style>p{}</style>"):
        assert mincut.main_text(begin + "<p>One two three four five six.</p>") == "One two three four five six."
    assert mincut.main_text("<head><title>T</title>One two three four five six.") == "One two three four five six."
    assert mincut.main_text("<article><p>Where <math><mi>x</mi></math> is <object>a drawing</object> here."
                            "</article>") == "Where x is a drawing here."


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    for n in range(1, 7):
        emit, turn = rng.normal(size=n), rng.normal(size=(2, 2))
        weights = {}
        for y in itertools.product([0, 1], repeat=n):
            s = sum(e if v else 0 for e, v in zip(emit, y)) + sum(turn[a, b] for a, b in zip(y, y[1:]))
            weights[y] = np.exp(s)
        z = sum(weights.values())
        good, pairs = crf.marginals(emit, turn)
        for i in range(n):
            assert abs(good[i] - sum(w for y, w in weights.items() if y[i]) / z) < 1e-9
        for a, b in itertools.product([0, 1], repeat=2):
            want = sum(w * sum((u, v) == (a, b) for u, v in zip(y, y[1:])) for y, w in weights.items()) / z
            assert abs(pairs[a, b] - want) < 1e-9


def test_signature_estimates_probability_jaccard():
    a, b = np.arange(1, 401, dtype=np.uint64) * np.uint64(7919), np.arange(41, 441, dtype=np.uint64) * np.uint64(7919)
    x, y = (prob_minhash.signature(e, np.ones(400), 1024) for e in (a, b))
    assert abs((x == y).mean() - 360 / 440) < 0.05
    w = np.r_[np.full(200, 3.0), np.ones(200)]
    order = np.random.default_rng(0).permutation(400)
    assert (prob_minhash.signature(a, w) == prob_minhash.signature(a[order], w[order])).all()


def test_packer_takes_the_smallest_sum_of_squares():
    rng, size = random.Random(3), 12
    p, level = packing.Packer(size), {}
    for _ in range(300):
        length = rng.randint(1, size)
        gaps = np.zeros(size + 1, int)
        for used in level.values():
            gaps[size - used] += 1

        def after(g):
            c = gaps.copy()
            if g < size:
                c[g] -= 1
            c[g - length] += 1
            return int((c[1:size] ** 2).sum())

        sequence, offset = p.place(length)
        assert level.get(sequence, 0) == offset and offset + length <= size
        choices = [g for g in range(length, size) if gaps[g]] + [size]
        if length < size:
            assert after(size - offset) == min(map(after, choices))
        level[sequence] = offset + length


def test_no_random_access_keeps_the_best():
    rng = np.random.default_rng(4)
    for n in (1, 5, 6, 300, 1000):
        x = np.floor(rng.normal(size=(n, 6)) * 50).astype(np.int64)
        x[: n // 3] = x[0]
        order = np.argsort(x, axis=0, kind="stable").T
        lists = order, np.take_along_axis(x.T, order, axis=1)
        for q in (x[0], np.zeros(6, np.int64), -x[-1]):
            alive = topk.no_random_access(lists, q, 5, -2 ** 62)
            scores = x @ q
            floor = np.sort(scores)[-min(5, n)]
            assert set(np.flatnonzero(scores > floor)) <= set(alive.tolist())
            assert (scores[alive] >= floor).sum() >= min(5, n)


def test_queries_read_the_lists_together():
    rng = np.random.default_rng(8)
    for scale in (50, 2 ** 27):                        # the second is not exact in floats
        x = np.floor(rng.normal(size=(900, 8)) * scale).astype(np.int64)
        order = np.argsort(x, axis=0, kind="stable").T
        lists = order, np.take_along_axis(x.T, order, axis=1)
        queries = np.concatenate([x[:40], np.zeros((1, 8), np.int64), -x[40:60]])
        scores = queries @ x.T
        least = np.sort(scores, axis=1)[:, -5]
        for floors in (np.full(61, topk.NO_FLOOR), least, np.where(np.arange(61) % 2, least, topk.NO_FLOOR)):
            met = dict(topk.read_in_step(lists, queries, 5, floors))
            assert sorted(met) == list(range(61))
            for i, alive in met.items():
                assert set(np.flatnonzero(scores[i] >= least[i])) <= set(alive.tolist())
            assert np.mean([len(met[i]) for i in range(61) if i != 40]) < 450


def test_compact_windows_hold_every_run_once():
    values = np.random.default_rng(6).integers(0, 40, 30).astype(np.uint64)
    found = compact_windows.windows(values, 5)
    for a in range(30):
        for b in range(a + 4, 30):
            held = [w for w in found if w[0] <= a <= w[1] <= b <= w[2]]
            assert len(held) == 1 and held[0][1] == a + int(values[a:b + 1].argmin())


def test_short_texts_are_one_shingle():
    assert len(shingles([])) == 0 and len(shingles(["a"])) == len(shingles(list("abcde"))) == 1
    assert len(shingles(list("abcdef"))) == 2


def test_windows_in_a_found_passage_are_not_swept(monkeypatch):
    items, asked, sweep = np.arange(4000), [], compact_windows.agreeing

    def counting(met, enough, narrow, some=slice(None)):
        asked.append(len(met[some]))
        return sweep(met, enough, narrow, some)

    monkeypatch.setattr(compact_windows, "agreeing", counting)
    at = np.repeat(np.arange(50, 3900, 10), 8)
    met = np.column_stack([at, at - 50, at + 60, at, at - 50, at + 60, np.tile(np.arange(8), len(at) // 8)])
    assert compact_windows.equal_passages(items, items, met, 46, 0.8, 4) == [(0, 3999, 0)]
    assert sum(asked) < len(met) / 20


def test_words_that_are_not_unicode_have_hashes():
    words = ["a", "\ud800b", "c"]
    assert word_hashes(words).tolist() == [
        xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words] and not len(word_hashes([]))


def test_reliabilities_tell_good_labelers():
    counts = {("secret", "1111"): 90, ("secret", "0000"): 100, ("secret", "0001"): 10, ("secret", "0111"): 20}
    post = pii.expectation_maximisation(counts)
    assert post["secret", "1111"] > 0.9 and post["secret", "0000"] < 0.1
    w = pii.span_classifier(counts, post)
    assert w[0] < 0 < sum(w)
    assert pii.expectation_maximisation({}) == {} and len(pii.span_classifier({}, {})) == 5


def test_chunks_have_the_ids_of_the_text():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", " ", "\u0391\u03a3 \u03a3. \u039f\u0394\u039f\u03a3,x", "a\u00a0b\u2003c \x1cq\x1dz", "e\u0301 \u0308x", "\u0130stanbul",
             "it's don't 12,345\t\ty\r\nz", "\x85a\x0bb\x0cc", "\ufb01 \u2460 \uff12", "\u1100\u1161 \u11a8", "x\u0000y \U0001f600!?"] * 2
    known = {}
    for size in (500_000, 3):
        got = packing.token_bytes(tok, texts, known, size)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
            tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_known_chunks_are_looked_up_once():
    from tokenizers import Tokenizer

    class Known(dict):
        again = 0

        def __getitem__(self, chunk):
            self.again += 1
            return super().__getitem__(chunk)

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    known, texts = Known(), ["one two  two\n\tthree\r\n", "\n", "  four one\x0bfive ", None]
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        known.again = 0
        got = packing.token_bytes(tok, texts, known)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert known.again == 0
