"""Word shingles as 64-bit integers, and seeded random numbers, in numpy."""

import numpy as np
import xxhash

WORDS = 5


def mix(x):
    """A bijection of 64-bit integers with well-spread bits (the splitmix finaliser)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text):
    return (text or "").lower().split()


def word_hashes(words):
    try:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    except UnicodeEncodeError:
        return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words),
                           np.uint64, len(words))


def shingles(words, size=WORDS):
    """One hash per run of `size` words in text order; a shorter text is one shingle, an empty
    one has none."""
    h = word_hashes(words)
    n = max(min(1, len(h)), len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(size, len(h))):
            out = mix(out + h[i:i + n] + np.uint64(i + 1))
    return out


def shingles_of_all(texts, size=WORDS):
    """`shingles` of each list of words, hashed in one go."""
    h = word_hashes([w for words in texts for w in words])
    ends = np.cumsum([len(words) for words in texts])
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out + h[i:i + len(out)] + np.uint64(i + 1))
    return [out[end - len(words):end - size + 1] if len(words) >= size else shingles(words, size)
            for words, end in zip(texts, ends, strict=True)]
