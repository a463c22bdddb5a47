"""Similarity of short strings on a 0..100 scale, as columns.

Spark has an edit distance with substitutions but none built on the longest common subsequence.
Its length is folded here over the characters of the longer string with the bit-parallel
recurrence of Hyyrö (2004): the shorter string is a row of bits, BITS to a 64-bit integer so that
sums keep their carry, and one step is an addition and three bit operations.

The functions that begin with an underscore and take strings are the same scores in plain Python,
for code that already runs inside a task.
"""

from pyspark.sql import functions as F

BITS = 60
FULL = (1 << BITS) - 1
SPACES = r"(?U)[\s\x{1C}-\x{1F}]+"


def _lcs(a, b):
    if not a or not b:
        return 0
    where = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & where.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def _ratio(a, b):
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * _lcs(a, b) / total


def _share(distance, total):
    return 100.0 if total == 0 else 100.0 * (1 - distance / total)


def _token_set_ratio(a, b):
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    common = left & right
    if common and (left <= right or right <= left):
        return 100.0
    da, db = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    s = len(" ".join(sorted(common)))
    sa, sb = s + (s > 0) + len(da), s + (s > 0) + len(db)
    best = _share(len(da) + len(db) - 2 * _lcs(da, db), sa + sb)
    if s:
        best = max(best, _share(1 + len(da), s + sa), _share(1 + len(db), s + sb))
    return best


def _partial_ratio(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n, m = len(a), len(b)
    spans = {(max(0, i), min(m, i + n)) for i in range(1 - n, m)}
    best = max(_ratio(a, b[lo:hi]) for lo, hi in spans)
    if n == m:
        best = max(best, max(_ratio(b, a[lo:hi]) for lo, hi in spans))
    return best


def _let(value, use):
    """`use(value)` with `value` computed once, however often it is read."""
    return F.transform(F.array(value), use)[0]


def one_if(score, test):
    """Generates the row with `score` if it passes `test`.  As a generator it is computed once per
    row, after what came before, where a filter would move and compute it again."""
    return F.explode(F.filter(F.array(score), test))


def _long(n):
    return F.lit(n).cast("bigint")


def _chars(c):
    return F.filter(F.split(c, ""), lambda x: x != "")


def _bits(chars, char):
    """Where `char` stands in at most BITS characters, a bit per place."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(chars) - 1), _long(0),
        lambda found, i: F.when(F.get(chars, i) == char, found.bitwiseOR(F.call_function("shiftleft", _long(1), i)))
        .otherwise(found))


def _words(chars):
    """The characters in groups of BITS."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / BITS).cast("int")),
                       lambda w: F.slice(chars, w * BITS + 1, F.lit(BITS)))


class _Short:
    """A short string of 1 to BITS characters: its bits per character, and the fold over them."""

    @staticmethod
    def table(chars):
        return F.map_from_entries(F.transform(
            F.array_distinct(chars), lambda c: F.struct(c, _bits(chars, c))))

    @staticmethod
    def nothing(table):
        return _long(0)

    @staticmethod
    def fold(row):
        left = F.aggregate(row, _long(FULL), lambda v, x: (v + v.bitwiseAND(x)).bitwiseAND(_long(FULL)).bitwiseOR(
            v.bitwiseAND(F.bitwise_not(x))))
        return BITS - F.bit_count(left)


class _Any:
    """The same for strings of any length: a carry goes from each integer to the next."""

    @staticmethod
    def table(chars):
        return _let(_words(chars), lambda words: F.map_from_entries(F.transform(
            F.array_distinct(chars), lambda c: F.struct(c, F.transform(words, lambda w: _bits(w, c))))))

    @staticmethod
    def nothing(table):
        return F.transform(F.map_values(table)[0], lambda _: _long(0))

    @staticmethod
    def fold(row):
        def step(v, x):
            def word(so_far, p):
                return _let(p["v"] + p["v"].bitwiseAND(p["x"]) + so_far["carry"], lambda total: F.struct(
                    F.shiftright(total, BITS).alias("carry"),
                    F.concat(so_far["out"], F.array(total.bitwiseAND(_long(FULL)).bitwiseOR(
                        p["v"].bitwiseAND(F.bitwise_not(p["x"]))))).alias("out")))
            pairs = F.zip_with(v, x, lambda a, b: F.struct(a.alias("v"), b.alias("x")))
            start = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("out"))
            return F.aggregate(pairs, start, word)["out"]

        left = F.aggregate(row, F.transform(F.get(row, F.lit(0)), lambda _: _long(FULL)), step)
        return F.aggregate(left, F.lit(0), lambda n, v: n + BITS - F.bit_count(v))


def _row(kind, s, l):  # noqa: E741
    """For every character of the longer string, where it stands in the shorter one."""
    return _let(_let(_chars(s["text"]), kind.table), lambda t: F.transform(
        _chars(l["text"]), lambda c: F.coalesce(F.try_element_at(t, c), kind.nothing(t))))


def _by_length(a, b, use):
    """`use(shorter, longer)` over struct columns with `text` and `size`; of equals, a comes first."""
    side = lambda c: F.struct(c.alias("text"), F.length(c).alias("size"))
    pair = F.when(F.length(a) > F.length(b), F.struct(side(b).alias("s"), side(a).alias("l"))).otherwise(
        F.struct(side(a).alias("s"), side(b).alias("l")))
    return _let(pair, lambda p: use(p["s"], p["l"]))


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _lcs_length(a, b):
    """Length of the longest common subsequence."""
    def use(s, l):  # noqa: E741
        def of(kind):
            return kind.fold(_row(kind, s, l))
        return (F.when(s["size"] == 0, 0).when(s["size"] <= BITS, of(_Short)).otherwise(of(_Any)))
    return _by_length(a, b, use)


def _nulls(a, b, score):
    """Null if a side is, else `score` of the two, each computed once."""
    both = F.struct(_col(a).alias("a"), _col(b).alias("b"))
    return _let(both, lambda p: F.when(p["a"].isNotNull() & p["b"].isNotNull(), score(p["a"], p["b"])))


def ratio(a, b):
    """Share of the characters of both strings that a longest common subsequence covers."""
    def score(a, b):
        total = F.length(a) + F.length(b)
        return F.when(total == 0, 100.0).otherwise(F.lit(200.0) * _lcs_length(a, b) / total)
    return _nulls(a, b, score)


def _part(distance, total):
    return F.when(total == 0, 100.0).otherwise(F.lit(100.0) * (1 - distance / total))


def token_set_ratio(a, b, at_least=None):
    """The best of three comparisons of shared and differing words.

    With `at_least`, scores from there on are exact and lower ones may come out lower still: the
    edit distance, which subsequences cannot beat, then spares most pairs the fold."""
    def words(c):
        return F.array_sort(F.array_distinct(F.filter(F.split(c, SPACES), lambda w: w != "")))

    def facts(a, b):
        return _let(F.struct(words(a).alias("a"), words(b).alias("b")), lambda w: F.struct(
            F.size(w["a"]).alias("na"), F.size(w["b"]).alias("nb"),
            F.length(F.array_join(F.array_intersect(w["a"], w["b"]), " ")).alias("s"),
            F.array_join(F.array_except(w["a"], w["b"]), " ").alias("da"),
            F.array_join(F.array_except(w["b"], w["a"]), " ").alias("db")))

    def score(a, b):
        def use(f):
            la, lb, s = F.length(f["da"]), F.length(f["db"]), f["s"]
            gap = F.when(s > 0, 1).otherwise(0)
            total = 2 * (s + gap) + la + lb
            differing = _part(la + lb - 2 * _lcs_length(f["da"], f["db"]), total)
            if at_least is not None:
                room = F.floor(total * (1 - at_least / 100.0) + 1e-9).cast("int")
                differing = F.when(F.call_function("levenshtein", f["da"], f["db"], room) < 0, 0.0).otherwise(differing)
            shared = F.when(s > 0, F.greatest(_part(1 + la, 2 * s + 1 + la), _part(1 + lb, 2 * s + 1 + lb))).otherwise(0.0)
            return (F.when((f["na"] == 0) | (f["nb"] == 0), 0.0)
                    .when((s > 0) & ((la == 0) | (lb == 0)), 100.0).otherwise(F.greatest(differing, shared)))
        return _let(facts(a, b), use)
    return _nulls(a, b, score)


def partial_ratio(a, b):
    """The best `ratio` of the shorter string with a window of its length over the longer one,
    windows that reach over the ends included; of strings of equal length, both ways round."""
    def windows(s, l, kind):  # noqa: E741
        n, m = s["size"], l["size"]

        def best(row):
            # windows by where they begin and end in the longer string
            spans = F.transform(F.sequence(1 - n, m - 1), lambda i: F.struct(
                F.greatest(F.lit(0), i).alias("lo"), F.least(m, i + n).alias("hi")))
            return F.array_max(F.transform(spans, lambda x: F.lit(200.0) * kind.fold(
                F.slice(row, x["lo"] + 1, x["hi"] - x["lo"])) / (n + x["hi"] - x["lo"])))
        return _let(_row(kind, s, l), best)

    def use(s, l):  # noqa: E741
        def both(kind):
            return F.when(s["size"] == l["size"], F.greatest(windows(s, l, kind), windows(l, s, kind))).otherwise(
                windows(s, l, kind))
        return (F.when(l["size"] == 0, 100.0).when(s["size"] == 0, 0.0)
                .when(s["size"] <= BITS, both(_Short)).otherwise(both(_Any)))
    return _nulls(a, b, lambda a, b: _by_length(a, b, use))
