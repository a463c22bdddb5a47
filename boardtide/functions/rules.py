"""Ordered rule lists and match-in-context search as column expressions."""

import math

from pyspark.sql import Column, functions as F

from boardtide import fixed
from boardtide.functions.text import FLAGS, _col, matches

MARK, END = "\u0001", "\u0002"


def first_match(rules, c) -> Column:
    """Label of the first rule whose pattern occurs in the text; null when none does."""
    text = _col(c)
    chain = None
    for label, pattern in rules:
        hit = matches(text, pattern)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain


def lookup(mapping, key, default=None) -> Column:
    """Value of a small literal mapping as a CASE chain (stays in generated code)."""
    chain = None
    for k, v in mapping.items():
        chain = (F.when(key == F.lit(k), F.lit(v)) if chain is None
                 else chain.when(key == F.lit(k), F.lit(v)))
    return chain if default is None else chain.otherwise(F.lit(default))


def bind(value, body) -> Column:
    """`body(value)` with `value` evaluated once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def _without_marks(c):
    return F.translate(_col(c), MARK + END, "")


def demanded_years(text) -> Column:
    """Largest number of years of experience the text asks for, ignoring company history.

    Every match is marked in place, so a rejected match still consumes its text.  The number
    is then read after each mark that no history phrase directly precedes.  `text` must have
    its white space collapsed, which makes the phrase sit exactly one space before the mark.
    """
    marked = F.regexp_replace(_without_marks(text), FLAGS + fixed.YEARS_DEMANDED, MARK + "$0")
    asked = (FLAGS + MARK + "(?<!" + fixed.YEARS_AS_HISTORY + r"\s" + MARK + ")"
             + fixed.YEARS_LEAD_IN + r"(\d{1,2})")
    found = F.regexp_extract_all(marked, F.lit(asked), F.lit(1))
    return F.array_max(F.transform(found, lambda x: x.try_cast("int")))


def any_match_outside(text, pattern, reject, before, after, min_match_chars) -> Column:
    """True when some match of `pattern` has no `reject` match in its surrounding window.

    The window is `before` characters left of the match, the match, and `after` characters
    right of it.  Marking splits the text at match starts; since each match has at least
    `min_match_chars` characters, a bounded number of neighbouring pieces (cut to the window
    size) always covers the window, so the work is linear in the text.
    """
    reach_left = math.ceil(before / min_match_chars) + 1
    reach_right = math.ceil(after / min_match_chars) + 1

    def cut(piece):
        plain = F.replace(piece, F.lit(END), F.lit(""))
        return F.struct(
            F.right(plain, F.lit(before)).alias("tail"),
            F.left(plain, F.lit(after)).alias("head"),
            F.substring_index(piece, END, 1).alias("hit"),
            F.left(F.substring_index(piece, END, -1), F.lit(after)).alias("rest"),
        )

    def window(pieces, i):
        # pieces[0] is the text before the first match; pieces[i] starts with match i
        lefts = F.slice(pieces, F.greatest(i - reach_left, F.lit(0)) + 1,
                        F.least(i, F.lit(reach_left)))
        left = F.array_join(F.transform(lefts, lambda z: z["tail"]), "")
        right = F.array_join(
            F.transform(F.slice(pieces, i + 2, reach_right), lambda z: z["head"]), "")
        return F.concat(F.right(left, F.lit(before)), pieces[i]["hit"],
                        F.left(F.concat(pieces[i]["rest"], right), F.lit(after)))

    def some_free(pieces):
        free = F.exists(F.sequence(F.lit(1), F.size(pieces) - 1),
                        lambda i: ~matches(window(pieces, i), reject))
        return F.when(F.size(pieces) > 1, free).otherwise(False)

    marked = F.regexp_replace(_without_marks(text), FLAGS + pattern, MARK + "$0" + END)
    return bind(F.transform(F.split(marked, MARK), cut), some_free)
