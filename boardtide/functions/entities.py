"""HTML character references as columns.

A text is cut at its ampersands; each piece then begins with a reference or not.  Names that end in
a semicolon are looked up whole in a literal map, by first letter and name.  The older names that
need none count as the longest prefix of the piece, which one pattern finds.  Numbers follow the
rules browsers use: the Windows code page for 128 to 159, nothing for what is no character.
"""

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import functions as F

NO_CHARACTER = "�"
LARGEST = 0x10FFFF


@lru_cache
def _tables():
    """(JSON of first letter -> name with semicolon -> text, of name without -> text, their pattern)."""
    whole, bare = {}, {}
    for name, value in html5.items():
        if name.endswith(";"):
            whole.setdefault(name[0], {})[name] = value
        else:
            bare[name] = value
    names = "|".join(sorted(bare, key=lambda n: (-len(n), n)))
    return json.dumps(whole), json.dumps(bare), f"^(?:{names})"


def _code_page():
    """The characters browsers read numbers 128 to 159 as."""
    return "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))


def _character(n):
    """A code point as text."""
    # the mark in front is taken for the byte order and goes
    wide = F.concat(F.unhex(F.lit("0000FEFF")), F.unhex(F.lpad(F.hex(n), 8, "0")))
    nothing = (n.between(1, 8) | n.between(14, 31) | (n == 11) | (n == 127) | n.between(0xFDD0, 0xFDEF)
               | n.bitwiseAND(F.lit(0xFFFF)).isin(0xFFFE, 0xFFFF))
    return (F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > LARGEST), NO_CHARACTER)
            .when(n.between(128, 159), F.substring(F.lit(_code_page()), (n - 127).cast("int"), F.lit(1)))
            .when(nothing, "").otherwise(F.decode(wide, "UTF-32")))


def _number(piece):
    """A piece that begins with # decoded; numbers too long to be a character are none."""
    def value(pattern, base):
        digits = F.regexp_extract(piece, pattern, 1)
        number = F.conv(F.when(digits == "", "0").otherwise(digits), base, 10).cast("bigint")
        return F.when(F.length(digits) <= 9, number)

    def read(head, n):
        taken = F.regexp_extract(piece, head, 0)
        return F.concat(_character(n), F.substring(piece, F.length(taken) + 1, F.length(piece)))

    return (F.when(piece.rlike("^#[0-9]"), read("^#[0-9]+;?", value("^#0*([0-9]*)", 10)))
            .when(piece.rlike("^#[xX][0-9a-fA-F]"), read("^#[xX][0-9a-fA-F]+;?", value("^#[xX]0*([0-9a-fA-F]*)", 16)))
            .otherwise(F.concat(F.lit("&"), piece)))


def _name(piece):
    whole, bare, pattern = _tables()
    rest = lambda taken: F.substring(piece, F.length(taken) + 1, F.length(piece))
    full = F.regexp_extract(piece, "^[A-Za-z][A-Za-z0-9]{0,30};", 0)
    known = F.try_element_at(F.try_element_at(
        F.from_json(F.lit(whole), "map<string,map<string,string>>"), F.left(piece, F.lit(1))), full)
    short = F.regexp_extract(piece, pattern, 0)
    old = F.try_element_at(F.from_json(F.lit(bare), "map<string,string>"), short)
    return F.coalesce(F.concat(known, rest(full)), F.when(short != "", F.concat(old, rest(short))),
                      F.concat(F.lit("&"), piece))


def unescape(c):
    """All character references of a text decoded, once."""
    c = F.col(c) if isinstance(c, str) else c
    pieces = F.split(c, "&")
    decoded = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
                          lambda p: F.when(p.startswith("#"), _number(p)).otherwise(_name(p)))
    return F.when(F.instr(c, "&") == 0, c).otherwise(F.concat(F.get(pieces, F.lit(0)), F.array_join(decoded, "")))
