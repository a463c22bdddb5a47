"""Employer and firm names."""

from pyspark.sql import Column, functions as F

from boardtide import fixed
from boardtide.functions.text import FLAGS, _col, strip

_JUNK = "[^a-z0-9]+"


def denoise(name, strip_geography=False) -> Column:
    """Lower-case words without legal forms; geography and size words only on request."""
    out = F.regexp_replace(F.lower(_col(name)), FLAGS + fixed.LEGAL_WORDS, " ")
    if strip_geography:
        out = F.regexp_replace(out, FLAGS + fixed.GEO_WORDS, " ")
    return F.trim(F.regexp_replace(out, _JUNK, " "))


def compact(name, strip_geography=False) -> Column:
    return F.regexp_replace(denoise(name, strip_geography), _JUNK, "")


def squash(name) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(F.lower(_col(name)), _JUNK, "")


def brand_variants(name) -> Column:
    """Compact forms of the whole name and of its `/ ( ) ,` parts, distinct, longest first."""
    whole = _col(name)
    parts = F.concat(F.array(whole), F.split(whole, "[/(),]"))
    forms = F.array_distinct(F.transform(parts, lambda part: compact(part)))
    kept = F.filter(forms, lambda v: F.length(v) >= fixed.MIN_BRAND_CHARS)
    return F.array_sort(
        kept,
        lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
        .when(a < b, -1).when(a > b, 1).otherwise(0),
    )


def _stripped(name, noise):
    return strip(F.regexp_replace(F.lower(_col(name)), FLAGS + noise, " "))


def board_denoise(name) -> Column:
    return _stripped(name, fixed.BOARD_NOISE_WORDS)


def tenant_denoise(name) -> Column:
    return _stripped(name, fixed.TENANT_NOISE_WORDS)


def _words(c):
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def _first_word(c):
    return F.coalesce(F.try_element_at(_words(c), F.lit(1)), F.lit(""))


def board_tokens(firm_id, name) -> Column:
    """Plausible board tokens for a firm, most likely first, distinct."""
    firm_id, stripped = _col(firm_id), board_denoise(name)
    packed = F.regexp_replace(stripped, _JUNK, "")
    dashed = F.regexp_replace(F.regexp_replace(stripped, _JUNK, "-"), "^-+|-+$", "")
    plain = [firm_id, packed, dashed, squash(name), _first_word(stripped)]
    early = [
        F.when(base != "", F.concat(base, F.lit(suffix)))
        for base in (firm_id, packed) for suffix in fixed.CAMPUS_SUFFIXES
    ]
    long_enough = lambda t: t.isNotNull() & (F.length(t) >= fixed.MIN_TOKEN_CHARS)
    return F.array_distinct(F.filter(F.array(*plain, *early), long_enough))


def tenant_tokens(firm_id, name) -> Column:
    """Plausible tenant names for a firm; each must be a legal host label."""
    stripped = tenant_denoise(name)
    initials = F.array_join(F.transform(_words(stripped), lambda w: F.left(w, F.lit(1))), "")
    forms = F.array(
        _col(firm_id),
        F.regexp_replace(stripped, _JUNK, ""),
        squash(name),
        _first_word(stripped),
        F.left(initials, F.lit(fixed.INITIALISM_CHARS)),
    )
    return F.array_distinct(F.filter(forms, lambda t: t.rlike(fixed.TENANT_PATTERN)))
