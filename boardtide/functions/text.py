"""Column functions over text.  All patterns ignore case and treat text as Unicode."""

from pyspark.sql import Column, functions as F

from boardtide import fixed
from boardtide.functions.entities import unescape

FLAGS = "(?iU)"
# white space as `strip()` understands it: Unicode white space plus the ASCII separators
_WS = r"[\s\x{1C}-\x{1F}]"
_STRIP = rf"(?U)^{_WS}+|{_WS}+$"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def matches(c, pattern) -> Column:
    """True when `pattern` occurs anywhere in the text (ignore case, Unicode)."""
    return _col(c).rlike(FLAGS + pattern)


def strip(c) -> Column:
    return F.regexp_replace(_col(c), _STRIP, "")


def collapse(c) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(_col(c), rf"(?U){_WS}+", " ")


def blank_to_empty(c) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def none_if_empty(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def first_filled(*cols) -> Column:
    """First value that is neither null nor the empty string, else the empty string."""
    return F.coalesce(*[none_if_empty(c) for c in cols], F.lit(""))


def replace_all(c, pairs) -> Column:
    out = _col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def strip_tags(c) -> Column:
    return F.regexp_replace(_col(c), "<[^>]+>", " ")


def clean_text(c) -> Column:
    """Flat lower-case text: tags to spaces, six entities in order, white space collapsed."""
    bare = replace_all(strip_tags(blank_to_empty(c)), fixed.CLEAN_ENTITIES)
    return F.lower(F.trim(collapse(bare)))


def tag_text(fragment) -> Column:
    """Visible text of an HTML fragment."""
    return F.trim(collapse(unescape(strip_tags(fragment))))


def escape_markup(c) -> Column:
    return replace_all(c, (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")))


def join_distinct(array, separator="; ") -> Column:
    """Non-empty items, first occurrence kept, in order, joined."""
    kept = F.filter(array, lambda x: x.isNotNull() & (x != ""))
    return F.array_join(F.array_distinct(kept), separator)


def join_filled(array, separator="; ") -> Column:
    """Non-empty items in order, duplicates kept, joined."""
    return F.array_join(F.filter(array, lambda x: x.isNotNull() & (x != "")), separator)


def split_pipe(c) -> Column:
    """Items of a pipe-joined list, blank items dropped."""
    parts = F.split(blank_to_empty(c), r"\|")
    return F.filter(parts, lambda p: strip(p) != "")


def key_part(c) -> Column:
    """Lower-case slug; outer white space turns into outer dashes, which are cut."""
    lowered = F.lower(_col(c).cast("string"))
    return F.btrim(F.regexp_replace(lowered, "[^a-z0-9]+", "-"), F.lit("-"))


def job_key(platform, firm_id, external_id, on_blank="null") -> Column:
    """`platform:firm:id`, each part a slug.  A blank part is null, or an error on request."""
    parts = [key_part(p) for p in (platform, firm_id, external_id)]
    whole = F.concat_ws(":", *parts)
    ok = F.lit(True)
    for p in parts:
        ok = ok & F.coalesce(p != "", F.lit(False))
    if on_blank == "error":
        return F.when(ok, whole).otherwise(
            F.raise_error(F.concat(F.lit("job key needs three non-empty parts: "), whole))
        )
    return F.when(ok, whole)


def slug_chars(c) -> Column:
    """Each character that is not a letter or digit becomes one dash; outer dashes removed."""
    return F.btrim(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]", "-"), F.lit("-"))


def mentions_place(*cols, place=fixed.PLACE) -> Column:
    """Any of the texts contains the place name, ignoring case.  Null-safe."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(F.contains(F.lower(_col(c)), F.lit(place.lower())), F.lit(False))
    return hit


def any_mentions_place(array, place=fixed.PLACE) -> Column:
    return F.coalesce(
        F.exists(array, lambda x: F.contains(F.lower(x), F.lit(place.lower()))), F.lit(False)
    )


def has_place_code(c, pattern=fixed.PLACE_CODE_PATTERN) -> Column:
    """Word-bounded place name or country code ("Glasgow" holds "sg" and must not match)."""
    return F.coalesce(matches(c, pattern), F.lit(False))


def to_json_extra(**fields) -> Column:
    """Pack scalar columns of mixed types into one JSON string; nulls stay visible."""
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )
