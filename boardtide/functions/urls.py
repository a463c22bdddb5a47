"""Facts readable from a URL."""

from pyspark.sql import Column, functions as F

from boardtide import fixed
from boardtide.functions.text import FLAGS, _col, matches


def host_of(url) -> Column:
    """Lower-case host; null when the URL has none.  Unescaped characters later on are fine."""
    host = F.regexp_extract(
        _col(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.nullif(host, F.lit("")))


def path_of(url) -> Column:
    """Path and query as a robots rule sees them; "/" when empty."""
    path = F.regexp_extract(_col(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return F.when(path == "", "/").when(~path.startswith("/"), F.concat(F.lit("/"), path)) \
        .otherwise(path)


def is_absolute(url) -> Column:
    return F.coalesce(_col(url).rlike("(?i)^https?://"), F.lit(False))


def is_job_page(url) -> Column:
    return F.coalesce(matches(url, fixed.JOB_PAGE_URL), F.lit(False))


def job_page_id(url) -> Column:
    return F.regexp_extract(_col(url), FLAGS + fixed.JOB_PAGE_URL, 1)


def place_from_slug(url, codes=fixed.PLACE_CODES, name=fixed.PLACE_NAME) -> Column:
    """Place name when the first word of the segment after /job/ is exactly the place."""
    segment = F.regexp_extract(F.coalesce(_col(url), F.lit("")), "/job/([^/]+)", 1)
    head = F.lower(F.substring_index(segment, "-", 1))
    return F.when(head.isin(*codes), F.lit(name)).otherwise(F.lit(""))


def apply_domain(url, ats_hosts=fixed.ATS_HOSTS) -> Column:
    """Host of an apply link without `www.`; empty when it belongs to a board platform."""
    host = F.regexp_replace(F.coalesce(host_of(url), F.lit("")), r"^www\.", "")
    shared = F.lit(False)
    for h in ats_hosts:
        shared = shared | host.endswith(h)
    return F.when(shared, F.lit("")).otherwise(host)


def resolve_relative(base, path) -> Column:
    """Absolute URL of a link found on `base` (an origin without trailing slash)."""
    path, base = _col(path), _col(base)
    return (
        F.when(is_absolute(path), path)
        .when(path.startswith("//"), F.concat(F.substring_index(base, "//", 1), path))
        .when(path.startswith("/"), F.concat(base, path))
        .otherwise(F.concat(base, F.lit("/"), path))
    )
