"""What all normalisers share: validation, projection to the posting layout, outcomes."""

from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.functions import text, urls


UNREADABLE = "payload is not readable"
TRIMMED = ("title", "firm_id", "external_id", "apply_url")


def elements(items, layout, outer=False):
    """pos, j: one parsed row per payload element, each from its own JSON text.

    A bad element cannot spoil its neighbours.  Parsing happens inside the explode, where no
    later filter can be pushed to: each element is parsed exactly once.  `outer` keeps a row with
    nulls where there are no items.
    """
    return (F.posexplode_outer if outer else F.posexplode)(F.transform(items, lambda raw: F.from_json(raw, layout))).alias("pos", "j")


def judged(landed, items):
    """`landed` with its parsed `items`.  A response without them is a failed read, whatever its
    status was: an error page must not look like an empty board."""
    ok = F.coalesce("ok", F.lit(False))
    parsed = landed.withColumn("items", F.when(ok, items))
    broken = ok & F.col("items").isNull()
    return parsed.withColumns({
        "ok": ok & ~broken, "error": F.when(broken, UNREADABLE).otherwise(F.col("error"))})


def drop_failed(rows, landed, group):
    """A firm (or site) with a failed read yields nothing at all."""
    failed = landed.filter(~F.coalesce("ok", F.lit(False))).select(*group).distinct()
    return rows.join(failed, list(group), "left_anti")


def plain(row, *names):
    """Plain-string fields of a payload row: JSON null and absent both read as empty."""
    return [F.coalesce(row[n], F.lit("")).alias(n) for n in names]


def readable_date(raw, parsed):
    """An optional date may be absent, but one that is present has to be a date."""
    return raw.isNull() | parsed.isNotNull()


def posting_checks():
    """The invariants every stored posting meets."""
    filled = lambda c: text.strip(F.coalesce(F.col(c), F.lit(""))) != ""
    return (filled("title") & filled("firm_id") & filled("external_id")
            & urls.is_absolute(text.strip("apply_url"))
            & F.col("source_platform").isin(*fixed.PLATFORMS)
            & (F.col("posted_date_basis").isNull()
               | F.col("posted_date_basis").isin(*fixed.DATE_BASES))
            & text.job_key("source_platform", "firm_id", "external_id").isNotNull())


def split_valid(rows):
    """(valid, quarantined): rows that meet the invariants, trimmed, and the others as they are."""
    ok = F.coalesce(posting_checks(), F.lit(False))
    return rows.filter(ok).withColumns({c: text.strip(c) for c in TRIMMED}), rows.filter(~ok)


def require_valid(rows):
    """A stored row that breaks an invariant stops the run, which names it."""
    ok = F.coalesce(posting_checks(), F.lit(False))
    complaint = F.raise_error(F.concat(
        F.lit("stored posting breaks the invariants: "), F.coalesce("job_key", F.lit("no key"))))
    return rows.filter(F.when(ok, True).otherwise(complaint.cast("boolean")))


def mark(rows, required, here):
    """Add valid (required fields and storage invariants hold), here and job_key."""
    return rows.withColumns({
        "valid": F.coalesce(required & posting_checks(), F.lit(False)), "here": here,
        "job_key": text.job_key("source_platform", "firm_id", "external_id"),
    })


def postings_of(rows):
    """Valid rows that belong here, trimmed, in the posting layout plus order columns."""
    kept = rows.filter(F.col("valid") & F.col("here"))
    return kept.withColumns({c: text.strip(c) for c in TRIMMED})


def stored(postings):
    return schema.conform(postings, schema.POSTING)


def invalid_note(n):
    return F.when(n > 0, F.concat(n.cast("string"), F.lit(" rows failed validation"))).otherwise("")


def outcomes_of(landed, rows, platform, group=("firm_id",)):
    """One outcome per firm that was read: its rows, or why it could not be read."""
    reads = landed.groupBy(*group).agg(
        F.bool_and(F.coalesce("ok", F.lit(False))).alias("ok"),
        F.max(F.when(~F.coalesce("ok", F.lit(False)), F.coalesce("error", F.lit("")))).alias("why"))
    counts = rows.groupBy(*group).agg(
        F.count_if(F.col("valid") & F.col("here")).alias("n"),
        F.count_if(~F.col("valid")).alias("bad"))
    joined = reads.join(counts, list(group), "left").na.fill(0, ["n", "bad"])
    return joined.select(
        *group, F.lit(platform).alias("platform"), "ok",
        F.when(F.col("ok"), F.col("n")).otherwise(0).cast("bigint").alias("row_count"),
        F.when(F.col("ok"), invalid_note(F.col("bad")))
        .otherwise(F.col("why")).alias("error"))


def readable(landed):
    return landed.filter(F.coalesce("ok", F.lit(False)))
