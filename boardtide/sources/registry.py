"""Small dimension files: firm registry, employer aliases, family overrides."""

from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.functions import rules, text
from boardtide.sources.snapshots import folder_exists


def _read_csv(spark, path, layout, order):
    """Trimmed CSV rows with their position in the file; typed and empty when there is none."""
    if not folder_exists(spark, path):
        return spark.createDataFrame([], layout).withColumn(order, F.lit(0).cast("bigint"))
    names = schema.names(layout)
    as_text = ", ".join(f"{n} string" for n in names)
    raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
           .schema(as_text).csv(path))
    return raw.select(*[text.blank_to_empty(text.strip(n)).alias(n) for n in names],
                      F.monotonically_increasing_id().alias(order))


def registry_violations(rows):
    """firm_id, line, problem for every rule a registry row breaks, plus duplicate ids."""
    wired = F.col("status") == "wired"
    platform = F.col("ats_platform")
    need = rules.lookup(
        {p: ",".join(f) for p, f in fixed.REQUIRED_FIELDS.items()}, platform, "")
    filled = F.create_map(*[x for c in ("ats_token", "ats_host", "board_site", "careers_url")
                            for x in (F.lit(c), F.col(c))])
    missing = F.filter(F.split(need, ","), lambda n: (n != "") & (filled[n] == ""))
    unknown = lambda c, allowed: (F.col(c) != "") & ~F.col(c).isin(*allowed)
    checks = [
        (~F.col("firm_id").rlike(r"(?U)^[\p{L}\p{N}_-]*[\p{L}\p{N}][\p{L}\p{N}_-]*$"),
         F.lit("firm_id must be an alphanumeric slug")),
        (F.col("tier").try_cast("bigint").isNull(), F.lit("tier must be a whole number")),
        (unknown("ats_platform", fixed.PLATFORMS), F.concat(F.lit("unknown platform "), platform)),
        (unknown("status", fixed.FIRM_STATUSES), F.concat(F.lit("unknown status "), F.col("status"))),
        (unknown("robots_status", fixed.ROBOTS_STATUSES),
         F.concat(F.lit("unknown robots_status "), F.col("robots_status"))),
        (wired & (platform == ""), F.lit("wired requires a platform")),
        (wired & (F.col("robots_status") == "disallowed"),
         F.lit("robots disallow this board, so it cannot be wired")),
        (wired & (F.size(missing) > 0),
         F.concat(platform, F.lit(" needs "), F.array_join(missing, ", "))),
    ]
    problems = F.filter(F.array(*[F.when(bad, msg) for bad, msg in checks]),
                        lambda p: p.isNotNull())
    broken = rows.select("firm_id", "line", F.explode(problems).alias("problem"))
    copies = (rows.groupBy(F.lower("firm_id").alias("id")).agg(
        F.count("*").alias("n"), F.max_by("firm_id", "line").alias("firm_id"), F.max("line").alias("line"))
              .filter("n > 1").select("firm_id", "line", F.lit("duplicate firm_id").alias("problem")))
    return broken.unionByName(copies)


def typed_registry(rows):
    """Registry rows with their types: blank platform is null, blank statuses get the default."""
    return rows.select(
        F.lower("firm_id").alias("firm_id"), "firm_name", "sector",
        F.col("tier").try_cast("bigint").alias("tier"),
        text.none_if_empty("ats_platform").alias("ats_platform"),
        "ats_token", "ats_host", "board_site", "careers_url",
        text.first_filled("robots_status", F.lit("unknown")).alias("robots_status"),
        text.first_filled("status", F.lit("todo")).alias("status"), "notes", "registry_ord")


def read_registry_rows(spark, path):
    if not folder_exists(spark, path):
        raise FileNotFoundError(f"there is no registry at {path}")
    rows = _read_csv(spark, path, schema.REGISTRY, "registry_ord")
    return rows.filter(F.col("firm_id") != "").withColumn("line", F.col("registry_ord") + 2)


def load_registry(spark, path):
    """The validated registry.  All problems are reported together, then it fails once."""
    rows = read_registry_rows(spark, path)
    problems = registry_violations(rows).orderBy("line").collect()
    if problems:
        listing = "\n".join(f"  line {r.line} ({r.firm_id}): {r.problem}" for r in problems)
        raise ValueError(f"{path} has problems:\n{listing}")
    return typed_registry(rows)


def fetchable(registry, platform=None):
    out = registry.filter((F.col("status") == "wired") & F.col("ats_platform").isNotNull())
    return out if platform is None else out.filter(F.col("ats_platform") == platform)


def select_firms(registry, platform=None, firm_id=None, exclude=()):
    """The firms one run reads: fetchable, optionally one platform or firm, minus exclusions."""
    out = fetchable(registry, platform)
    if firm_id:
        out = out.filter(F.col("firm_id") == firm_id)
    return out.filter(~F.col("ats_platform").isin(*exclude)) if exclude else out


def counts_by(registry, column):
    """Firms per status or platform; rows without a value are not counted."""
    return (registry.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias("firms")))


def load_aliases(spark, path):
    rows = _read_csv(spark, path, schema.ALIASES, "alias_ord").filter(F.col("firm_id") != "")
    return rows.withColumn("alias_kind", F.lower("alias_kind"))


def load_overrides(spark, path):
    """job_key -> job_family; rows with both fields only, the later of two duplicates wins."""
    return latest_overrides(_read_csv(spark, path, schema.OVERRIDES, "override_ord"))


def latest_overrides(rows, order="override_ord"):
    return (rows.filter((F.col("job_key") != "") & (F.col("job_family") != ""))
            .groupBy("job_key").agg(F.max_by("job_family", order).alias("job_family")))


def upsert_registry(registry, hits, only_status="todo", force_platform=None):
    """Registry with verified hits written in; every other row and column stays as it is.

    `hits` has one row per firm_id with the columns to set (ats_platform, ats_token, ats_host,
    board_site where known) and a `note`.  Only rows in `only_status` change.  With
    `force_platform`, a row in another status is corrected too when its board site differs.
    Notes are appended, except under `force_platform`, which restates them.
    """
    new = hits.select(F.col("firm_id"), *[
        (F.col(c) if c in hits.columns else F.lit(None).cast("string")).alias(f"_{c}")
        for c in ("ats_platform", "ats_token", "ats_host", "board_site", "note")])
    joined = registry.join(new, "firm_id", "left")
    change = F.col("_ats_platform").isNotNull() & (F.col("status") == only_status)
    if force_platform:
        change = F.col("_ats_platform").isNotNull() & (
            (F.col("status") == only_status) | (F.col("board_site") != F.col("_board_site")))
    note = (F.col("_note") if force_platform else
            F.when(text.strip("notes") != "", F.concat(text.strip("notes"), F.lit("; "), "_note"))
            .otherwise(F.col("_note")))
    values = {
        "ats_platform": F.col("_ats_platform"), "ats_token": F.col("_ats_token"),
        "ats_host": F.coalesce("_ats_host", "ats_host"),
        "board_site": F.coalesce("_board_site", "board_site"),
        "robots_status": F.lit("allowed"), "status": F.lit("wired"), "notes": note,
    }
    return joined.select(*[
        F.when(change, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in registry.columns])
