"""The curated table: classified postings with firm, lifecycle and salary columns."""

from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.functions import text
from boardtide.operators.classify import apply_overrides, classify_postings
from boardtide.operators.merge import merge_sources, summarise_candidates
from boardtide.session import broadcast_if_small


def curate(postings, registry, lifecycle, overrides, snapshot_date, place=fixed.PLACE,
           lifecycle_key="job_key"):
    """Curated rows in the declared layout.

    The dimension and the overrides are broadcast when their count proves them small; the
    lifecycle is the one join that moves postings, on the key.  `lifecycle_key="raw_job_key"`
    looks a re-keyed portal row up under the key it was stored with.
    """
    firms = registry.select("firm_id", F.col("firm_name").alias("_name"),
                            F.col("sector").alias("_sector"), F.col("tier").alias("_tier"))
    named = postings.join(broadcast_if_small(firms), "firm_id", "left").withColumn(
        "sector", F.coalesce("_sector", F.lit("")))
    classified = apply_overrides(classify_postings(named), broadcast_if_small(overrides))
    life = lifecycle.select(F.col("job_key").alias(lifecycle_key), "first_seen", "last_seen",
                            "status")
    rows = classified.join(life, lifecycle_key, "left")
    extra = lambda name: F.col(f"extra.{name}")
    place_named = text.mentions_place("location_raw", place=place)
    return schema.conform(rows.withColumns({
        "firm_name": F.coalesce("_name", text.none_if_empty(extra("employer_name")), "firm_id"),
        "tier": F.coalesce("_tier", F.lit(0)),
        "is_singapore": place_named | (F.col("source_platform") == fixed.PORTAL_PLATFORM),
        "status": F.coalesce("status", F.lit("open")),
        "mcf_job_id": F.coalesce(extra("mcf_job_id"), F.lit("")),
        "salary_min": extra("salary_min").try_cast("double"),
        "salary_max": extra("salary_max").try_cast("double"),
        "snapshot_date": F.lit(snapshot_date).cast("date"),
    }), schema.CURATED)


def build_tables(postings, lifecycle, registry, aliases, overrides, snapshot_date, stage=None,
                 **options):
    """(curated, candidates, merged) from the newest postings and a computed lifecycle."""
    merged = merge_sources(postings, registry, aliases, **({"stage": stage} if stage else {}))
    curated = curate(merged.postings, registry, lifecycle, overrides, snapshot_date, **options)
    written = summarise_candidates(merged.candidates)
    return curated, schema.conform(written, schema.CANDIDATES), merged
