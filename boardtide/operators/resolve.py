"""Employer names onto registry firms: alias by number, alias by name, exact brand, fuzzy brand.

Names are resolved once per distinct (employer, uen), never per posting.  The fuzzy step joins
on the prefixes of the compact employer name, so only firms whose brand really starts the name
are scored; there is no all-pairs comparison.  What an unmatched name scored at best is found by
upper bounds (`nearest`).
"""

from pyspark.sql import functions as F

from boardtide import fixed
from boardtide.functions import names, text
from boardtide.functions.similarity import one_if, token_set_ratio
from boardtide.operators.nearest import best_scores
from boardtide.session import broadcast_if_small


def registry_brands(registry):
    """One row per brand variant, owned by the first registry row that carries it, plus owners."""
    return registry.select(
        "firm_id", "registry_ord", names.denoise("firm_name").alias("firm_words"),
        F.explode(names.brand_variants("firm_name")).alias("brand"))


def resolve_employers(employers, registry, aliases, threshold=fixed.NAME_MATCH_THRESHOLD, unmatched=True):
    """employer_name, uen -> firm_id, basis, score, one row per distinct input pair.

    `registry` has firm_id, firm_name, registry_ord; `aliases` has alias_kind, alias_value,
    firm_id, alias_ord.  The score is that of the firm taken for the fuzzy basis, the best of all
    firms for an unmatched name, and 0 where no score was needed.  It decides nothing for an
    unmatched name; `unmatched=False` leaves it null there and saves the search.
    """
    base = employers.select(
        F.coalesce("employer_name", F.lit("")).alias("employer_name"),
        text.strip(F.coalesce("uen", F.lit(""))).alias("uen")).distinct()
    base = base.select(
        "*", F.upper("uen").alias("k_uen"), names.compact("employer_name").alias("k_name"),
        names.compact("employer_name", True).alias("k_brand"))

    first = lambda c: F.min_by("firm_id", c)
    by_uen = (aliases.filter((F.col("alias_kind") == "uen") & (F.col("alias_value") != ""))
              .groupBy(F.upper("alias_value").alias("k_uen")).agg(first("alias_ord").alias("f1")))
    by_name = (aliases.filter(F.col("alias_kind") == "name")
               .select(names.compact("alias_value").alias("k_name"), "firm_id", "alias_ord")
               .filter(F.col("k_name") != "")
               .groupBy("k_name").agg(first("alias_ord").alias("f2")))
    brands = registry_brands(registry)
    exact = (brands.groupBy(F.col("brand").alias("k_brand"))
             .agg(first("registry_ord").alias("f3")))
    staged = (base.join(broadcast_if_small(by_uen), "k_uen", "left")
              .join(broadcast_if_small(by_name), "k_name", "left")
              .join(broadcast_if_small(exact), "k_brand", "left"))

    blank = text.strip("employer_name") == ""
    undecided = F.coalesce("f1", "f2", "f3").isNull() & ~blank
    asked = staged.filter(undecided).select("employer_name", "k_brand").distinct()
    fuzzy = _fuzzy(asked, brands, threshold)
    out = staged.join(fuzzy, "employer_name", "left")
    best = F.lit(None).cast("bigint")
    if unmatched:
        left = asked.join(fuzzy, "employer_name", "left_anti").select(names.denoise("employer_name").alias("words"))
        found = best_scores(employers.sparkSession, left.distinct(), "words", brands, "firm_words")
        out = out.withColumn("words", names.denoise("employer_name")).join(
            found.select("words", "best_score"), "words", "left")
        best = F.coalesce("best_score", F.lit(0).cast("bigint"))
    basis = (F.when(F.col("f1").isNotNull(), "alias:uen")
             .when(F.col("f2").isNotNull(), "alias:name")
             .when(blank, "no-employer-name")
             .when(F.col("f3").isNotNull(), "exact-name")
             .when(F.col("f4").isNotNull(), "fuzzy-name").otherwise("unmatched"))
    firm = (F.when(F.coalesce("f1", "f2").isNotNull(), F.coalesce("f1", "f2"))
            .when(blank, F.lit(None)).otherwise(F.coalesce("f3", "f4")))
    return out.select("employer_name", "uen", firm.alias("firm_id"), basis.alias("basis"),
                      F.when(basis == "fuzzy-name", F.col("score")).when(basis == "unmatched", best)
                      .otherwise(0).alias("score"))


def _fuzzy(unresolved, brands, threshold):
    prefixes = unresolved.filter(F.length("k_brand") >= fixed.MIN_BRAND_CHARS).select(
        "employer_name",
        F.explode(F.transform(
            F.sequence(F.lit(fixed.MIN_BRAND_CHARS), F.length("k_brand")),
            lambda n: F.left("k_brand", n))).alias("brand"))
    pairs = (prefixes.join(broadcast_if_small(brands), "brand")
             .select("employer_name", "firm_id", "registry_ord", "firm_words").distinct())
    score = F.floor(token_set_ratio("firm_words", names.denoise("employer_name"), threshold))
    scored = pairs.select("*", one_if(score, lambda s: s >= threshold).alias("score"))
    return (scored.groupBy("employer_name")
            .agg(F.min(F.struct("registry_ord", "firm_id", "score")).alias("best"))
            .select("employer_name", F.col("best.firm_id").alias("f4"),
                    F.col("best.score").cast("bigint").alias("score")))
