"""Eligibility and job family as ordered rules over columns.

Each stage is its own projection, so an expression that later stages read several times (the
cleaned body, a rule hit) is computed once per row, and the body is only searched by rules
when the title and the department did not decide.
"""

from pyspark.sql import functions as F

from boardtide import fixed
from boardtide.functions import rules, text
from boardtide.functions.text import FLAGS, matches


def _optional(df, name, default):
    return F.col(name) if name and name in df.columns else default


def grad_verdict(df, title="title", body="description_text", min_years=None,
                 position_levels=None, employment_types=None, experience_level=None):
    """Add is_grad, is_internship, grad_confidence, grad_basis and grad_signals.

    `min_years` is an integer column; `position_levels` and `employment_types` are arrays of
    strings; `experience_level` is text.  Missing inputs count as not stated.
    """
    no_items = F.array().cast("array<string>")
    keep = df.columns
    lower_all = lambda c: F.transform(c, lambda x: F.lower(text.strip(x)))
    staged = df.select(
        *keep,
        text.strip(F.col(title)).alias("_t"),
        text.clean_text(body).alias("_d"),
        _optional(df, min_years, F.lit(None).cast("int")).alias("_y"),
        lower_all(F.coalesce(_optional(df, position_levels, no_items), no_items)).alias("_lv"),
        F.coalesce(_optional(df, employment_types, no_items), no_items).alias("_et"),
        text.strip(F.coalesce(_optional(df, experience_level, F.lit("")), F.lit(""))).alias("_el"),
    )

    segments = F.filter(F.split(F.col("_t"), FLAGS + fixed.JUNIOR_ALTERNATIVE_SPLIT),
                        lambda s: text.strip(s) != "")
    junior_side = (F.size(segments) >= 2) & F.exists(
        segments, lambda s: ~matches(s, fixed.SENIORITY))
    typed_intern = F.exists("_et", lambda x: F.lower(x).contains(fixed.INTERNSHIP_TYPES[0])
                            | F.lower(x).contains(fixed.INTERNSHIP_TYPES[1]))
    heavy = [k for k, w in fixed.POSITION_LEVEL_WEIGHTS.items() if w <= -1.0]
    staged = staged.select(
        *staged.columns,
        (matches("_t", fixed.INTERNSHIP_TITLE) | typed_intern).alias("_intern"),
        (matches("_t", fixed.PROGRAMME_TITLE)
         | matches("_t", fixed.ANCHORED_PROGRAMME)).alias("_prog"),
        (matches("_t", fixed.STATED_FRESH_GRAD)
         | rules.any_match_outside(
             "_d", fixed.STATED_FRESH_GRAD, fixed.FRESH_GRAD_REDIRECT, fixed.REDIRECT_BEFORE,
             fixed.REDIRECT_AFTER, fixed.FRESH_GRAD_MIN_CHARS)).alias("_fresh"),
        F.coalesce(F.col("_y").cast("int"), rules.demanded_years("_d")).alias("_years"),
        matches("_t", fixed.SENIORITY).alias("_senior"),
        junior_side.alias("_either"),
        matches("_el", fixed.LEVEL_ENTRY).alias("_entry"),
        F.coalesce((F.col("_y") >= 2) & F.exists("_lv", lambda x: x.isin(*heavy)),
                   F.lit(False)).alias("_contra"),
        *[matches("_t", p).alias(f"_s{i}") for i, (p, _, _) in enumerate(fixed.SCORE_SIGNALS)],
    )

    year_known = F.coalesce(F.col("_y") <= 1, F.lit(False))
    rescued = (F.col("_prog") | F.col("_fresh") | F.col("_either")) & year_known
    veto = (
        F.when(matches("_t", fixed.NOT_A_ROLE), "veto:not-a-role")
        .when(matches("_t", fixed.SUBJECT_MATTER), "veto:graduate-as-subject-matter")
        .when(matches("_t", fixed.ACADEMIC_TRACK), "veto:academic-track")
        .when((F.col("_el") != "") & ~F.col("_entry") & ~F.col("_prog")
              & matches("_el", fixed.LEVEL_SENIOR),
              F.concat(F.lit("veto:experience-level-"), F.lower("_el")))
        .when(F.col("_years") >= fixed.YEARS_VETO,
              F.concat(F.lit("veto:"), F.col("_years"), F.lit("-years-required")))
        .when(F.col("_senior") & ~rescued, "veto:seniority-in-title")
    )
    route = (
        F.when(F.col("_prog") & ~F.col("_contra"), "route:programme")
        .when(F.col("_fresh"), "route:states-fresh-grad")
        .when(F.col("_y") == 0, "route:zero-years")
        .when(F.col("_entry"), "route:experience-level")
        .when(matches("_t", fixed.ENTRY_TITLE) & F.coalesce(F.col("_y") <= 1, F.lit(True)),
              "route:entry-level-title")
        .otherwise("no-route")
    )
    score = F.lit(0.0)
    for i, (_, weight, _) in enumerate(fixed.SCORE_SIGNALS):
        score = score + F.when(F.col(f"_s{i}"), weight).otherwise(0.0)
    score = score + rules.lookup(fixed.YEARS_WEIGHTS, F.col("_y"), 0.0)
    score = score + F.aggregate(
        "_lv", F.lit(0.0),
        lambda acc, x: acc + rules.lookup(fixed.POSITION_LEVEL_WEIGHTS, x, 0.0))
    signals = F.concat(
        F.filter(F.array(*[F.when(F.col(f"_s{i}"), name)
                           for i, (_, _, name) in enumerate(fixed.SCORE_SIGNALS)]),
                 lambda x: x.isNotNull()),
        F.when(F.col("_y").isNotNull(), F.array(F.concat(F.lit("years:"), F.col("_y"))))
        .otherwise(no_items),
        F.transform(F.filter("_lv", lambda x: x.isin(*fixed.POSITION_LEVEL_WEIGHTS)),
                    lambda x: F.concat(F.lit("level:"), x)),
    )
    decided = staged.select(*keep, "_intern", veto.alias("_veto"), route.alias("_route"),
                            F.round(score, 2).alias("_score"), signals.alias("_signals"))
    clear = F.col("_veto").isNull()
    return decided.select(
        *keep,
        (clear & F.col("_route").startswith("route:")).alias("is_grad"),
        F.col("_intern").alias("is_internship"),
        F.when(clear, F.col("_score")).otherwise(0.0).alias("grad_confidence"),
        F.coalesce("_veto", "_route").alias("grad_basis"),
        F.when(clear, F.col("_signals")).otherwise(no_items).alias("grad_signals"),
    )


def family_verdict(df, title="title", body="description_text", department="department",
                   sector="sector", rule_list=fixed.FAMILY_RULES, body_chars=None):
    """Add job_family, family_group, family_confidence and family_basis.

    Title, then department, then the cleaned body (its first `body_chars` where given), then the
    sector's residual family; the first rule that matches within a tier decides.
    """
    keep = df.columns
    get = lambda name: F.coalesce(_optional(df, name, F.lit("")), F.lit(""))
    one = df.select(*keep, rules.first_match(rule_list, text.strip(get(title))).alias("_ft"),
                    text.strip(get(department)).alias("_dep"),
                    F.lower(text.strip(get(sector))).alias("_sec"))
    two = one.select(*one.columns, F.when(F.col("_ft").isNull() & (F.col("_dep") != ""),
                                          rules.first_match(rule_list, "_dep")).alias("_fd"))
    open_row = F.col("_ft").isNull() & F.col("_fd").isNull()
    cleaned = text.clean_text(get(body))
    lead = F.when(open_row, cleaned if body_chars is None else F.left(cleaned, F.lit(body_chars)))
    three = two.select(*two.columns, lead.alias("_lead"))
    four = three.select(*three.columns, F.when(F.col("_lead") != "", rules.first_match(
        rule_list, "_lead")).alias("_fb"))
    residual = rules.lookup(fixed.SECTOR_RESIDUAL, F.col("_sec"))
    basis = (F.when(F.col("_ft").isNotNull(), "title").when(F.col("_fd").isNotNull(), "department")
             .when(F.col("_fb").isNotNull(), "description")
             .when(residual.isNotNull(), "sector-residual").otherwise("unmatched"))
    five = four.select(
        *keep,
        F.coalesce("_ft", "_fd", "_fb", residual, F.lit(fixed.FAMILY_UNMATCHED)).alias("job_family"),
        basis.alias("family_basis"))
    return five.select(
        *keep, "job_family",
        rules.lookup(fixed.FAMILY_GROUPS, F.col("job_family")).alias("family_group"),
        rules.lookup(fixed.FAMILY_CONFIDENCE, F.col("family_basis")).alias("family_confidence"),
        "family_basis")


def role_type(basis="grad_basis", is_grad="is_grad", is_internship="is_internship"):
    return (F.when(~F.col(is_grad), fixed.ROLE_TYPE_NONE)
            .when(F.col(is_internship), fixed.ROLE_TYPE_INTERNSHIP)
            .otherwise(rules.lookup(fixed.ROLE_TYPE_BY_BASIS, F.col(basis),
                                    fixed.ROLE_TYPE_DEFAULT)))


def classify_postings(df):
    """Both verdicts and the role type for postings that carry a typed `extra` and a `sector`."""
    extra = lambda name: F.col(f"extra.{name}")
    typed = text.split_pipe(extra("employment_types"))
    own_type = F.when(F.col("employment_type") != "", F.array("employment_type")) \
        .otherwise(F.array().cast("array<string>"))
    ready = df.select(
        *df.columns,
        extra("min_years").try_cast("int").alias("_min_years"),
        text.split_pipe(extra("position_levels")).alias("_levels"),
        F.when(F.size(typed) > 0, typed).otherwise(own_type).alias("_types"),
        text.first_filled(extra("experience_level"), extra("experience")).alias("_level"),
    )
    graded = grad_verdict(ready, min_years="_min_years", position_levels="_levels",
                          employment_types="_types", experience_level="_level")
    graded = graded.drop("_min_years", "_levels", "_types", "_level", "grad_signals")
    return family_verdict(graded).withColumn("role_type", role_type())


def apply_overrides(df, overrides):
    """A hand-written family wins over the rules.  An unknown family name is an error."""
    known = F.col("_override").isin(*fixed.FAMILY_GROUPS)
    checked = F.when(F.col("_override").isNull() | known, F.col("_override")).otherwise(
        F.raise_error(F.concat(F.lit("unknown job family: "), F.col("_override"))))
    has = F.col("_override").isNotNull()
    joined = df.join(overrides.select("job_key", F.col("job_family").alias("_override")),
                     "job_key", "left").withColumn("_override", checked)
    manual = "manual-override"
    return joined.select(*[
        {
            "job_family": F.coalesce("_override", "job_family"),
            "family_group": F.when(has, rules.lookup(fixed.FAMILY_GROUPS, F.col("_override")))
            .otherwise(F.col("family_group")),
            "family_confidence": F.when(has, fixed.FAMILY_CONFIDENCE[manual])
            .otherwise(F.col("family_confidence")),
            "family_basis": F.when(has, manual).otherwise(F.col("family_basis")),
        }.get(c, F.col(c)).alias(c) for c in df.columns])


def evaluate(df, predicted="predicted", gold="gold", more=()):
    """tp, fp, fn, tn, precision, recall and accuracy of boolean labels, and `more` aggregates, in
    one pass."""
    p, g = F.col(predicted), F.col(gold)
    counts = df.agg(F.count_if(p & g).alias("tp"), F.count_if(p & ~g).alias("fp"),
                    F.count_if(~p & g).alias("fn"), F.count_if(~p & ~g).alias("tn"), *more)
    over = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(1.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*", over(tp, tp + fp).alias("precision"), over(tp, tp + fn).alias("recall"),
        over(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def evaluate_labels(labels):
    """Classify a label table (registry layout `schema.LABELS`) and score both verdicts."""
    ready = labels.select(
        "*", F.col("min_years").try_cast("int").alias("_years_in"),
        text.split_pipe("position_levels").alias("_levels_in"),
        text.split_pipe("employment_types").alias("_types_in"),
        F.col("job_family").alias("_want")).drop("job_family")
    kept = ready.withColumnsRenamed({"is_grad": "_gold", "is_internship": "_gold_intern"})
    graded = grad_verdict(kept, body="desc_excerpt", min_years="_years_in",
                          position_levels="_levels_in", employment_types="_types_in")
    return family_verdict(graded, body="desc_excerpt", department=None, sector=None).select(
        "firm", "title", "note", F.col("is_grad").alias("predicted"),
        (F.col("_gold") == "1").alias("gold"),
        (F.col("is_internship") == (F.col("_gold_intern") == "1")).alias("internship_right"),
        (F.col("job_family") == F.col("_want")).alias("family_right"), "grad_basis")


def score_verdicts(rows):
    """`evaluate` of rows from `evaluate_labels`, with the family accuracy and the number of wrong
    internship verdicts, in one pass.  A label without a family is not counted for it."""
    known = F.col("family_right").isNotNull()
    return evaluate(rows, more=[
        F.coalesce(F.try_divide(F.count_if("family_right"), F.count_if(known)), F.lit(1.0)).alias("family_accuracy"),
        F.count_if(~F.col("internship_right")).alias("internship_errors")])


def mismatches(rows):
    """One row per wrong verdict: firm, title, what (graduate, family or internship), why, note."""
    wrong = F.filter(F.array(
        F.when(F.col("predicted") != F.col("gold"), "graduate"), F.when(~F.col("family_right"), "family"),
        F.when(~F.col("internship_right"), "internship")), lambda w: w.isNotNull())
    return rows.select("firm", "title", F.explode(wrong).alias("what"), F.col("grad_basis").alias("why"), "note")
