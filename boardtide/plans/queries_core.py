"""Lifecycle, snapshots, classification and text functions over the generic tables."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.functions import dates, names, rules, text, urls
from boardtide.operators import asof, classify, lifecycle, reports
from boardtide.plans.bindings import (
    BODIES, EV, EV_SQL, PART, ev_outcomes, query, spread, table)
from boardtide.session import checkpoint_root
from boardtide.sources import snapshots
from boardtide.sources.lifecycle_store import LifecycleStore

# --- lifecycle ------------------------------------------------------------------------------

LIFECYCLE_SQL = EV_SQL + """, closable AS (
  SELECT source, snapshot_date, firm_id FROM outcomes WHERE ok AND row_count > 0
  UNION
  SELECT e.source, e.snapshot_date, e.firm_id FROM ev e JOIN (
    SELECT source, snapshot_date FROM outcomes GROUP BY 1, 2
    HAVING count(*) = 1 AND bool_and(ok AND row_count > 0)) s
  ON e.source = s.source AND e.snapshot_date = s.snapshot_date),
keys AS (SELECT source, job_key, min(snapshot_date) AS fs, max(snapshot_date) AS ls,
  count(DISTINCT snapshot_date) AS seen, max(firm_id) AS firm_id FROM ev GROUP BY 1, 2),
gone AS (SELECT k.job_key, min(CASE WHEN c.snapshot_date > k.ls THEN c.snapshot_date END) AS nc,
  count(CASE WHEN c.snapshot_date > k.fs AND c.snapshot_date < k.ls AND p.job_key IS NULL
        THEN 1 END) AS holes
  FROM keys k JOIN closable c ON k.source = c.source AND k.firm_id = c.firm_id
  LEFT JOIN (SELECT DISTINCT job_key, snapshot_date FROM ev) p
  ON p.job_key = k.job_key AND p.snapshot_date = c.snapshot_date GROUP BY 1),
views AS (SELECT source, max(snapshot_date) AS lv FROM ev GROUP BY 1),
life AS (SELECT k.job_key, k.fs AS first_seen, k.ls AS last_seen,
  CASE WHEN g.nc IS NOT NULL THEN 'closed' WHEN coalesce(g.holes, 0) > 0 THEN 'reposted'
       WHEN v.lv > k.ls THEN 'unknown' ELSE 'open' END AS status,
  g.nc AS disappeared_on, k.seen AS times_seen
  FROM keys k LEFT JOIN gone g ON k.job_key = g.job_key JOIN views v ON v.source = k.source)
"""


@query("lifecycle_table", LIFECYCLE_SQL + "SELECT * FROM life")
def lifecycle_table(spark, sf_dir):
    ev = EV.frame(spark, sf_dir)
    return lifecycle.compute_lifecycle(ev, ev_outcomes(ev))


@query("lifecycle_status", LIFECYCLE_SQL
       + "SELECT status, count(*) AS postings, CAST(sum(times_seen) AS BIGINT) AS sightings FROM life GROUP BY 1")
def lifecycle_status(spark, sf_dir):
    return (lifecycle_table(spark, sf_dir).groupBy("status")
            .agg(F.count("*").alias("postings"), F.sum("times_seen").alias("sightings")))


@query("lifecycle_one_more_day", LIFECYCLE_SQL + "SELECT * FROM life")
def lifecycle_one_more_day(spark, sf_dir):
    """History up to the day before the newest one, then one incremental step."""
    ev = EV.frame(spark, sf_dir)
    newest = ev.agg(F.max("snapshot_date")).first()[0]
    day, before = F.col("snapshot_date") == F.lit(newest), F.col("snapshot_date") < F.lit(newest)
    outcomes = ev_outcomes(ev)
    state = lifecycle.compute_lifecycle(ev.filter(before), outcomes.filter(before),
                                        keep=("source", "firm_id"))
    return lifecycle.advance_lifecycle(
        state, ev.filter(day), outcomes.filter(day), newest).drop("source", "firm_id")


@query("closable_firms", LIFECYCLE_SQL + "SELECT source, snapshot_date, firm_id FROM closable")
def closable_firms(spark, sf_dir):
    ev = EV.frame(spark, sf_dir)
    return lifecycle.closable_firms(ev, ev_outcomes(ev))


@query("closable_postings", LIFECYCLE_SQL + """SELECT e.event_id, e.job_key, e.snapshot_date
  FROM ev e JOIN closable c ON e.source = c.source AND e.snapshot_date = c.snapshot_date
  AND e.firm_id = c.firm_id""")
def closable_postings(spark, sf_dir):
    ev = EV.frame(spark, sf_dir)
    shut = lifecycle.closable_firms(ev, ev_outcomes(ev))
    return ev.join(shut, ["source", "snapshot_date", "firm_id"]).select(
        "event_id", "job_key", "snapshot_date")


LAST_FIRM_SQL = """SELECT source, job_key, firm_id FROM (
  SELECT event_type AS source, props AS job_key, CAST(user_id AS STRING) AS firm_id,
    row_number() OVER (PARTITION BY event_type, props
      ORDER BY CAST(ts AS DATE) DESC, CAST(user_id AS STRING) DESC) AS rn FROM events) WHERE rn = 1"""


@query("last_known_firm", LAST_FIRM_SQL)
def last_known_firm(spark, sf_dir):
    ev = EV.frame(spark, sf_dir)
    return lifecycle.last_known_firm(ev.withColumn("job_key", F.col("props")))


CUTOFF = dt.date(2024, 1, 20)


@query("asof_newest_partition", f"""WITH u AS (
  SELECT user_id AS source, CAST(ts AS DATE) AS snapshot_date, event_id FROM events
  WHERE CAST(ts AS DATE) <= DATE '{CUTOFF}')
SELECT source, snapshot_date, event_id FROM u
WHERE (source, snapshot_date) IN (SELECT source, max(snapshot_date) FROM u GROUP BY 1)""")
def asof_newest_partition(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source"), F.to_date("ts").alias("snapshot_date"), "event_id")
    return asof.newest_per_source(ev, CUTOFF)


# --- snapshot store -------------------------------------------------------------------------

def _store(spark, sf_dir, days=None, root=None):
    """Events written as a partitioned snapshot store under a fresh folder, or added to `root`;
    `days` is a condition on snapshot_date."""
    root = root or f"{checkpoint_root(spark)}/store-{uuid.uuid4().hex}"
    ev = EV.frame(spark, sf_dir)
    ev = ev if days is None else ev.filter(days)
    postings = ev.select(
        "source", "snapshot_date", "job_key", "firm_id", F.lit("lever").alias("source_platform"),
        F.col("event_id").cast("string").alias("external_id"), F.col("source").alias("title"),
        F.lit("https://x.example.com/1").alias("apply_url"),
        text.to_json_extra(min_years=F.floor("value"), salary_min=F.col("value"),
                           uen=F.col("firm_id")).alias("extra_json"))
    outcomes = ev_outcomes(ev).withColumn("platform", F.col("source")).withColumn(
        "error", F.lit(""))
    snapshots.write_snapshots(spark, root, postings, outcomes)
    return root


@query("store_round_trip", EV_SQL + """SELECT source, snapshot_date, job_key, firm_id,
  CAST(event_id AS STRING) AS external_id, source AS title, '' AS location_raw,
  CAST(floor(value) AS BIGINT) AS min_years, value AS salary_min FROM ev""")
def store_round_trip(spark, sf_dir):
    """Write both datasets, read the history back, rehydrate the packed fields."""
    postings, _ = snapshots.read_history(spark, _store(spark, sf_dir))
    return snapshots.as_postings(postings).select(
        "source", "snapshot_date", "job_key", "firm_id", "external_id", "title", "location_raw",
        F.col("extra.min_years").try_cast("bigint").alias("min_years"),
        F.col("extra.salary_min").try_cast("double").alias("salary_min"))


@query("store_newest_scan", EV_SQL + f""", c AS (SELECT * FROM outcomes
  WHERE snapshot_date <= DATE '{CUTOFF}') SELECT source, snapshot_date, firm_id, ok, row_count
FROM c WHERE (source, snapshot_date) IN (SELECT source, max(snapshot_date) FROM c GROUP BY 1)""")
def store_newest_scan(spark, sf_dir):
    """The as-of scan on the store: partitions chosen from the listing, scan pruned statically."""
    return snapshots.read_newest(spark, _store(spark, sf_dir), CUTOFF, "outcomes").select(
        "source", "snapshot_date", "firm_id", "ok", "row_count")


@query("lifecycle_advanced", LIFECYCLE_SQL + "SELECT * FROM life")
def lifecycle_advanced(spark, sf_dir):
    """The stored lifecycle: history once, then the two newest days as two daily runs."""
    newest = EV.frame(spark, sf_dir).agg(F.max("snapshot_date")).first()[0]
    root = _store(spark, sf_dir, F.col("snapshot_date") < F.date_sub(F.lit(newest), 1))
    store = LifecycleStore(spark, root, f"{root}-life")
    store.update()
    _store(spark, sf_dir, F.col("snapshot_date") >= F.date_sub(F.lit(newest), 1), root)
    store.update()
    return store.read().drop("source", "firm_id")


# --- classification -------------------------------------------------------------------------

def _re(column, pattern):
    return f"regexp_matches({column}, '{pattern.replace(chr(39), chr(39) * 2)}', 'i')"


_BACK_OFFICE = r"(?!\s+(operations|support|settlement|ops|controls?))"


def _rule_sql(column, pattern):
    """A rule for an engine without look-ahead: drop the excluded phrases first."""
    if _BACK_OFFICE not in pattern:
        return _re(column, pattern)
    rest = f"regexp_replace({column}, 'trading\\s+(operations|support|settlement|ops|controls?)', '', 'gi')"
    plain = pattern.replace("|trading" + _BACK_OFFICE, "")
    return f"({_re(column, plain)} OR {_re(rest, chr(92) + 'btrading' + chr(92) + 'b')})"


def _first_match_sql(column):
    arms = " ".join(f"WHEN {_rule_sql(column, p)} THEN '{f}'" for f, p in fixed.FAMILY_RULES)
    return f"CASE {arms} END"


def _case(mapping, column):
    return (f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
            + " END")


_T = "title"
_PROG = f"({_re(_T, fixed.PROGRAMME_TITLE)} OR {_re(_T, fixed.ANCHORED_PROGRAMME)})"
_FRESH = f"({_re(_T, fixed.STATED_FRESH_GRAD)} OR invites)"
_EITHER = ("(contains(title, '/') AND NOT "
           + _re("split_part(title, '/', 1)", fixed.SENIORITY) + " OR contains(title, '/') AND NOT "
           + _re("split_part(title, '/', 2)", fixed.SENIORITY) + ")")
_HEAVY = "(contains(levels, 'Senior Management') OR contains(levels, 'Middle Management'))"
_SCORE = " + ".join(f"CASE WHEN {_re(_T, p)} THEN {w} ELSE 0 END" for p, w, _ in fixed.SCORE_SIGNALS)
_YEARS = "CASE min_years WHEN 0 THEN 2.0 WHEN 1 THEN 1.0 WHEN 2 THEN -1.0 ELSE 0 END"
_LEVEL_SUM = ("CASE levels WHEN 'Fresh/entry level|Executive' THEN 2.0 WHEN 'Senior Management' THEN -2.0 "
              "WHEN 'Junior Executive' THEN 1.0 WHEN 'Middle Management|Odd' THEN -2.0 ELSE 0 END")
GRADE_SQL = f"""WITH p AS ({PART.sql()}), s AS (SELECT *, {_PROG} AS prog, {_FRESH} AS fresh,
  coalesce(min_years, prose_years) AS years, {_re(_T, fixed.SENIORITY)} AS senior, {_EITHER} AS either,
  min_years >= 2 AND {_HEAVY} AS contra, {_re('experience_level', fixed.LEVEL_ENTRY)} AS entry,
  ({_re(_T, fixed.INTERNSHIP_TITLE)} OR types LIKE 'Internship%') AS is_internship FROM p),
v AS (SELECT *, CASE WHEN {_re(_T, fixed.NOT_A_ROLE)} THEN 'veto:not-a-role'
  WHEN {_re(_T, fixed.SUBJECT_MATTER)} THEN 'veto:graduate-as-subject-matter'
  WHEN {_re(_T, fixed.ACADEMIC_TRACK)} THEN 'veto:academic-track'
  WHEN experience_level <> '' AND NOT entry AND NOT prog AND {_re('experience_level', fixed.LEVEL_SENIOR)}
    THEN 'veto:experience-level-' || lower(experience_level)
  WHEN years >= 3 THEN 'veto:' || years || '-years-required'
  WHEN senior AND NOT ((prog OR fresh OR either) AND coalesce(min_years <= 1, false))
    THEN 'veto:seniority-in-title' END AS veto,
  CASE WHEN prog AND NOT coalesce(contra, false) THEN 'route:programme'
  WHEN fresh THEN 'route:states-fresh-grad' WHEN min_years = 0 THEN 'route:zero-years'
  WHEN entry THEN 'route:experience-level'
  WHEN {_re(_T, fixed.ENTRY_TITLE)} AND coalesce(min_years <= 1, true) THEN 'route:entry-level-title'
  ELSE 'no-route' END AS route,
  round(CAST({_SCORE} + {_YEARS} + {_LEVEL_SUM} AS DOUBLE), 2) AS score FROM s),
graded AS (SELECT p_partkey, title, veto IS NULL AND route LIKE 'route:%' AS is_grad, is_internship,
  CASE WHEN veto IS NULL THEN score ELSE 0.0 END AS grad_confidence,
  coalesce(veto, route) AS grad_basis FROM v)
"""
ROLE_SQL = ("CASE WHEN NOT is_grad THEN 'Not graduate' WHEN is_internship THEN 'Internship' ELSE coalesce("
            + _case(fixed.ROLE_TYPE_BY_BASIS, "grad_basis") + ", 'Graduate role') END")


def _graded(spark, sf_dir):
    part = spread(PART.frame(spark, sf_dir)).withColumns({
        "_levels": text.split_pipe("levels"), "_types": text.split_pipe("types")})
    return classify.grad_verdict(part, min_years="min_years", position_levels="_levels",
                                 employment_types="_types", experience_level="experience_level")


@query("eligibility", GRADE_SQL + f"SELECT *, {ROLE_SQL} AS role_type FROM graded")
def eligibility(spark, sf_dir):
    return _graded(spark, sf_dir).withColumn("role_type", classify.role_type()).select(
        "p_partkey", "title", "is_grad", "is_internship", "grad_confidence", "grad_basis", "role_type")


_BODY = ("lower(trim(replace(regexp_replace(description_text, '<[^>]+>', ' ', 'g'), '&nbsp;', ' ')))")
FAMILY_SQL = f"""WITH p AS ({PART.sql()}), f AS (SELECT p_partkey, title, sector,
  {_first_match_sql('title')} AS ft,
  CASE WHEN department <> '' THEN {_first_match_sql('department')} END AS fd,
  {_first_match_sql(_BODY)} AS fb FROM p),
fam AS (SELECT p_partkey, title, coalesce(ft, fd, fb, CASE WHEN sector = 'consulting'
    THEN 'management_consulting' END, 'other') AS job_family,
  CASE WHEN ft IS NOT NULL THEN 'title' WHEN fd IS NOT NULL THEN 'department'
    WHEN fb IS NOT NULL THEN 'description' WHEN sector = 'consulting' THEN 'sector-residual'
    ELSE 'unmatched' END AS family_basis FROM f)
"""
_GROUP_SQL = _case(fixed.FAMILY_GROUPS, "job_family")
_CONF_SQL = ("CAST(CASE family_basis " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in fixed.FAMILY_CONFIDENCE.items()) + " END AS DOUBLE)")


@query("job_family", FAMILY_SQL + f"""SELECT p_partkey, title, job_family, {_GROUP_SQL} AS family_group,
  {_CONF_SQL} AS family_confidence, family_basis FROM fam""")
def job_family(spark, sf_dir):
    return classify.family_verdict(spread(PART.frame(spark, sf_dir))).select(
        "p_partkey", "title", "job_family", "family_group", "family_confidence", "family_basis")


@query("manual_override", FAMILY_SQL + f""", o AS (SELECT CAST(p_partkey AS STRING) AS job_key,
    CASE WHEN p_type = 'LARGE' THEN 'legal' ELSE 'quant_dev' END AS fam FROM part WHERE p_brand = 'Brand#23'),
  x AS (SELECT CAST(p_partkey AS STRING) AS job_key, coalesce(o.fam, fam.job_family) AS job_family,
    CASE WHEN o.fam IS NULL THEN family_basis ELSE 'manual-override' END AS family_basis
    FROM fam LEFT JOIN o ON o.job_key = CAST(p_partkey AS STRING))
SELECT job_key, job_family, {_GROUP_SQL} AS family_group, {_CONF_SQL} AS family_confidence, family_basis
FROM x""")
def manual_override(spark, sf_dir):
    fam = job_family(spark, sf_dir).select(
        F.col("p_partkey").cast("string").alias("job_key"), "job_family", "family_group",
        "family_confidence", "family_basis")
    overrides = (table(spark, sf_dir, "part").filter("p_brand = 'Brand#23'").select(
        F.col("p_partkey").cast("string").alias("job_key"),
        F.when(F.col("p_type") == "LARGE", "legal").otherwise("quant_dev").alias("job_family")))
    return classify.apply_overrides(fam, overrides)


_BY_SOURCE = {f"src{i}": i % len(BODIES) for i in range(20)}
CONTEXT_SQL = "SELECT doc_id, CASE source " + " ".join(
    f"WHEN '{s}' THEN {'NULL' if BODIES[i][2] is None else BODIES[i][2]}" for s, i in _BY_SOURCE.items()
) + " END AS years, CASE source " + " ".join(
    f"WHEN '{s}' THEN {str(BODIES[i][3]).upper()}" for s, i in _BY_SOURCE.items()
) + " END AS invites FROM documents"


@query("find_in_context", CONTEXT_SQL)
def find_in_context(spark, sf_dir):
    """Whole documents with a clause appended by source: years asked, graduates invited."""
    clause = rules.lookup({s: BODIES[i][1] for s, i in _BY_SOURCE.items()}, F.col("source"))
    body = spread(table(spark, sf_dir, "documents")).select(
        "doc_id", text.clean_text(F.concat("text", F.lit(". "), clause)).alias("body"))
    return body.select(
        "doc_id", rules.demanded_years("body").alias("years"),
        rules.any_match_outside("body", fixed.STATED_FRESH_GRAD, fixed.FRESH_GRAD_REDIRECT,
                                fixed.REDIRECT_BEFORE, fixed.REDIRECT_AFTER,
                                fixed.FRESH_GRAD_MIN_CHARS).alias("invites"))


@query("classifier_eval", """WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp,
  count(*) FILTER (WHERE quality = 1 AND toxic <> 0) AS fp,
  count(*) FILTER (WHERE quality <> 1 AND toxic = 0) AS fn,
  count(*) FILTER (WHERE quality <> 1 AND toxic <> 0) AS tn FROM labels)
SELECT tp, fp, fn, tn, coalesce(tp / nullif(tp + fp, 0), 1.0) AS "precision",
  coalesce(tp / nullif(tp + fn, 0), 1.0) AS recall,
  coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 1.0) AS accuracy FROM c""")
def classifier_eval(spark, sf_dir):
    return classify.evaluate(table(spark, sf_dir, "labels").select(
        (F.col("quality") == 1).alias("predicted"), (F.col("toxic") == 0).alias("gold")))


# --- text -----------------------------------------------------------------------------------

_SPACE = (r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
          r"\x{3000}]")


def _collapsed(c):
    return f"regexp_replace(regexp_replace({c}, '{_SPACE}+', ' ', 'g'), '^ | $', '', 'g')"


def _clean_sql(c):
    out = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    for old, new in fixed.CLEAN_ENTITIES:
        out = f"replace({out}, '{old}', '{new.replace(chr(39), chr(39) * 2)}')"
    return f"lower({_collapsed(out)})"


@query("html_clean_text", f"""SELECT page_id, {_clean_sql('html')} AS body,
  substr({_clean_sql('html')}, 1, {fixed.FAMILY_BODY_CHARS}) AS lead,
  substr(html, 1, {fixed.DESCRIPTION_CAP}) AS capped FROM pages""")
def html_clean_text(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages")).select("page_id", "html", text.clean_text("html").alias("body"))
    return pages.select("page_id", "body", F.left("body", F.lit(fixed.FAMILY_BODY_CHARS)).alias("lead"),
                        F.left("html", F.lit(fixed.DESCRIPTION_CAP)).alias("capped"))


_TAGLESS = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
for _old, _new in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"')):
    _TAGLESS = f"replace({_TAGLESS}, '{_old}', '{_new}')"


@query("html_visible_text",
       f"""SELECT page_id, {_collapsed(f"regexp_replace({_TAGLESS}, '&amp;?', '&', 'g')")} AS body FROM pages""")
def html_visible_text(spark, sf_dir):
    """Tags out, every HTML entity decoded, white space collapsed."""
    return table(spark, sf_dir, "pages").select("page_id", text.tag_text("html").alias("body"))


@query("escape_and_trim", f"""SELECT doc_id, replace(replace(replace(substr(text, 1, 90), '&', '&amp;'),
  '<', '&lt;'), '>', '&gt;') AS safe, regexp_replace(text, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS stripped
FROM documents""")
def escape_and_trim(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.escape_markup(F.left("text", F.lit(fixed.DIGEST_TITLE_CHARS))).alias("safe"),
        text.strip("text").alias("stripped"))


def _slug_sql(c):
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-')"


@query("job_keys", f"""SELECT doc_id, {_slug_sql('source')} || ':' || {_slug_sql('lang')} || ':'
  || doc_id AS job_key, CASE WHEN {_slug_sql("split_part(text, ' ', 1)")} <> '' THEN 'src:'
  || {_slug_sql("split_part(text, ' ', 1)")} || ':1' END AS word_key FROM documents""")
def job_keys(spark, sf_dir):
    """Stable keys; a part that normalises to nothing gives no key."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.job_key("source", "lang", "doc_id").alias("job_key"),
        text.job_key(F.lit(" Src "), F.substring_index("text", " ", 1), F.lit("#1")).alias("word_key"))


@query("place_predicates", r"""SELECT doc_id, contains(lower(text), 'anwh') AS mentions,
  regexp_matches(lower(text), '(^|[^\pL\pN_])(the|les)([^\pL\pN_]|$)') AS coded FROM documents""")
def place_predicates(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.mentions_place("text", place="ANWH").alias("mentions"),
        text.has_place_code("text", r"\bthe\b|\bles\b").alias("coded"))


@query("posted_dates", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso_day,
  CAST(o_orderdate AS DATE) AS epoch_day,
  CASE o_orderstatus WHEN 'O' THEN CASE WHEN o_totalprice > 250000 THEN DATE '2026-08-08'
      ELSE DATE '2026-08-07' END
    WHEN 'F' THEN DATE '2026-08-08' - CAST(floor(o_totalprice / 10000) AS INTEGER) END AS relative_day,
  CASE WHEN o_orderstatus <> 'P' THEN 'published' END AS basis,
  CASE WHEN o_totalprice < 30000 THEN 'date unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS shown
FROM orders""")
def posted_dates(spark, sf_dir):
    """Dates as boards write them, parsed back: ISO with offset, epoch millis, relative text."""
    today = F.lit(dt.date(2026, 8, 8))
    days = F.floor(F.col("o_totalprice") / 10000).cast("string")
    said = (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Posted 30+ Days Ago"), days))
            .when(F.col("o_orderstatus") == "F", F.concat(F.lit("posted "), days, F.lit(" days  ago")))
            .when(F.col("o_totalprice") > 250000, "Posted Today").otherwise("POSTED YESTERDAY"))
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00-04:00"))
    relative = dates.relative_date(said, today)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.iso_date(iso).alias("iso_day"),
        dates.epoch_millis_date(F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86_400_000 + 86_399_999).alias("epoch_day"),
        relative.alias("relative_day"), dates.basis_when(relative).alias("basis"),
        dates.shown_date(F.when(F.col("o_totalprice") >= 30000, F.col("o_orderdate").cast("date")),
                         F.lit(None).cast("date")).alias("shown"))


@query("list_fields", r"""SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderstatus <> 'O' THEN '; '
  || o_orderstatus ELSE '; O' END AS distinct_join, 2 AS n_items,
  'x' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]', '-', 'g') AS slug FROM orders""")
def list_fields(spark, sf_dir):
    listed = F.concat(F.lit(" |"), "o_orderpriority", F.lit("||"), "o_orderstatus", F.lit("|"))
    items = text.split_pipe(listed)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.join_distinct(F.concat(items, F.array(F.lit("")), items)).alias("distinct_join"),
        F.size(items).alias("n_items"),
        text.slug_chars(F.concat(F.lit(" -X"), "o_orderpriority", F.lit("- "))).alias("slug"))


@query("packed_extra", """SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
  value, CAST(NULL AS BIGINT) AS bad FROM events""")
def packed_extra(spark, sf_dir):
    packed = text.to_json_extra(
        min_years=F.get_json_object("props", "$.k").try_cast("int"), salary_min=F.col("value"),
        experience=F.col("event_type"), uen=F.lit(None).cast("string"))
    back = table(spark, sf_dir, "events").select(
        "event_id", F.from_json(packed, schema.EXTRA).alias("x"))
    return back.select("event_id", F.col("x.min_years").try_cast("bigint").alias("k"),
                       F.col("x.salary_min").try_cast("double").alias("value"),
                       F.col("x.experience").try_cast("bigint").alias("bad"))


@query("url_facts", r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
  CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1) = '' THEN '/'
    ELSE regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1) END AS path,
  CASE WHEN regexp_matches(regexp_extract(url, '^https?://([^/?#]+)', 1), 'example\.net$') THEN ''
    ELSE regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '^www\.', '') END AS domain,
  regexp_matches(url, '/en/[0-9]+') AS is_job,
  CASE WHEN contains(url, '/en/') THEN 'Singapore' ELSE '' END AS place FROM pages""")
def url_facts(spark, sf_dir):
    job = F.regexp_replace("url", "/en/([0-9]+).*$", "/job/$1/sg")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.host_of("url").alias("host"), urls.path_of("url").alias("path"),
        urls.apply_domain("url", ("example.net",)).alias("domain"), urls.is_job_page(job).alias("is_job"),
        urls.place_from_slug(F.regexp_replace("url", "/en/[0-9]+", "/job/SG-1"))
        .alias("place"))


@query("employer_names", """SELECT s_suppkey, 'supplier ' || lpad(CAST(s_suppkey AS STRING), 9, '0') AS words,
  'supplier' || lpad(CAST(s_suppkey AS STRING), 9, '0') AS compact,
  'supplier' || lpad(CAST(s_suppkey AS STRING), 9, '0') || 'zenith,supplier'
    || lpad(CAST(s_suppkey AS STRING), 9, '0') || ',zenith' AS brands FROM supplier""")
def employer_names(spark, sf_dir):
    legal = F.concat(F.upper("s_name"), F.lit(" (SINGAPORE) Holdings PTE. LTD."))
    brands = names.brand_variants(F.concat("s_name", F.lit(" Limited / Zenith Co")))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", names.denoise(legal, True).alias("words"), names.compact(legal, True).alias("compact"),
        F.array_join(brands, ",").alias("brands"))


@query("blocking_tokens", """WITH n AS (SELECT DISTINCT p_name, split_part(p_name, ' ', 1) AS a,
    split_part(p_name, ' ', 2) AS b FROM part), t AS (
  SELECT p_name, 'board' AS kind, unnest([a || '_' || b, a || b, a || '-' || b, a || b || 'group', a])
    AS token FROM n UNION
  SELECT p_name, 'board', x || s FROM (SELECT p_name, unnest([a || '_' || b, a || b]) AS x FROM n),
    (SELECT unnest(['campus','students','university','grads','graduates','earlycareers']) AS s) UNION
  SELECT p_name, 'tenant', unnest([a || b, a || b || 'group', a, substr(a, 1, 1) || substr(b, 1, 1)]) FROM n)
SELECT DISTINCT p_name, kind, token FROM t""")
def blocking_tokens(spark, sf_dir):
    firms = table(spark, sf_dir, "part").select("p_name").distinct()
    fid, name = F.replace("p_name", F.lit(" "), F.lit("_")), F.concat(F.initcap("p_name"), F.lit(" Group"))
    kinds = F.array(
        F.struct(F.lit("board").alias("kind"), names.board_tokens(fid, name).alias("tokens")),
        F.struct(F.lit("tenant").alias("kind"), names.tenant_tokens(fid, name).alias("tokens")))
    each = firms.select("p_name", F.explode(kinds).alias("k"))
    return each.select("p_name", "k.kind", F.explode("k.tokens").alias("token"))


# --- first wins, budgets --------------------------------------------------------------------

@query("dedupe_first_wins", """SELECT doc_id, text, lang FROM (SELECT *, row_number() OVER (
  PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedupe_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return asof.first_wins(docs, ["text"], ["doc_id"])


@query("detail_budget", """SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER (
  PARTITION BY l_suppkey ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey) <= 80 AS in_budget
FROM lineitem""")
def detail_budget(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    return reports.split_budget(
        lines, ["l_suppkey"], ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"],
        fixed.DETAIL_BUDGET).select("l_suppkey", "l_orderkey", "l_linenumber", "in_budget")


@query("top_per_board", """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number()
  OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem)
WHERE rn <= 120""")
def top_per_board(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return reports.top_per_group(lines, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"],
                                 fixed.MAX_JOB_PAGES)
