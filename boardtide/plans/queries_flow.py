"""Resolution, merging, curation, selection, reports, boards and robots over the generic tables."""

import datetime as dt

from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.functions import similarity, text
from boardtide.operators import (
    boards, curate, fuzzy_join, merge, packing, reports, resolve, robots, select)
from boardtide.plans.bindings import (
    BASE, EV, EV_SQL, ROWS, ROWS_SQL, WISHES_SQL, Binding, OrdersWithCustomers, ev_outcomes, query, spread,
    subscriptions, table)
from boardtide.session import table_stage
from boardtide.sources import registry as dims, state



def lcs_sql(a, b):
    """SQL for the length of the longest common subsequence; `a` has at most 120 characters.  Bits of
    a 128-bit integer stand for the characters of `a`."""
    bits = f"""list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(1, length({a}) + 1),
      lambda i: CASE WHEN substr({a}, i::INT, 1) = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END))::HUGEINT)"""
    full = f"((1::HUGEINT << length({a})::INT) - 1)"
    return f"""(length({a}) - bit_count(list_reduce(list_prepend({full}, {bits}),
      lambda v, x: ((v + (v & x)) | (v & ~x)) & {full})))"""


# --- employer resolution --------------------------------------------------------------------

# A firm's words are "supplier 000000001", an employer's these and perhaps more; scores of the unmatched
# come from all pairs, with "supplier" and, where they share it, the number as common words.
EMPLOYER_SQL = f"""WITH e AS (SELECT DISTINCT upper(s_name) || CASE l_returnflag WHEN 'A' THEN ' PTE. LTD.'
    WHEN 'N' THEN ' (SINGAPORE) HOLDINGS PTE LTD' ELSE ' TRADING AND SECURITIES' END AS employer_name,
    CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN 'holdings singapore ' ELSE 'securities trading ' END AS more,
    CASE WHEN l_linestatus = 'O' THEN '' ELSE 'uen' || s_suppkey END AS uen, s_name,
    s_suppkey, s_acctbal, s_nationkey, l_returnflag FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
r AS (SELECT *, CASE WHEN uen <> '' AND s_nationkey < 5 THEN 'alias-' || s_suppkey
    WHEN s_acctbal >= 3000 THEN 's' || s_suppkey
    WHEN l_returnflag = 'A' AND s_nationkey > 15 THEN 'named-' || s_suppkey END AS firm_id,
  CASE WHEN uen <> '' AND s_nationkey < 5 THEN 'alias:uen'
    WHEN l_returnflag = 'A' AND s_nationkey > 15 AND s_acctbal < 3000 THEN 'alias:name'
    WHEN s_acctbal >= 3000 AND l_returnflag <> 'R' THEN 'exact-name'
    WHEN s_acctbal >= 3000 THEN 'fuzzy-name' ELSE 'unmatched' END AS basis FROM e),
pairs AS (SELECT r.s_name, r.more, substr(r.s_name, 10) || ' ' || r.more AS a, substr(f.s_name, 10) AS b,
    length(r.more) + 18 AS la, 18 AS lb
  FROM (SELECT DISTINCT s_name, more FROM r WHERE basis = 'unmatched') r, supplier f WHERE f.s_acctbal >= 3000),
best AS (SELECT s_name, more, max(floor(greatest(
    100.0::DOUBLE * (1 - (length(trim(a)) + 9 - 2 * {lcs_sql("b", "trim(a)")}) / (la + lb)),
    100.0::DOUBLE * (1 - (1 + length(trim(a))) / (17 + length(trim(a))::DOUBLE)),
    100.0::DOUBLE * (1 - 10.0::DOUBLE / 26)))) AS score FROM pairs GROUP BY 1, 2)
SELECT employer_name, uen, firm_id, basis, CAST(CASE basis WHEN 'fuzzy-name' THEN 100 WHEN 'unmatched' THEN score
  ELSE 0 END AS BIGINT) AS score FROM r LEFT JOIN best ON r.s_name = best.s_name AND r.more = best.more"""


@query("resolve_employers", EMPLOYER_SQL)
def resolve_employers(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    names_in = (table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()
                .join(sup, F.col("l_suppkey") == F.col("s_suppkey")))
    ending = (F.when(F.col("l_returnflag") == "A", " PTE. LTD.")
              .when(F.col("l_returnflag") == "N", " (SINGAPORE) HOLDINGS PTE LTD")
              .otherwise(" TRADING AND SECURITIES"))
    employers = names_in.select(
        F.concat(F.upper("s_name"), ending).alias("employer_name"),
        F.when(F.col("l_linestatus") == "O", "").otherwise(F.concat(F.lit("uen"), key)).alias("uen"))
    registry = sup.filter("s_acctbal >= 3000").select(
        F.concat(F.lit("s"), key).alias("firm_id"), F.col("s_name").alias("firm_name"),
        F.col("s_suppkey").alias("registry_ord"))
    aliases = sup.filter("s_nationkey < 5").select(
        F.lit("uen").alias("alias_kind"), F.concat(F.lit("UEN"), key).alias("alias_value"),
        F.concat(F.lit("alias-"), key).alias("firm_id"), F.col("s_suppkey").alias("alias_ord")
    ).unionByName(sup.filter("s_nationkey > 15 AND s_acctbal < 3000").select(
        F.lit("name").alias("alias_kind"), F.concat("s_name", F.lit(" Limited")).alias("alias_value"),
        F.concat(F.lit("named-"), key).alias("firm_id"), F.col("s_suppkey").alias("alias_ord")))
    return resolve.resolve_employers(employers, registry, aliases)


# a part's name beside texts of several shapes: one that holds it, one turned round, its type, a
# long one, a few of its letters, an empty one
_SHAPES = ["lower(concat(p_type, ' ', p_name, ' ', p_brand))", "reverse(p_name)", "lower(p_type)",
           "concat(lower(p_type), ' ', p_name, ' ', lower(p_brand), ' size ', CAST(p_size AS VARCHAR(9)), ' ', p_name)",
           "substr(p_name, 3, 7)", "concat('  ', substr(p_name, 1, 0))"]
_NAMES = Binding("part", p_partkey="p_partkey", a="concat(p_name, ' ', lower(p_brand))", b=(
    f"CASE p_partkey % {len(_SHAPES)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_SHAPES)) + " END"))


def _ratio_sql(a, b):
    return f"200.0::DOUBLE * {lcs_sql(a, b)} / (length({a}) + length({b}))"


def _windows_sql(a, b):
    return f"""list_max(list_transform(range(1 - length({a}), length({b})), lambda i: {_ratio_sql(
        a, f"substr({b}, greatest(0, i)::INT + 1, (least(length({b}), i + length({a})) - greatest(0, i))::INT)")}))"""


def _sorted_words(c):
    return f"list_sort(list_distinct(list_filter(string_split({c}, ' '), lambda x: x <> '')))"


#: From word lists ta and tb: length of the shared words, the differing words, length of both texts.
_WORD_FACTS = """length(array_to_string(list_filter(ta, lambda x: list_contains(tb, x)), ' ')) AS c,
  array_to_string(list_filter(ta, lambda x: NOT list_contains(tb, x)), ' ') AS da,
  array_to_string(list_filter(tb, lambda x: NOT list_contains(ta, x)), ' ') AS db"""
_TOTAL = "(2 * (c + (c > 0)::INT) + length(da) + length(db))"
_TOKEN_SET = f"""CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0 WHEN c > 0 AND (da = '' OR db = '') THEN 100 ELSE greatest(
    100 * (1 - (length(da) + length(db) - 2 * CASE WHEN length(da) <= length(db) THEN {lcs_sql("da", "db")}
      ELSE {lcs_sql("db", "da")} END) / {_TOTAL}::DOUBLE),
    CASE WHEN c > 0 THEN 100 * (1 - (1 + length(da)) / (2 * c + 1 + length(da))::DOUBLE) ELSE 0 END,
    CASE WHEN c > 0 THEN 100 * (1 - (1 + length(db)) / (2 * c + 1 + length(db))::DOUBLE) ELSE 0 END) END"""


@query("name_similarity", f"""WITH n AS ({_NAMES.sql()}),
w AS (SELECT *, length(a) <= length(b) AS up, {_sorted_words("a")} AS ta, {_sorted_words("b")} AS tb FROM n),
o AS (SELECT *, CASE WHEN up THEN a ELSE b END AS s, CASE WHEN up THEN b ELSE a END AS l, {_WORD_FACTS} FROM w)
SELECT p_partkey, {_ratio_sql("s", "l")} AS plain, {_TOKEN_SET} AS token_set,
  CASE WHEN length(s) = length(l) THEN greatest({_windows_sql("s", "l")}, {_windows_sql("l", "s")})
    ELSE {_windows_sql("s", "l")} END AS partial_score FROM o""")
def name_similarity(spark, sf_dir):
    """The three similarity scores of each part's name against texts of several shapes."""
    return spread(_NAMES.frame(spark, sf_dir)).select(
        "p_partkey", similarity.ratio("a", "b").alias("plain"), similarity.token_set_ratio("a", "b").alias("token_set"),
        similarity.partial_ratio("a", "b").alias("partial_score"))


# an edit distance above the room a score of 88 leaves rules a pair out
@query("similar_titles", f"""WITH l AS (SELECT DISTINCT p_brand, p_name || ' ' || lower(p_type) AS t FROM part),
r AS (SELECT DISTINCT p_brand, p_name || 's ' || lower(p_type) AS t FROM part),
w AS (SELECT l.p_brand, l.t AS title_left, r.t AS title_right, {_sorted_words("l.t")} AS ta, {_sorted_words("r.t")} AS tb
  FROM l JOIN r ON l.p_brand = r.p_brand),
f AS (SELECT *, {_WORD_FACTS} FROM w),
near AS (SELECT * FROM f WHERE c >= 0.7 * least(length(title_left), length(title_right))
  OR levenshtein(da, db) <= {_TOTAL} * 0.12 + 1e-9),
scored AS (SELECT p_brand, title_left, title_right, {_TOKEN_SET} AS score FROM near)
SELECT * FROM scored WHERE score >= 88""")
def similar_titles(spark, sf_dir):
    """All pairs of a brand's part titles that are at least 88 alike, found without all-pairs."""
    part = table(spark, sf_dir, "part")
    left = part.select("p_brand", F.concat_ws(" ", "p_name", F.lower("p_type")).alias("t"))
    right = part.select("p_brand", F.concat(F.col("p_name"), F.lit("s "), F.lower("p_type")).alias("t"))
    return fuzzy_join.similar_titles(left, right, "p_brand", "t", fixed.TITLE_MATCH_THRESHOLD)


# --- merge and curate -----------------------------------------------------------------------

_EMPLOYER = ("upper(n_name) || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' BANK SECURITIES PTE LTD' "
             "ELSE ' BANK PTE LTD' END")
_BOARD = "CASE o_orderstatus WHEN 'F' THEN 'lever' WHEN 'P' THEN 'ashby' ELSE 'mcf' END"
# a portal title equals none of the boards' titles, is close to the one and holds the other
_TITLE = "o_orderpriority || CASE o_orderstatus WHEN 'F' THEN ' usher' WHEN 'P' THEN '' ELSE ' ushers' END"
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


class OrdersOfNations:
    @staticmethod
    def frame(spark, sf_dir):
        return OrdersWithCustomers.frame(spark, sf_dir).join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def _merge_inputs(spark, sf_dir):
    """Filled and pending orders are two boards of a firm, open ones the portal; firms are nations'
    banks."""
    orders = spread(OrdersOfNations.frame(spark, sf_dir))
    on_board = F.col("o_orderstatus").isin("F", "P")
    employer = F.expr(_EMPLOYER)
    firm = F.when(on_board, F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string"))) \
        .otherwise(text.slug_chars(employer))
    platform = F.expr(_BOARD)
    key = F.col("o_orderkey").cast("string")
    portal_only = lambda c: F.when(~on_board, c)
    known = {"employer_name": portal_only(employer), "min_years": portal_only(F.lit(0)),
             "salary_min": portal_only(F.col("o_totalprice")),
             "mcf_job_post_id": portal_only(F.concat(F.lit("P"), key))}
    rows = orders.select(
        firm.alias("firm_id"), platform.alias("source_platform"), key.alias("external_id"),
        F.expr(_TITLE).alias("title"),
        F.concat(F.lit("https://jobs.example.com/"), key).alias("apply_url"),
        F.when(F.col("c_acctbal") > 0, "Singapore").otherwise("London").alias("location_raw"),
        F.lit("").alias("description_text"), F.lit("").alias("department"),
        F.lit("").alias("employment_type"),
        F.when(F.col("o_totalprice") >= 30000, F.col("o_orderdate").cast("date")).alias("posted_date"),
        F.lit("published").alias("posted_date_basis"),
        F.struct(*[known.get(n, F.lit(None)).cast("string").alias(n)
                   for n in schema.names(schema.EXTRA)]).alias("extra"))
    rows = rows.withColumn("job_key", text.job_key("source_platform", "firm_id", "external_id"))
    registry = table(spark, sf_dir, "nation").filter("n_regionkey < 4").select(
        F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("firm_id"),
        F.concat(F.initcap("n_name"), F.lit(" Bank")).alias("firm_name"),
        F.when(F.col("n_regionkey") == 1, "consulting").otherwise("bank").alias("sector"),
        (F.col("n_regionkey") + 1).cast("bigint").alias("tier"),
        F.col("n_nationkey").alias("registry_ord"))
    aliases = spark.createDataFrame([], schema.ALIASES).withColumn("alias_ord", F.lit(0))
    return rows, registry, aliases


def _merge_stored(spark, sf_dir):
    """The inputs and a stage, with the postings stored, as a run finds them: several branches read them."""
    rows, registry, aliases = _merge_inputs(spark, sf_dir)
    stage = table_stage(spark)
    return stage(rows, "postings"), registry, aliases, stage


MERGE_SQL = f"""WITH o AS (SELECT o_orderkey, o_orderstatus, {_TITLE} AS title, n_regionkey, n_nationkey,
    c_acctbal, o_totalprice, 'nation-' || n_nationkey AS firm, {_EMPLOYER} AS employer, {_BOARD} AS board,
    {_BOARD} || ':nation-' || n_nationkey || ':' || o_orderkey AS board_key,
    'mcf:' || trim(regexp_replace(lower({_EMPLOYER}), '[^a-z0-9]+', '-', 'g'), '-') || ':' || o_orderkey AS raw_key,
    CASE WHEN o_totalprice >= 30000 THEN CAST(o_orderdate AS DATE) END AS d
  FROM {_ORDERS}),
b AS (SELECT * FROM o WHERE o_orderstatus <> 'O'),
p AS (SELECT * FROM o WHERE o_orderstatus = 'O' AND n_regionkey < 4),
titles AS (SELECT l.title AS pt, r.title AS bt, {_sorted_words("lower(l.title)")} AS ta, {_sorted_words("lower(r.title)")} AS tb
  FROM (SELECT DISTINCT title FROM p) l, (SELECT DISTINCT title FROM b) r),
facts AS (SELECT *, {_WORD_FACTS} FROM titles),
alike AS (SELECT pt, bt FROM facts WHERE {_TOKEN_SET} >= 88),
t AS (SELECT p.raw_key, min(b.board_key) AS twin_key FROM p JOIN alike ON p.title = alike.pt
  JOIN b ON p.firm = b.firm AND b.title = alike.bt AND (p.d IS NULL OR b.d IS NULL OR abs(p.d - b.d) <= 14) GROUP BY 1),
m AS (SELECT p.*, t.twin_key FROM p LEFT JOIN t ON p.raw_key = t.raw_key),
e AS (SELECT twin_key, arg_max('P' || o_orderkey, raw_key) AS post_id, arg_max(o_totalprice, raw_key) AS salary
  FROM m WHERE twin_key IS NOT NULL GROUP BY 1),
kept AS (SELECT b.board_key AS job_key, b.board_key AS raw_job_key, b.firm AS firm_id, b.title, b.d,
    coalesce(e.post_id, '') AS mcf_job_id, e.salary AS salary_min, b.c_acctbal, b.n_nationkey, b.n_regionkey,
    b.o_orderkey, false AS portal, b.board
  FROM b LEFT JOIN e ON e.twin_key = b.board_key
  UNION ALL SELECT 'mcf:' || firm || ':' || o_orderkey, raw_key, firm, title, d, '', o_totalprice, c_acctbal,
    n_nationkey, n_regionkey, o_orderkey, true, 'mcf'
  FROM m WHERE twin_key IS NULL)
"""


@query("merge_twins", MERGE_SQL + "SELECT raw_key AS job_key, twin_key FROM m WHERE twin_key IS NOT NULL")
def merge_twins(spark, sf_dir):
    *inputs, stage = _merge_stored(spark, sf_dir)
    return merge.merge_sources(*inputs, stage=stage).folded.select("job_key", "twin_key")


@query("merge_kept", MERGE_SQL + "SELECT job_key, raw_job_key, firm_id, mcf_job_id, salary_min FROM kept")
def merge_kept(spark, sf_dir):
    *inputs, stage = _merge_stored(spark, sf_dir)
    kept = merge.merge_sources(*inputs, stage=stage).postings
    return kept.select("job_key", "raw_job_key", "firm_id",
                       F.coalesce("extra.mcf_job_id", F.lit("")).alias("mcf_job_id"),
                       F.col("extra.salary_min").try_cast("double").alias("salary_min"))


@query("merge_counters", MERGE_SQL + """SELECT 'kept' AS counter, count(*) AS n FROM kept UNION ALL
SELECT 'merged', count(*) FROM t UNION ALL SELECT 'graduate', count(*) FILTER (WHERE portal) FROM kept UNION ALL
SELECT 'candidates', count(*) FROM o WHERE o_orderstatus = 'O' AND n_regionkey >= 4""")
def merge_counters(spark, sf_dir):
    """Counted while the tables are written, as a run does."""
    rows, registry, aliases, stage = _merge_stored(spark, sf_dir)
    none = spark.createDataFrame([], schema.LIFECYCLE)
    overrides = spark.createDataFrame([], "job_key string, job_family string")
    curated, candidates, _ = curate.build_tables(rows, none, registry, aliases, overrides, dt.date(2001, 8, 1), stage=stage)
    counted = reports.RunCounters(rows.filter(F.col("source_platform") == fixed.PORTAL_PLATFORM).count())
    stage(counted.curated(curated), "curated"), stage(counted.candidates(candidates), "candidates")
    return spark.createDataFrame(sorted(counted.get().items()), "counter string, n bigint")


@query("candidates_topn", MERGE_SQL + """SELECT employer, count(*) AS postings FROM o
WHERE o_orderstatus = 'O' AND n_regionkey >= 4 GROUP BY 1""")
def candidates_topn(spark, sf_dir):
    """Only the unresolved rows are read, so nothing of the twin search is stored or run."""
    merged = merge.merge_sources(*_merge_inputs(spark, sf_dir))
    return merge.summarise_candidates(merged.candidates)


@query("candidates_busiest", MERGE_SQL + """SELECT employer, count(*) AS postings FROM o
WHERE o_orderstatus = 'O' AND n_regionkey >= 4 GROUP BY 1 ORDER BY 2 DESC, min(raw_key) LIMIT 3""")
def candidates_busiest(spark, sf_dir):
    """The head of the report: the three busiest employers outside the registry."""
    return merge.summarise_candidates(merge.merge_sources(*_merge_inputs(spark, sf_dir)).candidates, top=3)


@query("curated_table", MERGE_SQL + f"""SELECT kept.job_key, firm_id, CASE WHEN n_regionkey < 4 THEN 'Nation_' || n_nationkey
    || ' Bank' ELSE firm_id END AS firm_name, CASE WHEN n_regionkey = 1 THEN 'consulting' WHEN n_regionkey < 4 THEN 'bank'
    ELSE '' END AS sector, CAST(CASE WHEN n_regionkey < 4 THEN n_regionkey + 1 ELSE 0 END AS BIGINT) AS tier, title,
  board AS source_platform,
  portal OR c_acctbal > 0 AS is_singapore, d AS posted_date, li.fs AS first_seen, li.ls AS last_seen,
  coalesce(li.status, 'open') AS status,
  CASE WHEN ov.job_key IS NOT NULL THEN 'legal' WHEN n_regionkey = 1 THEN 'management_consulting'
    ELSE 'other' END AS job_family,
  portal AS is_grad, CASE WHEN portal THEN 'route:zero-years' ELSE 'no-route' END AS grad_basis,
  CASE WHEN portal THEN 'Entry level' ELSE 'Not graduate' END AS role_type, mcf_job_id, salary_min,
  DATE '2001-08-01' AS snapshot_date
FROM kept LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS fs, CAST(o_orderdate AS DATE) + 10 AS ls,
    CASE o_orderstatus WHEN 'F' THEN 'closed' ELSE 'reposted' END AS status,
    {_BOARD} || ':nation-' || c_nationkey || ':' || o_orderkey AS job_key
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000) li ON li.job_key = kept.job_key
LEFT JOIN (SELECT 'mcf:nation-' || c_nationkey || ':' || o_orderkey AS job_key
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 490000) ov ON ov.job_key = kept.job_key""")
def curated_table(spark, sf_dir):
    """Merge, classify, override, and join the dimension and the lifecycle."""
    rows, registry, aliases, stage = _merge_stored(spark, sf_dir)
    orders = OrdersWithCustomers.frame(spark, sf_dir)
    key = lambda platform: F.concat_ws(
        ":", platform, F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")),
        F.col("o_orderkey").cast("string")).alias("job_key")
    life = orders.filter("o_totalprice > 100000").select(
        key(F.expr(_BOARD)), F.col("o_orderdate").cast("date").alias("first_seen"),
        F.date_add(F.col("o_orderdate").cast("date"), 10).alias("last_seen"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("reposted").alias("status"))
    overrides = orders.filter("o_totalprice > 490000").select(
        key(F.lit("mcf")), F.lit("legal").alias("job_family"))
    table_, _, _ = curate.build_tables(rows, life, registry, aliases, overrides, dt.date(2001, 8, 1),
                                        stage=stage)
    return table_.select(
        "job_key", "firm_id", "firm_name", "sector", "tier", "title", "source_platform", "is_singapore",
        "posted_date", "first_seen", "last_seen", "status", "job_family", "is_grad", "grad_basis",
        "role_type", "mcf_job_id", "salary_min", "snapshot_date")


# --- selection ------------------------------------------------------------------------------

_LIVE = ROWS_SQL + f", live AS (SELECT * FROM cur WHERE {BASE})"
_PRIORITY = ", ".join(f"'{g}'" for g in fixed.PRIORITY_GROUPS)
SINCE = dt.date(1999, 6, 30)


@query("select_new", _LIVE + f"""SELECT job_key, family_group, role_type, posted_date, first_seen FROM live
WHERE family_group IN ({_PRIORITY}) AND role_type IN ('Graduate programme', 'Entry level')
  AND first_seen > DATE '{SINCE}'""")
def select_new(spark, sf_dir):
    out = select.select_new(ROWS.frame(spark, sf_dir), SINCE, ("Graduate programme", "Entry level"))
    return out.select("job_key", "family_group", "role_type", "posted_date", "first_seen")


_MATCH = _LIVE + f""", {WISHES_SQL}, matched AS (SELECT w.chat_id, l.* FROM live l JOIN wishes w
  ON l.role_type = w.role_type AND l.family_group = w.family_group)"""


def _matches(spark, sf_dir):
    subs = state.active_subscriptions(subscriptions(spark, sf_dir))
    return select.match_subscribers(select.notifiable(ROWS.frame(spark, sf_dir)), subs)


@query("subscription_match", _MATCH + "SELECT chat_id, job_key, role_type, family_group FROM matched")
def subscription_match(spark, sf_dir):
    return _matches(spark, sf_dir).select("chat_id", "job_key", "role_type", "family_group")


@query("matching_counts", _MATCH + """SELECT w.chat_id, count(m.job_key) AS matching FROM
  (SELECT DISTINCT chat_id FROM wishes) w LEFT JOIN matched m ON m.chat_id = w.chat_id GROUP BY 1""")
def matching_counts(spark, sf_dir):
    return select.matching_counts(ROWS.frame(spark, sf_dir),
                                  state.active_subscriptions(subscriptions(spark, sf_dir)))


@query("firms_open_roles", _MATCH + "SELECT chat_id, firm_name, count(*) AS roles FROM matched GROUP BY 1, 2")
def firms_open_roles(spark, sf_dir):
    return select.firms_with_roles(ROWS.frame(spark, sf_dir),
                                   state.active_subscriptions(subscriptions(spark, sf_dir)))


_SENT = _MATCH + """, sent AS (SELECT DISTINCT chat_id, job_key FROM matched WHERE first_seen < DATE '1999-01-01'
  UNION SELECT 'NATION_0', 'ord:gone'), due AS (SELECT chat_id, job_key FROM matched EXCEPT SELECT * FROM sent)"""


def _sent(matches):
    before = matches.filter(F.col("first_seen") < F.lit(dt.date(1999, 1, 1))).select("chat_id", "job_key")
    gone = matches.sparkSession.createDataFrame([("NATION_0", "ord:gone")], schema.SENT_STATE)
    return before.distinct().unionByName(gone)


@query("unsent_diff", _SENT + "SELECT * FROM due")
def unsent_diff(spark, sf_dir):
    matches = _matches(spark, sf_dir)
    return select.unsent(matches, _sent(matches)).select("chat_id", "job_key")


@query("sent_state", _SENT + """SELECT chat_id, job_key FROM (SELECT * FROM sent UNION SELECT * FROM due) x
WHERE job_key IN (SELECT job_key FROM cur) OR (chat_id, job_key) IN (SELECT * FROM due)""")
def sent_state(spark, sf_dir):
    matches = _matches(spark, sf_dir)
    sent = _sent(matches)
    return select.record_sent(sent, select.unsent(matches, sent), ROWS.frame(spark, sf_dir))


def _escaped_sql(c):
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


#: One step per line of a reader: the message it goes to and that message's size.
_DIGEST_SQL = _MATCH.replace("WITH ", "WITH RECURSIVE ", 1) + f""", told AS (
  SELECT chat_id, family_group, posted_date, job_key, '<b>🎓 ' || count(*) OVER (PARTITION BY chat_id)
    || ' new graduate role(s)</b> · 2001-08-01' AS header, chr(10) || '<b>' || {_escaped_sql("family_group")} || '</b> ('
    || count(*) OVER (PARTITION BY chat_id, family_group) || ')' AS grp,
    '• <a href="' || {_escaped_sql("apply_url")} || '">' || {_escaped_sql("left(title, 90)")} || '</a>' || chr(10) || '  '
    || {_escaped_sql("left(firm_name, 40)")} || ' · '
    || coalesce(strftime(coalesce(posted_date, first_seen), '%Y-%m-%d'), 'date unknown') AS line FROM matched),
parts AS (SELECT chat_id, family_group, posted_date, job_key, header, grp, 1 AS kind, line AS part FROM told UNION ALL
  SELECT DISTINCT chat_id, family_group, NULL, NULL, header, grp, 0, grp FROM told),
items AS (SELECT chat_id, header, grp, part, row_number() OVER (
    PARTITION BY chat_id ORDER BY family_group, kind, posted_date DESC NULLS LAST, job_key) AS idx FROM parts),
walk AS (
  SELECT chat_id, 0::BIGINT AS idx, 1::BIGINT AS no, length(header) AS size, header AS part FROM items WHERE idx = 1
  UNION ALL
  SELECT i.chat_id, i.idx, w.no + (w.size + length(i.part) > 3800)::INT,
    CASE WHEN w.size + length(i.part) > 3800
      THEN length(i.header) + 9 + length((w.no + 1)::VARCHAR) + length(i.grp) + 1 ELSE w.size END + length(i.part) + 1,
    CASE WHEN w.size + length(i.part) > 3800 THEN i.header || ' (cont. ' || (w.no + 1) || ')' || chr(10) || i.grp || chr(10)
      ELSE '' END || i.part
  FROM walk w JOIN items i ON i.chat_id = w.chat_id AND i.idx = w.idx + 1)
SELECT chat_id, no AS message_no, string_agg(part, chr(10) ORDER BY idx) AS message FROM walk GROUP BY 1, 2"""


@query("digest_messages", _DIGEST_SQL)
def digest_messages(spark, sf_dir):
    return packing.render_digest(_matches(spark, sf_dir), "2001-08-01")


@query("digest_messages_long_readers", _DIGEST_SQL)
def digest_messages_long_readers(spark, sf_dir):
    """The same messages with readers of more than 500 lines packed by all tasks together."""
    return packing.render_digest(_matches(spark, sf_dir), "2001-08-01", long_reader=500)


@query("digest_totals", _MATCH + """SELECT chat_id, count(*) AS lines, true AS fits, CAST(1 AS BIGINT) AS first_no
FROM matched GROUP BY 1""")
def digest_totals(spark, sf_dir):
    """Every matching role is in exactly one message and no message is too long."""
    sent = packing.render_digest(_matches(spark, sf_dir), "2001-08-01")
    return sent.groupBy("chat_id").agg(
        F.sum(F.regexp_count("message", F.lit("<a href="))).cast("bigint").alias("lines"),
        (F.max(F.length("message")) <= 4096).alias("fits"), F.min("message_no").alias("first_no"))


@query("reply_totals", _MATCH + """SELECT chat_id, count(*) AS lines, true AS fits, CAST(1 AS BIGINT) AS headings
FROM matched GROUP BY 1""")
def reply_totals(spark, sf_dir):
    """Plain replies: every row once, one heading per reader, no message too long."""
    sent = packing.render_reply(_matches(spark, sf_dir), "<b>Newest</b>")
    count = lambda what: F.sum(F.regexp_count("message", F.lit(what))).cast("bigint")
    return sent.groupBy("chat_id").agg(
        count("<a href=").alias("lines"), (F.max(F.length("message")) <= 4096).alias("fits"),
        count("<b>Newest</b>").alias("headings"))


@query("dashboard_view", ROWS_SQL + """SELECT job_key, posted_date, first_seen,
  CASE WHEN first_seen >= DATE '2001-07-29' THEN '🆕' ELSE '' END AS "new" FROM cur
WHERE is_grad AND NOT is_internship AND is_singapore AND status IN ('open', 'unknown')
  AND family_group IN ('Operations', 'Legal') AND (posted_date IS NULL OR posted_date >= DATE '2001-05-03')""")
def dashboard_view(spark, sf_dir):
    return _dashboard(spark, sf_dir).select("job_key", "posted_date", "first_seen", "new")


def _dashboard(spark, sf_dir):
    return select.dashboard(ROWS.frame(spark, sf_dir), dt.date(2001, 8, 1),
                            statuses=("open", "unknown"), groups=("Operations", "Legal"))


@query("headline", ROWS_SQL + """SELECT count(*) AS matching,
  count(*) FILTER (WHERE first_seen >= DATE '2001-07-29') AS new_rows,
  count(DISTINCT firm_name) AS firms, count(DISTINCT job_family) AS families FROM cur
WHERE is_grad AND NOT is_internship AND is_singapore AND status IN ('open', 'unknown')
  AND family_group IN ('Operations', 'Legal') AND (posted_date IS NULL OR posted_date >= DATE '2001-05-03')""")
def headline(spark, sf_dir):
    return reports.headline(_dashboard(spark, sf_dir))


@query("status_counts", ROWS_SQL + """SELECT status, count(*) AS postings FROM cur
WHERE is_grad AND NOT is_internship GROUP BY 1""")
def status_counts(spark, sf_dir):
    return reports.status_counts(ROWS.frame(spark, sf_dir))


@query("family_rollup", ROWS_SQL + """SELECT family_group, job_family, count(*) AS postings,
  CAST(sum(count(*)) OVER (PARTITION BY family_group) AS BIGINT) AS group_postings FROM cur GROUP BY 1, 2""")
def family_rollup(spark, sf_dir):
    return reports.family_counts(ROWS.frame(spark, sf_dir))


@query("source_counts", ROWS_SQL + """SELECT source_platform, posted_date_basis, count(*) AS postings
FROM cur WHERE source_platform <> 'ashby' GROUP BY 1, 2""")
def source_counts(spark, sf_dir):
    rows = ROWS.frame(spark, sf_dir).filter(~F.col("source_platform").isin("ashby"))
    return reports.count_by(rows, "source_platform", "posted_date_basis")


@query("facets", ROWS_SQL + """SELECT DISTINCT facet, value FROM (
  SELECT 'status' AS facet, status AS value FROM cur UNION ALL SELECT 'family_group', family_group FROM cur
  UNION ALL SELECT 'sector', sector FROM cur UNION ALL SELECT 'firm_name', firm_name FROM cur) x
WHERE value <> ''""")
def facets(spark, sf_dir):
    return reports.facets(ROWS.frame(spark, sf_dir), ["status", "family_group", "sector", "firm_name"])


_ORDERED = "ORDER BY family_group ASC NULLS LAST, posted_date DESC NULLS LAST, job_key"


@query("search_matches", _LIVE + f"""SELECT job_key, title, firm_name FROM live
WHERE contains(lower(title), 'urgent') OR contains(lower(firm_name), 'urgent') {_ORDERED} LIMIT 40""")
def search_matches(spark, sf_dir):
    live = select.notifiable(ROWS.frame(spark, sf_dir))
    return select.search(live, "URGENT").select("job_key", "title", "firm_name")


@query("latest_matches", _LIVE + f"SELECT job_key, family_group, posted_date FROM live {_ORDERED} LIMIT 50")
def latest_matches(spark, sf_dir):
    live = select.notifiable(ROWS.frame(spark, sf_dir))
    return select.latest(live, "500").select("job_key", "family_group", "posted_date")


# --- reports --------------------------------------------------------------------------------

@query("platform_health", EV_SQL + """SELECT source, max(snapshot_date) AS snapshot_date,
  count(*) AS firms_attempted, count(*) FILTER (WHERE ok) AS firms_ok, CAST(sum(row_count) AS BIGINT) AS "rows",
  1.0::DOUBLE - count(*) FILTER (WHERE ok) / count(*) AS failure_rate,
  count(*) FILTER (WHERE ok) = 0 OR sum(row_count) = 0 AS broken
FROM outcomes o WHERE snapshot_date = (SELECT max(snapshot_date) FROM outcomes x WHERE x.source = o.source)
GROUP BY source""")
def platform_health(spark, sf_dir):
    return reports.platform_health(ev_outcomes(EV.frame(spark, sf_dir)))


@query("read_failures", EV_SQL + """SELECT source AS platform, firm_id, 'unknown error' AS error FROM outcomes o
WHERE NOT ok AND snapshot_date = (SELECT max(snapshot_date) FROM outcomes x WHERE x.source = o.source)""")
def read_failures(spark, sf_dir):
    return reports.read_failures(ev_outcomes(EV.frame(spark, sf_dir)).withColumn("error", F.lit("")))


@query("ingest_summary", EV_SQL + """SELECT CAST(sum(row_count) AS BIGINT) AS postings, count(*) AS firms,
  count(*) FILTER (WHERE NOT ok) AS failed FROM outcomes""")
def ingest_summary(spark, sf_dir):
    return reports.ingest_summary(ev_outcomes(EV.frame(spark, sf_dir)))


# --- registry and small dimensions ----------------------------------------------------------

def _registry_rows(spark, sf_dir):
    """Suppliers as registry rows, some of them breaking the rules."""
    key = F.col("s_suppkey").cast("string")
    wired = F.col("s_nationkey") < 12
    return table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_nationkey") == 13, F.concat(F.lit("a b "), key))
        .when(F.col("s_nationkey") == 14, "twice").otherwise(F.concat(F.lit("s-"), key)).alias("firm_id"),
        F.col("s_name").alias("firm_name"), F.lit("bank").alias("sector"),
        F.when(F.col("s_nationkey") == 15, "one").otherwise("1").alias("tier"),
        F.when(F.col("s_nationkey") == 2, "").when(F.col("s_nationkey") < 6, "workday")
        .otherwise("lever").alias("ats_platform"),
        F.lit("tok").alias("ats_token"),
        F.when(F.col("s_nationkey") == 4, "").otherwise("host").alias("ats_host"),
        F.when(F.col("s_nationkey") < 5, "").otherwise("site").alias("board_site"),
        F.lit("").alias("careers_url"),
        F.when(F.col("s_nationkey") == 8, "disallowed").otherwise("allowed").alias("robots_status"),
        F.when(wired, "wired").otherwise("todo").alias("status"),
        F.when(F.col("s_acctbal") > 5000, "old").otherwise("").alias("notes"),
        F.col("s_suppkey").alias("registry_ord"), F.col("s_suppkey").alias("line"))


REG_SQL = """WITH r AS (SELECT s_suppkey AS line, s_nationkey AS n, s_acctbal AS bal,
  CASE WHEN s_nationkey = 13 THEN 'a b ' || s_suppkey WHEN s_nationkey = 14 THEN 'twice'
    ELSE 's-' || s_suppkey END AS firm_id,
  CASE WHEN s_nationkey = 2 THEN NULL WHEN s_nationkey < 6 THEN 'workday' ELSE 'lever' END AS platform,
  CASE WHEN s_nationkey < 12 THEN 'wired' ELSE 'todo' END AS status FROM supplier)
"""


@query("registry_rules", REG_SQL + """SELECT firm_id, line, 'firm_id must be an alphanumeric slug' AS problem
  FROM r WHERE n = 13 UNION ALL
SELECT firm_id, line, 'tier must be a whole number' FROM r WHERE n = 15 UNION ALL
SELECT firm_id, line, 'wired requires a platform' FROM r WHERE n = 2 UNION ALL
SELECT firm_id, line, 'robots disallow this board, so it cannot be wired' FROM r WHERE n = 8 UNION ALL
SELECT firm_id, line, CASE WHEN n = 4 THEN 'workday needs ats_host, board_site' ELSE 'workday needs board_site'
  END FROM r WHERE n IN (0, 1, 3, 4) UNION ALL
SELECT firm_id, max(line), 'duplicate firm_id' FROM r GROUP BY 1 HAVING count(*) > 1""")
def registry_rules(spark, sf_dir):
    return dims.registry_violations(_registry_rows(spark, sf_dir))


@query("registry_counts", REG_SQL + """SELECT 'status' AS what, status AS value, count(*) AS firms FROM r GROUP BY 2
UNION ALL SELECT 'platform', platform, count(*) FROM r WHERE platform IS NOT NULL GROUP BY 2
UNION ALL SELECT 'fetchable', platform, count(*) FROM r WHERE platform IS NOT NULL AND status = 'wired' GROUP BY 2""")
def registry_counts(spark, sf_dir):
    reg = dims.typed_registry(_registry_rows(spark, sf_dir))
    one = lambda df, what, c: dims.counts_by(df, c).select(
        F.lit(what).alias("what"), F.col(c).alias("value"), "firms")
    return (one(reg, "status", "status").unionByName(one(reg, "platform", "ats_platform"))
            .unionByName(one(dims.fetchable(reg), "fetchable", "ats_platform")))


@query("registry_upsert", REG_SQL + """SELECT firm_id, line, CASE WHEN status = 'todo' AND bal > 0 AND n NOT IN (13, 14)
    THEN 'ashby' ELSE platform END AS ats_platform,
  CASE WHEN status = 'todo' AND bal > 0 AND n NOT IN (13, 14) THEN 'wired' ELSE status END AS status,
  CASE WHEN status = 'todo' AND bal > 0 AND n NOT IN (13, 14) THEN
    CASE WHEN bal > 5000 THEN 'old; found' ELSE 'found' END
  WHEN bal > 5000 THEN 'old' ELSE '' END AS notes FROM r""")
def registry_upsert(spark, sf_dir):
    rows = _registry_rows(spark, sf_dir)
    hits = table(spark, sf_dir, "supplier").filter(
        "s_acctbal > 0 AND s_nationkey NOT IN (13, 14)").select(
        F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("firm_id"),
        F.lit("ashby").alias("ats_platform"), F.lit("new").alias("ats_token"), F.lit("found").alias("note"))
    reg = dims.typed_registry(rows).withColumn("line", F.col("registry_ord"))
    return dims.upsert_registry(reg, hits).select("firm_id", "line", "ats_platform", "status", "notes")


@query("override_table", """SELECT 'k' || s_nationkey AS job_key, arg_max(CAST(s_suppkey AS STRING), s_suppkey)
  AS job_family FROM supplier WHERE s_acctbal > 0 GROUP BY 1""")
def override_table(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("k"), F.col("s_nationkey").cast("string")).alias("job_key"),
        F.when(F.col("s_acctbal") > 0, F.col("s_suppkey").cast("string")).otherwise("").alias("job_family"),
        F.col("s_suppkey").alias("override_ord"))
    return dims.latest_overrides(rows)


@query("active_subscribers", f"WITH {WISHES_SQL} SELECT DISTINCT chat_id FROM wishes")
def active_subscribers(spark, sf_dir):
    return state.active_subscriptions(subscriptions(spark, sf_dir)).select("chat_id")


# --- boards ---------------------------------------------------------------------------------

_POSTS_SQL = """WITH l AS (SELECT CASE l_returnflag WHEN 'A' THEN 'ashby' WHEN 'N' THEN 'lever' ELSE 'greenhouse'
    END AS platform, replace(p_name, ' ', '') AS packed, split_part(p_name, ' ', 1) AS head, p_name,
    l_discount > 0.05 AS here, l_linestatus FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT *, l_linestatus = 'O' AND NOT (platform = 'lever' AND p_name LIKE '%anvil') AS own FROM l),
census AS (SELECT platform, CASE WHEN own THEN packed ELSE head END AS token, count(*) AS total,
  count(*) FILTER (WHERE here) AS in_place,
  max(CASE WHEN own AND platform = 'greenhouse' THEN p_name ELSE '' END) AS board_name,
  max(CASE WHEN own AND platform = 'ashby' THEN 'https://www.' || packed || '.com/1' ELSE '' END) AS sample_url
  FROM b GROUP BY 1, 2),
firms AS (SELECT DISTINCT replace(p_name, ' ', '_') AS firm_id, p_name AS firm_name,
  replace(p_name, ' ', '') AS packed, split_part(p_name, ' ', 1) AS head FROM part),
hits AS (SELECT f.firm_id, f.firm_name, c.* FROM firms f JOIN census c ON c.token = f.packed
  UNION ALL SELECT f.firm_id, f.firm_name, c.* FROM firms f JOIN census c ON c.token = f.head
  WHERE NOT EXISTS (SELECT 1 FROM census x WHERE x.platform = c.platform AND x.token = f.packed)),
judged AS (SELECT *, CASE WHEN length(token) < 4 THEN false WHEN board_name <> '' OR sample_url <> '' THEN true
    WHEN token <> replace(firm_name, ' ', '') THEN false ELSE in_place > 0 END AS verified,
  CASE WHEN length(token) < 4 THEN 'token too short to trust' WHEN board_name <> '' THEN 'board name matches'
    WHEN sample_url <> '' THEN 'apply domain matches'
    WHEN token <> replace(firm_name, ' ', '') THEN 'nothing to verify against'
    WHEN in_place > 0 THEN 'token matches' ELSE 'token matches but no Singapore roles' END AS reason FROM hits)
"""


def _board_posts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    platform = (F.when(F.col("l_returnflag") == "A", "ashby").when(F.col("l_returnflag") == "N", "lever")
                .otherwise("greenhouse"))
    packed = F.replace("p_name", F.lit(" "), F.lit(""))
    own = (F.col("l_linestatus") == "O") & ~((platform == "lever") & F.col("p_name").endswith("anvil"))
    return lines.select(
        platform.alias("platform"), F.when(own, packed).otherwise(F.substring_index("p_name", " ", 1))
        .alias("token"), F.col("l_orderkey").alias("posting_ord"),
        F.when(F.col("l_discount") > 0.05, "Singapore").otherwise("London").alias("location"),
        F.when(own & (platform == "greenhouse"), F.col("p_name")).alias("board_name"),
        F.when(own & (platform == "ashby"), F.concat(F.lit("https://www."), packed, F.lit(".com/1")))
        .alias("url"))


def _board_hits(spark, sf_dir):
    firms = table(spark, sf_dir, "part").select(
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("firm_id"), F.col("p_name").alias("firm_name")).distinct()
    return boards.match_boards(firms, boards.board_census(_board_posts(spark, sf_dir)))


@query("board_census", _POSTS_SQL + "SELECT * FROM census")
def board_census(spark, sf_dir):
    return boards.board_census(_board_posts(spark, sf_dir))


@query("blocking_match", _POSTS_SQL + "SELECT firm_id, platform, token, total, in_place FROM hits")
def blocking_match(spark, sf_dir):
    return _board_hits(spark, sf_dir).select("firm_id", "platform", "token", "total", "in_place")


@query("board_verification", _POSTS_SQL + "SELECT firm_id, platform, token, verified, reason FROM judged")
def board_verification(spark, sf_dir):
    return boards.verify_boards(_board_hits(spark, sf_dir)).select(
        "firm_id", "platform", "token", "verified", "reason")


@query("best_board", _POSTS_SQL + """SELECT firm_id, platform, token, total, in_place FROM (SELECT *, row_number()
  OVER (PARTITION BY firm_id ORDER BY in_place DESC, total DESC, platform) AS rn FROM judged WHERE verified)
WHERE rn = 1""")
def best_board(spark, sf_dir):
    hits = boards.verify_boards(_board_hits(spark, sf_dir))
    order = F.when(F.col("platform") == "ashby", 0).when(F.col("platform") == "greenhouse", 1).otherwise(2)
    return boards.best_board(hits.withColumn("board_ord", order)).select(
        "firm_id", "platform", "token", "total", "in_place")


@query("best_site", """WITH s AS (SELECT p_brand, l_linestatus AS site, count(*) AS total,
  count(*) FILTER (WHERE l_discount > 0.05) AS in_place FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_brand AS firm_id, site, total, in_place FROM (SELECT *, row_number() OVER (PARTITION BY p_brand
  ORDER BY in_place DESC, total DESC, site) AS rn FROM s) WHERE rn = 1""")
def best_site(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sites = lines.groupBy(F.col("p_brand").alias("firm_id"), F.col("l_linestatus").alias("site")).agg(
        F.count("*").alias("total"), F.count_if(F.col("l_discount") > 0.05).alias("in_place"))
    sites = sites.select("*", F.col("firm_id").alias("firm_name"), F.lit("h").alias("host"),
                         F.lower("firm_id").alias("tenant"),
                         F.when(F.col("site") == "F", 0).otherwise(1).alias("site_ord"))
    return boards.best_site(sites).select("firm_id", "site", "total", "in_place")


@query("tenant_verification", """SELECT p_brand AS firm_id, l_linestatus AS tenant_kind, count(*) AS total,
  l_linestatus = 'O' AS verified FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def tenant_verification(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    hits = lines.groupBy(F.col("p_brand").alias("firm_id"), F.col("l_linestatus").alias("tenant_kind")).agg(
        F.count("*").alias("total")).withColumn("firm_name", F.concat("firm_id", F.lit(" Bank Ltd")))
    hits = hits.withColumn("tenant", F.when(F.col("tenant_kind") == "O", F.lower("firm_id")).otherwise("xyz-co"))
    return boards.verify_tenants(hits).select("firm_id", "tenant_kind", "total", "verified")


# --- robots ---------------------------------------------------------------------------------

_ROBOTS = "User-agent: *\nDisallow: /fr/ # not these\nAllow: /en/1\nDisallow: /en/\n"


@query("robots_admission", r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS h,
  regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1) AS path FROM pages),
v AS (SELECT page_id, CASE WHEN h LIKE 'www.%' THEN 'allowed' WHEN h LIKE 'm.%' THEN 'disallowed'
  WHEN h LIKE 'blog.%' THEN 'unknown' WHEN path LIKE '/fr/%' THEN 'disallowed'
  WHEN path LIKE '/en/1%' THEN 'allowed' WHEN path LIKE '/en/%' THEN 'disallowed' ELSE 'allowed' END AS verdict FROM p)
SELECT page_id, verdict, verdict <> 'disallowed' AS may_fetch FROM v""")
def robots_admission(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    files = pages.select(host.alias("host")).distinct().select(
        "host", F.when(F.col("host").startswith("www."), 404).when(F.col("host").startswith("m."), 403)
        .when(F.col("host").startswith("blog."), 500).otherwise(200).alias("status"),
        F.lit(_ROBOTS).alias("body"))
    return robots.admit(pages, files).select("page_id", "verdict", "may_fetch")


@query("robots_site_names", r"""WITH h AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages)
SELECT host, replace(host, '.', '_') || ',Open_Jobs,Internal' AS sites FROM h""")
def robots_site_names(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host")).distinct()
    name = F.replace("host", F.lit("."), F.lit("_"))
    body = F.concat(F.lit("Disallow: /Internal/\nDisallow: /refreshFacet/\nDisallow: /\nAllow: /Open_Jobs/x\n"
                          "Sitemap: https://t.wd3.myworkdayjobs.com/"), name, F.lit("/siteMap.xml\n"))
    return hosts.select("host", F.array_join(robots.site_candidates(body), ",").alias("sites"))
