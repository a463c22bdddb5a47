"""The generic tables seen as postings, outcomes, titles, names and subscriptions.

A binding is a list of SQL expressions that mean the same in Spark and in ANSI SQL engines, so
each query and its check derive their input from one definition.
"""

from pyspark.sql import functions as F

QUERIES, CHECKS = {}, {}


def query(name, sql=None):
    """Register a query and, where one exists, the equivalent SQL over the base tables."""
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn
    return keep


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df):
    """Share a scan that has fewer splits than cores among all of them.

    For inputs whose rows cost much more than their bytes; a large table has enough splits and
    is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Binding:
    def __init__(self, origin, /, **exprs):
        self.origin, self.exprs = origin, exprs

    def frame(self, spark, sf_dir):
        df = table(spark, sf_dir, self.origin) if isinstance(self.origin, str) \
            else self.origin.frame(spark, sf_dir)
        return df.selectExpr(*[f"{e} AS {n}" for n, e in self.exprs.items()])

    def sql(self):
        origin = self.origin if isinstance(self.origin, str) else f"({self.origin.sql()})"
        return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in self.exprs.items()) + f" FROM {origin}"


def choose(column, options, default="''"):
    """CASE expression from literal values of a column to literal results."""
    return (f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in options.items())
            + f" ELSE {default} END")


# --- events as dated postings ---------------------------------------------------------------

EV = Binding(
    "events", source="event_type", snapshot_date="CAST(ts AS DATE)",
    firm_id="CAST(user_id AS STRING)",
    job_key="event_type || ':' || CAST(user_id AS STRING) || ':' || "
            "CAST(CAST(floor(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) / 10) AS BIGINT) "
            "AS STRING)",
    value="value", event_id="event_id", props="props")
SWEEP = "signup"

OUTCOMES_SQL = f"""
  SELECT source, snapshot_date, firm_id, max(value) >= 150 AS ok, count(*) AS row_count
  FROM ev WHERE source <> '{SWEEP}' GROUP BY source, snapshot_date, firm_id
  UNION ALL
  SELECT source, snapshot_date, '_sweep', max(value) >= 250, count(*)
  FROM ev WHERE source = '{SWEEP}' GROUP BY source, snapshot_date"""
EV_SQL = f"WITH ev AS ({EV.sql()}), outcomes AS ({OUTCOMES_SQL})"


def ev_outcomes(ev):
    """A read counts as good when the firm-day's largest value says so; one source is a sweep."""
    agg = lambda df, floor, *keys: df.groupBy(*keys).agg(
        (F.max("value") >= floor).alias("ok"), F.count("*").alias("row_count"))
    firms = agg(ev.filter(F.col("source") != SWEEP), 150, "source", "snapshot_date", "firm_id")
    sweep = agg(ev.filter(F.col("source") == SWEEP), 250, "source", "snapshot_date").withColumn(
        "firm_id", F.lit("_sweep"))
    return firms.unionByName(sweep.select(*firms.columns))


# --- parts as titles ------------------------------------------------------------------------

ROLES = (
    "Data Analyst", "Software Engineer", "Legal Counsel", "Quant Trader", "Trading Operations Analyst",
    "Supply Chain Planner", "Research Fellow", "Audit Associate", "Business Analyst",
    "Machine Learning Engineer", "Process Engineer", "Treasury Officer", "Trading", "HR Executive",
    "Marketing Manager", "Investment Analyst", "Product Manager", "Consultant", "Laboratory Technician",
    "Strategy Associate", "Associate", "Open House", "Clerk", "Engineer / Senior Engineer", "Quant Researcher",
)
_PREFIX = {"ECONOMY": "Graduate ", "STANDARD": "Senior ", "PROMO": "Junior ", "SMALL": "",
           "MEDIUM": "Management Trainee, ", "LARGE": "Campus "}
_LEVELS = {"ECONOMY": "Fresh/entry level|Executive", "STANDARD": "Senior Management",
           "PROMO": "Junior Executive", "SMALL": "Professional", "MEDIUM": "Middle Management|Odd",
           "LARGE": ""}
# (upper end of p_size, body text, years asked in prose, invites graduates)
BODIES = (
    (5, "<p>We require at least 5 years of experience in valves.</p>", 5, False),
    (10, "our house looks back on over 25 years of shipping experience in every port", None, False),
    (15, "recent graduates should apply through our early-career site, which lists their openings", None, False),
    (20, "we welcome fresh&nbsp;graduates and final year students", None, True),
    (25, "you bring 0-3 years from audit, risk and compliance desks", None, True),
    (30, "2 years of experience, then 1-2 yrs experience; over 9 years of experience as a firm", 2, False),
    (99, "you will work with our <b>logistics</b> team", None, False),
)


def _by_size(position, quote=True):
    lit = lambda v: "NULL" if v is None else (f"'{v}'" if quote else str(v).upper())
    arms = " ".join(f"WHEN p_size <= {b[0]} THEN {lit(b[position])}" for b in BODIES[:-1])
    return f"CASE {arms} ELSE {lit(BODIES[-1][position])} END"


PART = Binding(
    "part", p_partkey="p_partkey",
    title=f"({choose('p_type', _PREFIX)}) || ("
          + choose("p_brand", {f"Brand#{i + 1}": r for i, r in enumerate(ROLES)}, "'Clerk'")
          + ") || ' - ' || p_name || CASE WHEN p_size > 45 THEN ' 2026 Intake' ELSE '' END",
    description_text=_by_size(1),
    prose_years=f"CAST({_by_size(2, False)} AS BIGINT)",
    invites=_by_size(3, False),
    min_years="CASE WHEN p_retailprice < 950 THEN 0 WHEN p_retailprice < 1000 THEN 1 "
              "WHEN p_retailprice < 1020 THEN 2 WHEN p_retailprice < 1030 THEN 3 ELSE NULL END",
    levels=choose("p_type", _LEVELS),
    types="CASE WHEN p_brand = 'Brand#9' THEN 'Internship/Attachment' ELSE 'Full Time' END",
    experience_level="CASE WHEN p_brand = 'Brand#21' THEN 'Entry Level' "
                     "WHEN p_brand = 'Brand#20' THEN 'Mid-Senior Level' ELSE '' END",
    department="CASE WHEN p_size > 40 THEN 'Treasury and Tax' ELSE '' END",
    sector="CASE WHEN p_type = 'SMALL' THEN 'consulting' ELSE 'bank' END")

# --- orders as curated rows -----------------------------------------------------------------

SEGMENT_GROUPS = {"AUTOMOBILE": "Operations", "BUILDING": "Supply Chain", "FURNITURE": "Data & Analytics",
                  "HOUSEHOLD": "Legal", "MACHINERY": "Quant & Trading"}
PRIORITY_ROLES = {"1-URGENT": "Graduate programme", "2-HIGH": "Graduate role", "3-MEDIUM": "Entry level",
                  "4-NOT SPECIFIED": "Internship", "5-LOW": "Not graduate"}
STATUS = {"O": "open", "F": "closed", "P": "unknown"}
TODAY = "DATE '2001-08-01'"


class OrdersWithCustomers:
    SQL = "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey"

    @staticmethod
    def frame(spark, sf_dir):
        return table(spark, sf_dir, "orders").join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))

    @classmethod
    def sql(cls):
        return cls.SQL


ROWS = Binding(
    OrdersWithCustomers, job_key="'ord:' || CAST(o_orderkey AS STRING)",
    firm_id="'c' || CAST(o_custkey AS STRING)", firm_name="c_name",
    sector="'nation-' || CAST(c_nationkey AS STRING)",
    title="o_orderpriority || ' ' || c_mktsegment || ' role'",
    apply_url="'https://jobs.example.com/' || CAST(o_orderkey AS STRING)",
    job_family="lower(c_mktsegment)", family_group=choose("c_mktsegment", SEGMENT_GROUPS),
    role_type=choose("o_orderpriority", PRIORITY_ROLES),
    is_grad="o_orderpriority <> '5-LOW'", is_internship="o_orderpriority = '4-NOT SPECIFIED'",
    is_singapore="c_acctbal >= 0", status=choose("o_orderstatus", STATUS),
    source_platform="CASE WHEN c_acctbal > 5000 THEN 'lever' ELSE 'ashby' END",
    posted_date_basis="CASE WHEN o_totalprice < 30000 THEN 'observed' ELSE 'published' END",
    posted_date="CASE WHEN o_totalprice < 30000 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    first_seen="CASE WHEN o_totalprice > 400000 THEN NULL ELSE CAST(o_orderdate AS DATE) END")
BASE = "is_grad AND NOT is_internship AND is_singapore AND status = 'open'"
ROWS_SQL = f"WITH cur AS ({ROWS.sql()})"

SUB_GROUPS = {0: "Operations|Legal", 1: "Data & Analytics", 2: "Legal|Quant & Trading",
              3: "", 4: "Supply Chain|Operations|Legal"}
SUB_ROLES = {0: "Graduate programme|Entry level", 1: "Graduate programme|Graduate role|Entry level",
             2: "Entry level", 3: "Graduate role", 4: "Graduate role|Internship"}


def _by_region(options):
    return ("CASE " + " ".join(f"WHEN n_regionkey = {k} THEN '{v}'" for k, v in options.items())
            + " ELSE '' END")


SUBS = Binding("nation", chat_id="n_name", roles=_by_region(SUB_ROLES), grps=_by_region(SUB_GROUPS),
               active="n_nationkey <> 7")
WISHES_SQL = f"""subs AS ({SUBS.sql()}), wishes AS (
  SELECT chat_id, role_type, unnest(string_split(grps, '|')) AS family_group FROM (
    SELECT chat_id, unnest(string_split(roles, '|')) AS role_type, grps FROM subs
    WHERE active AND roles <> '' AND grps <> ''))"""


def subscriptions(spark, sf_dir):
    from boardtide.functions.text import split_pipe

    return SUBS.frame(spark, sf_dir).select(
        "chat_id", split_pipe("roles").alias("role_types"), split_pipe("grps").alias("groups"),
        F.lit(None).cast("date").alias("last_notified"), "active",
        F.array().cast("array<string>").alias("notified_keys"))
