"""The normalisers over payloads that Spark builds from the order and customer tables.

Each order becomes one landed response of its customer's board.  The SQL checks state the
expected postings from the base columns, never from the payload.
"""

from pyspark.sql import functions as F

from boardtide import schema
from boardtide.operators import lifecycle
from boardtide.plans.bindings import query, spread, table
from boardtide.session import table_stage
from boardtide.sources.payloads import normalise

KEY = "CAST(o_orderkey AS STRING)"
_READ = "o_totalprice >= 5000"
_WHOLE = "o_totalprice < 490000"


def _orders(spark, sf_dir):
    return spread(table(spark, sf_dir, "orders")).withColumns({
        "key": F.col("o_orderkey").cast("string"),
        "day": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "town": F.when(F.col("o_orderstatus") == "F", "London").otherwise("Singapore"),
        "link": F.concat(F.lit("https://jobs.example.com/"), F.col("o_orderkey").cast("string")),
    })


def _land(df, payload, **fields):
    """Rows in the landed layout; every order's firm is its customer."""
    base = {
        "firm_id": F.concat(F.lit("c"), F.col("o_custkey").cast("string")), "ats_token": F.lit("tok"),
        "ats_host": F.lit("h.example.com"), "board_site": F.lit("site"),
        "fetched_on": F.lit("2026-08-08").cast("date"), "kind": F.lit("list"),
        "page": F.col("o_orderkey"), "url": F.lit(None).cast("string"), "ok": F.lit(True),
        "error": F.lit(None).cast("string"), "payload": payload,
    }
    base.update(fields)
    return df.select(*[base[n].alias(n) for n in schema.names(schema.LANDED)])


def _json(column):
    return F.to_json(column)


def _board(*jobs):
    return _json(F.struct(F.array(*jobs).alias("jobs")))


def _name(c):
    return F.struct(c.alias("name"))


def _greenhouse_landed(spark, sf_dir):
    o = _orders(spark, sf_dir)
    stamp = F.concat("day", F.lit("T23:15:00-04:00"))
    job = lambda key, title: F.struct(
        key.alias("id"), title.alias("title"), F.col("link").alias("absolute_url"),
        _name(F.col("town")).alias("location"),
        F.array(_name(F.lit("Hub")), _name(F.col("town"))).alias("offices"),
        F.array(_name(F.lit("Desk")), _name(F.lit(""))).alias("departments"),
        F.when(F.col("o_orderpriority") < "3", stamp).alias("first_published"),
        F.when(F.col("o_orderpriority") < "5", stamp).alias("updated_at"),
        F.concat(F.lit("&lt;p&gt;R&amp;amp;D &eacute;"), F.col("key"), F.lit("&lt;/p&gt;")).alias("content"))
    # the second job has no title and must be counted, not stored
    both = _board(job(F.col("o_orderkey"), F.concat(F.lit(" Role "), "o_orderpriority")),
                  job(-F.col("o_orderkey") - 1, F.lit(None).cast("string")))
    ok = F.expr(_READ)
    # the largest answers break off
    both = F.when(F.expr(_WHOLE), both).otherwise(F.left(both, F.lit(60)))
    return _land(o, F.when(ok, both), ok=ok, error=F.when(~ok, F.repeat(F.lit("Timeout "), 40)))


@query("normalise_greenhouse", f"""SELECT 'greenhouse:c' || o_custkey || ':' || o_orderkey AS job_key,
  'Role ' || o_orderpriority AS title, 'https://jobs.example.com/' || o_orderkey AS apply_url,
  'Singapore; Hub' AS location_raw, '<p>R&amp;D é' || o_orderkey || '</p>' AS description_text,
  CASE WHEN o_orderpriority < '5' THEN CAST(o_orderdate AS DATE) END AS posted_date,
  CASE WHEN o_orderpriority < '3' THEN 'published' WHEN o_orderpriority < '5' THEN 'updated' END
    AS posted_date_basis, 'Desk' AS department FROM orders WHERE o_orderstatus <> 'F'
    AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE NOT ({_READ} AND {_WHOLE}))""")
def normalise_greenhouse(spark, sf_dir):
    return normalise("greenhouse", _greenhouse_landed(spark, sf_dir))[0].select(
        "job_key", "title", "apply_url", "location_raw", "description_text", "posted_date",
        "posted_date_basis", "department")


@query("read_outcomes", f"""SELECT 'c' || o_custkey AS firm_id, 'greenhouse' AS platform, bool_and({_READ} AND {_WHOLE}) AS ok,
  CASE WHEN bool_and({_READ} AND {_WHOLE}) THEN count(*) FILTER (WHERE o_orderstatus <> 'F') ELSE 0 END AS row_count,
  CASE WHEN bool_and({_READ} AND {_WHOLE}) THEN count(*) || ' rows failed validation'
    WHEN bool_and({_WHOLE}) THEN repeat('Timeout ', 40) ELSE 'payload is not readable' END AS error FROM orders GROUP BY o_custkey""")
def read_outcomes(spark, sf_dir):
    return normalise("greenhouse", _greenhouse_landed(spark, sf_dir))[1]


@query("normalise_lever", """SELECT 'lever:c' || o_custkey || ':' || o_orderkey AS job_key, o_orderpriority AS title,
  'Singapore' AS location_raw, 'plain' || chr(10) || '0-2 years' || chr(10) || 'end' AS description_text,
  CAST(o_orderdate AS DATE) AS posted_date, 'published' AS posted_date_basis, 'Desk; Team' AS department,
  o_orderstatus AS employment_type FROM orders WHERE o_orderstatus <> 'F'""")
def normalise_lever(spark, sf_dir):
    o = _orders(spark, sf_dir)
    millis = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86_400_000
    job = F.struct(
        F.col("key").alias("id"), F.col("o_orderpriority").alias("text"), F.lit("").alias("hostedUrl"),
        F.col("link").alias("applyUrl"), millis.alias("createdAt"),
        F.struct(F.col("o_orderstatus").alias("commitment"), F.lit("Desk").alias("department"),
                 F.col("town").alias("location"), F.lit("Team").alias("team")).alias("categories"),
        F.lit("<p>x</p>").alias("description"), F.lit("plain").alias("descriptionPlain"),
        F.array(F.struct(F.lit("Needs").alias("text"), F.lit("0-2 years").alias("content"))).alias("lists"),
        F.lit("end ").alias("additionalPlain"))
    return normalise("lever", _land(o, _json(F.array(job))))[0].select(
        "job_key", "title", "location_raw", "description_text", "posted_date", "posted_date_basis",
        "department", "employment_type")


@query("normalise_ashby", """SELECT 'ashby:c' || o_custkey || ':' || o_orderkey AS job_key,
  CASE o_orderstatus WHEN 'F' THEN 'London; Singapore' ELSE 'Singapore' END AS location_raw,
  'html' AS description_text, CAST(o_orderdate AS DATE) AS posted_date, 'Desk; Desk' AS department
FROM orders WHERE o_orderpriority <> '5-LOW'""")
def normalise_ashby(spark, sf_dir):
    o = _orders(spark, sf_dir)
    job = F.struct(
        F.col("key").alias("id"), F.col("o_orderpriority").alias("title"), F.col("town").alias("location"),
        F.array(F.struct(F.lit("Singapore").alias("location")), F.struct(F.col("town").alias("location")))
        .alias("secondaryLocations"), F.lit("Desk").alias("department"), F.lit("Desk").alias("team"),
        F.col("link").alias("jobUrl"), F.concat("day", F.lit("T00:00:00.000+00:00")).alias("publishedAt"),
        F.lit("html").alias("descriptionHtml"), (F.col("o_orderpriority") != "5-LOW").alias("isListed"))
    return normalise("ashby", _land(o, _board(job)))[0].select(
        "job_key", "location_raw", "description_text", "posted_date", "department")


@query("normalise_workable", """SELECT 'workable:c' || o_custkey || ':' || o_orderkey AS job_key,
  'Singapore; SG' AS location_raw, 'd' || chr(10) || 'r' AS description_text, CAST(o_orderdate AS DATE) AS posted_date,
  'Entry level' AS experience FROM orders WHERE o_orderstatus <> 'F'""")
def normalise_workable(spark, sf_dir):
    o = _orders(spark, sf_dir)
    early = F.col("o_orderpriority") < "3"
    job = F.struct(
        F.col("o_orderpriority").alias("title"), F.col("key").alias("shortcode"), F.col("link").alias("shortlink"),
        F.when(F.col("town") == "London", "GB").otherwise("SG").alias("country"), F.col("town").alias("city"),
        F.lit("").alias("state"), F.when(early, F.col("day")).alias("published_on"),
        F.when(early, "1990-01-01").otherwise(F.col("day")).alias("created_at"), F.lit("d").alias("description"),
        F.lit("r").alias("requirements"), F.lit("fruit").alias("benefits"),
        F.lit("Entry level").alias("experience"))
    return normalise("workable", _land(o, _board(job)))[0].select(
        "job_key", "location_raw", "description_text", "posted_date",
        F.get_json_object("extra_json", "$.experience").alias("experience"))


@query("normalise_smartrecruiters", f"""WITH bad AS (SELECT DISTINCT o_custkey FROM orders WHERE NOT ({_READ}))
SELECT 'smartrecruiters:c' || o_custkey || ':' || o_orderkey AS job_key, 'Town; ' || CASE o_orderstatus
    WHEN 'O' THEN 'sg' ELSE 'Singapore' END AS location_raw,
  CASE WHEN o_orderpriority < '4' THEN 'jd' || chr(10) || 'q' || chr(10) || 'co' ELSE '' END AS description_text,
  'https://jobs.smartrecruiters.com/tok/' || o_orderkey AS apply_url FROM orders
WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM bad)""")
def normalise_smartrecruiters(spark, sf_dir):
    """Lists joined to details; a firm with an unreadable list page yields nothing."""
    o = _orders(spark, sf_dir)
    country = F.when(F.col("o_orderstatus") == "O", "sg").when(F.col("o_orderstatus") == "F", "us") \
        .otherwise("Singapore")
    item = F.struct(F.col("key").alias("id"), F.col("o_orderpriority").alias("name"),
                    F.struct(F.lit("Town").alias("city"), country.alias("country")).alias("location"))
    part = lambda t: F.struct(F.lit(t).alias("text"))
    ad = F.struct(F.struct(F.struct(
        part("co").alias("companyDescription"), part("jd").alias("jobDescription"),
        part("q").alias("qualifications")).alias("sections")).alias("jobAd"))
    lists = _land(o, _json(F.struct(F.array(item).alias("content"))), ok=F.expr(_READ), error=F.lit("500"))
    details = _land(o.filter("o_orderpriority < '5'"), _json(ad), kind=F.lit("detail"), url=F.col("key"),
                    ok=F.col("o_orderpriority") < "4")
    return normalise("smartrecruiters", lists.unionByName(details))[0].select(
        "job_key", "location_raw", "description_text", "apply_url")


def _workday_landed(spark, sf_dir):
    o = _orders(spark, sf_dir)
    path = F.concat(F.lit("/job/X/R-"), F.col("key"))
    where = F.when(F.col("o_orderpriority") == "5-LOW", "2 Locations").otherwise(F.col("town"))
    site = F.when(F.col("o_totalprice") > 250000, "Main").otherwise("Campus")
    title = F.when(F.col("o_orderpriority") == "1-URGENT", "Graduate role").otherwise("Cook")
    item = F.struct(title.alias("title"), path.alias("externalPath"), where.alias("locationsText"),
                    F.lit("Posted 3 Days Ago").alias("postedOn"))
    info = F.struct(F.struct(
        F.lit("body").alias("jobDescription"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("REQ-"), F.col("key"))).alias("jobReqId"),
        F.col("town").alias("location"), F.array(F.lit("Paris")).alias("additionalLocations"))
        .alias("jobPostingInfo"))
    lists = _land(o, _json(F.struct(F.array(item).alias("jobPostings"))), board_site=site)
    return lists.unionByName(_land(o, _json(info), kind=F.lit("detail"), url=path, board_site=site))


_WORKDAY_SQL = """WITH l AS (SELECT *, o_orderpriority = '5-LOW' AS multi, o_orderpriority = '1-URGENT' AS nice,
  CASE WHEN o_totalprice > 250000 THEN 'Main' ELSE 'Campus' END AS site FROM orders),
w AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, site ORDER BY o_orderkey) > 0 AS used
  FROM l WHERE multi OR o_orderstatus <> 'F'),
k AS (SELECT * FROM w WHERE NOT multi OR (used AND o_orderstatus <> 'F'))
"""


@query("normalise_workday", _WORKDAY_SQL + """SELECT 'workday:c' || o_custkey || CASE WHEN used AND o_orderstatus = 'O'
    THEN ':req-' ELSE ':r-' END || o_orderkey AS job_key, CASE WHEN used THEN 'Singapore; Paris' ELSE 'Singapore' END
    AS location_raw, CASE WHEN used THEN 'body' ELSE '' END AS description_text, DATE '2026-08-05' AS posted_date,
  'https://h.example.com/en-US/' || site || '/job/X/R-' || o_orderkey AS apply_url FROM k""")
def normalise_workday(spark, sf_dir):
    return normalise("workday", _workday_landed(spark, sf_dir))[0].select(
        "job_key", "location_raw", "description_text", "posted_date", "apply_url")


@query("workday_outcomes", _WORKDAY_SQL + """, n AS (SELECT o_custkey, site, min(o_orderkey) AS first,
    0 AS over FROM l GROUP BY 1, 2),
x AS (SELECT o_custkey, site, count(*) FILTER (WHERE NOT used) AS over FROM w GROUP BY 1, 2),
s AS (SELECT n.o_custkey, n.site, n.first, coalesce(x.over, 0) AS over FROM n LEFT JOIN x
  ON n.o_custkey = x.o_custkey AND n.site = x.site),
f AS (SELECT o_custkey, count(*) AS sites, coalesce(string_agg(site || ': ' || over
    || ' postings over the detail budget, title-only', '; ' ORDER BY first) FILTER (WHERE over > 0), '') AS named,
  coalesce(max(over || ' postings over the detail budget, title-only') FILTER (WHERE over > 0), '') AS plain
  FROM s GROUP BY 1)
SELECT 'c' || f.o_custkey AS firm_id, 'workday' AS platform, true AS ok, (SELECT count(*) FROM k
  WHERE k.o_custkey = f.o_custkey) AS row_count, CASE WHEN sites > 1 THEN named ELSE plain END AS error,
  true AS complete FROM f""")
def workday_outcomes(spark, sf_dir):
    return normalise("workday", _workday_landed(spark, sf_dir))[1]


@query("normalise_successfactors", """SELECT 'successfactors:c' || o_custkey || ':' || o_orderkey AS job_key,
  'R&D <' || o_orderpriority || '>' AS title, 'https://h.example.com/X/job/Singapore-R/' || o_orderkey || '/' AS apply_url,
  CASE o_orderstatus WHEN 'O' THEN 'SG, 238891' ELSE 'Singapore' END AS location_raw,
  CASE o_orderstatus WHEN 'O' THEN 'Risk' ELSE '' END AS department, 'observed' AS posted_date_basis FROM orders
WHERE o_orderstatus <> 'F'""")
def normalise_successfactors(spark, sf_dir):
    o = _orders(spark, sf_dir)
    field = lambda n, v: (f'<div class="section-field {n} c"><span>{n}</span><div>{n} {v} </div></div>')
    fields = F.when(F.col("o_orderstatus") == "O", field("location", "SG, 238891") + field("department", "Risk")
                    + "</div>").when(F.col("o_orderstatus") == "F", field("location", "Glasgow") + "</div>").otherwise("")
    page = F.concat(
        F.lit('<ul><li class="job-tile job-id-'), F.col("key"), F.lit(' x" data-url="/X/job/Singapore-R/'),
        F.col("key"), F.lit('/"><a class="jobTitle-link" href="#">\n R&amp;D <b>&lt;'), F.col("o_orderpriority"),
        F.lit("&gt;</b></a>"), fields, F.lit("</li></ul>"))
    return normalise("successfactors", _land(o, page, kind=F.lit("all")))[0].select(
        "job_key", "title", "apply_url", "location_raw", "department", "posted_date_basis")


@query("normalise_phenom", """SELECT 'phenom:c' || o_custkey || ':' || o_orderkey AS job_key,
  o_orderpriority AS title, CASE o_orderstatus WHEN 'O' THEN 'Town, Region' ELSE 'Singapore' END AS location_raw,
  ' Hi ' AS description_text, CAST(o_orderdate AS DATE) AS posted_date,
  CASE o_orderstatus WHEN 'O' THEN 'FULL; PART' ELSE 'FULL' END AS employment_type FROM orders
WHERE o_orderstatus <> 'F'""")
def normalise_phenom(spark, sf_dir):
    """Sitemap lines, narrowed by slug, joined to the job pages."""
    return normalise("phenom", _phenom_landed(_orders(spark, sf_dir)))[0].select(
        "job_key", "title", "location_raw", "description_text", "posted_date", "employment_type")


def _phenom_landed(o, listed="true", read="true"):
    """A sitemap per order, which lists its page where `listed` holds, and the page, read where `read` does."""
    url = F.concat(F.lit("https://h.example.com/g/en/job/"), F.col("key"), F.lit("/Role-"), F.col("town"))
    about = F.lit("<url><loc>https://h.example.com/about</loc></url>")
    loc = F.when(F.expr(listed), F.concat(F.lit("<url><loc> "), url, F.lit(" </loc></url>"), about)).otherwise(about)
    spots = F.struct(F.struct(F.lit("Town").alias("addressLocality"), F.lit("Region").alias("addressRegion"),
                              F.lit("Town").alias("addressCountry")).alias("address"))
    posting = lambda kind, where: F.to_json(F.struct(*[c for c in (
        F.lit("JobPosting").alias("@type"), F.col("o_orderpriority").alias("title"),
        F.concat("day", F.lit("T05:00:00Z")).alias("datePosted"), kind.alias("employmentType"), where,
        F.lit("<p>Hi</p>").alias("description")) if c is not None]))
    body = F.when(F.col("o_orderstatus") == "O", F.concat(
        F.lit('[{"@type": "Thing"}, '), posting(F.array(F.lit("FULL"), F.lit("PART")), spots.alias("jobLocation")),
        F.lit("]"))).otherwise(posting(F.lit("FULL"), None))
    page = F.concat(F.lit('<script type="application/ld+json">{oops</script>'
                          '<script data-x="1" type="application/ld+json">'), body, F.lit("</script>"))
    return _land(o, loc, kind=F.lit("sitemap")).unionByName(_land(
        o, page, kind=F.lit("page"), url=url, ok=F.expr(read), error=F.lit("Timeout")))


_LISTED, _FETCHED = "o_orderpriority <> '5-LOW'", "o_totalprice >= 20000"


@query("lifecycle_after_bad_read", f"""WITH n AS (SELECT *, {_LISTED} AND {_FETCHED} AS seen FROM orders WHERE o_orderstatus <> 'F'),
f AS (SELECT o_custkey, bool_or({_LISTED} AND NOT {_FETCHED}) AS unread, count(*) FILTER (WHERE seen) AS n FROM n GROUP BY 1)
SELECT 'phenom:c' || n.o_custkey || ':' || o_orderkey AS job_key, CASE WHEN seen THEN 'open'
  WHEN unread OR f.n = 0 THEN 'unknown' ELSE 'closed' END AS status FROM n JOIN f ON n.o_custkey = f.o_custkey""")
def lifecycle_after_bad_read(spark, sf_dir):
    """Two days of one board; on the second some jobs are gone and some job pages could not be read.
    Where a page was not read, nothing of the firm may be taken for closed."""
    o, days = _orders(spark, sf_dir), []
    for day, landed in (("2024-01-01", _phenom_landed(o)), ("2024-01-02", _phenom_landed(o, _LISTED, _FETCHED))):
        days.append([df.withColumn("source", F.lit("phenom")).withColumn("snapshot_date", F.lit(day).cast("date"))
                     for df in normalise("phenom", landed)])
    postings, outcomes = (a.unionByName(b) for a, b in zip(*days))
    # stored, as a run finds them: the lifecycle reads both several times
    stage = table_stage(spark)
    postings = stage(postings.select("source", "snapshot_date", "firm_id", "job_key"), "postings")
    outcomes = stage(outcomes, "outcomes")
    return lifecycle.compute_lifecycle(postings, outcomes).select("job_key", "status")


def _portal_landed(spark, sf_dir):
    o = _orders(spark, sf_dir)
    hiring = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("ACME "), "o_orderpriority"))
    company = lambda n, u: F.struct(n.alias("name"), u.alias("uen"))
    job = F.struct(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderpriority")).alias("uuid"),
        F.lit("Analyst").alias("title"), F.when(F.col("o_orderstatus") != "P", F.lit(1)).alias("minimumYearsExperience"),
        F.array(F.struct(F.lit("Executive").alias("position")), F.struct(F.lit("Manager").alias("position")))
        .alias("positionLevels"),
        company(F.when(F.col("o_orderstatus") == "F", "").otherwise("Agency Co"), F.lit("77")).alias("postedCompany"),
        company(hiring, F.lit("88")).alias("hiringCompany"),
        F.struct(F.col("o_totalprice").alias("minimum")).alias("salary"),
        F.struct(F.concat(F.lit("P"), F.col("key")).alias("jobPostId"), F.col("link").alias("jobDetailsUrl"),
                 F.when(F.col("o_totalprice") > 20000, F.col("day")).alias("originalPostingDate"),
                 F.lit("2030-01-01").alias("newPostingDate")).alias("metadata"))
    return _land(o, _json(F.struct(F.array(job).alias("results"))), url=F.lit("term"), ok=F.expr(_READ),
                 error=F.lit("Timeout"))


_PORTAL_SQL = """WITH v AS (SELECT *, 'u' || o_custkey || '-' || o_orderpriority AS uuid, row_number() OVER (
  PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders WHERE o_totalprice > 20000)
"""


@query("normalise_portal", _PORTAL_SQL + """SELECT uuid AS external_id, CASE o_orderstatus
    WHEN 'O' THEN 'acme-' || trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]', '-', 'g'), '-')
    WHEN 'F' THEN 'uen-77' ELSE 'agency-co' END AS firm_id, CAST(o_orderdate AS DATE) AS posted_date,
  'Executive|Manager' AS position_levels, CASE WHEN o_orderstatus <> 'P' THEN '1' END AS min_years,
  o_totalprice AS salary_min, 'P' || o_orderkey AS post_id FROM v WHERE rn = 1""")
def normalise_portal(spark, sf_dir):
    """One sweep over many pages: the first page that lists a posting supplies it."""
    extra = F.from_json("extra_json", schema.EXTRA)
    return normalise("mcf", _portal_landed(spark, sf_dir))[0].withColumn("x", extra).select(
        "external_id", "firm_id", "posted_date", F.col("x.position_levels").alias("position_levels"),
        F.col("x.min_years").alias("min_years"), F.col("x.salary_min").try_cast("double").alias("salary_min"),
        F.col("x.mcf_job_post_id").alias("post_id"))


@query("portal_outcome", _PORTAL_SQL + f""", e AS (SELECT o_orderkey, 'term p' || o_orderkey || ': ' || CASE WHEN
    o_totalprice >= 5000 THEN 'validation' ELSE 'Timeout' END AS e FROM orders WHERE o_totalprice <= 20000
  ORDER BY o_orderkey LIMIT 5)
SELECT '_mcf_sweep' AS firm_id, 'mcf' AS platform, (SELECT count(*) FROM v WHERE rn = 1) > 0 AS ok,
  (SELECT count(*) FROM v WHERE rn = 1) AS row_count, (SELECT coalesce(string_agg(e, '; ' ORDER BY o_orderkey), '') FROM e)
  AS error, (SELECT bool_and({_READ}) FROM orders) AS complete""")
def portal_outcome(spark, sf_dir):
    return normalise("mcf", _portal_landed(spark, sf_dir))[1]


@query("quarantine_split", """SELECT o_orderkey, o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AS stored FROM orders""")
def quarantine_split(spark, sf_dir):
    """The storage invariants split rows into stored and quarantined; none is lost."""
    from boardtide.sources.payloads.common import split_valid

    o = _orders(spark, sf_dir).select(
        "o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("firm_id"),
        F.lit("lever").alias("source_platform"), F.col("key").alias("external_id"),
        F.when(F.col("o_orderstatus") == "P", "  ").otherwise("T ").alias("title"),
        F.when(F.col("o_orderpriority") == "5-LOW", "/rel").otherwise(F.col("link")).alias("apply_url"),
        F.lit(None).cast("string").alias("posted_date_basis"))
    good, bad = split_valid(o)
    flag = lambda df, v: df.select("o_orderkey", F.lit(v).alias("stored"))
    return flag(good, True).unionByName(flag(bad, False))
