"""Admission of URLs against landed robots files, and site names read out of them."""

from pyspark.sql import functions as F, Window as W

from boardtide import fixed
from boardtide.functions import urls
from boardtide.functions.text import FLAGS

_UNQUOTE = lambda c: F.coalesce(
    F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def robots_rules(bodies, agent="*"):
    """host -> ordered array of (allow, path) that apply to `agent`.

    `bodies` has host and body.  Lines are numbered; a user-agent line that does not follow
    another one opens a group, an empty line closes it.  Named groups win over the `*` group;
    the first of either kind that has rules counts.  A host's lines are bounded by its file.
    """
    lines = bodies.select("host", F.posexplode(F.split("body", r"\r\n|\r|\n")).alias("n", "raw"))
    bare = F.regexp_replace(F.regexp_replace("raw", "#.*$", ""), r"(?U)^\s+|\s+$", "")
    word = F.lower(F.regexp_replace(F.substring_index(F.col("bare"), ":", 1), r"\s+$", ""))
    value = F.regexp_replace(F.regexp_extract("bare", "^[^:]*:(.*)$", 1), r"(?U)^\s+|\s+$", "")
    kind = (F.when(F.col("raw") == "", "blank").when(~F.col("bare").contains(":"), None)
            .when(F.col("word") == "user-agent", "agent")
            .when(F.col("word").isin("allow", "disallow", "crawl-delay", "request-rate"), "rule"))
    lines = (lines.withColumn("bare", bare).withColumn("word", word)
             .select("host", "n", "word", _UNQUOTE(value).alias("value"), kind.alias("kind"))
             .filter(F.col("kind").isNotNull()))
    in_order = W.partitionBy("host").orderBy("n")
    opens = (F.col("kind") == "blank") | (
        (F.col("kind") == "agent") & F.coalesce(F.lag("kind").over(in_order) != "agent", F.lit(True)))
    lines = lines.withColumn("opens", opens.cast("int")).withColumn(
        "part", F.sum("opens").over(in_order))
    parts = lines.groupBy("host", "part").agg(
        F.collect_list(F.when(F.col("kind") == "agent", F.lower("value"))).alias("agents"),
        F.count_if(F.col("kind") == "rule").alias("n_rules"),
        F.array_sort(F.collect_list(F.when(
            F.col("word").isin("allow", "disallow"),
            F.struct("n", ((F.col("word") == "allow") | (F.col("value") == "")).alias("allow"),
                     F.col("value").alias("path"))))).alias("rules"))
    wanted = F.lower(F.substring_index(F.lit(agent), "/", 1))
    general = F.array_contains("agents", "*")
    # an empty agent value is part of every name; the file's author asked for that
    named = ~general & F.exists("agents", lambda a: F.contains(wanted, a))
    usable = parts.filter((F.size("agents") > 0) & (F.col("n_rules") > 0) & (general | named))
    return (usable.groupBy("host")
            .agg(F.min_by("rules", F.struct(general.cast("int"), "part")).alias("rules")))


def admit(pages, robots, agent="*", unknown_is_allowed=True):
    """Add `verdict` (allowed / disallowed / unknown) and `may_fetch` to rows with a `url`.

    `robots` has host, status and body as landed: 200 is read, 401 and 403 deny everything, 404
    allows everything, anything else is unknown.  Of several files of a host the newest by
    `fetched_on` counts, or the largest (status, body) where there is no such column.  Each host's rules travel as one array, so a
    host with very many URLs is a plain skewed equi-join and no (url, rule) pairs are produced.
    """
    newest = F.col("fetched_on") if "fetched_on" in robots.columns else F.struct("status", "body")
    files = robots.groupBy("host").agg(F.max_by(F.struct("status", "body"), newest).alias("file")).select(
        "host", "file.*")
    rules = robots_rules(files.filter(F.col("status") == 200), agent)
    known = files.select("host", "status").join(rules, "host", "left")
    path = _UNQUOTE(urls.path_of("url"))
    joined = pages.withColumn("_host", urls.host_of("url")).withColumn("_path", path).join(
        known.withColumnRenamed("host", "_host"), "_host", "left")
    hit = F.try_element_at(F.filter("rules", lambda r: (r["path"] == "*") | (r["path"] == "")
                                    | F.startswith(F.col("_path"), r["path"])), F.lit(1))
    allowed = F.coalesce(hit["allow"], F.lit(True))
    verdict = (F.when(F.col("_host").isNull() | F.col("status").isNull(), "unknown")
               .when(F.col("status").isin(401, 403), "disallowed")
               .when(F.col("status") == 404, "allowed")
               .when(F.col("status") != 200, "unknown")
               .when(allowed, "allowed").otherwise("disallowed"))
    return (joined.withColumn("verdict", verdict)
            .withColumn("may_fetch", F.when(F.col("verdict") == "unknown",
                                            F.lit(unknown_is_allowed))
                        .otherwise(F.col("verdict") == "allowed"))
            .select(*pages.columns, "verdict", "may_fetch"))


def _lines_of(body, word):
    return F.regexp_extract_all(body, F.lit(rf"(?iUm)^\s*{word}:\s*(\S+)\s*$"), F.lit(1))


def disallowed_paths(body):
    """Paths named in Disallow lines, in order, without the blanket ones."""
    return F.filter(_lines_of(body, "Disallow"),
                    lambda p: ~p.isin("/", "*") & ~p.startswith("/*"))


def site_candidates(body):
    """Career-site names a robots file gives away: sitemaps first, then Allow, then Disallow."""
    from_maps = F.transform(_lines_of(body, "Sitemap"),
                            lambda u: F.regexp_extract(u, FLAGS + fixed.SITE_IN_SITEMAP, 1))
    named = F.concat(from_maps, _lines_of(body, "Allow"), disallowed_paths(body))
    first = F.transform(named, lambda p: F.substring_index(
        F.regexp_replace(p, "^/+|/+$", ""), "/", 1))
    return F.array_distinct(F.filter(
        first, lambda s: (s != "") & ~F.lower(s).isin(*fixed.NON_SITE_SEGMENTS)))
