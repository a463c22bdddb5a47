"""Choosing rows for readers: digest selections, dashboard filters, search, sent state."""

from pyspark.sql import functions as F

from boardtide import fixed
from boardtide.session import broadcast_if_small

DIGEST_ORDER = [F.asc_nulls_last, F.desc_nulls_last]


def notifiable(curated, statuses=("open",)):
    return curated.filter(F.col("is_grad") & ~F.col("is_internship") & F.col("is_singapore")
                          & F.col("status").isin(*statuses))


def newer_than(df, since, column="first_seen"):
    """Rows first seen after `since`; a null date never counts as newer."""
    return df if since is None else df.filter(F.col(column) > F.lit(since))


def select_new(curated, since=None, role_types=(), groups=()):
    """The single-reader digest: chosen (or priority) groups, optional role types, unordered."""
    out = notifiable(curated).filter(
        F.col("family_group").isin(*(groups or fixed.PRIORITY_GROUPS)))
    if role_types:
        out = out.filter(F.col("role_type").isin(*role_types))
    return newer_than(out, since)


def digest_order(df, *first):
    """Family group ascending, newest posted first, nulls last, key as the tie-break."""
    return df.orderBy(*first, *digest_keys())


def digest_keys():
    return [F.asc_nulls_last("family_group"), F.desc_nulls_last("posted_date"), F.asc("job_key")]


def _wishes(subs):
    """One row per subscriber and wanted (role type, group)."""
    return (subs.select("chat_id", F.explode(F.array_distinct("role_types")).alias("role_type"),
                        "groups")
            .select("chat_id", "role_type",
                    F.explode(F.array_distinct("groups")).alias("family_group")))


def match_subscribers(postings, subs):
    """Postings each subscriber asked for: an equi-join on (role type, group).

    There are few (role type, group) values, so every one of them is hot.  With a checked-small
    subscriber side the postings never move; otherwise AQE splits the hot partitions.
    """
    return postings.join(broadcast_if_small(_wishes(subs)), ["role_type", "family_group"])


def matching_counts(postings, subs):
    """Open rows per subscriber without pairing rows: postings are counted per (type, group)."""
    volume = (notifiable(postings).groupBy("role_type", "family_group")
              .agg(F.count("*").alias("n")))
    wanted = _wishes(subs).join(volume, ["role_type", "family_group"], "left")
    return wanted.groupBy("chat_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("matching"))


def firms_with_roles(postings, subs):
    """Open roles per subscriber and firm, counted before the join for the same reason."""
    volume = (notifiable(postings).groupBy("role_type", "family_group", "firm_name")
              .agg(F.count("*").alias("n")))
    return (volume.join(_wishes(subs), ["role_type", "family_group"])
            .groupBy("chat_id", "firm_name").agg(F.sum("n").alias("roles")))


def unsent(matches, sent):
    """Rows whose (chat_id, job_key) has not been delivered yet."""
    return matches.join(sent, ["chat_id", "job_key"], "left_anti")


def record_sent(sent, delivered, live):
    """(sent or delivered) kept when still live or just delivered.

    Only `sent` needs the live check, so the union is taken after pruning it.
    """
    pruned = sent.select("chat_id", "job_key").join(
        live.select("job_key").distinct(), "job_key", "left_semi").select("chat_id", "job_key")
    return pruned.unionByName(delivered.select("chat_id", "job_key")).distinct()


def record_sent_single(sent, delivered, live):
    """The single-reader rule: everything sent so far, as far as it is still live."""
    both = sent.select("chat_id", "job_key").unionByName(delivered.select("chat_id", "job_key"))
    return both.distinct().join(live.select("job_key").distinct(), "job_key", "left_semi") \
        .select("chat_id", "job_key")


def dashboard(curated, today, grad_only=True, internships=False, place_only=True,
              statuses=("open",), groups=(), families=(), sectors=(), firms=(), max_age_days=90,
              new_days=fixed.NEW_WINDOW_DAYS):
    """The filter set of the dashboard.  Families override groups; undated rows always stay."""
    out = curated
    if grad_only:
        out = out.filter("is_grad")
    if not internships:
        out = out.filter(~F.col("is_internship"))
    if place_only:
        out = out.filter("is_singapore")
    for column, chosen in (("status", statuses), ("job_family", families),
                           ("family_group", () if families else groups),
                           ("sector", sectors), ("firm_name", firms)):
        if chosen:
            out = out.filter(F.col(column).isin(*chosen))
    day = F.lit(today).cast("date")
    out = out.filter(F.col("posted_date").isNull()
                     | (F.col("posted_date") >= F.date_sub(day, max_age_days)))
    fresh = F.coalesce(F.col("first_seen") >= F.date_sub(day, new_days), F.lit(False))
    return out.withColumn("new", F.when(fresh, fixed.NEW_MARK).otherwise(""))


def dashboard_keys():
    return [F.desc_nulls_last("posted_date"), F.desc_nulls_last("first_seen"), F.asc("job_key")]


def search(matches, needle, regex=False, limit=fixed.SEARCH_LIMIT):
    """First rows, in digest order, whose title or firm holds the text."""
    if regex:
        hit = lambda c: F.col(c).rlike("(?i)" + needle)
    else:
        hit = lambda c: F.contains(F.lower(c), F.lit(needle.lower()))
    found = matches.filter(hit("title") | hit("firm_name"))
    return found.orderBy(*digest_keys()).limit(limit)


def clamp_limit(argument, default=fixed.LATEST_DEFAULT, most=fixed.LATEST_MAX):
    try:
        return max(1, min(most, int(argument)))
    except (TypeError, ValueError):
        return default


def latest(matches, argument=None, newest=False):
    """Head of the digest order; `newest` sorts by date alone instead."""
    keys = dashboard_keys() if newest else digest_keys()
    return matches.orderBy(*keys).limit(clamp_limit(argument))
