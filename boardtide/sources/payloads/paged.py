"""Sources read in pages, with details or pages landed beside the lists.

Landed rows carry `kind` ("list", "detail", "sitemap", "page", "filtered", "all"), the position
of the response in the firm's reads in `page`, and in `url` what a detail or page is about.
"""

from pyspark.sql import functions as F

from boardtide import fixed
from boardtide.functions import dates, text, urls
from boardtide.functions.text import FLAGS
from boardtide.operators.asof import first_wins
from boardtide.operators.reports import split_budget, top_per_group
from boardtide.sources.payloads import common
from boardtide.sources.payloads.boards import _project, _rows

SMARTRECRUITERS = (
    "id string, name string, uuid string, refNumber string, releasedDate string, "
    "location struct<city:string,region:string,country:string,remote:boolean>, "
    "department struct<label:string>, function struct<label:string>, "
    "typeOfEmployment struct<label:string>, experienceLevel struct<label:string>"
)
AD = "jobAd struct<sections:struct<%s>>" % ",".join(
    f"{s}:struct<text:string>" for s in fixed.AD_SECTIONS)
WORKDAY = (
    "title string, externalPath string, locationsText string, postedOn string, "
    "bulletFields array<string>"
)
WORKDAY_DETAIL = (
    "jobPostingInfo struct<jobDescription:string,jobReqId:string,location:string,"
    "additionalLocations:array<string>>"
)
PORTAL = (
    "uuid string, title string, description string, minimumYearsExperience bigint, "
    "positionLevels array<struct<position:string>>, "
    "employmentTypes array<struct<employmentType:string>>, "
    "categories array<struct<category:string>>, "
    "postedCompany struct<name:string,uen:string>, hiringCompany struct<name:string,uen:string>, "
    "salary struct<minimum:double,maximum:double,type:struct<salaryType:string>>, "
    "metadata struct<jobPostId:string,jobDetailsUrl:string,originalPostingDate:string,"
    "newPostingDate:string,expiryDate:string,repostCount:bigint,isPostedOnBehalf:boolean,"
    "totalNumberOfView:bigint,totalNumberJobApplication:bigint>"
)
LD_POSTING = (
    "title string, datePosted string, employmentType string, jobLocation string, "
    "description string"
)
LD_PLACES = (
    "array<struct<address:struct<addressLocality:string,addressRegion:string,"
    "addressCountry:string>>>"
)


def _lists(landed, kind="list"):
    return landed.filter(F.col("kind") == kind)


def _details(landed, kind, *columns):
    """One readable detail per (firm, url); the latest page wins when one was read twice."""
    keys = ["firm_id", *columns, "url"]
    return (common.readable(_lists(landed, kind)).groupBy(*keys)
            .agg(F.max_by("payload", "page").alias("detail")))


def smartrecruiters(landed, place=fixed.PLACE, codes=fixed.PLACE_CODES):
    lists = common.judged(_lists(landed), F.from_json("payload", "content array<string>")["content"])
    rows = _rows(lists, SMARTRECRUITERS)
    details = _details(landed, "detail").select(
        "firm_id", F.col("url").alias("_id"), "detail")
    joined = (rows.withColumn("_id", F.col("j")["id"])
              .join(details, ["firm_id", "_id"], "left")
              .withColumn("ad", F.from_json("detail", AD)["jobAd"]["sections"]))
    j, loc = F.col("j"), F.col("j")["location"]
    released = dates.iso_date(j["releasedDate"])
    label = lambda n: F.coalesce(j[n]["label"], F.lit(""))
    city, country = F.coalesce(loc["city"], F.lit("")), F.coalesce(loc["country"], F.lit(""))
    near = F.lit(True) if place is None else (
        F.lower(country).isin(*codes) | text.mentions_place(city, place=place))
    out = _project(
        joined.withColumn("near", near), "smartrecruiters",
        j["id"].isNotNull() & j["name"].isNotNull()
        & common.readable_date(j["releasedDate"], released), F.col("near"),
        external_id=j["id"], title=j["name"],
        apply_url=F.format_string(fixed.PUBLIC_URL_SMARTRECRUITERS, F.col("ats_token"), j["id"]),
        location_raw=text.join_filled(F.array(city, loc["region"], country)),
        description_text=text.join_filled(
            F.array(*[F.col("ad")[s]["text"] for s in fixed.AD_SECTIONS]), "\n"),
        posted_date=released, posted_date_basis=dates.basis_when(released),
        department=label("department"), employment_type=label("typeOfEmployment"),
        extra_json=text.to_json_extra(
            ref_number=F.coalesce(j["refNumber"], F.lit("")),
            experience_level=label("experienceLevel"), function=label("function"),
            remote=F.coalesce(loc["remote"], F.lit(False))),
        near=F.col("near"))
    return out, common.outcomes_of(lists, out, "smartrecruiters")


def workday(landed, place=fixed.PLACE, budget=None):
    """Several sites per tenant; every landed detail is used.

    A row that only says "3 Locations" is judged by its detail: elsewhere means dropped.  With a
    `budget`, details count for the first so many rows of a site: beyond it a row of several
    locations cannot be judged and is dropped, others are kept on their title alone.
    """
    site = ["firm_id", "board_site"]
    lists = common.judged(
        _lists(landed), F.from_json("payload", "jobPostings array<string>")["jobPostings"])
    rows = common.drop_failed(common.readable(lists).select(
        *site, "ats_host", "fetched_on", "page", common.elements("items", WORKDAY)), lists, site)
    j = F.col("j")
    listed = F.coalesce(j["locationsText"], F.lit(""))
    rows = rows.select(
        "*", (j["title"].isNotNull() & j["externalPath"].isNotNull()).alias("well_formed"),
        text.matches(listed, fixed.MULTI_LOCATION).alias("multi"),
        F.when(text.matches(j["title"], fixed.WORTH_DETAIL), 0).otherwise(1).alias("dull"),
        listed.alias("listed"))
    wanted = rows.filter("well_formed").filter(
        F.lit(True) if place is None
        else F.col("multi") | text.mentions_place("listed", place=place))
    ranked = wanted.withColumn("in_budget", F.lit(True)) if budget is None else split_budget(
        wanted.withColumn("single", F.when(F.col("multi"), 0).otherwise(1)),
        site, ["single", "dull", "page", "pos"], budget)

    details = _details(landed, "detail", "board_site").select(
        *site, F.col("url").alias("_path"),
        F.from_json("detail", WORKDAY_DETAIL)["jobPostingInfo"].alias("info"))
    seen = ranked.withColumn("_path", j["externalPath"]).join(details, [*site, "_path"], "left")
    used = lambda c: F.when(F.col("in_budget"), c)
    info = F.col("info")
    places = F.concat(
        F.array(info["location"]),
        F.coalesce(info["additionalLocations"], F.array().cast("array<string>")))
    seen = seen.select(
        "*", F.coalesce(used(info["jobDescription"]), F.lit("")).alias("body"),
        F.coalesce(used(info["jobReqId"]), F.lit("")).alias("req"),
        F.coalesce(used(F.when(info.isNotNull(), text.join_filled(places))), F.lit(""))
        .alias("resolved"))
    elsewhere = F.lit(False) if place is None else (
        F.col("multi") & ((F.col("in_budget") & (F.col("resolved") != "")
                           & ~text.mentions_place("resolved", place=place))
                          | ~F.col("in_budget")))
    last_segment = F.element_at(
        F.split(F.regexp_replace(j["externalPath"], "^/+|/+$", ""), "/"), -1)
    posted = dates.relative_date(j["postedOn"], F.col("fetched_on"))
    bullet = F.coalesce(F.try_element_at(j["bulletFields"], F.lit(1)), F.lit(""))
    out = _project(
        seen, "workday", F.lit(True), ~F.col("elsewhere"),
        external_id=text.first_filled(F.col("req"), last_segment), title=j["title"],
        apply_url=F.format_string(fixed.PUBLIC_URL_WORKDAY, F.col("ats_host"),
                                  F.col("board_site"), j["externalPath"]),
        location_raw=text.first_filled(F.col("resolved"), F.col("listed")),
        description_text=F.col("body"), posted_date=posted,
        posted_date_basis=dates.basis_when(posted),
        extra_json=text.to_json_extra(
            requisition_id=text.first_filled(F.col("req"), bullet),
            posted_on_raw=F.coalesce(j["postedOn"], F.lit(""))),
        board_site=F.col("board_site"), elsewhere=elsewhere)
    keyed = first_wins(common.postings_of(out), ["job_key"], ["page", "pos"])
    return keyed, _workday_outcomes(lists, rows, ranked, keyed)


def _workday_outcomes(lists, rows, ranked, keyed):
    """ok when any site could be read; notes of the sites, named when there are several."""
    site = ["firm_id", "board_site"]
    reads = lists.groupBy(*site).agg(
        F.bool_and(F.coalesce("ok", F.lit(False))).alias("ok"), F.min("page").alias("first"),
        F.max(F.when(~F.coalesce("ok", F.lit(False)), F.col("error"))).alias("why"))
    bad = rows.groupBy(*site).agg(F.count_if(~F.col("well_formed")).alias("bad"))
    over = ranked.groupBy(*site).agg(F.count_if(~F.col("in_budget")).alias("over"))
    notes = F.array(
        common.invalid_note(F.col("bad")),
        F.when(F.col("over") > 0, F.concat(F.col("over").cast("string"), F.lit(
            " postings over the detail budget, title-only"))).otherwise(""))
    per_site = (reads.join(bad, site, "left").join(over, site, "left")
                .na.fill(0, ["bad", "over"]).select(
                    *site, "ok", "first", F.when(F.col("ok"), text.join_filled(notes))
                    .otherwise(F.coalesce("why", F.lit(""))).alias("note")))
    # a firm has a handful of sites, so this list is short whatever the number of postings
    firms = per_site.groupBy("firm_id").agg(
        F.bool_or("ok").alias("ok"), F.bool_and("ok").alias("complete"),
        F.array_sort(F.collect_list(F.struct("first", "board_site", "note"))).alias("sites"))
    named = F.transform(F.filter("sites", lambda s: s["note"] != ""),
                        lambda s: F.concat(s["board_site"], F.lit(": "), s["note"]))
    count = keyed.groupBy("firm_id").agg(F.count("*").alias("row_count"))
    return firms.join(count, "firm_id", "left").select(
        "firm_id", F.lit("workday").alias("platform"), "ok",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.when(F.size("sites") > 1, F.array_join(named, "; "))
        .otherwise(F.col("sites")[0]["note"]).alias("error"), "complete")


def successfactors(landed, place=fixed.PLACE):
    """HTML tiles.  A search filtered by place is trusted; without hits the full sweep is used."""
    landed = common.judged(landed, F.when(text.strip("payload") != "", F.lit(True)))
    pages = common.readable(landed).select(
        "firm_id", F.concat(F.lit("https://"), "ats_host").alias("base"), "kind", "page",
        F.posexplode(F.split("payload", fixed.TILE_MARKER)).alias("pos", "chunk"))
    grab = lambda p, g=1: F.regexp_extract("chunk", p, g)
    tiles = pages.filter(F.col("pos") > 0).select(
        "firm_id", "base", "kind", "page", "pos", grab(r"^(\d+)").alias("id"),
        grab(fixed.TILE_URL).alias("link"), grab("(?s)" + fixed.TILE_TITLE).alias("title"),
        F.transform(F.regexp_extract_all("chunk", F.lit("(?sU)" + fixed.TILE_SECTION), F.lit(1)),
                    lambda n: F.lower(n)).alias("names"),
        F.regexp_extract_all("chunk", F.lit("(?sU)" + fixed.TILE_SECTION), F.lit(2)).alias("bodies"))
    tiles = tiles.filter((F.col("id") != "") & (F.col("link") != "") & (F.col("title") != ""))
    raw = F.concat(F.array(F.col("link"), text.strip_tags("title")), F.transform("bodies", text.strip_tags))
    # generated, so that the decoded texts are computed once and then read from several places
    tiles = tiles.select("*", F.explode(F.array(F.transform(raw, text.unescape))).alias("texts"))
    tidy = lambda c: F.trim(text.collapse(c))

    def unlabelled(c):
        # the label is there twice: once for screen readers, once visible
        for _ in range(2):
            c = text.strip(F.regexp_replace(c, FLAGS + fixed.TILE_LABEL, ""))
        return c

    values = F.transform(F.slice("texts", 3, F.size("texts")), lambda c: unlabelled(tidy(c)))
    tiles = tiles.select(
        "firm_id", "kind", "page", "pos", F.col("id"), tidy(F.col("texts")[1]).alias("title"),
        urls.resolve_relative("base", F.col("texts")[0]).alias("apply_url"),
        F.filter(F.arrays_zip(F.col("names").alias("n"), values.alias("v")),
                 lambda z: F.coalesce(z["v"], F.lit("")) != "").alias("fields"))
    tiles = tiles.filter(F.col("title") != "")
    last = lambda name: F.coalesce(F.try_element_at(
        F.filter("fields", lambda z: z["n"] == name), F.lit(-1))["v"], F.lit(""))
    other = F.filter(F.array_distinct(F.transform("fields", lambda z: z["n"])),
                     lambda n: ~n.isin("location", "department"))
    extra = F.map_from_entries(F.transform(other, lambda n: F.struct(n, F.element_at(
        F.filter("fields", lambda z: z["n"] == n), -1)["v"])))
    located = text.first_filled(last("location"), urls.place_from_slug("apply_url"))
    rows = tiles.select(
        "firm_id", F.lit("successfactors").alias("source_platform"), "kind", "page", "pos",
        F.col("id").alias("external_id"), "title", "apply_url", located.alias("location_raw"),
        F.lit("").alias("description_text"), F.lit(None).cast("date").alias("posted_date"),
        F.lit("observed").alias("posted_date_basis"), last("department").alias("department"),
        text.first_filled(last("shifttype"), last("jobtype")).alias("employment_type"),
        F.to_json(extra).alias("extra_json"))
    here = F.lit(True) if place is None else (
        (F.col("kind") == "filtered") | text.has_place_code("location_raw"))
    rows = common.mark(rows, F.lit(True), here)
    hits = (rows.filter(F.col("kind") == "filtered").groupBy("firm_id")
            .agg(F.count("*").alias("filtered_hits")))
    chosen = rows.join(hits, "firm_id", "left").filter(
        (F.col("kind") == "filtered") | F.col("filtered_hits").isNull())
    keyed = first_wins(common.postings_of(chosen.drop("filtered_hits")), ["job_key"],
                       ["page", "pos"])
    return keyed, _sweep_outcomes(landed, keyed, "successfactors")


def _sweep_outcomes(landed, keyed, platform):
    """A sweep stands once its first page was read; later failures become notes in page order, and
    the board counts as seen in part."""
    ok = F.coalesce("ok", F.lit(False))
    stops = F.transform(F.array_sort(F.collect_list(F.when(~ok, F.struct("kind", "page", F.coalesce(
        "error", F.lit("")).alias("error"))))), lambda s: F.concat(
            F.lit("stopped at page "), s["page"].cast("string"), F.lit(": "), s["error"]))
    reads = landed.groupBy("firm_id", "kind").agg(F.min_by(ok, "page").alias("ok"), F.bool_and(ok).alias("complete"),
                                                  stops.alias("stops"))
    # a firm has at most two kinds of search
    firms = reads.groupBy("firm_id").agg(
        F.bool_and("ok").alias("ok"), F.bool_and("complete").alias("complete"),
        F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("kind", "stops"))), lambda k: k["stops"])),
                     "; ").alias("note"),
        F.bool_or((F.col("kind") == "filtered") & ~F.col("ok")).alias("place_failed"),
        F.bool_or(F.col("kind") == "filtered").alias("asked"))
    count = keyed.groupBy("firm_id").agg(
        F.count("*").alias("row_count"), F.bool_or(F.col("kind") == "filtered").alias("answered"))
    fell_back = "locationsearch returned nothing; fell back to the unfiltered sweep"
    return firms.join(count, "firm_id", "left").select(
        "firm_id", F.lit(platform).alias("platform"), "ok",
        F.when(F.col("ok"), F.coalesce("row_count", F.lit(0))).otherwise(0).cast("bigint")
        .alias("row_count"),
        F.when(~F.col("ok"), F.when(F.col("place_failed"), "location search failed").otherwise("search failed"))
        .otherwise(text.join_filled(F.array(
            F.when(F.col("asked") & ~F.coalesce("answered", F.lit(False)), fell_back),
            F.col("note")))).alias("error"), "complete")


def phenom(landed, place=fixed.PLACE, max_pages=None):
    """Sitemap URLs narrowed by slug, then the JobPosting block of each landed page.

    With `max_pages`, only the first so many pages of a firm are used.
    """
    maps = common.judged(landed.filter(F.col("kind") == "sitemap"), F.when(
        F.col("payload").rlike(r"(?i)<(urlset|sitemapindex|url|loc)\b"), F.lit(True)))
    found = common.readable(maps).select("firm_id", "page", F.posexplode(F.regexp_extract_all(
        "payload", F.lit("(?s)" + fixed.SITEMAP_LOC), F.lit(1))).alias("pos", "url"))
    found = found.filter(urls.is_job_page("url"))
    if place is not None:
        found = found.filter(text.mentions_place("url", place=place))
    listed = first_wins(found, ["firm_id", "url"], ["page", "pos"])
    if max_pages is not None:
        listed = top_per_group(listed, ["firm_id"], ["page", "pos"], max_pages)
    pages = listed.join(_details(landed, "page"), ["firm_id", "url"])
    missing = found.select("firm_id", "url").distinct().join(pages, ["firm_id", "url"], "left_anti")

    blocks = F.regexp_extract_all("detail", F.lit("(?si)" + fixed.LD_JSON_BLOCK), F.lit(1))
    items = F.flatten(F.transform(blocks, lambda b: F.coalesce(
        F.when(text.strip(b).startswith("["), F.from_json(b, "array<string>"))
        .otherwise(F.array(b)), F.array().cast("array<string>"))))
    block = F.slice(F.filter(
        items, lambda x: F.get_json_object(x, "$['@type']") == "JobPosting"), 1, 1)
    rows = pages.select("firm_id", "url", "page", F.col("pos").alias("place"),
                        common.elements(block, LD_POSTING))
    j = F.col("j")
    spots = F.flatten(F.transform(
        F.coalesce(F.from_json(j["jobLocation"], LD_PLACES), F.array().cast(LD_PLACES)),
        lambda p: F.array(p["address"]["addressLocality"], p["address"]["addressRegion"],
                          p["address"]["addressCountry"])))
    posted = dates.iso_date(j["datePosted"])
    kind = j["employmentType"]
    out = _project(
        rows.filter(text.strip(F.coalesce(j["title"], F.lit(""))) != ""), "phenom", F.lit(True),
        F.lit(True), external_id=urls.job_page_id("url"), title=j["title"],
        apply_url=F.col("url"),
        location_raw=text.first_filled(text.join_distinct(spots, ", "), F.lit(fixed.PLACE_NAME)),
        description_text=text.strip_tags(F.coalesce(j["description"], F.lit(""))),
        posted_date=posted, posted_date_basis=dates.basis_when(posted),
        employment_type=F.coalesce(
            F.when(kind.startswith("["), F.array_join(F.from_json(kind, "array<string>"), "; "))
            .otherwise(kind), F.lit("")))
    return out, _site_outcomes(maps, out, missing)


def _site_outcomes(maps, out, missing):
    """A firm stands once its first sitemap was read; the errors of the others become its note.  A
    sitemap or a listed page that was not read leaves the board seen in part."""
    ok = F.coalesce("ok", F.lit(False))
    # a firm has a handful of sitemaps, so this list is short whatever the number of postings
    errors = F.transform(F.array_sort(F.collect_list(F.when(
        ~ok, F.struct("page", F.coalesce("error", F.lit("")).alias("error"))))), lambda e: e["error"])
    reads = maps.groupBy("firm_id").agg(
        F.min_by(ok, "page").alias("ok"), F.bool_and(ok).alias("all_read"), F.min_by("error", "page").alias("why"),
        F.array_join(errors, "; ").alias("note"))
    count = out.groupBy("firm_id").agg(F.count_if("valid").alias("n"))
    left = missing.groupBy("firm_id").agg(F.count("*").alias("unread"))
    return reads.join(count, "firm_id", "left").join(left, "firm_id", "left").select(
        "firm_id", F.lit("phenom").alias("platform"), "ok",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.when(F.col("ok"), F.col("note")).otherwise(F.col("why")), F.lit(""))
        .alias("error"), (F.col("all_read") & F.col("unread").isNull()).alias("complete"))


def portal(landed, place=None):
    """The government portal: one sweep over many search terms, first hit of a posting wins."""
    landed = common.judged(landed, F.from_json("payload", "results array<string>")["results"])
    # a response without elements stays as a row that is not valid, for the outcome
    rows = landed.select("page", F.col("url").alias("term"), "ok", "error", common.elements("items", PORTAL, outer=True))
    j, meta = F.col("j"), F.col("j")["metadata"]
    named = lambda array, field: F.transform(
        F.coalesce(j[array], F.array().cast(f"array<struct<{field}:string>>")),
        lambda x: F.coalesce(x[field], F.lit("")))
    hiring = text.strip(F.coalesce(j["hiringCompany"]["name"], F.lit(""))) != ""
    company = lambda f: F.coalesce(
        F.when(hiring, j["hiringCompany"][f]).otherwise(j["postedCompany"][f]), F.lit(""))
    posted = dates.iso_date(meta["originalPostingDate"])
    required = (j["uuid"].isNotNull() & j["title"].isNotNull() & meta["jobPostId"].isNotNull()
                & meta["jobDetailsUrl"].isNotNull() & posted.isNotNull())
    out = _project(
        rows, fixed.PORTAL_PLATFORM, required, F.lit(True),
        firm_id=text.first_filled(
            text.slug_chars(company("name")),
            F.when(company("uen") != "", F.concat(F.lit("uen-"), company("uen"))),
            F.lit("unknown")),
        external_id=j["uuid"], title=j["title"], apply_url=meta["jobDetailsUrl"],
        location_raw=F.lit(fixed.PLACE_NAME),
        description_text=F.coalesce(j["description"], F.lit("")),
        posted_date=posted, posted_date_basis=F.lit("published"),
        department=text.join_filled(named("categories", "category")),
        employment_type=text.join_filled(named("employmentTypes", "employmentType")),
        extra_json=text.to_json_extra(
            mcf_job_post_id=meta["jobPostId"], uen=company("uen"), employer_name=company("name"),
            posted_company_name=F.coalesce(j["postedCompany"]["name"], F.lit("")),
            is_posted_on_behalf=F.coalesce(meta["isPostedOnBehalf"], F.lit(False)),
            min_years=j["minimumYearsExperience"],
            position_levels=text.join_filled(named("positionLevels", "position"), "|"),
            employment_types=text.join_filled(named("employmentTypes", "employmentType"), "|"),
            salary_min=j["salary"]["minimum"], salary_max=j["salary"]["maximum"],
            salary_type=F.coalesce(j["salary"]["type"]["salaryType"], F.lit("")),
            repost_count=F.coalesce(meta["repostCount"], F.lit(0)),
            posting_expires_on=F.coalesce(meta["expiryDate"], F.lit("")),
            views=F.coalesce(meta["totalNumberOfView"], F.lit(0)),
            applications=F.coalesce(meta["totalNumberJobApplication"], F.lit(0))),
        term=F.col("term"), ok=F.col("ok"), error=F.col("error"))
    keyed = first_wins(common.postings_of(out).drop("ok", "error"), ["external_id"], ["page", "pos"])
    return keyed, _portal_outcome(out)


def _portal_outcome(out):
    """One outcome for the whole sweep; ok when it produced anything; its first five errors.  A term's
    page that was not read leaves the sweep seen in part."""
    place = F.concat(F.coalesce("term", F.lit("")), F.lit(" p"), F.col("page").cast("string"),
                     F.lit(": "))
    read = F.coalesce("ok", F.lit(False))
    bad = out.filter(~read | (F.col("pos").isNotNull() & ~F.col("valid"))).select(
        "page", F.coalesce("pos", F.lit(-1)).alias("pos"),
        F.concat(place, F.when(read, "validation").otherwise(F.coalesce("error", F.lit("")))).alias("e"))
    errors = bad.orderBy("page", "pos").limit(5).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("page", "pos", "e"))), lambda x: x["e"]), "; ")
        .alias("e"))
    # an id that is valid is not null, and after a failed read there is none
    counted = out.agg(
        F.count_distinct(F.when(F.col("valid") & F.col("here"), text.strip("external_id"))).alias("n"),
        F.coalesce(F.bool_and(read), F.lit(True)).alias("complete"))
    return counted.crossJoin(errors).select(
        F.lit(fixed.SWEEP_FIRM_ID).alias("firm_id"),
        F.lit(fixed.PORTAL_PLATFORM).alias("platform"), (F.col("n") > 0).alias("ok"),
        F.col("n").alias("row_count"), F.col("e").alias("error"), "complete")
