"""Boards that answer with the whole list in one JSON response."""

from pyspark.sql import functions as F

from boardtide import fixed
from boardtide.functions import dates, text
from boardtide.sources.payloads import common

GREENHOUSE = (
    "id bigint, title string, absolute_url string, location struct<name:string>, "
    "offices array<struct<name:string>>, departments array<struct<name:string>>, "
    "updated_at string, first_published string, requisition_id string, content string, "
    "education string"
)
LEVER = (
    "id string, text string, hostedUrl string, applyUrl string, createdAt bigint, "
    "categories struct<commitment:string,department:string,location:string,team:string>, "
    "description string, descriptionPlain string, additionalPlain string, "
    "lists array<struct<text:string,content:string>>, workplaceType string"
)
ASHBY = (
    "id string, title string, location string, secondaryLocations array<struct<location:string>>, "
    "department string, team string, employmentType string, jobUrl string, applyUrl string, "
    "publishedAt string, descriptionPlain string, descriptionHtml string, isListed boolean"
)
WORKABLE = (
    "title string, shortcode string, code string, url string, shortlink string, "
    "application_url string, employment_type string, department string, function string, "
    "country string, city string, state string, telecommuting boolean, published_on string, "
    "created_at string, description string, requirements string, benefits string, "
    "education string, experience string"
)


def _rows(judged, layout):
    return common.drop_failed(common.readable(judged).select(
        "firm_id", "ats_token", "page", common.elements("items", layout)), judged, ["firm_id"])


def _jobs(landed):
    return common.judged(landed, F.from_json("payload", "jobs array<string>")["jobs"])


def _names(array):
    return F.transform(F.coalesce(array, F.array().cast("array<struct<name:string>>")),
                       lambda x: F.coalesce(x["name"], F.lit("")))


def _project(rows, platform, required, here, **cols):
    base = {
        "firm_id": F.col("firm_id"), "source_platform": F.lit(platform), "page": F.col("page"),
        "pos": F.col("pos"), "location_raw": F.lit(""), "description_text": F.lit(""),
        "posted_date": F.lit(None).cast("date"), "posted_date_basis": F.lit(None).cast("string"),
        "department": F.lit(""), "employment_type": F.lit(""), "extra_json": F.lit("{}"),
        "j": F.col("j"),
    }
    base.update(cols)
    flat = rows.select(*[c.alias(n) for n, c in base.items()])
    return common.mark(flat, required, here).drop("j")


def _here(place, *tests):
    if place is None:
        return F.lit(True)
    return text.mentions_place(*tests, place=place)


def greenhouse(landed, place=fixed.PLACE):
    j = F.col("j")
    landed = _jobs(landed)
    rows = _rows(landed, GREENHOUSE)
    published, updated = dates.iso_date(j["first_published"]), dates.iso_date(j["updated_at"])
    places = F.concat(F.array(F.coalesce(j["location"]["name"], F.lit(""))), _names(j["offices"]))
    required = (j["id"].isNotNull() & j["title"].isNotNull() & j["absolute_url"].isNotNull()
                & common.readable_date(j["first_published"], published)
                & common.readable_date(j["updated_at"], updated))
    out = _project(
        rows, "greenhouse", required, _here(place, "location_raw"),
        external_id=j["id"].cast("string"), title=j["title"], apply_url=j["absolute_url"],
        location_raw=text.join_distinct(places),
        description_text=text.unescape(F.coalesce(j["content"], F.lit(""))),
        posted_date=F.coalesce(published, updated),
        posted_date_basis=F.when(published.isNotNull(), "published")
        .when(updated.isNotNull(), "updated"),
        department=text.join_filled(_names(j["departments"])),
        extra_json=text.to_json_extra(
            requisition_id=F.coalesce(j["requisition_id"], F.lit("")),
            education=F.coalesce(j["education"], F.lit("")),
            updated_at=F.coalesce(j["updated_at"], F.lit(""))))
    return out, common.outcomes_of(landed, out, "greenhouse")


def lever(landed, place=fixed.PLACE):
    j = F.col("j")
    landed = common.judged(landed, F.from_json("payload", "array<string>"))
    rows = _rows(landed, LEVER)
    posted = dates.epoch_millis_date(j["createdAt"])
    cat = lambda n: F.coalesce(j["categories"][n], F.lit(""))
    sections = F.transform(
        F.coalesce(j["lists"], F.array().cast("array<struct<text:string,content:string>>")),
        lambda x: F.coalesce(x["content"], F.lit("")))
    body = F.concat(
        F.array(text.first_filled(j["descriptionPlain"], j["description"])), sections,
        F.array(F.coalesce(j["additionalPlain"], F.lit(""))))
    out = _project(
        rows, "lever", j["id"].isNotNull() & j["text"].isNotNull(), _here(place, "location_raw"),
        external_id=j["id"], title=j["text"],
        apply_url=text.first_filled(j["hostedUrl"], j["applyUrl"]),
        location_raw=cat("location"), description_text=text.strip(F.array_join(body, "\n")),
        posted_date=posted, posted_date_basis=dates.basis_when(posted),
        department=text.join_filled(F.array(cat("department"), cat("team"))),
        employment_type=cat("commitment"),
        extra_json=text.to_json_extra(workplace_type=F.coalesce(j["workplaceType"], F.lit(""))))
    return out, common.outcomes_of(landed, out, "lever")


def ashby(landed, place=fixed.PLACE):
    j = F.col("j")
    # drafts and private links are not openings: they are neither rows nor failures
    landed = _jobs(landed)
    rows = _rows(landed, ASHBY).filter(F.coalesce(j["isListed"], F.lit(True)))
    posted = dates.iso_date(j["publishedAt"])
    more = F.transform(
        F.coalesce(j["secondaryLocations"], F.array().cast("array<struct<location:string>>")),
        lambda x: F.coalesce(x["location"], F.lit("")))
    out = _project(
        rows, "ashby", j["id"].isNotNull() & j["title"].isNotNull()
        & common.readable_date(j["publishedAt"], posted), _here(place, "location_raw"),
        external_id=j["id"], title=j["title"],
        apply_url=text.first_filled(j["jobUrl"], j["applyUrl"]),
        location_raw=text.join_distinct(
            F.concat(F.array(F.coalesce(j["location"], F.lit(""))), more)),
        description_text=text.first_filled(j["descriptionPlain"], j["descriptionHtml"]),
        posted_date=posted, posted_date_basis=dates.basis_when(posted),
        department=text.join_filled(F.array(j["department"], j["team"])),
        employment_type=F.coalesce(j["employmentType"], F.lit("")))
    return out, common.outcomes_of(landed, out, "ashby")


def workable(landed, place=fixed.PLACE):
    j = F.col("j")
    landed = _jobs(landed)
    rows = _rows(landed, WORKABLE)
    first, second = dates.iso_date(j["published_on"]), dates.iso_date(j["created_at"])
    posted = F.coalesce(first, second)
    required = (j["title"].isNotNull() & j["shortcode"].isNotNull()
                & common.readable_date(j["published_on"], first)
                & common.readable_date(j["created_at"], second))
    out = _project(
        rows, "workable", required, _here(place, "location_raw"),
        external_id=j["shortcode"], title=j["title"],
        apply_url=text.first_filled(j["url"], j["shortlink"], j["application_url"]),
        location_raw=text.join_filled(F.array(j["city"], j["state"], j["country"])),
        description_text=text.join_filled(F.array(j["description"], j["requirements"]), "\n"),
        posted_date=posted, posted_date_basis=dates.basis_when(posted),
        department=text.join_filled(F.array(j["department"], j["function"])),
        employment_type=F.coalesce(j["employment_type"], F.lit("")),
        extra_json=text.to_json_extra(
            code=F.coalesce(j["code"], F.lit("")), education=F.coalesce(j["education"], F.lit("")),
            experience=F.coalesce(j["experience"], F.lit("")),
            telecommuting=F.coalesce(j["telecommuting"], F.lit(False))))
    return out, common.outcomes_of(landed, out, "workable")
