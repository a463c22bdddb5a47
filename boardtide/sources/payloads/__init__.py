"""Landed responses to unified postings and read outcomes, one function per platform."""

from boardtide.sources.payloads import boards, common, paged

NORMALISERS = {
    "greenhouse": boards.greenhouse,
    "lever": boards.lever,
    "ashby": boards.ashby,
    "workable": boards.workable,
    "smartrecruiters": paged.smartrecruiters,
    "workday": paged.workday,
    "successfactors": paged.successfactors,
    "phenom": paged.phenom,
    "mcf": paged.portal,
}
# these already return keyed, de-duplicated postings
_KEYED = {"workday", "successfactors", "mcf"}


def normalise(platform, landed, **options):
    """(postings, outcomes) of one platform's landed responses (layout `schema.LANDED`)."""
    rows, outcomes = NORMALISERS[platform](landed, **options)
    postings = rows if platform in _KEYED else common.postings_of(rows)
    return common.stored(postings), outcomes


def quarantined(platform, landed, **options):
    """Rows of a platform that failed validation, for inspection."""
    rows, _ = NORMALISERS[platform](landed, **options)
    if platform in _KEYED:
        raise ValueError(f"{platform} reports failed rows in its outcomes only")
    return rows.filter("not valid")
