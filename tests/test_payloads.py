"""Normalisers: field mapping, null tolerance, dates, locations, outcomes."""

import datetime as dt
import json

import pytest

from boardtide import schema
from boardtide.sources.payloads import normalise

TODAY = dt.date(2026, 8, 8)


def landed(spark, rows):
    full = []
    for r in rows:
        base = dict(firm_id="f", ats_token="tok", ats_host="h.example.com", board_site="site",
                    fetched_on=TODAY, kind="list", page=0, url=None, ok=True, error=None, payload=None)
        base.update(r)
        if not (base["payload"] is None or isinstance(base["payload"], str)):
            base["payload"] = json.dumps(base["payload"])
        full.append(tuple(base[n] for n in schema.names(schema.LANDED)))
    return spark.createDataFrame(full, schema.LANDED)


def run(spark, platform, rows, **options):
    postings, outcomes = normalise(platform, landed(spark, rows), **options)
    return ({r.external_id: r for r in postings.collect()}, {r.firm_id: r for r in outcomes.collect()})


def test_greenhouse(spark):
    jobs = [
        {"id": 1, "title": " Analyst ", "absolute_url": "https://x.com/1", "requisition_id": None,
         "first_published": "2026-07-23T23:11:28-04:00", "updated_at": "2026-08-01T10:11:28-04:00",
         "location": {"name": "Singapore"}, "offices": [{"name": "London"}, {"name": "Singapore"}],
         "departments": [{"name": "A"}, {"name": None}, {"name": "B"}],
         "content": "&lt;p&gt;Caf&eacute; &amp;amp; more&lt;/p&gt;", "unknown": {"x": 1}},
        {"id": 2, "title": "B", "absolute_url": "https://x.com/2", "updated_at": "2026-08-01T10:11:28Z",
         "location": None, "offices": [{"name": "singapore hub"}]},
        {"id": 3, "title": "C", "absolute_url": "https://x.com/3", "location": {"name": "London"}},
        {"id": 4, "title": None, "absolute_url": "https://x.com/4", "location": {"name": "Singapore"}},
        {"id": "bad", "title": "E", "absolute_url": "https://x.com/5"},
        {"id": 6, "title": "F", "absolute_url": "/relative", "location": {"name": "Singapore"}},
    ]
    p, o = run(spark, "greenhouse", [{"payload": {"jobs": jobs}},
                                     {"firm_id": "g", "ok": False, "error": "Boom" * 100},
                                     {"firm_id": "h", "payload": {"jobs": []}}])
    assert set(p) == {"1", "2"}
    one = p["1"]
    assert (one.job_key, one.title, one.location_raw, one.department) == (
        "greenhouse:f:1", "Analyst", "Singapore; London", "A; B")
    assert one.description_text == "<p>Café &amp; more</p>"
    assert (one.posted_date, one.posted_date_basis) == (dt.date(2026, 7, 23), "published")
    assert json.loads(one.extra_json)["requisition_id"] == ""
    assert (p["2"].posted_date, p["2"].posted_date_basis) == (dt.date(2026, 8, 1), "updated")
    assert (o["f"].ok, o["f"].row_count, o["f"].error) == (True, 2, "3 rows failed validation")
    assert (o["g"].ok, o["g"].row_count, len(o["g"].error)) == (False, 0, 400)
    assert (o["h"].ok, o["h"].row_count, o["h"].error) == (True, 0, "")
    everywhere, _ = run(spark, "greenhouse", [{"payload": {"jobs": jobs}}], place=None)
    assert set(everywhere) == {"1", "2", "3"}


def test_lever(spark):
    jobs = [{"id": "a", "text": "Analyst", "applyUrl": "https://l/a", "createdAt": 1754006400000,
             "categories": {"location": "Singapore", "team": "T", "department": None, "commitment": "Full"},
             "description": "<p>d</p>", "lists": [{"text": "x", "content": "0-2 years"}],
             "additionalPlain": "end "},
            {"id": "b", "text": "No link", "categories": {"location": "Singapore"}}]
    p, o = run(spark, "lever", [{"payload": jobs}])
    a = p["a"]
    assert a.description_text == "<p>d</p>\n0-2 years\nend"
    assert (a.posted_date, a.department, a.employment_type) == (dt.date(2025, 8, 1), "T", "Full")
    assert o["f"].error == "1 rows failed validation" and o["f"].row_count == 1


def test_ashby(spark):
    jobs = [{"id": "a", "title": "X", "location": "London", "secondaryLocations": [
                {"location": "Singapore"}, {"location": "London"}], "department": "D", "team": "T",
             "jobUrl": "https://a/a", "publishedAt": "2026-08-01T00:00:00.000+00:00"},
            {"id": "b", "title": "Draft", "location": "Singapore", "jobUrl": "https://a/b", "isListed": False}]
    p, o = run(spark, "ashby", [{"payload": {"jobs": jobs}}])
    assert set(p) == {"a"}
    assert (p["a"].location_raw, p["a"].department) == ("London; Singapore", "D; T")
    assert (o["f"].row_count, o["f"].error) == (1, "")


def test_workable(spark):
    jobs = [{"title": "X", "shortcode": "S1", "url": "", "shortlink": "https://w/s", "city": "Singapore",
             "country": "SG", "created_at": "2026-08-02", "published_on": None, "description": "d",
             "requirements": "r", "benefits": "free fruit", "experience": "Entry level",
             "telecommuting": True}]
    p, _ = run(spark, "workable", [{"payload": {"jobs": jobs}}])
    r = p["S1"]
    assert (r.apply_url, r.location_raw, r.description_text) == ("https://w/s", "Singapore; SG", "d\nr")
    assert r.posted_date == dt.date(2026, 8, 2)
    assert json.loads(r.extra_json) == {"code": "", "education": "", "experience": "Entry level",
                                        "telecommuting": True}


def test_smartrecruiters(spark):
    def item(i, country="sg", city="Town"):
        return {"id": i, "name": f"Job {i}", "location": {"city": city, "country": country},
                "releasedDate": "2026-08-01T09:00:00.000Z", "experienceLevel": {"label": "Entry Level"}}
    ad = {"jobAd": {"sections": {"companyDescription": {"text": "co"}, "qualifications": {"text": "q"},
                                 "jobDescription": {"text": "jd"}, "videos": {"urls": []}}}}
    p, o = run(spark, "smartrecruiters", [
        {"payload": {"content": [item("1"), item("2", "us")]}},
        {"payload": {"content": [item("3", "xx", "Singapore City")]}, "page": 1},
        {"kind": "detail", "url": "1", "payload": ad},
        {"kind": "detail", "url": "3", "ok": False, "error": "gone"},
        {"firm_id": "g", "payload": {"content": [item("9")]}},
        {"firm_id": "g", "page": 1, "ok": False, "error": "500"}])
    assert set(p) == {"1", "3"}
    assert p["1"].description_text == "jd\nq\nco" and p["3"].description_text == ""
    assert p["1"].apply_url == "https://jobs.smartrecruiters.com/tok/1"
    assert json.loads(p["1"].extra_json)["experience_level"] == "Entry Level"
    assert (o["f"].ok, o["f"].row_count) == (True, 2) and (o["g"].ok, o["g"].error) == (False, "500")


def test_workday(spark):
    def item(path, title="Analyst", where="Singapore", posted="Posted 3 Days Ago", bullets=("R-1",)):
        return {"title": title, "externalPath": path, "locationsText": where, "postedOn": posted,
                "bulletFields": list(bullets)}

    def detail(path, loc, req=None, extra=(), site="site"):
        return {"kind": "detail", "url": path, "board_site": site, "payload": {"jobPostingInfo": {
            "jobDescription": "body", "jobReqId": req, "location": loc, "additionalLocations": list(extra)}}}
    rows = [
        {"payload": {"jobPostings": [
            item("/job/SG/A_R-1"), item("/job/SG/B_R-2", where="2 Locations", posted="Posted 30+ Days Ago"),
            item("/job/SG/C_R-3", where="3 locations"), item("/job/UK/D_R-4", where="London"),
            {"title": "broken"}]}},
        {"payload": {"jobPostings": [item("/job/SG/A_R-1", title="Same again")]}, "page": 1,
         "board_site": "second"},
        detail("/job/SG/A_R-1", "Singapore - Central", "REQ 1"),
        detail("/job/SG/A_R-1", "Singapore", "REQ 1", site="second"),
        detail("/job/SG/B_R-2", "London", None, ["Singapore"]), detail("/job/SG/C_R-3", "Paris")]
    p, o = run(spark, "workday", rows)
    assert set(p) == {"REQ 1", "B_R-2"}
    a = p["REQ 1"]
    assert (a.job_key, a.title, a.location_raw, a.posted_date, a.posted_date_basis) == (
        "workday:f:req-1", "Analyst", "Singapore - Central", dt.date(2026, 8, 5), "published")
    assert a.apply_url == "https://h.example.com/en-US/site/job/SG/A_R-1"
    assert (p["B_R-2"].location_raw, p["B_R-2"].posted_date) == ("London; Singapore", None)
    assert json.loads(p["B_R-2"].extra_json)["requisition_id"] == "R-1"
    assert (o["f"].ok, o["f"].row_count, o["f"].error) == (True, 2, "site: 1 rows failed validation")


def test_workday_budget_and_failures(spark):
    def item(i, title, where="Singapore"):
        return {"title": title, "externalPath": f"/job/{i}", "locationsText": where}
    rows = [{"payload": {"jobPostings": [item(0, "Cook"), item(1, "Graduate Analyst"), item(2, "Chef"),
                                         item(3, "Any", "4 Locations")]}},
            {"kind": "detail", "url": "/job/0", "payload": {"jobPostingInfo": {"jobDescription": "x"}}},
            {"kind": "detail", "url": "/job/1", "payload": {"jobPostingInfo": {"jobDescription": "y"}}},
            {"firm_id": "g", "ok": False, "error": "down"}]
    p, o = run(spark, "workday", rows, budget=2)
    # the aggregated row and the graduate title get the budget; the others stay title-only
    assert {k: r.description_text for k, r in p.items()} == {"0": "", "1": "y", "2": "", "3": ""}
    assert o["f"].error == "2 postings over the detail budget, title-only"
    assert (o["g"].ok, o["g"].row_count, o["g"].error) == (False, 0, "down")
    q, _ = run(spark, "workday", rows, budget=0)
    assert set(q) == {"0", "1", "2"}


TILE = ('<li class="job-tile job-id-{i} row" data-url="{u}"><a class="jobTitle-link x" href="#">\n'
        ' {t} </a>{s}</li>')
SECTION = ('<div id="a" class="section-field {n} c" style=""><span>{l}</span><div>{l} {v}\n </div>'
           '</div>')


def test_successfactors(spark):
    sec = SECTION.format(n="department", l="Department", v="R&amp;D") + SECTION.format(
        n="location", l="Location", v="SG, 238891") + SECTION.format(n="shifttype", l="Shift Type", v="Day")
    page = "<ul>" + TILE.format(i=11, u="/job/A%2C-B/11/", t="A &amp; <b>B</b>", s=sec + "</div>") + TILE.format(
        i=12, u="/X/job/Singapore-Risk/12/", t="Risk", s="") + TILE.format(
        i=13, u="/X/job/Essen-Risk/13/", t="Else", s="") + TILE.format(i=14, u="/q", t=" ", s="") + "</ul>"
    p, o = run(spark, "successfactors", [
        {"kind": "filtered", "payload": "<ul></ul>"}, {"kind": "all", "payload": page},
        {"kind": "all", "payload": page, "page": 1}])
    assert set(p) == {"11", "12"}
    one = p["11"]
    assert (one.title, one.location_raw, one.department, one.employment_type) == (
        "A & B", "SG, 238891", "R&D", "Day")
    assert one.apply_url == "https://h.example.com/job/A%2C-B/11/"
    assert (one.posted_date, one.posted_date_basis) == (None, "observed")
    assert json.loads(one.extra_json) == {"shifttype": "Day"}
    assert p["12"].location_raw == "Singapore"
    assert (o["f"].ok, o["f"].row_count) == (True, 2) and "fell back" in o["f"].error
    p, o = run(spark, "successfactors", [{"kind": "filtered", "payload": page},
                                         {"kind": "all", "payload": page}])
    assert set(p) == {"11", "12", "13"} and o["f"].error == ""


def test_phenom(spark):
    u = "https://h.example.com/global/en/job/%d/Role-%s"
    sitemap = "".join(f"<url><loc> {x} </loc></url>" for x in (
        u % (1, "Singapore"), u % (1, "Singapore"), u % (2, "Berlin"), u % (3, "singapore"),
        u % (4, "Singapore"), "https://h.example.com/about/singapore"))

    def page(n, slug, *blocks):
        return {"kind": "page", "url": u % (n, slug), "payload": "<html>" + "".join(
            f'<script type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>'
            for b in blocks)}
    job = {"@type": "JobPosting", "title": "Associate, Singapore (2027)", "datePosted": "2026-08-01T00:00:00Z",
           "employmentType": ["FULL_TIME", "OTHER"], "description": "<p>Hi</p>",
           "jobLocation": {"address": {"addressLocality": "Singapore", "addressRegion": "", "addressCountry": "Singapore"}}}
    rows = [{"kind": "sitemap", "payload": sitemap},
            page(1, "Singapore", "{broken", {"@type": "Organization"}, [{"@type": "X"}, job]),
            page(3, "singapore", {"@type": "JobPosting", "title": "T", "datePosted": "soon",
                                  "jobLocation": [{"address": {"addressLocality": "A"}}, {"address": {"addressLocality": "B"}}]}),
            page(4, "Singapore", {"@type": "Organization"})]
    p, o = run(spark, "phenom", rows)
    assert set(p) == {"1", "3"}
    assert (p["1"].title, p["1"].location_raw, p["1"].employment_type, p["1"].description_text) == (
        "Associate, Singapore (2027)", "Singapore", "FULL_TIME; OTHER", " Hi ")
    assert (p["1"].posted_date, p["3"].posted_date, p["3"].location_raw) == (dt.date(2026, 8, 1), None, "A, B")
    assert (o["f"].ok, o["f"].row_count) == (True, 2)
    p, _ = run(spark, "phenom", rows, max_pages=1)
    assert set(p) == {"1"}


def test_portal(spark):
    def job(u, hiring=None, **meta):
        base = {"jobPostId": "P-" + u, "jobDetailsUrl": "https://m/" + u, "originalPostingDate": "2026-05-13",
                "newPostingDate": "2026-07-14"}
        base.update(meta)
        return {"uuid": u, "title": "Management Associate", "postedCompany": {"name": "TOTAL CO.", "uen": "1"},
                "hiringCompany": hiring, "minimumYearsExperience": 0,
                "positionLevels": [{"position": "Professional"}, {"position": "Executive"}],
                "employmentTypes": [{"employmentType": "Full Time"}], "salary": {"minimum": 4000, "maximum": None},
                "metadata": base}
    p, o = run(spark, "mcf", [
        {"url": "graduate", "payload": {"results": [job("a"), job("b", {"name": "ASML (SG) LTD", "uen": "2"})]}},
        {"url": "analyst", "page": 1, "payload": {"results": [job("a", title="later"), job("c", originalPostingDate=None)]}},
        {"url": "trainee", "page": 2, "ok": False, "error": "Timeout"}])
    assert set(p) == {"a", "b"}
    assert (p["a"].firm_id, p["a"].posted_date, p["a"].location_raw) == (
        "total-co", dt.date(2026, 5, 13), "Singapore")
    assert p["b"].firm_id == "asml--sg--ltd"
    x = json.loads(p["a"].extra_json)
    assert (x["position_levels"], x["min_years"], x["salary_min"], x["salary_max"]) == (
        "Professional|Executive", 0, 4000.0, None)
    out = o["_mcf_sweep"]
    assert (out.ok, out.row_count, out.error) == (
        True, 2, "analyst p1: validation; trainee p2: Timeout")


@pytest.mark.parametrize("platform", ["greenhouse", "lever", "smartrecruiters", "workday", "mcf"])
def test_unparsable_payload_is_a_failed_read(spark, platform):
    for bad in ("<html>not json</html>", '{"jobs": [{"id": 1, "tit', "{}", "", None):
        p, o = run(spark, platform, [{"payload": bad, "url": "t"}])
        out = next(iter(o.values()))
        assert p == {} and (out.ok, out.row_count) == (False, 0)
        assert "payload is not readable" in out.error


def test_one_bad_page_fails_the_firm(spark):
    job = {"id": 1, "title": "A", "absolute_url": "https://x.com/1", "location": {"name": "Singapore"}}
    p, o = run(spark, "greenhouse", [{"payload": {"jobs": [job]}}, {"page": 1, "payload": "oops"},
                                     {"firm_id": "g", "payload": {"jobs": [job | {"id": 2}]}}])
    assert set(p) == {"2"}
    assert (o["f"].ok, o["f"].row_count, o["f"].error) == (False, 0, "payload is not readable")
    assert (o["g"].ok, o["g"].row_count) == (True, 1)


def test_stored_rows_must_keep_the_invariants(spark):
    from boardtide.sources.payloads.common import require_valid, split_valid

    rows = spark.createDataFrame(
        [("k1", "f", "lever", "1", " T ", " https://x/1", "published"), ("k2", "f", "lever", "2", " ", "https://x/2", None),
         ("k3", "f", "nowhere", "3", "T", "https://x/3", None), ("k4", "f", "lever", "#", "T", "https://x/4", None),
         ("k5", "f", "lever", "5", "T", "/x", None), ("k6", "f", "lever", "6", "T", "https://x/6", "guessed")],
        "job_key string, firm_id string, source_platform string, external_id string, title string, "
        "apply_url string, posted_date_basis string")
    good, bad = split_valid(rows)
    assert [(r.job_key, r.title, r.apply_url) for r in good.collect()] == [("k1", "T", "https://x/1")]
    assert bad.count() == 5
    assert require_valid(good).count() == 1
    with pytest.raises(Exception, match="breaks the invariants: k[2-6]"):
        require_valid(rows).collect()
