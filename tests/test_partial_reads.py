"""Reads that count as ok but missed part of a board close nothing."""

from tests.test_payloads import TILE, run


def tiles(i):
    return "<ul>" + TILE.format(i=i, u=f"/X/job/Singapore-A/{i}/", t="Role", s="") + "</ul>"


def test_later_list_pages(spark):
    rows = [{"kind": "all", "payload": tiles(1)}, *[
        {"kind": "all", "page": n, "ok": False, "error": f"e{n}"} for n in (10, 2)],
        {"firm_id": "g", "kind": "all", "payload": tiles(2)},
        {"firm_id": "h", "kind": "filtered", "ok": False, "error": "x"}, {"firm_id": "h", "kind": "all", "payload": tiles(3)},
        {"firm_id": "i", "kind": "all", "ok": False, "error": "x"}]
    _, o = run(spark, "successfactors", rows)
    assert (o["f"].ok, o["f"].complete, o["f"].error) == (True, False, "stopped at page 2: e2; stopped at page 10: e10")
    assert (o["g"].ok, o["g"].complete, o["g"].error) == (True, True, "")
    assert (o["h"].ok, o["h"].error) == (False, "location search failed")
    assert (o["i"].ok, o["i"].error) == (False, "search failed")


def test_sites_terms_and_job_pages(spark):
    item = {"title": "T", "externalPath": "/job/1", "locationsText": "Singapore"}
    _, o = run(spark, "workday", [{"payload": {"jobPostings": [item]}},
                                  {"board_site": "two", "ok": False, "error": "down", "page": 1}])
    assert (o["f"].ok, o["f"].complete) == (True, False)
    _, o = run(spark, "mcf", [{"url": "a", "payload": {"results": []}}, {"url": "b", "ok": False, "error": "Timeout"}])
    assert o["_mcf_sweep"].complete is False
    u = "https://h.example.com/global/en/job/1/Role-Singapore"
    listed = {"kind": "sitemap", "payload": f"<url><loc>{u}</loc></url>"}
    page = {"kind": "page", "url": u, "payload": "<html></html>"}
    for rows, whole in (([listed, page], True), ([listed], False), ([listed, page | {"ok": False, "error": "x"}], False),
                        ([listed, page, {"kind": "sitemap", "page": 1, "ok": False, "error": "x"}], False)):
        _, o = run(spark, "phenom", rows)
        assert (o["f"].ok, o["f"].complete) == (True, whole)
