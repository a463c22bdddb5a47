"""Files as users have them: layouts, absent files, repeated keys."""

import json

import pytest

from boardtide.operators.fuzzy_join import similar_titles
from boardtide.operators.robots import admit
from boardtide.sources import registry, state

HEAD = ("firm_id,firm_name,sector,tier,ats_platform,ats_token,ats_host,board_site,careers_url,"
        "robots_status,status,notes\n")


def test_missing_registry_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        registry.load_registry(spark, str(tmp_path / "none.csv"))
    assert registry.load_aliases(spark, str(tmp_path / "none.csv")).count() == 0


def test_ids_that_differ_in_case_are_duplicates(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(HEAD + "ACME,A,s,1,,,,,,,todo,\nacme,B,s,1,,,,,,,todo,\nbeta,C,s,1,,,,,,,todo,\n")
    with pytest.raises(ValueError, match="line 3 .acme.: duplicate firm_id"):
        registry.load_registry(spark, str(path))


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("layout", ["object", "array", "lines"])
def test_subscription_layouts(spark, tmp_path, indent, layout):
    records = [{"chat_id": "1", "role_types": ["a"], "groups": ["g"], "notified_keys": ["k"]},
               {"chat_id": {"bad": 1}, "groups": 7}, {"chat_id": "2", "active": False}]
    text = {"object": json.dumps({"subscriptions": records}, indent=indent),
            "array": "\n " + json.dumps(records, indent=indent),
            "lines": "\n".join(map(json.dumps, records)) + "\n{broken\n\n"}[layout]
    (tmp_path / "s.json").write_text(text)
    rows = {r.chat_id: r for r in state.read_subscriptions(spark, str(tmp_path / "s.json")).collect()}
    assert {"1", "2"} <= set(rows) and rows["1"].notified_keys == ["k"] and rows["2"].active is False
    assert rows["1"].active is True


def test_newest_robots_file_of_a_host_counts(spark):
    pages = spark.createDataFrame([("https://a.com/x",)], "url string")
    files = spark.createDataFrame(
        [("a.com", 200, "User-agent: *\nDisallow: /", "2026-01-01"), ("a.com", 404, "", "2026-01-02")],
        "host string, status int, body string, fetched_on string")
    assert [r.verdict for r in admit(pages, files).collect()] == ["allowed"]
    assert admit(pages, files.drop("fetched_on")).count() == 1


def test_titles_below_the_exact_range_are_refused(spark):
    titles = spark.createDataFrame([("f", "analyst")], "firm string, title string")
    with pytest.raises(ValueError):
        similar_titles(titles, titles, "firm", "title", 50)
