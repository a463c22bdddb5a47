"""What several branches of a query read is worked out once."""

import datetime as dt

from boardtide import schema
from boardtide.plans import queries_flow, queries_payloads
from boardtide.sources.payloads import normalise


def tables(spark, folder):
    day = dt.datetime(1998, 1, 5)
    orders = [(i, i % 3, "FPO"[i % 3], 40000.0 + i, day, "5-LOW" if i % 5 == 0 else "1-URGENT") for i in range(1, 40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, f"c{i}", i, "BUILDING", 10.0) for i in range(3)], "c_custkey long, c_name string, "
                          "c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(i, f"NATION_{i}", i) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int"
                          ).write.parquet(f"{folder}/nation.parquet")
    return str(folder)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lifecycle_reads_stored_days(spark, tmp_path):
    found = queries_payloads.lifecycle_after_bad_read(spark, tables(spark, tmp_path))
    assert "o_orderkey" not in plan(found) and found.count() == 26


def test_merge_reads_stored_postings(spark, tmp_path):
    folder = tables(spark, tmp_path)
    assert "o_orderkey" not in plan(queries_flow.merge_twins(spark, folder))
    assert "o_orderkey" not in plan(queries_flow.merge_kept(spark, folder))


def test_portal_outcome_parses_responses_twice(spark):
    job = ('{"uuid": "%s", "title": "T", "metadata": {"jobPostId": "P", "jobDetailsUrl": "https://x.example.com/1", '
           '"originalPostingDate": "2024-01-02"}}')
    pages = [(1, True, None, '{"results": [%s, %s, {"uuid": "bad"}]}' % (job % "a", job % "b")),
             (2, False, "Timeout", None), (3, True, None, '{"results": []}'), (4, True, None, "<html>"),
             (5, True, None, '{"results": [%s]}' % (job % "a"))]
    known = {"firm_id": "_mcf_sweep", "kind": "list", "url": "term", "fetched_on": dt.date(2024, 1, 3)}
    rows = [tuple({**known, "page": p, "ok": ok, "error": e, "payload": body}.get(n) for n in schema.names(schema.LANDED))
            for p, ok, e, body in pages]
    outcome = normalise("mcf", spark.createDataFrame(rows, schema.LANDED).repartition(3))[1]
    assert plan(outcome).count("Repartition 3") == 2
    row = outcome.first()
    assert (row["ok"], row["row_count"], row["complete"]) == (True, 2, False)
    assert row["error"] == ("term p1: validation; term p2: Timeout; term p4: payload is not readable")
