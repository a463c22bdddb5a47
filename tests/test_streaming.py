"""Landing in two batches gives the same store as landing at once."""

import datetime as dt
import json

from boardtide import schema
from boardtide.sources import snapshots
from boardtide.streaming.landing import land_stream

D = dt.date(2026, 8, 10)


def test_landing_is_idempotent(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "check"))

    def drop(firm, day, ids):
        jobs = [{"id": i, "title": "T", "absolute_url": f"https://x/{i}", "location": {"name": "Singapore"}}
                for i in ids]
        spark.createDataFrame([(firm, "t", "h", "s", day, "list", 0, None, True, None,
                                json.dumps({"jobs": jobs}))], schema.LANDED).write.mode("append").parquet(landing)

    def run():
        q = land_stream(spark, landing, root, "greenhouse", checkpoint)
        q.awaitTermination(120)
        assert q.exception() is None
        return {(r.snapshot_date, r.firm_id, r.external_id)
                for r in snapshots.read_history(spark, root)[0].collect()}

    drop("a", D, [1, 2])
    drop("a", D + dt.timedelta(1), [2])
    first = {(D, "a", "1"), (D, "a", "2"), (D + dt.timedelta(1), "a", "2")}
    assert run() == first
    assert run() == first
    drop("b", D, [7])
    assert run() == first | {(D, "b", "7")}
    assert snapshots.read_outcomes(spark, root, "greenhouse", D).count() == 2
