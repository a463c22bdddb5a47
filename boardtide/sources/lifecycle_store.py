"""The lifecycle as a stored table that is advanced by day, not replayed.

Closed keys, which only grow in number, lie apart from the others.  A day reads its own partitions,
the live keys, and of the closed ones those that are back; it writes the live keys anew and adds
the newly closed ones.  A closed key that came back stays in the older folders, where its newer
row, live or closed again, overrules it.

The note of a version names the day it stands at and the partitions it has seen.  If one of them
was replaced, removed, or came late, history is replayed once.
"""

import datetime as dt

from pyspark.sql import functions as F

from boardtide.operators.lifecycle import advance_lifecycle, compute_lifecycle
from boardtide.sources import snapshots
from boardtide.sources.generations import Generations

LAYOUT = ("job_key string, first_seen date, last_seen date, status string, disappeared_on date, "
          "times_seen bigint, source string, firm_id string")
CLOSED = LAYOUT + ", closed_in int"
KEY = ["source", "job_key"]
#: Folders of closed keys after which they are written as one.
FOLDERS = 30


class LifecycleStore:
    """Where `root` is a folder of its own, `snapshots_root` that of the snapshot store."""

    def __init__(self, spark, snapshots_root, root):
        self.spark, self.snapshots = spark, snapshots_root
        self.versions = Generations(spark, root)

    def _seen(self):
        """When each partition of the store was last written, by its name."""
        found = {}
        for table in ("postings", "outcomes"):
            for platform, date, when in snapshots.written_partitions(self.spark, self.snapshots, table):
                found[f"{table}/{platform}/{date.isoformat()}"] = when
        return found

    def read(self, at=None):
        """All keys, each once: the newest row of each, from live ones and closed ones."""
        at = at or self.versions.current()
        live = self.versions.read("live", LAYOUT, at)
        shut = self._closed(at).join(live.select(*KEY), KEY, "left_anti")
        return live.unionByName(shut.drop("closed_in"))

    def _closed(self, at, keys=None):
        """The newest row of closed keys, all or those of `keys`."""
        rows = self.versions.read("closed", CLOSED, at)
        if keys is not None:
            rows = rows.join(keys, KEY, "left_semi")
        if at is None or len(at["tables"].get("closed", [])) < 2:
            return rows
        others = [c for c in rows.columns if c not in KEY]
        newest = rows.groupBy(*KEY).agg(F.max(F.struct("closed_in", *[c for c in others if c != "closed_in"])).alias("r"))
        return newest.select(*KEY, "r.*").select(*rows.columns)

    def update(self, replay=False):
        """Bring the state up to the newest day of the snapshot store; returns that day.

        `replay` starts anew, for stores whose folders do not tell when they were written."""
        at, seen = self.versions.current(), self._seen()
        days = sorted({name.rsplit("/", 1)[1] for name in seen})
        if not days:
            return None
        stood = at["note"]["day"] if at else ""
        known = {n: w for n, w in seen.items() if n.rsplit("/", 1)[1] <= stood}
        if replay or at is None or known != at["note"]["seen"]:
            self._replay(seen, days[-1], at)
        else:
            for day in days:
                if day > stood:
                    at = self._advance(at, day, {n: w for n, w in seen.items() if n.rsplit("/", 1)[1] <= day})
        return dt.date.fromisoformat(days[-1])

    def _replay(self, seen, day, at):
        views = snapshots.view_calendar(self.spark, self.snapshots)
        state = compute_lifecycle(*snapshots.read_history(self.spark, self.snapshots), keep=("source", "firm_id"),
                                  views=views)
        self._publish(state, day, seen, at, anew=True)

    def _advance(self, at, day, seen):
        date = dt.date.fromisoformat(day)
        postings, outcomes = snapshots.read_day(self.spark, self.snapshots, date)
        live = self.versions.read("live", LAYOUT, at)
        # only keys that are not live can be among the closed ones
        back = postings.select(*KEY).distinct().join(live.select(*KEY), KEY, "left_anti")
        state = live.unionByName(self._closed(at, back).drop("closed_in"))
        return self._publish(advance_lifecycle(state, postings, outcomes, date), day, seen, at)

    def _publish(self, state, day, seen, at, anew=False):
        # one pass over the state, read by the live and the closed part
        work = Generations(self.spark, f"{self.versions.root}/work")
        try:
            work.publish({"state": state.select(*[c.split()[0] for c in LAYOUT.split(", ")])})
            stored = work.read("state", LAYOUT)
            order = at["version"] + 1 if at else 1
            closed = stored.filter("status = 'closed'").withColumn("closed_in", F.lit(order))
            live = stored.filter("status <> 'closed'")
            replace, append = {"live": live}, {"closed": closed}
            if anew:
                replace, append = {"live": live, "closed": closed}, {}
            elif len(at["tables"].get("closed", [])) >= FOLDERS:
                kept = self._closed(at).join(stored.select(*KEY), KEY, "left_anti")
                replace, append = {"live": live, "closed": kept.unionByName(closed)}, {}
            self.versions.publish(replace, append, {"day": day, "seen": seen}, at)
        finally:
            snapshots.delete_folder(self.spark, work.root)
        return self.versions.current()
