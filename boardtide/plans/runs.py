"""The three runs: land payloads, rebuild the curated tables, serve readers."""

from pyspark.sql import functions as F

from boardtide import fixed, schema
from boardtide.operators import classify, packing, reports, select
from boardtide.operators.curate import build_tables
from boardtide.session import table_stage
from boardtide.sources import registry as dims, snapshots
from boardtide.sources.generations import Generations
from boardtide.sources.lifecycle_store import LifecycleStore
from boardtide.sources.payloads import normalise
from boardtide.sources.payloads.common import require_valid
from boardtide.sources.state import active_subscriptions


def ingest(spark, root, landed, platform, date, **options):
    """Normalise one platform's landed payloads and replace that day's partition.

    Returns how many postings and firms were read and how many reads failed."""
    postings, outcomes = normalise(platform, landed, **options)
    counted = reports.ReadCounters()
    snapshots.write_snapshot(spark, root, platform, date, postings, counted.outcomes(outcomes))
    return counted.get()


def rebuild(spark, root, out, registry, aliases, overrides, replay=False, **options):
    """Publish the curated and candidate tables from the snapshot store; returns the date.

    The lifecycle is advanced by the days since the last run (`replay`: from all history).  Both
    tables appear together, in one version of `out`; a run that fails leaves the version before.
    """
    latest = snapshots.latest_snapshot_date(spark, root)
    if latest is None:
        raise RuntimeError("no snapshots on disk; ingest first")
    life = LifecycleStore(spark, root, f"{out}/lifecycle")
    life.update(replay)
    current = require_valid(snapshots.as_postings(snapshots.read_newest(spark, root, latest)))
    stage = table_stage(spark)
    try:
        curated, candidates, _ = build_tables(
            current, life.read().select(*schema.names(schema.LIFECYCLE)), registry, aliases, overrides, latest,
            stage=stage, **options)
        portal_rows = snapshots.read_newest(spark, root, latest).filter(
            F.col("source") == fixed.PORTAL_PLATFORM).count()
        counted = reports.RunCounters(portal_rows)
        Generations(spark, out).publish({"postings": counted.curated(curated).hint("rebalance"),
                                         "candidates": counted.candidates(candidates)}, note=counted.get)
    finally:
        snapshots.delete_folder(spark, stage.folder)
    return latest


def rebuild_from_files(spark, root, out, registry_csv, aliases_csv, overrides_csv, **options):
    return rebuild(spark, root, out, dims.load_registry(spark, registry_csv),
                   dims.load_aliases(spark, aliases_csv), dims.load_overrides(spark, overrides_csv),
                   **options)


def read_curated(spark, out, at=None):
    """The curated table; `at` is a pointer of `Generations.current`, for several tables of one version."""
    return Generations(spark, out).read("postings", schema.CURATED, at)


def read_candidates(spark, out, at=None):
    return Generations(spark, out).read("candidates", schema.CANDIDATES, at)


def read_counters(spark, out):
    """kept, merged, candidates and graduate rows of the run that published `out`."""
    at = Generations(spark, out).current()
    return at["note"] if at else None


def serve(curated, subscriptions, sent, snapshot_date):
    """(messages, new sent state) for all active subscribers."""
    matches = select.match_subscribers(select.notifiable(curated),
                                       active_subscriptions(subscriptions))
    due = select.unsent(matches, sent)
    return (packing.render_digest(due, snapshot_date),
            select.record_sent(sent, due, curated))


def health(outcomes, curated, candidates, registry, labels):
    """The parts of the daily report (`reports.daily_report` writes them)."""
    scores = classify.score_verdicts(classify.evaluate_labels(labels))
    return reports.health_parts(
        reports.platform_health(outcomes), reports.read_failures(outcomes),
        candidates.orderBy(F.desc("postings"), "employer"), curated, dims.counts_by(registry, "status"), scores)
