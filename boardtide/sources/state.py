"""Subscriptions and the record of what was sent to whom."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from boardtide import schema
from boardtide.sources.generations import read_sent, write_sent  # noqa: F401
from boardtide.sources.snapshots import folder_exists

_CORRUPT = "_corrupt"


def read_subscriptions(spark, path):
    """Records of a JSON object's `subscriptions`, of a JSON array, or one per line.

    Objects and arrays may be indented in any way.  Records that cannot be read are skipped.
    """
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema.SUBSCRIPTIONS)
    layout = StructType(schema.SUBSCRIPTIONS.fields + [StructField(_CORRUPT, StringType())])
    value = F.trim("value")
    records = (F.when(F.ltrim(F.regexp_replace("value", r"^\s+", "")).startswith("["),
                      F.from_json(value, "array<string>"))
               .otherwise(F.coalesce(F.from_json(value, "subscriptions array<string>")["subscriptions"],
                                     F.split("value", r"\r?\n"))))
    raw = spark.read.text(path, wholetext=True).select(F.explode(records).alias("record")).select(
        F.from_json("record", layout, {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("r")).select("r.*")
    empty = F.array().cast("array<string>")
    return raw.filter(F.col(_CORRUPT).isNull() & F.col("chat_id").isNotNull()).select(
        "chat_id", F.coalesce("role_types", empty).alias("role_types"),
        F.coalesce("groups", empty).alias("groups"), "last_notified",
        F.coalesce("active", F.lit(True)).alias("active"),
        F.coalesce("notified_keys", empty).alias("notified_keys"))


def active_subscriptions(subs):
    """Active, with at least one role type and one group chosen."""
    return subs.filter(F.col("active") & (F.size("role_types") > 0) & (F.size("groups") > 0))


def sent_keys(subs):
    """Sent state as (chat_id, job_key) rows."""
    return subs.select("chat_id", F.explode("notified_keys").alias("job_key")).distinct()
