"""Declared table layouts.  Types are stated once and never inferred."""

from pyspark.sql import types as T


def _schema(spec):
    types = {"s": T.StringType(), "l": T.LongType(), "d": T.DateType(), "f": T.DoubleType(),
             "b": T.BooleanType(), "a": T.ArrayType(T.StringType())}
    fields = []
    for item in spec.split():
        name, code = item.split(":")
        fields.append(T.StructField(name, types[code], True))
    return T.StructType(fields)


POSTING = _schema(
    "job_key:s firm_id:s source_platform:s external_id:s title:s apply_url:s location_raw:s "
    "description_text:s posted_date:d posted_date_basis:s department:s employment_type:s "
    "extra_json:s"
)
# `complete` is false where a read that counts as ok missed part of the board; null where a read is
# either whole or failed
OUTCOME = _schema("firm_id:s platform:s ok:b row_count:l error:s complete:b")
LIFECYCLE = _schema(
    "job_key:s first_seen:d last_seen:d status:s disappeared_on:d times_seen:l"
)
CURATED = _schema(
    "job_key:s firm_id:s firm_name:s sector:s tier:l title:s apply_url:s source_platform:s "
    "external_id:s location_raw:s is_singapore:b posted_date:d posted_date_basis:s first_seen:d "
    "last_seen:d status:s job_family:s family_group:s family_confidence:f family_basis:s "
    "is_grad:b grad_confidence:f grad_basis:s role_type:s is_internship:b department:s "
    "employment_type:s mcf_job_id:s salary_min:f salary_max:f description_text:s snapshot_date:d"
)
CANDIDATES = _schema("employer:s postings:l")
REGISTRY = _schema(
    "firm_id:s firm_name:s sector:s tier:l ats_platform:s ats_token:s ats_host:s board_site:s "
    "careers_url:s robots_status:s status:s notes:s"
)
ALIASES = _schema("alias_kind:s alias_value:s firm_id:s")
OVERRIDES = _schema("job_key:s job_family:s why:s")
LABELS = _schema(
    "firm:s title:s min_years:s position_levels:s employment_types:s desc_excerpt:s "
    "is_grad:s is_internship:s job_family:s note:s"
)
SUBSCRIPTIONS = _schema(
    "chat_id:s role_types:a groups:a last_notified:d active:b notified_keys:a"
)
SENT_STATE = _schema("chat_id:s job_key:s")

# fields the classifier reads out of extra_json; values of any scalar type are read as text
EXTRA = _schema(
    "min_years:s position_levels:s employment_types:s experience_level:s experience:s "
    "employer_name:s uen:s mcf_job_post_id:s mcf_job_id:s mcf_url:s "
    "salary_min:s salary_max:s salary_type:s"
)

# one landed response: what was asked for, whether it could be read, and the body
LANDED = _schema(
    "firm_id:s ats_token:s ats_host:s board_site:s fetched_on:d kind:s page:l url:s ok:b "
    "error:s payload:s"
)


def names(schema):
    return [f.name for f in schema.fields]


def conform(df, schema):
    """Project `df` to exactly the declared columns, in order, cast to the declared types."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
