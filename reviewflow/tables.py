"""Input tables and the two derived views every query starts from.

``reviews`` stands for the processed review set (rating, title, text) and
``lifecycle_events`` for the endpoint event log (start / in_service / status /
predict / shutdown). Both are derived from the given test tables, row for row, so
their size grows with the tables. The SQL text of both views is kept here as well:
the DuckDB oracle inlines it as a CTE, and the DataFrame forms below must stay equal
to it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import table_path

REVIEWS_SQL = """
SELECT d.doc_id,
       CAST(CASE WHEN l.quality = 1 THEN 4 + d.doc_id % 2
                 WHEN l.quality = 0 THEN 1 + d.doc_id % 3 END AS DOUBLE) AS rating,
       CASE WHEN d.doc_id % 7 <> 0 THEN split_part(d.text, '.', 1) END AS title,
       d.text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

LIFECYCLE_EVENTS_SQL = """
SELECT event_id, ts,
       concat('model-', CAST(user_id % 10 AS STRING)) AS model_id,
       CASE event_type WHEN 'signup' THEN 'start' WHEN 'click' THEN 'in_service'
                       WHEN 'view' THEN 'status' WHEN 'purchase' THEN 'predict'
                       ELSE 'shutdown' END AS kind,
       CASE WHEN event_id % 11 <> 0 THEN concat('user', CAST(user_id AS STRING)) END AS name,
       CASE WHEN event_id % 13 <> 0 THEN
         concat('2', CAST(user_id % 10 AS STRING), '5-555-', CAST(1000 + event_id % 9000 AS STRING)) END AS phone,
       CASE WHEN event_id % 17 <> 0 THEN props ELSE '' END AS text
FROM events
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def reviews_from(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Without ``labels`` the rating is null and no join is made."""
    d = documents.select("doc_id", "text")
    title = F.when(F.col("doc_id") % 7 != 0, F.substring_index(F.col("text"), ".", 1))
    if labels is None:
        return d.select("doc_id", F.lit(None).cast("double").alias("rating"), title.alias("title"), "text")
    # labels is keyed by doc_id (at most one row per document); a plain left join keeps
    # every document. Catalyst picks broadcast only when its size estimate allows it.
    l = labels.select("doc_id", "quality")
    q = F.col("quality")
    rating = (F.when(q == 1, F.lit(4) + F.col("doc_id") % 2)
              .when(q == 0, F.lit(1) + F.col("doc_id") % 3)
              .cast("double"))
    return (d.join(l, "doc_id", "left")
            .select("doc_id", rating.alias("rating"), title.alias("title"), "text"))


def reviews(spark: SparkSession, sf_dir: str, with_rating: bool = True) -> DataFrame:
    """``with_rating=False`` for queries that read neither the rating nor its label."""
    return reviews_from(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels") if with_rating else None)


# The event-type to lifecycle-kind mapping of the fixture view.
KIND_OF_EVENT_TYPE = {"signup": "start", "click": "in_service", "view": "status",
                      "purchase": "predict"}  # every other type: shutdown


def _kind(event_type: Column) -> Column:
    out = None
    for et, kind in KIND_OF_EVENT_TYPE.items():
        out = F.when(event_type == et, kind) if out is None else out.when(event_type == et, kind)
    return out.otherwise("shutdown")


def lifecycle_events_from(events: DataFrame) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    phone = F.concat(F.lit("2"), (uid % 10).cast("string"), F.lit("5-555-"),
                     (F.lit(1000) + eid % 9000).cast("string"))
    return events.select(
        "event_id", "ts",
        F.concat(F.lit("model-"), (uid % 10).cast("string")).alias("model_id"),
        _kind(F.col("event_type")).alias("kind"),
        F.when(eid % 11 != 0, F.concat(F.lit("user"), uid.cast("string"))).alias("name"),
        F.when(eid % 13 != 0, phone).alias("phone"),
        F.when(eid % 17 != 0, F.col("props")).otherwise(F.lit("")).alias("text"),
    )


def _raw_filter(kinds) -> Column:
    """Predicate on the raw ``event_type`` equivalent to ``kind IN kinds``, so it can be
    pushed into the Parquet scan (a filter on the derived CASE column cannot)."""
    types = [et for et, k in KIND_OF_EVENT_TYPE.items() if k in kinds]
    cond = F.col("event_type").isin(types) if types else F.lit(False)
    if "shutdown" in kinds:   # every other type, null included
        cond = cond | ~F.coalesce(F.col("event_type").isin(list(KIND_OF_EVENT_TYPE)), F.lit(False))
    return cond


def lifecycle_events(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """The lifecycle event log; ``kinds`` keeps only those kinds, filtered at the scan."""
    events = read_table(spark, sf_dir, "events")
    if kinds is not None:
        events = events.where(_raw_filter(kinds))
    return lifecycle_events_from(events)


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the CTEs of the derived views it reads."""
    parts = []
    if "reviews" in names:
        parts.append(f"reviews AS ({REVIEWS_SQL})")
    if "lifecycle_events" in names:
        parts.append(f"lifecycle_events AS ({LIFECYCLE_EVENTS_SQL})")
    if not parts:
        return sql
    body = sql.strip()
    m = re.match(r"(?is)^with(\s+recursive)?\s+", body)
    if m:
        head = "WITH RECURSIVE " if m.group(1) else "WITH "
        return head + ",\n".join(parts) + ",\n" + body[m.end():]
    return "WITH " + ",\n".join(parts) + "\n" + body
