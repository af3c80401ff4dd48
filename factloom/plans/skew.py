"""Queries of problem 1: a few labels hold most facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.skew import heavy_keys, key_profile
from factloom.runtime import table

FIELDS = (("predicate_label", "triple", "triple_id", "object_status"), ("concept_label", "instance_triple", "original_triple_id", "status"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Labels that hold at least 5 % of the rows of their table."""
    parts = [heavy_keys(table(spark, root, name), field).select(F.lit(field).alias("field_name"), "label") for field, name, _, _ in FIELDS]
    return parts[0].unionByName(parts[1])


def p1_label_profile(spark: SparkSession, root: str) -> DataFrame:
    """For each label of both fields: rows, first and last fact, status runs and late rows in input order."""
    parts = [
        key_profile(table(spark, root, name), field, ident, state, "created_at").select(
            F.lit(field).alias("field_name"), "label", "rows", "first_id", "last_id", "state_runs", "late_rows"
        )
        for field, name, ident, state in FIELDS
    ]
    return parts[0].unionByName(parts[1])


QUERIES = {"p1_found": p1_found, "p1_label_profile": p1_label_profile}


def _profile_sql(field: str, name: str, ident: str, state: str) -> str:
    return f"""
    SELECT '{field}' AS field_name, label, count(*) AS rows, arg_min(ident, no) AS first_id, arg_max(ident, no) AS last_id,
           CAST(sum(CASE WHEN no = 1 OR state IS DISTINCT FROM was THEN 1 ELSE 0 END) AS BIGINT) AS state_runs,
           CAST(sum(CASE WHEN ts < was_ts THEN 1 ELSE 0 END) AS BIGINT) AS late_rows
    FROM (SELECT {field} AS label, {ident} AS ident, {state} AS state, created_at AS ts, row_number() OVER w AS no,
                 lag({state}) OVER w AS was, lag(created_at) OVER w AS was_ts
          FROM (SELECT *, row_number() OVER () AS place FROM {name}) WINDOW w AS (PARTITION BY {field} ORDER BY place))
    GROUP BY label"""


ORACLE = {
    "p1_found": " UNION ALL ".join(
        f"SELECT '{f}' AS field_name, {f} AS label FROM {t} GROUP BY {f} HAVING {f} IS NOT NULL AND count(*) >= 0.05 * (SELECT count(*) FROM {t})" for f, t, _, _ in FIELDS
    ),
    "p1_label_profile": " UNION ALL ".join(_profile_sql(*x) for x in FIELDS),
}
