"""Collisions: rows that would become equal to one that is there or to an earlier one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import num
from factloom.schema import SIGNATURE


def same(left: str, right: str, columns: list[str], null_safe: set[str]) -> Column:
    """Equality column by column: null equals null only in ``null_safe``. Structs are never compared."""
    one = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) if c in null_safe else F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in columns]
    return reduce(lambda a, b: a & b, one)


def keep_first(rows: DataFrame, keys: list[str], ident: str, by_number: bool = False) -> DataFrame:
    """The ids that come first for their keys, by string or by number; nulls of a key are equal.

    An aggregate, so a hot key is combined before the shuffle, and no group is sorted.
    """
    order = F.struct(num(F.col(ident)), F.col(ident)) if by_number else F.col(ident)
    return rows.groupBy(*keys).agg(F.min_by(F.col(ident), order).alias(ident)).select(ident)


def resolve(rows: DataFrame, table: DataFrame, keys: list[str], ident: str, null_safe: set[str] = frozenset(), by_number: bool = False) -> DataFrame:
    """``rows`` with ``is_duplicate``: another row of ``table`` has its keys already, or an earlier one of ``rows`` has."""
    # a semi join needs no distinct right side: the table is shuffled once at most, and not at all where the rows are few
    taken = rows.alias("r").join(table.select(*keys).alias("t"), same("r", "t", keys, null_safe), "left_semi").select(F.col(f"r.{ident}").alias(ident)).distinct()
    first = keep_first(rows, keys, ident, by_number)
    marked = rows.join(taken.withColumn("__taken", F.lit(True)), ident, "left").join(first.withColumn("__first", F.lit(True)), ident, "left")
    return marked.withColumn("is_duplicate", F.col("__taken").isNotNull() | F.col("__first").isNull()).drop("__taken", "__first")


def resolve_picks(picks: DataFrame, table: DataFrame, null_safe: bool = True, by_number: bool = False) -> DataFrame:
    """Facts with a picked ``object_id`` (all signature columns and ``triple_id``), marked by collisions of their signature."""
    return resolve(picks, table, SIGNATURE, "triple_id", {"predicate_id"} if null_safe else frozenset(), by_number)


def apply_predicate_map(queue: DataFrame, table: DataFrame, known: DataFrame) -> DataFrame:
    """``triple_id, predicate_id, is_duplicate`` of queue rows whose label has a known predicate.

    The key is coarser than a signature: subject, new predicate, object label.
    """
    found = queue.drop("predicate_id").join(known, "predicate_label")
    return resolve(found, table, ["subject_id", "predicate_id", "object_label"], "triple_id", by_number=True).select("triple_id", "predicate_id", "is_duplicate")


def apply_concept_map(queue: DataFrame, table: DataFrame, known: DataFrame) -> DataFrame:
    """``original_triple_id, concept_id, is_duplicate`` of queue rows whose label has a known class.

    Duplicates go from the class facts and from the facts.
    """
    found = queue.drop("concept_id").join(known, "concept_label")
    return resolve(found, table, ["entity_id", "concept_id"], "original_triple_id", by_number=True).select("original_triple_id", "concept_id", "is_duplicate")


def insert_or_ignore(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in ``table``, one of each; a null in a key never collides."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    fresh = rows.join(table.select(*keys).distinct(), keys, "left_anti")
    return fresh.filter(whole).dropDuplicates(keys).unionByName(fresh.filter(~whole))
