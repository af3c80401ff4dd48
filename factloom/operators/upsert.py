"""Entities, predicates and classes by label and description."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import assign_ids, num
from factloom.runtime import staged


def upsert_pairs(items: DataFrame, table: DataFrame, prefix: str, item: str = "triple_id") -> tuple[DataFrame, DataFrame]:
    """Ids for ``items`` (columns ``item, label, description``) and the rows to add.

    An item whose label and description are in ``table`` (columns ``id, label, description``) has that id; others get one
    new id per pair, numbered on from the table's rows in the order of the first item. Comparison is exact; a null label or
    description is equal to none, and such items are left out. Returns ``item, id`` of all items, and
    ``id, label, description, embedding_index, first_appeared`` of the new rows.
    """
    pairs = items.select(item, "label", "description").dropna(subset=["label", "description"])
    known = table.groupBy("label", "description").agg(F.min("id").alias("id"))
    first = pairs.groupBy("label", "description").agg(F.min(F.struct(num(F.col(item)).alias("n"), F.col(item).alias("item"))).alias("first"))
    fresh = first.join(known, ["label", "description"], "left_anti").select("label", "description", F.col("first.n").alias("__n"), F.col("first.item").alias("first_appeared"))
    start = table.agg(F.coalesce(F.max(num(F.col("id"))) + 1, F.lit(0))).first()[0]
    new = assign_ids(fresh, prefix, start, F.col("__n"), F.col("first_appeared"), F.col("label"), F.col("description"), name="id")
    new = staged(new.select("id", "label", "description", num(F.col("id")).alias("embedding_index"), "first_appeared"))
    every = known.unionByName(new.select("label", "description", "id"))
    return pairs.join(every, ["label", "description"]).select(item, "id"), new
