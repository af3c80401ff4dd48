"""Candidates for a disambiguation, in order, and the pick among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST = 5


def ordered(links: DataFrame, item: str, candidate: str, table: DataFrame) -> DataFrame:
    """``item, candidates``: the candidates of each item that are in ``table``, with label and description, by position."""
    there = links.join(table.select(F.col("id").alias(candidate), "label", "description"), candidate)
    entry = F.struct("position", F.col(candidate).alias("id"), "label", "description")
    return there.groupBy(item).agg(F.array_sort(F.collect_list(entry)).alias("candidates"))  # at most MOST links an item


def pick(candidates: Column, choice: Column) -> Column:
    """The id of the ``choice``-th candidate from 1, null when out of range: the rank among those that are left."""
    return F.get(candidates, choice - 1)["id"]


def merged(exact: DataFrame, near: DataFrame, item: str, most: int = MOST) -> DataFrame:
    """``item, candidate, position``: exact matches first, then neighbours that aren't among them, ``most`` in all.

    Both inputs have ``item, candidate, position``.
    """
    first = exact.select(item, "candidate", F.lit(0).alias("source"), "position").unionByName(near.select(item, "candidate", F.lit(1).alias("source"), "position"))
    best = first.groupBy(item, "candidate").agg(F.min(F.struct("source", "position")).alias("at"))
    rank = F.row_number().over(Window.partitionBy(item).orderBy("at", "candidate"))
    return best.withColumn("position", rank - 1).filter(F.col("position") < most).select(item, "candidate", "position")


def exact_matches(items: DataFrame, item: str, label: str, entities: DataFrame) -> DataFrame:
    """``item, candidate, description``: entities with just the item's label and a description."""
    there = entities.filter(F.col("description").isNotNull()).select(F.col("label").alias(label), F.col("id").alias("candidate"), "description").distinct()
    return items.select(item, label).join(there, label).select(item, "candidate", "description")


def group_split(entities: DataFrame, more_than: int = MOST) -> DataFrame:
    """``label, n, many``: entities per label, and whether they are more than are shown."""
    sizes = entities.filter(F.col("description").isNotNull() & F.col("label").isNotNull()).groupBy("label").agg(F.count_distinct("id").alias("n"))
    return sizes.select("label", "n", (F.col("n") > more_than).alias("many"))


def reranked(matches: DataFrame, item: str, score: str, most: int = MOST) -> DataFrame:
    """``item, candidate, position``: the ``most`` candidates of highest score of each item, ties by id."""
    rank = F.row_number().over(Window.partitionBy(item).orderBy(F.desc(score), "candidate"))
    return matches.withColumn("position", rank - 1).filter(F.col("position") < most).select(item, "candidate", "position")


def cosine(a: Column, b: Column) -> Column:
    """Inner product of two unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def ned2_candidates(items: DataFrame, entities: DataFrame, near: DataFrame, embed) -> DataFrame:
    """``triple_id, candidate, position``: for items with many entities of their label those of most similar description,
    else these and then the nearest labels. ``near`` has ``triple_id, candidate, position``; ``embed`` adds ``embedding``."""
    matches = exact_matches(items, "triple_id", "object_label", entities)
    sizes = matches.groupBy("triple_id").agg(F.count("*").alias("n"))
    many = sizes.filter(F.col("n") > MOST).select("triple_id")
    few = items.select("triple_id").join(many, "triple_id", "left_anti")
    target = embed(items.join(many, "triple_id", "left_semi").select("triple_id", "object_description"), "object_description").select("triple_id", F.col("embedding").alias("target"))
    texts = matches.join(many, "triple_id", "left_semi").select("description").distinct()
    scored = matches.join(embed(texts, "description"), "description").join(target, "triple_id").withColumn("score", cosine(F.col("embedding"), F.col("target")))
    by_number = Window.partitionBy("triple_id").orderBy(F.length("candidate"), "candidate")
    listed = matches.join(few, "triple_id", "left_semi").withColumn("position", F.row_number().over(by_number) - 1)
    return reranked(scored, "triple_id", "score").unionByName(merged(listed, near.join(few, "triple_id", "left_semi"), "triple_id"))
