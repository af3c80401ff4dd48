"""New facts into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import assign_ids


def ingest(raw: DataFrame, known: DataFrame, start: int, *order) -> tuple[DataFrame, DataFrame]:
    """Facts and class facts from ``raw`` (``subject_id, subject, predicate, object``).

    First match wins: the pair of predicate and object is in ``known`` (see ``reuse.consistent_objects``), the predicate is
    ``instanceOf``, or neither. Ids go on from ``start`` in ``order``. Repeated facts are kept: they are resolved later.
    """
    numbered = assign_ids(raw, "T", start, *(order or (F.col("subject_id"), F.col("predicate"), F.col("object"))), name="triple_id")
    joined = numbered.join(known.select(F.col("predicate_label").alias("predicate"), F.col("object_label").alias("object"), F.col("object_id").alias("__known")), ["predicate", "object"], "left")
    reused, typed = F.col("__known").isNotNull(), F.col("predicate") == "instanceOf"
    facts = joined.select(
        "triple_id",
        "subject_id",
        F.col("subject").alias("subject_label"),
        F.col("predicate").alias("predicate_label"),
        F.when(~reused & typed, "P0").alias("predicate_id"),
        F.when(~reused & typed, "finished").otherwise("generated").alias("predicate_status"),
        F.col("object").alias("object_label"),
        F.col("__known").alias("object_id"),
        F.when(reused, "ne").when(typed, "class").otherwise("unrecognized").alias("object_type"),
        F.when(reused | typed, "finished").otherwise("generated").alias("object_status"),
    )
    return facts, class_facts(facts.filter((F.col("object_type") == "class")))


def class_facts(facts: DataFrame) -> DataFrame:
    """The class facts of ``instanceOf`` facts."""
    return facts.select(F.col("triple_id").alias("original_triple_id"), F.col("subject_id").alias("entity_id"), F.col("object_label").alias("concept_label"), F.lit("generated").alias("status"))
