"""What is known already and need not be asked again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import num
from factloom.functions.parsing import trim_white
from factloom.operators import dedup, vectors
from factloom.runtime import staged


def consistent_objects(facts: DataFrame, more_than: int = 50) -> DataFrame:
    """``predicate_label, object_label, object_id, facts``: pairs with more than so many facts of one and the same object."""
    named = facts.filter((F.col("object_type") == "ne") & F.col("object_id").isNotNull() & F.col("predicate_label").isNotNull() & F.col("object_label").isNotNull())
    grouped = named.groupBy("predicate_label", "object_label").agg(F.count("*").alias("facts"), F.min("object_id").alias("object_id"), F.max("object_id").alias("__max"))
    return grouped.filter((F.col("facts") > more_than) & (F.col("object_id") == F.col("__max"))).drop("__max")


def label_map(df: DataFrame, label: str, ident: str, longer_than: int = -1) -> DataFrame:
    """``label, id``: the id known for each label longer than so many characters, the largest as a string. A null label is
    none; an empty one is, with ``longer_than`` below 0."""
    known = df.filter(F.col(ident).isNotNull() & (F.length(label) > longer_than))
    return known.groupBy(F.col(label).alias(label)).agg(F.max(ident).alias(ident))


def ned_frequency(facts: DataFrame, batchwise: bool) -> DataFrame:
    """``object_label, n``: facts of each object that were disambiguated: with a batch, or else with an object id."""
    done = F.col("ned1_batch_id").isNotNull() if batchwise else (F.col("object_type") == "ne") & F.col("object_id").isNotNull()
    return facts.filter(done & F.col("object_label").isNotNull()).groupBy("object_label").agg(F.count("*").alias("n"))


def normal_label(label: Column, prefix: int | None) -> Column:
    """The label in lower case without outer white space; its first ``prefix`` characters are cut first."""
    return trim_white(F.lower(label if prefix is None else F.substring(label, 1, prefix)))


def thin_by_label(items: DataFrame, label: str, ident: str, prefix: int | None) -> DataFrame:
    """``norm, id``: the item of least number for each normal label. A hot label is combined before the shuffle."""
    first = F.min_by(F.col(ident), F.struct(num(F.col(ident)), F.col(ident)))
    return items.filter(F.col(label).isNotNull()).groupBy(normal_label(F.col(label), prefix).alias("norm")).agg(first.alias(ident))


def thin(items: DataFrame, label: str, ident: str, known: DataFrame, threshold: int, prefix: int) -> DataFrame:
    """``thin_by_label`` by whole labels once ``known`` has more rows than ``threshold``, by prefixes before."""
    return thin_by_label(items, label, ident, None if known.count() > threshold else prefix)


def thin_by_cluster(rest: DataFrame, facts: DataFrame, embedder: vectors.Embedder, distance: float = 0.15, more_than: int = 50) -> DataFrame:
    """``triple_id``: of object labels that are alike the first; of labels with more than so many disambiguated facts among
    ``facts`` one fact a subject, else one in all."""
    first_seen = F.min(num(F.col("triple_id"))).alias("idx")
    labels = staged(vectors.embed(rest.groupBy("object_label").agg(first_seen), "object_label", embedder))
    leaders = vectors.cluster_vectors(labels, distance).filter("idx = cluster").select("idx")
    chosen = labels.join(leaders, "idx").select("object_label")
    frequent = ned_frequency(facts, False).filter(F.col("n") > more_than).select("object_label", F.lit(True).alias("__often"))
    rows = rest.join(chosen, "object_label").join(frequent, "object_label", "left")
    keyed = rows.withColumn("__subject", F.when(F.col("__often"), F.col("subject_id")))
    return dedup.keep_first(keyed, ["object_label", "__subject"], "triple_id", True)


def totals(**tables: tuple[DataFrame, str]) -> DataFrame:
    """``table_name, n``: distinct keys of each table."""
    whole = None
    for name, (df, key) in tables.items():
        one = df.agg(F.count_distinct(key).alias("n")).select(F.lit(name).alias("table_name"), "n")
        whole = one if whole is None else whole.unionByName(one)
    return whole
