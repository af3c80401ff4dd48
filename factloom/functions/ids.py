"""Ids: a letter and a dense number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.runtime import parallelism, staged


def num(ident: Column) -> Column:
    """The number of an id, null where there is none."""
    return F.substring(ident, 2, 1_000).try_cast("bigint")


def numbered(df: DataFrame, *order: Column, name: str = "nth") -> DataFrame:
    """``df`` with ``name``, a dense number from 0 in the order of ``order``, which must tell all rows apart.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the rows before that
    partition. No task sees more than its partition, unlike a window over all rows.
    """
    spark = df.sparkSession
    placed = df.withColumns({f"__o{i}": c for i, c in enumerate(order)})
    cols = [f"__o{i}" for i in range(len(order))]
    ranged = placed.repartitionByRange(parallelism(spark), *cols).sortWithinPartitions(*cols).drop(*cols)
    stage = staged(ranged.withColumn("__id", F.monotonically_increasing_id()))
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))  # a row a partition
    return (
        stage.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + place)
        .drop("__part", "__before", "__id")
    )


def next_number(df: DataFrame, ident: str) -> DataFrame:
    """One row, ``next_number``: one more than the largest number of an id, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(num(F.col(ident))) + 1, F.lit(0)).alias("next_number"))


def assign_ids(df: DataFrame, prefix: str, first: int, *order: Column, name: str = "new_id") -> DataFrame:
    """``df`` with dense ids ``prefix || first``, ``prefix || first + 1``, ... in the order of ``order``."""
    return numbered(df, *order, name="__nth").withColumn(name, F.concat(F.lit(prefix), (F.col("__nth") + F.lit(first)).cast("string"))).drop("__nth")
