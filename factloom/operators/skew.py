"""Per-key results over ordered rows where a few keys hold most rows.

Method: exact offset chunking. Keys are counted per input partition, the counts are summed into offsets in partition
order, every row gets its exact number within its key, keys are cut into chunks of equal size, chunks are processed in
parallel and their ordered boundary states merged. No task ever holds more than one chunk of a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.runtime import parallelism, staged

#: Offsets are broadcast up to this many rows (heavy keys times input partitions), else joined by a shuffle.
BROADCAST_OFFSETS = 200_000
#: A chunk has at least so many rows, for the cost of a chunk's state.
LEAST_CHUNK_ROWS = 4_096


def numbered_in_partition(df: DataFrame) -> DataFrame:
    """Add ``__part``, the input partition, and ``__nth``, the row's number within partition and ``__key``, from 0.

    Null is a key of its own. Rows are numbered as they stream by; memory holds one counter per key of the partition.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__nth", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("__key")
            coded = batch.column(at).dictionary_encode(null_encoding="encode")
            codes, keys = np.asarray(coded.indices), coded.dictionary.to_pylist()
            nth = pd.Series(codes).groupby(codes).cumcount().to_numpy()
            nth = nth + np.array([seen.get(k, 0) for k in keys], dtype=np.int64)[codes]
            for k, n in zip(keys, np.bincount(codes, minlength=len(keys)).tolist()):
                seen[k] = seen.get(k, 0) + n
            columns = [*batch.columns, pa.array(np.full(len(codes), part, dtype=np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__part", "__nth"])

    return df.mapInArrow(number, schema)


def offset_chunks(df: DataFrame, key: Column, chunk_rows: int | None = None) -> DataFrame:
    """``df`` with ``__key``, ``__no`` (exact number of the row within its key, in input order) and ``__chunk``.

    The rows are read twice, in the same partitions: an input that is shuffled before, and may fall into others the next time, is
    written once. ``chunk_rows`` defaults to a quarter of an even share of the rows per shuffle partition, so keys of more than
    one chunk number at most four times the partitions.
    """
    spark = df.sparkSession
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        df = staged(df)
    keyed = df.withColumn("__key", key)
    counts = staged(
        keyed.select("__key", F.spark_partition_id().alias("__part")).groupBy("__key", "__part").agg(F.count("*").alias("__n"))
    )
    if chunk_rows is None:
        total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        chunk_rows = max(LEAST_CHUNK_ROWS, total // (4 * parallelism(spark)))
    heavy = counts.groupBy("__key").agg(F.sum("__n").alias("__all")).filter(F.col("__all") > chunk_rows).select("__key")
    order = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.alias("c")
        .join(heavy.alias("h"), F.col("c.__key").eqNullSafe(F.col("h.__key")), "left_semi")
        .select(F.col("__key").alias("__okey"), F.col("__part").alias("__opart"), F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__before"))
    )
    offsets = staged(offsets)
    if offsets.count() <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    rows = numbered_in_partition(keyed)
    on = F.col("__key").eqNullSafe(F.col("__okey")) & (F.col("__part") == F.col("__opart"))
    # light keys have one chunk; their rows are in order by partition and number within it
    no = F.coalesce(F.col("__before") + F.col("__nth"), F.shiftleft(F.col("__part").cast("long"), 40) + F.col("__nth"))
    chunk = F.when(F.col("__before").isNotNull(), F.floor((F.col("__before") + F.col("__nth")) / F.lit(chunk_rows))).otherwise(F.lit(0))
    return rows.join(offsets, on, "left").withColumn("__no", no).withColumn("__chunk", chunk.cast("long")).drop("__okey", "__opart", "__before", "__nth", "__part")


def key_profile(df: DataFrame, key: str, ident: str, state: str, at: str, chunk_rows: int | None = None) -> DataFrame:
    """Per value of ``key``: what its rows look like in input order.

    ``rows``; ``first_id`` and ``last_id``, the ``ident`` of its first and last row; ``state_runs``, the number of
    maximal runs of equal ``state``; ``late_rows``, rows with an earlier ``at`` than the row just before them;
    ``chunks`` it was cut into. Null keys make one group; null states are equal to each other; a null ``at`` is never
    late. An empty table gives no rows. Rows repeated count each time they occur.
    """
    rows = offset_chunks(df.select(*dict.fromkeys([key, ident, state, at])), F.col(key), chunk_rows)
    within = Window.partitionBy("__key", "__chunk").orderBy("__no")
    flagged = rows.select(
        "__key",
        "__chunk",
        "__no",
        F.col(ident).alias("__id"),
        F.col(state).alias("__state"),
        F.col(at).alias("__at"),
        F.lag(F.lit(True)).over(within).isNull().alias("__first"),
        (~F.col(state).eqNullSafe(F.lag(state).over(within))).alias("__turn"),
        F.coalesce(F.col(at) < F.lag(at).over(within), F.lit(False)).alias("__late"),
    )
    edge = F.struct("__id", "__state", "__at")
    states = flagged.groupBy("__key", "__chunk").agg(
        F.count("*").alias("__rows"),
        F.count_if(F.col("__turn") | F.col("__first")).alias("__runs"),
        F.count_if("__late").alias("__lates"),
        F.min_by(edge, "__no").alias("__head"),
        F.max_by(edge, "__no").alias("__tail"),
    )
    order = Window.partitionBy("__key").orderBy("__chunk")
    before = states.withColumn("__prev", F.lag("__tail").over(order))
    joined = F.col("__prev").isNotNull()
    merged = before.select(
        "__key",
        "__chunk",
        "__rows",
        (F.col("__runs") - (joined & F.col("__head.__state").eqNullSafe(F.col("__prev.__state"))).cast("int")).alias("__runs"),
        (F.col("__lates") + F.coalesce(F.col("__head.__at") < F.col("__prev.__at"), F.lit(False)).cast("int")).alias("__lates"),
        "__head",
        "__tail",
    )
    return merged.groupBy(F.col("__key").alias("label")).agg(
        F.sum("__rows").alias("rows"),
        F.min_by("__head.__id", "__chunk").alias("first_id"),
        F.max_by("__tail.__id", "__chunk").alias("last_id"),
        F.sum("__runs").alias("state_runs"),
        F.sum("__lates").alias("late_rows"),
        F.count("*").alias("chunks"),
    )


def heavy_keys(df: DataFrame, key: str, share: float = 0.05, chunk_rows: int | None = None) -> DataFrame:
    """Values of ``key`` that hold at least ``share`` of all rows, repeated rows included, with their ``rows``.

    Values are compared character for character. Null is no value, but its rows count in the total.
    """
    rows = offset_chunks(df.select(key), F.col(key), chunk_rows)
    states = rows.groupBy("__key", "__chunk").agg(F.count("*").alias("__n"))
    per_key = states.groupBy(F.col("__key").alias("label")).agg(F.sum("__n").alias("rows"))
    total = per_key.agg(F.sum("rows").alias("__total"))
    return (
        per_key.crossJoin(F.broadcast(total))  # one row
        .filter(F.col("label").isNotNull() & (F.col("rows") >= F.lit(share) * F.col("__total")))
        .select("label", "rows")
    )
