"""The most frequent values of columns with billions of rows, in bounded memory.

Method: a Space-Saving summary of ``counters`` counters per partition, merged in a tree with error bounds, then a
second pass that counts the surviving candidates exactly. A value outside the final summary occurs at most ``floor``
times; if the k-th candidate is not above that, the passes run again with more counters, and at last every value is
counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.runtime import staged

FAN_IN = 32
#: Counters of the first try and of the last; more than the last needs exact counting of all values.
COUNTERS, MOST_COUNTERS = 2_048, 131_072
#: Candidates are broadcast while their texts take no more than this.
BROADCAST_BYTES = 8 << 20
SCHEMA = "field string, value string, upper long, error long, floor long, node int"


class SpaceSaving:
    """Counters with an upper bound and its error for each kept value; any other value occurred at most ``floor`` times."""

    def __init__(self, counters: int):
        self.counters, self.floor, self.kept = counters, 0, {}

    def add(self, values: list, uppers: list[int], errors: list[int], floor: int = 0) -> None:
        """Merge another summary, or exact counts (errors and floor of 0)."""
        kept, own = self.kept, self.floor
        if floor:
            there = set(values)
            for v, (u, e) in kept.items():
                if v not in there:
                    kept[v] = (u + floor, e + floor)
        for v, u, e in zip(values, uppers, errors):
            got = kept.get(v)
            kept[v] = (u + own, e + own) if got is None else (got[0] + u, got[1] + e)
        self.floor = own + floor
        if len(kept) > 2 * self.counters:
            self.shrink()

    def shrink(self) -> None:
        """Keep the largest counters; the largest dropped one bounds every value not kept."""
        if len(self.kept) > self.counters:
            ranked = sorted(self.kept.items(), key=lambda x: (-x[1][0], x[0]))
            self.floor = max(self.floor, ranked[self.counters][1][0])
            self.kept = dict(ranked[: self.counters])

    def frame(self, field: str, node: int) -> pd.DataFrame:
        self.shrink()
        rows = [(field, v, u, e, self.floor, node) for v, (u, e) in self.kept.items()]
        return pd.DataFrame(rows or [(field, None, 0, 0, self.floor, node)], columns=["field", "value", "upper", "error", "floor", "node"])


def summary(df: DataFrame, fields: list[str], counters: int) -> DataFrame:
    """One summary per field: ``field, value, upper, error, floor``; the true count lies in [upper - error, upper]."""
    nodes = df.rdd.getNumPartitions()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own = {f: SpaceSaving(counters) for f in fields}
        for batch in batches:
            for i, f in enumerate(fields):
                counts = pc.value_counts(batch.column(i).drop_null())
                n = counts.field("counts").to_pylist()
                own[f].add(counts.field("values").to_pylist(), n, [0] * len(n))
        for f in fields:
            yield pa.RecordBatch.from_pandas(own[f].frame(f, part).astype({"node": "int32"}), preserve_index=False)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = SpaceSaving(counters)
        for _, one in pdf.groupby("node"):
            real = one[one["value"].notna()]
            whole.add(real["value"].tolist(), real["upper"].tolist(), real["error"].tolist(), int(one["floor"].iat[0]))
        return whole.frame(pdf["field"].iat[0], int(pdf["node"].iat[0]) // FAN_IN)

    level = df.select(*fields).mapInArrow(count, SCHEMA)
    while True:
        level = level.groupBy("field", F.floor(F.col("node") / FAN_IN).alias("__up")).applyInPandas(merge, SCHEMA)
        nodes = -(-nodes // FAN_IN)
        if nodes <= 1:
            return level.drop("node")


def most_frequent(df: DataFrame, fields: list[str], k: int = 10, counters: int = COUNTERS) -> DataFrame:
    """``field, value, rank, count, approx, error`` of the ``k`` most frequent values of each string column.

    ``count`` is exact, ``approx`` the summary's count (at least ``count``, at most ``error`` above it). Nulls don't
    count; ties go by the value's UTF-8 bytes; fewer than ``k`` distinct values give fewer rows, an empty table none.
    Where the summaries can't tell which values are the ``k`` most frequent, all values are counted, and ``approx`` is
    then exact.
    """
    source = df.select(*[F.col(f).cast("string").alias(f) for f in fields])
    long = source.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")).select("x.*").filter("value is not null")
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("count"), "value"))
    while counters <= MOST_COUNTERS:
        found = staged(summary(source, fields, counters))
        floors = {r["field"]: r["floor"] for r in found.groupBy("field").agg(F.max("floor").alias("floor")).collect()}
        candidates = found.filter("value is not null").select("field", "value", F.col("upper").alias("approx"), "error")
        size = candidates.agg(F.coalesce(F.sum(F.octet_length("value") + 32), F.lit(0))).first()[0]
        small = F.broadcast(candidates) if size <= BROADCAST_BYTES else candidates
        exact = long.join(small, ["field", "value"]).groupBy("field", "value").agg(F.count("*").alias("count"), F.first("approx").alias("approx"), F.first("error").alias("error"))
        top = staged(exact.withColumn("rank", rank).filter(F.col("rank") <= k))
        least = {r["field"]: (r["least"], r["n"]) for r in top.groupBy("field").agg(F.min("count").alias("least"), F.count("*").alias("n")).collect()}
        # a value that isn't a candidate has at most floor rows: certain if the k-th has more, or if none was ever dropped
        if all(f == 0 or (least.get(x, (0, 0))[1] == k and least[x][0] > f) for x, f in floors.items()):
            return top
        counters *= 8
    exact = long.groupBy("field", "value").agg(F.count("*").alias("count"))
    return exact.withColumn("rank", rank).filter(F.col("rank") <= k).select("field", "value", "count", F.col("count").alias("approx"), F.lit(0).cast("long").alias("error"), "rank")
