"""Records that differ in formatting only: one record each, with the number of copies.

Method: canonical records are range-partitioned and externally sorted, then adjacent runs are scanned comparing full
keys. The record number is part of the sort order, so a group that holds a third of all rows spreads over many
partitions; one boundary state per partition joins the runs that cross.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.runtime import parallelism, staged

#: Separators of parts whose order doesn't matter.
PARTS = "[,;/|]"
#: White space and punctuation, which don't matter inside a part: Unicode's, and the ASCII symbols that are punctuation in print.
NOISE = r"[\s\p{Z}\p{C}\p{P}$+<=>^`|~]+"


def canonical(label: Column) -> Column:
    """The label without white space, letter case, punctuation and order of parts; null stays null.

    A label of nothing but punctuation and white space is its own canonical form, without its white space.
    """
    parts = F.transform(F.split(F.lower(label), PARTS), lambda p: F.regexp_replace(p, NOISE, ""))
    joined = F.array_join(F.array_sort(F.filter(parts, lambda p: p != "")), "\u0001")
    return F.when(joined == "", F.concat(F.lit("\u0002"), F.regexp_replace(label, r"[\s\p{Z}\p{C}]+", ""))).otherwise(joined)


def number(ident: Column) -> Column:
    """The digits of an id as a number, null where it has none."""
    return F.regexp_replace(ident, r"\D", "").try_cast("long")


def runs(records: DataFrame, keys: list[str], num: str, singles: bool = True) -> DataFrame:
    """For each record of ``records`` the least number of its group: ``keys``... , ``first_num``, ``copy_num``.

    Records with equal ``keys`` are one group; rows of one group with equal ``num`` are one record. Groups of one are
    left out unless ``singles``. A row with a null key or number has nothing it equals and is left out. Each ``keys``
    column must be a string. An empty table gives no rows.
    """
    spark = records.sparkSession
    # written once, as the range partitioning reads its input twice and keys are costly to make
    whole = staged(records.select(*keys, F.col(num).cast("long").alias("__num")).dropna())
    # the key columns of the sort are the full keys: a hash would only move the comparison
    ordered = whole.repartitionByRange(parallelism(spark), *keys, "__num").sortWithinPartitions(*keys, "__num")
    schema = ", ".join([*(f"`{k}` string" for k in keys), "__part int, __edge int, first_num long, copy_num long"])

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        key_now: tuple | None = None  # of the run that is open
        first_num, last_num, lead, count, held = 0, -1, True, 0, []

        def close(final: bool) -> Iterator[pd.DataFrame]:
            edge = (1 if lead else 0) + (2 if final else 0)
            # held are the first rows of the run, not yet given out as it could be a group of one
            if held and (singles or edge or count > 1):
                yield frame(key_now, held, first_num, edge)

        def frame(key: tuple, nums: list, first: int, edge: int) -> pd.DataFrame:
            return pd.DataFrame({**dict(zip(keys, key)), "__part": part, "__edge": edge, "first_num": first, "copy_num": nums})

        for pdf in frames:
            if pdf.empty:
                continue
            nums = pdf["__num"].to_numpy()
            same = np.ones(len(pdf), dtype=bool)
            for k in keys:
                v = pdf[k].to_numpy()
                same[1:] &= v[1:] == v[:-1]
            head = tuple(pdf[k].iat[0] for k in keys)
            same[0] = head == key_now
            fresh = ~same
            keep = fresh.copy()
            keep[1:] |= nums[1:] != nums[:-1]
            keep[0] |= nums[0] != last_num
            starts = np.flatnonzero(fresh)
            # the run that was open before this batch goes on until the first start
            until = int(starts[0]) if len(starts) else len(pdf)
            more = nums[:until][keep[:until]].tolist()
            if more:
                count += len(more)
                held += more
                if len(held) > 1 << 16:  # bounded: a long run goes out in pieces, all with the run's first number
                    yield frame(key_now, held[:-1], first_num, 1 if lead else 0)
                    held = held[-1:]  # the end of the partition may come next, and is one row's to tell
            if len(starts):
                if key_now is not None:
                    yield from close(False)
                    lead = False
                bounds = np.append(starts, len(pdf))
                # all runs that begin and end inside this batch, at once
                if len(starts) > 1:
                    inner = slice(int(starts[0]), int(starts[-1]))
                    kept = keep[inner]
                    of = np.cumsum(fresh[inner])[kept] - 1
                    sizes = np.bincount(of, minlength=len(starts) - 1)
                    leads = np.zeros(len(starts) - 1, dtype=np.int32)
                    if key_now is None and lead:
                        leads[0] = 1
                    take = (sizes[of] > 1) | singles | (leads[of] > 0)
                    if take.any():
                        at = np.flatnonzero(kept)[take] + inner.start
                        out = pdf.iloc[at][keys].copy()
                        out["__part"], out["__edge"] = part, leads[of[take]]
                        out["first_num"] = nums[starts[:-1]][of[take]]
                        out["copy_num"] = nums[at]
                        yield out
                    lead = False
                b = int(bounds[-2])
                key_now = tuple(pdf[k].iat[b] for k in keys)
                first_num = int(nums[b])
                held = nums[b:][keep[b:]].tolist()
                count = len(held)
            last_num = int(nums[-1])
        if key_now is not None:
            yield from close(True)

    scanned = staged(ordered.mapInPandas(scan, schema))
    # one state per partition and edge: at most two rows a partition reach the driver
    edges = (
        scanned.filter("__edge > 0")
        .groupBy("__part")
        .agg(
            F.min_by(F.struct(*keys, "first_num"), F.when(F.col("__edge").bitwiseAND(1) > 0, F.lit(0))).alias("head"),
            F.max_by(F.struct(*keys, "first_num"), F.when(F.col("__edge").bitwiseAND(2) > 0, F.lit(1))).alias("tail"),
        )
        .orderBy("__part")
        .collect()
    )
    carried, open_key, open_first = [], None, None
    for e in edges:
        key = tuple(e["head"][: len(keys)])
        if open_key == key:
            carried.append((e["__part"], open_first))
            first = open_first
        else:
            first = e["head"]["first_num"]
        tail = tuple(e["tail"][: len(keys)])
        if tail != key:
            first = e["tail"]["first_num"]
        open_key, open_first = tail, first
    carry = F.broadcast(spark.createDataFrame(carried, "__cpart int, __first long"))  # at most a row a partition
    crossing = (F.col("__part") == F.col("__cpart")) & (F.col("__edge").bitwiseAND(1) > 0)
    found = scanned.join(carry, crossing, "left").withColumn("first_num", F.coalesce("__first", "first_num"))
    if not singles:  # an edge run may have turned out a group of one
        edge_sizes = found.filter("__edge > 0").groupBy(*(F.col(k).alias(f"__g{i}") for i, k in enumerate(keys))).agg(F.count("*").alias("__size")).filter("__size > 1")
        on = None
        for i, k in enumerate(keys):
            c = F.col(k) == F.col(f"__g{i}")
            on = c if on is None else on & c
        found = found.filter("__edge = 0").select(*keys, "first_num", "copy_num").unionByName(
            found.filter("__edge > 0").join(F.broadcast(edge_sizes), on, "left_semi").select(*keys, "first_num", "copy_num")  # edge runs: two a partition
        )
    return found.select(*keys, "first_num", "copy_num")


def collapse(records: DataFrame, keys: list[str], num: str) -> DataFrame:
    """One row per group: ``keys``..., ``first_num`` of its representative and ``copies``, its number of records."""
    members = runs(records, keys, num)
    return members.groupBy(*keys).agg(F.min("first_num").alias("first_num"), F.count("*").alias("copies"))
