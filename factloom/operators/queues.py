"""Work queues: which items a stage may take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import num, numbered
from factloom.schema import IN_PROCESS, JOBS, once


def ready_condition(stage: str) -> Column:
    """The rows that wait for a stage, of the table in READY."""
    c = F.col
    named = c("object_type") == "ne"
    return {
        "elicitation": c("status") == "unexplored",
        "ner": (c("object_type") == "unrecognized") & (c("object_status") == "generated") & c("predicate_status").isin("pd_finished", "ondg", "finished"),
        "ned1": named & (c("object_status") == "ner_finished"),
        "ned2": named & (c("object_status") == "dg_finished") & c("object_description").isNotNull(),
        "nedg": named & (c("object_status") == "ned_finished1"),
        "pd": c("predicate_status") == "generated",
        "pdg": c("predicate_status") == "pd_finished",
        "cd": c("status") == "generated",
        "cdg": c("status") == "cd_finished",
    }[stage]


#: Table and key of each stage's items.
READY = {"elicitation": ("entity", "id"), "cd": ("instance_triple", "original_triple_id"), "cdg": ("instance_triple", "original_triple_id")} | {
    s: ("triple", "triple_id") for s in ("ner", "ned1", "ned2", "nedg", "pd", "pdg")
}


def ready(df: DataFrame, stage: str, limit: int | None = None) -> DataFrame:
    """The items of ``stage``, each once; the first ``limit`` by number where one is given."""
    key = READY[stage][1]
    found = once(df.filter(ready_condition(stage)), key)
    return found if limit is None else found.orderBy(num(F.col(key)), key).limit(limit)


def chunked(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` with ``batch_no``: items in the order of their number, ``size`` to a batch."""
    return numbered(df, num(F.col(key)), F.col(key), name="__nth").withColumn("batch_no", F.floor(F.col("__nth") / size)).drop("__nth")


def in_process(batches: DataFrame) -> DataFrame:
    """Batches that are still under way."""
    return once(batches.filter(F.col("status").isin(*IN_PROCESS)), "id")


def holding_items(batches: DataFrame, items: dict[str, DataFrame], status: str = "cancelled") -> DataFrame:
    """``id, job_type`` of batches of a status that items still refer to."""
    stopped = once(batches.filter(F.col("status") == status), "id").select("id", "job_type")
    parts = []
    for stage, (job, column, _) in JOBS.items():
        held = items[READY[stage][0]].select(F.col(column).alias("id")).dropna()
        parts.append(stopped.filter(F.col("job_type") == job).join(held, "id", "left_semi"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def gates(batches: DataFrame) -> DataFrame:
    """``gate, open``: a gate is closed while a batch of its group is under way."""
    groups = [(job, group) for job, _, group in JOBS.values() if group]
    of = F.create_map(*[F.lit(x) for pair in groups for x in pair])
    active = in_process(batches).select(of[F.col("job_type")].alias("gate")).dropna().groupBy("gate").agg(F.count("*").alias("n"))
    every = batches.sparkSession.createDataFrame([(g,) for g in ("NED", "PD", "CD")], "gate string")
    return every.join(active, "gate", "left").select("gate", F.col("n").isNull().alias("open"))


def batch_counts(batches: DataFrame) -> DataFrame:
    """Batches per job type and status."""
    return once(batches, "id").groupBy("job_type", "status").agg(F.count("*").alias("n"))
