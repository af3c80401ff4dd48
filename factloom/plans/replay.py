"""A small scripted knowledge base, built round by round."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.engine import Engine, Limits
from factloom.operators import queues
from factloom.operators.vectors import HashEmbedder
from factloom.responder import FolderBatches, ReplayResponder
from factloom.runtime import remove, shared_dir, staged
from factloom.schema import JOBS
from factloom.sources.store import Store


def script() -> list[tuple[str, str, str | None]]:
    """Answers by stage and item: one person with a class, a place that becomes an entity, a date and a second fact."""
    facts = [("Ada", "instanceOf", "human"), ("Ada", "bornIn", "Port Vell"), ("Ada", "birthYear", "1815"), ("Ada", "bornIn", "Port Vell")]
    text = json.dumps({"facts": [{"subject": s, "predicate": p, "object": o} for s, p, o in facts]})
    ner = [("T1", True), ("T2", False), ("T3", True)]
    return [
        ("elicitation", "E0", text),
        ("elicitation", "E1", "not json"),
        *[("ner", t, json.dumps({"phrase": "x", "is_ne": v})) for t, v in ner],
        *[(stage, t, "F") for stage in ("ned1", "ned2", "pd") for t in ("T1", "T2", "T3")],
        *[("nedg", t, "Description: A harbour.") for t in ("T1", "T3")],
        *[("pdg", t, f"Description: {about}") for t, about in (("T1", "Where one was born."), ("T2", "When one was born."), ("T3", "Where one was born."))],
        ("cd", "T0", "A"),
    ]


def replayed(spark: SparkSession, rounds: int = 3, batchwise: bool = False) -> DataFrame:
    """The facts after ``rounds`` rounds; ``batchwise`` with batches in folders, each answered between two rounds."""
    root = f"{shared_dir(spark)}/factloom-replay-{uuid.uuid4().hex}"
    store = Store(spark, f"{root}/store")
    store.create()
    embedder = HashEmbedder()
    store.seed("Ada", "A mathematician.", embedder)
    answers = ReplayResponder(spark.createDataFrame(script(), "stage string, custom_id string, text string"))
    stage_of = {job: stage for stage, (job, _, _) in JOBS.items()}
    client = FolderBatches(spark, f"{root}/batches")
    engine = Engine(store, answers, embedder, Limits(idle_rounds=1), client, batchwise)
    for _ in range(rounds):
        engine.round()
        for r in queues.in_process(store.read("batch_job")).collect():
            client.finish(r["id"], stage_of[r["job_type"]], answers)
    if batchwise:
        engine.poll()
    found = store.read("triple").select("triple_id", "predicate_label", "predicate_id", "predicate_status", "object_label", "object_id", "object_type", "object_status", F.col("object_description"))
    found = staged(found)
    remove(spark, root)
    return found
