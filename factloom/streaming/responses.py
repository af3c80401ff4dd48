"""Responses as they arrive in a folder."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.sources.jsonl import responses
from factloom.sources.store import Store


def stream_responses(
    spark: SparkSession, folder: str, checkpoint: str, store: Store, stage: str, apply: Callable[[dict[str, DataFrame], DataFrame], object], files_per_trigger: int = 100
) -> StreamingQuery:
    """Apply the answers in ``folder`` to the store, file by file, each micro-batch once.

    ``apply(state, responses)`` gives the Delta. The batch's number is recorded in the snapshot with its changes, so one
    that is given again after a crash changes nothing. Numbers count from 0 in each checkpoint folder, so they are recorded with
    the id that the folder holds: a new folder's batches are new.
    """
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(folder)

    def each(batch: DataFrame, number: int) -> None:
        ident = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]
        name = f"{stage}/{ident}/{number}"
        if not store.was_applied(name):
            store.apply(apply(store.state(), responses(batch)), name)

    return lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(spark: SparkSession, folder: str, schema, watermark: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Facts per window of arrival, as a stream; facts later than the watermark are left out."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.withWatermark("created_at", watermark).groupBy(F.window("created_at", window)).agg(F.count("*").alias("facts"))
