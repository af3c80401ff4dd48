"""Who answers requests."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLES = {"elicitation": ["elicitation"], "disambiguation": ["ner", "ned1", "ned2", "pd", "cd"], "description": ["nedg", "pdg", "cdg"]}


def role_of(stage: str) -> str:
    return next(role for role, stages in ROLES.items() if stage in stages)


def check_roles(config: dict[str, dict]) -> None:
    """Every role must be configured, and no other."""
    if unknown := sorted(set(config) - set(ROLES)):
        raise ValueError(f"unknown roles: {', '.join(unknown)}")
    if missing := sorted(set(ROLES) - set(config)):
        raise ValueError(f"roles without a backend: {', '.join(missing)}")


class Responder(Protocol):
    """Answers to requests ``custom_id, request``: ``custom_id, text``, with a null text where none came."""

    def answer(self, stage: str, requests: DataFrame) -> DataFrame: ...


class ReplayResponder:
    """Answers from a table ``stage, custom_id, text``."""

    def __init__(self, answers: DataFrame):
        self.answers = answers

    def answer(self, stage: str, requests: DataFrame) -> DataFrame:
        own = self.answers.filter(F.col("stage") == stage).select("custom_id", "text").dropDuplicates(["custom_id"])
        return requests.select("custom_id").join(own, "custom_id", "left")


class RateLimited(Exception):
    """The service asks to wait."""


class CallResponder:
    """Answers by calling a function of one request line, a bounded number at a time on each partition.

    A call that is RateLimited waits, twice as long each time, and is tried again; one that fails otherwise, or too often, has a null
    text.
    """

    def __init__(self, call: Callable[[str], str], workers: int = 16, tries: int = 3, wait: float = 2.0):
        self.call, self.workers, self.tries, self.wait = call, workers, tries, wait

    def answer(self, stage: str, requests: DataFrame) -> DataFrame:
        call, workers, tries, wait = self.call, self.workers, self.tries, self.wait

        def one(request: str) -> str | None:
            for n in range(tries):
                try:
                    return call(request)
                except RateLimited:
                    if n < tries - 1:
                        time.sleep(wait * 2**n)
                except Exception:
                    return None
            return None

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            with ThreadPoolExecutor(workers) as pool:
                for pdf in frames:
                    yield pd.DataFrame({"custom_id": pdf["custom_id"], "text": list(pool.map(one, pdf["request"]))})

        return requests.select("custom_id", "request").mapInPandas(run, "custom_id string, text string")


class RoutedResponder:
    """A responder for each role; a stage is answered by that of its role."""

    def __init__(self, responders: dict[str, Responder]):
        check_roles(responders)
        self.responders = responders

    def answer(self, stage: str, requests: DataFrame) -> DataFrame:
        return self.responders[role_of(stage)].answer(stage, requests)


class BatchClient(Protocol):
    """A service that takes batches of request lines and answers them later."""

    def create(self, stage: str, lines: DataFrame) -> str:
        """Hand in lines (column ``value``); the id of the batch."""

    def retrieve(self, batch: str) -> str:
        """The status of a batch. May raise."""

    def output(self, batch: str) -> DataFrame:
        """The response lines (column ``value``), none where there is no output."""


class FolderBatches:
    """Batches as folders: ``input`` holds the request lines, ``status`` (a text file) and ``output`` are written by whoever
    answers. Serves offline, and any service with a courier between it and the folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{path}"))

    def create(self, stage: str, lines: DataFrame) -> str:
        batch = f"{stage}-{uuid.uuid4().hex[:12]}"
        lines.select("value").write.text(f"{self.root}/{batch}/input")
        return batch

    def retrieve(self, batch: str) -> str:
        if not self._there(batch):
            raise LookupError(f"no batch {batch}")
        if not self._there(f"{batch}/status"):
            return "in_progress"
        return self.spark.read.text(f"{self.root}/{batch}/status", wholetext=True).first()[0].strip()

    def output(self, batch: str) -> DataFrame:
        if not self._there(f"{batch}/output"):
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.text(f"{self.root}/{batch}/output")

    def finish(self, batch: str, stage: str, responder: Responder, status: str = "completed") -> None:
        """Answer a batch by a responder: what a service would do."""
        lines = self.spark.read.text(f"{self.root}/{batch}/input")
        asked = lines.select(F.get_json_object("value", "$.custom_id").alias("custom_id"), F.col("value").alias("request"))
        content = F.array(F.struct(F.lit("output_text").alias("type"), F.col("text").alias("text")))
        message = F.array(F.struct(F.lit("message").alias("type"), content.alias("content")))
        line = F.to_json(F.struct("custom_id", F.struct(F.struct(message.alias("output")).alias("body")).alias("response")))
        responder.answer(stage, asked).filter(F.col("text").isNotNull()).select(line.alias("value")).write.text(f"{self.root}/{batch}/output")
        stream = self._fs.create(self._path(f"{self.root}/{batch}/status"), True)
        stream.write(bytearray(status.encode()))
        stream.close()


def load_config(path: str) -> dict[str, dict]:
    """Backends by role from a JSON file; every role must be there, and no other."""
    with open(path) as file:
        config = json.load(file)
    check_roles(config)
    return config
