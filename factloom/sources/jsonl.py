"""Requests and responses as lines of JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.parsing import custom_id, response_text, strip_think


def write_requests(lines: DataFrame, path: str, column: str = "value") -> None:
    """One request a line."""
    lines.select(F.col(column).alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines of all files in a folder."""
    return spark.read.text(path)


def responses(lines: DataFrame, unknown: str = "UNKNOWN") -> DataFrame:
    """``custom_id, text`` of response lines of either make; a line that can't be read has a null text."""
    return lines.select(custom_id(F.col("value"), unknown).alias("custom_id"), response_text(F.col("value")).alias("text"))


def normalised(line: Column) -> Column:
    """A chat response line as a response line; a line without choices passes through."""
    read = F.from_json(line, "custom_id string, response struct<body:struct<choices:array<struct<message:struct<content:string>>>,model:string,usage:struct<prompt_tokens:bigint,completion_tokens:bigint>>>")
    body = read["response"]["body"]
    text = strip_think(F.coalesce(F.try_element_at(body["choices"], F.lit(1))["message"]["content"], F.lit("")))
    content = F.array(F.struct(F.lit("output_text").alias("type"), text.alias("text")))
    message = F.array(F.struct(F.lit("message").alias("type"), F.lit("assistant").alias("role"), content.alias("content")))
    new = F.struct(read["custom_id"].alias("custom_id"), F.struct(F.struct(body["model"].alias("model"), message.alias("output"), body["usage"].alias("usage")).alias("body")).alias("response"))
    return F.when(F.size(body["choices"]) > 0, F.to_json(new)).otherwise(line)
