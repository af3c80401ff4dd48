"""Model answers to outcomes, as column expressions: a bad line fails alone, never its batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BODY = "output array<struct<type:string,content:array<struct<type:string,text:string>>>>, usage struct<prompt_tokens:bigint,completion_tokens:bigint,input_tokens:bigint,output_tokens:bigint>"
LINE = f"custom_id string, response struct<body:struct<{BODY.replace('output array', 'output:array').replace(', usage struct', ',usage:struct')},choices:array<struct<message:struct<content:string>>>,model:string>>"
FACTS = "facts array<struct<subject:string,predicate:string,object:string>>"
MARKER = "Description: "


def strip_think(text: Column) -> Column:
    """The text without think blocks and outer white space."""
    return trim_white(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))


def trim_white(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def message_text(body: Column) -> Column:
    """The first output text of the first message that has one, null if none has (``body`` is a struct of BODY)."""
    messages = F.filter(body["output"], lambda m: m["type"] == "message")
    texts = F.flatten(F.transform(messages, lambda m: F.filter(F.coalesce(m["content"], F.array().cast("array<struct<type:string,text:string>>")), lambda c: c["type"] == "output_text")))
    return F.try_element_at(texts, F.lit(1))["text"]


def response_text(line: Column) -> Column:
    """The answer text of a response line of either make: its first choice, or else its first message."""
    read = F.from_json(line, LINE)
    chat = F.try_element_at(read["response"]["body"]["choices"], F.lit(1))["message"]["content"]
    return F.when(F.size(read["response"]["body"]["choices"]) > 0, strip_think(chat)).otherwise(message_text(read["response"]["body"]))


def custom_id(line: Column, unknown: str) -> Column:
    """The id a response line is for, ``unknown`` where it has none."""
    return F.coalesce(F.from_json(line, LINE)["custom_id"], F.lit(unknown))


def option(text: Column, last: str, unsure: str | None = None) -> Column:
    """The one option letter from A to ``last`` in the text: ``pick`` 1.. of it, ``none`` or ``unsure``.

    ``last`` but for ``unsure`` is "none of these"; so are no letter and several. Returns ``struct<outcome, choice>``.
    """
    letters = F.array_distinct(F.regexp_extract_all(F.upper(trim_white(text)), F.lit(rf"(?U)\b([A-{last}])\b"), F.lit(1)))
    one = F.when(F.size(letters) == 1, F.try_element_at(letters, F.lit(1)))
    none = "F"
    outcome = (
        F.when(text.isNull(), F.lit("failed"))
        .when(one == (unsure or "?"), F.lit("unsure"))
        .when(one.isNull() | (one == none), F.lit("none"))
        .otherwise(F.lit("pick"))
    )
    return F.struct(outcome.alias("outcome"), F.when(outcome == "pick", F.ascii(one) - 64).alias("choice"))


def ned1_option(text: Column) -> Column:
    """A to E pick, F none, G unsure."""
    return option(text, "G", "G")


def ned2_option(text: Column) -> Column:
    """A to E pick, F none."""
    return option(text, "F")


def pd_option(text: Column) -> Column:
    """A to E and G pick (G, the seventh, is always out of range), F none; for predicates and classes."""
    return option(text, "G")


def description(text: Column) -> Column:
    """The text after the marker, up to a second one, or the text itself; not trimmed."""
    return F.when(F.startswith(text, F.lit(MARKER)), F.get(F.split(text, MARKER), F.lit(1))).otherwise(text)


def facts(df: DataFrame, ident: str, text: str) -> DataFrame:
    """``subject_id, subject, predicate, object, place`` of each complete fact; null counts as missing."""
    read = df.select(F.col(ident).alias("subject_id"), F.from_json(text, FACTS)["facts"].alias("facts"))
    rows = read.select("subject_id", F.posexplode("facts").alias("place", "f"))
    whole = F.col("f.subject").isNotNull() & F.col("f.predicate").isNotNull() & F.col("f.object").isNotNull()
    return rows.filter(whole).select("subject_id", "f.subject", "f.predicate", "f.object", "place")


def failed_facts(df: DataFrame, ident: str, text: str) -> DataFrame:
    """Ids of answers that hold no list of facts."""
    return df.filter(F.from_json(text, FACTS)["facts"].isNull()).select(ident)


def ner(text: Column) -> Column:
    """``struct<phrase, is_ne>``; both null unless both are there. Any value but false, 0, null and empty ones is true."""
    read = F.try_parse_json(text)
    phrase = F.try_variant_get(read, "$.phrase", "string")
    raw = F.try_variant_get(read, "$.is_ne", "string")
    kind = F.schema_of_variant(F.try_variant_get(read, "$.is_ne", "variant"))
    false = (
        ((kind == "BOOLEAN") & (raw == "false"))
        | ((kind == "STRING") & (raw == ""))
        | raw.isin("[]", "{}")
        | (~kind.isin("BOOLEAN", "STRING") & (raw.try_cast("double") == 0))
        | (kind == "VOID")
    )
    there = phrase.isNotNull() & kind.isNotNull()
    return F.when(there, F.struct(phrase.alias("phrase"), (~F.coalesce(false, F.lit(False))).alias("is_ne")))


def tokens_used(df: DataFrame, line: str) -> DataFrame:
    """One row: answers, prompt tokens and completion tokens."""
    usage = F.from_json(line, LINE)["response"]["body"]["usage"]
    return df.select(usage.alias("u")).agg(
        F.count("*").alias("answers"),
        F.coalesce(F.sum("u.prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("u.completion_tokens"), F.lit(0)).alias("completion_tokens"),
    )
