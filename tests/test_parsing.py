"""Answers and requests."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factloom.functions import parsing, prompts
from factloom.sources import jsonl


def values(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(f(F.col("t"))).collect()]


@pytest.mark.parametrize(
    ("text", "ned1", "ned2", "pd"),
    [
        ("B", ("pick", 2), ("pick", 2), ("pick", 2)), (" b. ", ("pick", 2),) + (("pick", 2),) * 2, ("A or B", ("none", None),) + (("none", None),) * 2,
        ("F", ("none", None),) + (("none", None),) * 2, ("G", ("unsure", None), ("none", None), ("pick", 7)), ("", ("none", None),) + (("none", None),) * 2,
        ("ÉA B.", ("pick", 2),) + (("pick", 2),) * 2, ("B b B", ("pick", 2),) + (("pick", 2),) * 2, (None, ("failed", None),) + (("failed", None),) * 2,
    ],
)
def test_options(spark, text, ned1, ned2, pd):
    for f, want in ((parsing.ned1_option, ned1), (parsing.ned2_option, ned2), (parsing.pd_option, pd)):
        assert tuple(values(spark, [text], f)[0]) == want


def test_description(spark):
    texts = ["Description: a", "Description: aDescription: b", "b Description: c", "", " Description: x", "Description: "]
    assert values(spark, texts, parsing.description) == ["a", "a", "b Description: c", "", " Description: x", ""]


def test_think(spark):
    assert values(spark, ["<think>a\nb</think>  c\t", "x<think>1</think>y<think>2</think>"], parsing.strip_think) == ["c", "xy"]


def test_facts(spark):
    texts = [
        json.dumps({"facts": [{"subject": "s", "predicate": "p", "object": "o"}, {"subject": "s", "predicate": "p"}, {"subject": "s", "predicate": None, "object": "o"}, {"subject": "s", "predicate": "n", "object": 5}]}),
        '{"facts": []}', '{"facts": 3}', "no json", None, "{}",
    ]
    df = spark.createDataFrame([(f"E{i}", t) for i, t in enumerate(texts)], "id string, t string")
    assert sorted((r["subject_id"], r["predicate"], r["object"]) for r in parsing.facts(df, "id", "t").collect()) == [("E0", "n", "5"), ("E0", "p", "o")]
    assert sorted(r["id"] for r in parsing.failed_facts(df, "id", "t").collect()) == ["E2", "E3", "E4", "E5"]


def test_ner(spark):
    truth = {"true": True, "false": False, '"false"': True, '""': False, "0": False, "0.0": False, "2": True, "null": False, "[]": False, "{}": False, "[0]": True}
    got = values(spark, [f'{{"phrase": "x", "is_ne": {v}}}' for v in truth], parsing.ner)
    assert [r["is_ne"] for r in got] == list(truth.values())
    assert values(spark, ['{"phrase": "x"}', '{"is_ne": true}', "x", None, ""], parsing.ner) == [None] * 5


def line(*output, ident="T1"):
    return json.dumps({"custom_id": ident, "response": {"body": {"output": list(output)}}})


def message(*texts, kind="message"):
    return {"type": kind, "content": [{"type": "output_text", "text": t} for t in texts]}


def test_message_text(spark):
    lines = [line(message("no", kind="reasoning"), message("yes", "second")), line(message(), message("later")), line(), "broken", line({"type": "message"}, message("after null"))]
    assert values(spark, lines, parsing.response_text) == ["yes", "later", None, None, "after null"]


def test_chat_lines_become_response_lines(spark):
    chat = json.dumps({"custom_id": "T2", "response": {"body": {"choices": [{"message": {"content": "<think>x</think> B"}}], "model": "m"}}})
    plain = line(message("A"))
    df = spark.createDataFrame([(chat,), (plain,)], "value string").select(jsonl.normalised(F.col("value")).alias("value"))
    assert [tuple(r) for r in jsonl.responses(df).collect()] == [("T2", "B"), ("T1", "A")]
    assert df.collect()[1]["value"] == plain


def test_unknown_ids_and_tokens(spark):
    text = json.dumps({"response": {"body": {"usage": {"prompt_tokens": 3, "completion_tokens": 4}}}})
    df = spark.createDataFrame([(text,), ("x",)], "value string")
    assert [r[0] for r in df.select(parsing.custom_id(F.col("value"), "U")).collect()] == ["U", "U"]
    assert tuple(parsing.tokens_used(df, "value").first()) == (2, 3, 4)


def test_requests(spark, tmp_path):
    df = spark.createDataFrame([("T1", "s", "p", "o")], "id string, s string, p string, o string")
    two = F.array(*[F.struct(F.lit(x).alias("label"), F.lit(None).cast("string").alias("description")) for x in "xy"])
    user = prompts.ned1(F.col("s"), F.col("p"), F.col("o"), two)
    lines = df.select(prompts.request("ned1", F.col("id"), user, "m").alias("value"))
    body = json.loads(lines.first()[0])
    assert body["custom_id"] == "T1" and body["body"]["max_output_tokens"] == 128
    assert body["body"]["input"][1]["content"].endswith('A. Entity: "x" ()\nB. Entity: "y" ()\nF. None of above.\nG. Unsure')
    jsonl.write_requests(lines, str(tmp_path / "out"))
    assert jsonl.read_lines(spark, str(tmp_path / "out")).first()[0] == lines.first()[0]
    chat = json.loads(lines.select(prompts.chat_request(F.col("value"), merge_system=True)).first()[0])
    assert [m["role"] for m in chat["body"]["messages"]] == ["user"] and chat["body"]["max_tokens"] == 128
