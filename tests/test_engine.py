"""The store, the round loop and the stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factloom.engine import Engine, Limits
from factloom.functions import prompts
from factloom.operators.outcomes import apply_nedg
from factloom.operators.vectors import HashEmbedder
from factloom.plans.catalogue import queries
from factloom.plans.replay import replayed
from factloom.responder import CallResponder, FolderBatches, RateLimited, ReplayResponder, RoutedResponder, check_roles, load_config, role_of
from factloom.runtime import shared_dir
from factloom.schema import TABLES
from factloom.sources.store import StaleState, Store
from factloom.streaming.responses import arrivals, stream_responses


def store(spark, path) -> Store:
    s = Store(spark, str(path / "kb"))
    s.create()
    return s


def triple(spark, **values):
    return spark.createDataFrame([{f.name: values.get(f.name) for f in TABLES["triple"]}], TABLES["triple"])


def test_replay_builds_the_knowledge_base(spark):
    rows = {r["triple_id"]: r for r in replayed(spark, 3).collect()}
    assert set(rows) == {"T0", "T1", "T2"}  # T3 repeats T1 and goes
    assert (rows["T1"]["object_id"], rows["T1"]["predicate_id"], rows["T1"]["object_status"]) == ("E1", "P1", "finished")
    assert (rows["T2"]["object_type"], rows["T0"]["object_type"]) == ("literal", "class")


def test_seed_only_into_an_empty_store(spark, tmp_path):
    s = store(spark, tmp_path)
    s.seed("Ada", "x", HashEmbedder())
    assert {r["kind"]: r["vector_count"] for r in s.metadata().collect()} == {"entity": 1, "predicate": 1, "concept": 1}
    with pytest.raises(ValueError):
        s.seed("Ada", "x", HashEmbedder())
    assert s.add_seed("predicate", "partOf", "y", HashEmbedder()) == "P1"


def test_nothing_to_do_stops(spark, tmp_path):
    s = store(spark, tmp_path)
    assert len(Engine(s, ReplayResponder(spark.createDataFrame([], "stage string, custom_id string, text string")), HashEmbedder(), Limits(idle_rounds=2)).run()) == 2


def test_closed_gate_blocks_and_open_gate_resets(spark, tmp_path):
    s = store(spark, tmp_path)
    s.commit({"triple": triple(spark, triple_id="T1", object_type="ne", object_status="onned1", predicate_status="finished")})
    batch = spark.createDataFrame([("b", None, "in_progress", None, "ned_source_triple", None)], TABLES["batch_job"])
    s.commit({"batch_job": batch})
    engine = Engine(s, ReplayResponder(spark.createDataFrame([], "stage string, custom_id string, text string")), HashEmbedder())
    engine.round()
    assert s.read("triple").first()["object_status"] == "onned1"
    s.commit({"batch_job": batch.withColumn("status", F.lit("completed"))})
    engine.reset(("ned1", "nedg", "ned2"))
    assert s.read("triple").first()["object_status"] == "ner_finished"


def test_stream_applies_each_batch_once(spark, tmp_path):
    s = store(spark, tmp_path)
    s.commit({"triple": triple(spark, triple_id="T1", object_type="ne", object_status="ondg")})
    folder = tmp_path / "in"
    folder.mkdir()
    body = {"output": [{"type": "message", "content": [{"type": "output_text", "text": "A harbour."}]}]}
    (folder / "a.jsonl").write_text(json.dumps({"custom_id": "T1", "response": {"body": body}}) + "\n")

    def apply(state, answers):
        found = answers.select(F.col("custom_id").alias("triple_id"), F.when(F.col("text").isNull(), "failed").otherwise("text").alias("outcome"), "text")
        return apply_nedg(state, found)

    for _ in range(2):
        stream_responses(spark, str(folder), str(tmp_path / "check"), s, "nedg", apply).awaitTermination()
    row = s.read("triple").first()
    assert (row["object_status"], row["object_description"]) == ("dg_finished", "A harbour.")
    (source,) = s._current()["applied"]
    version = s.apply(None, f"{source}/0")  # given again: nothing changes
    assert version == s._current()["version"] and s.was_applied(f"{source}/0") and not s.was_applied(f"{source}/1")
    # a new checkpoint counts from 0 again: its answers are new
    s.commit({"triple": triple(spark, triple_id="T1", object_type="ne", object_status="ondg")})
    stream_responses(spark, str(folder), str(tmp_path / "other"), s, "nedg", apply).awaitTermination()
    assert s.read("triple").first()["object_status"] == "dg_finished" and len(s._current()["applied"]) == 2


def test_calls_are_tried_again_and_then_null(spark):
    def call(request: str) -> str:
        if request == "bad":
            raise ValueError
        return request.upper()

    asked = spark.createDataFrame([("T1", "a"), ("T2", "bad")], "custom_id string, request string")
    assert {r["custom_id"]: r["text"] for r in CallResponder(call).answer("ner", asked).collect()} == {"T1": "A", "T2": None}


def test_roles():
    assert role_of("pdg") == "description"
    with pytest.raises(ValueError, match="unknown"):
        check_roles({"x": {}})
    with pytest.raises(ValueError, match="without"):
        check_roles({"elicitation": {}})


def test_late_facts_are_left_out_of_windows(spark, tmp_path):
    schema = "triple_id string, created_at timestamp"
    for i, (ident, at) in enumerate([("T1", "2024-01-01 00:01:00"), ("T2", "2024-01-01 00:03:00"), ("T3", "2024-01-01 02:00:00"), ("T4", "2024-01-01 00:02:00"), ("T5", "2024-01-01 04:00:00")]):
        row = spark.createDataFrame([(ident, at)], "triple_id string, t string").selectExpr("triple_id", "cast(t as timestamp) created_at")
        row.coalesce(1).write.mode("append").parquet(str(tmp_path / "facts"))
        query = arrivals(spark, str(tmp_path / "facts"), schema).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).outputMode("append")
        query.trigger(availableNow=True).start().awaitTermination()
    got = {str(r["w"]): r["facts"] for r in spark.read.parquet(str(tmp_path / "out")).selectExpr("window.start w", "facts").collect()}
    assert got["2024-01-01 00:00:00"] == 2  # T4 came after the watermark had passed


def test_thin_by_cluster_runs_over_the_queue(spark, tmp_path):
    def fact(number, subject, label, status="ner_finished", object_id=None, predicate="p", kind="ne"):
        return {"triple_id": f"T{number}", "subject_id": subject, "predicate_label": predicate, "object_label": label, "object_type": kind, "object_status": status, "object_id": object_id}

    rows = [fact(100 + i, f"E{i}", "Port Vell", "finished", f"E{i % 2}") for i in range(51)] + [fact(200 + i, f"E{i}", "Kelvin", "finished", "E9") for i in range(51)]
    rows += [fact(10, "E1", "Port Vell"), fact(9, "E1", "Port Vell"), fact(11, "E2", "Port Vell"), fact(12, "E3", "PORT VELL")]  # frequent: one a subject, none of the other spelling
    rows += [fact(20, "E1", "Zumba"), fact(21, "E2", "Zumba"), fact(22, "E2", "ZUMBA")]  # one in all
    rows += [fact(30, "E1", "Kelvin"), fact(31, "E2", "Kelvin", predicate="q")]  # the first is answered from what is known
    rows += [fact(40, "E1", "Quartz", kind="literal"), fact(41, "E1", "Quartz", "onned1")]  # not waiting
    whole = [{f.name: r.get(f.name) for f in TABLES["triple"]} for r in rows]
    spark.createDataFrame(whole, TABLES["triple"]).write.parquet(f"{tmp_path}/triple.parquet")
    got = sorted(r["triple_id"] for r in queries()["thin_by_cluster"](spark, str(tmp_path)).collect())
    assert got == ["T11", "T20", "T31", "T9"]


def test_a_commit_that_ends_early_leaves_the_old_state(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path)
    s.commit({"triple": triple(spark, triple_id="T1")})
    before = s._current()

    def stop(state):
        raise RuntimeError("ended between the tables and the pointer")

    monkeypatch.setattr(s, "_point", stop)
    with pytest.raises(RuntimeError):
        s.commit({"triple": triple(spark, triple_id="T2")})
    monkeypatch.undo()
    again = Store(spark, s.root)
    assert again._current() == before and again.read("triple").first()["triple_id"] == "T1"
    assert again.vacuum(1) > 0  # what the lost commit left, and the empty tables before
    assert again.read("triple").first()["triple_id"] == "T1"


def test_of_two_commits_onto_one_version_the_later_fails(spark, tmp_path):
    s, other = store(spark, tmp_path), Store(spark, str(tmp_path / "kb"))
    base = other._current()
    s.commit({"triple": triple(spark, triple_id="T1")})
    with pytest.raises(StaleState):
        other.commit({"triple": triple(spark, triple_id="T2")}, base=base)
    assert other.read("triple").first()["triple_id"] == "T1"


NER = [("ner", "T1", json.dumps({"phrase": "x", "is_ne": True})), ("ner", "T2", "not json")]


def test_batches_are_handed_in_polled_and_collected(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path)
    rows = [{f.name: {"triple_id": t, "object_type": "unrecognized", "object_status": "generated", "predicate_status": "finished", "object_label": "x"}.get(f.name) for f in TABLES["triple"]} for t in ("T1", "T2", "T3")]
    s.commit({"triple": spark.createDataFrame(rows, TABLES["triple"])})
    answers = ReplayResponder(spark.createDataFrame(NER, "stage string, custom_id string, text string"))
    client = FolderBatches(spark, str(tmp_path / "batches"))
    engine = Engine(s, None, HashEmbedder(), Limits(queue=2), client, True)
    assert engine.stage("ner", 2) == 1
    job = s.read("batch_job").first()
    assert (job["status"], job["job_type"]) == ("created", "ner")
    assert {(r["object_status"], r["ner_batch_id"]) for r in s.read("triple").collect()} == {("onner", job["id"])}
    # still out: running, of an unknown status, not to be asked for
    assert engine.poll() == (1, {"NED": True, "PD": True, "CD": True}) and s.read("batch_job").first()["status"] == "in_progress"
    monkeypatch.setattr(client, "retrieve", lambda batch: "resting")
    assert engine.poll()[0] == 1 and s.read("batch_job").first()["status"] == "in_progress"

    def broken(batch):
        raise OSError

    monkeypatch.setattr(client, "retrieve", broken)
    assert engine.poll() == (1, {"NED": False, "PD": False, "CD": False})
    monkeypatch.undo()
    # one answer, one that can't be read, one that is missing
    client.finish(job["id"], "ner", answers)
    assert engine.poll()[0] == 0 and s.read("batch_job").first()["status"] == "completed"
    assert {r["triple_id"]: r["object_status"] for r in s.read("triple").collect()} == {"T1": "ner_finished", "T2": "generated", "T3": "generated"}
    assert engine.report["ner"] == {"ne": 1, "failed": 2}
    # a cancelled batch that holds items gives them back before the first round
    s.commit({"triple": s.read("triple").withColumn("object_status", F.when(F.col("triple_id") == "T3", "onner").otherwise(F.col("object_status"))), "batch_job": s.read("batch_job").withColumn("status", F.lit("cancelled"))})
    engine.recover()
    assert {r["object_status"] for r in s.read("triple").filter("triple_id = 'T3'").collect()} == {"generated"}


def test_a_round_with_errors_is_not_idle(spark, tmp_path, monkeypatch):
    engine = Engine(store(spark, tmp_path), None, HashEmbedder(), Limits(idle_rounds=1))

    def broken(stage, quota):
        raise OSError

    monkeypatch.setattr(engine, "stage", broken)
    assert len(engine.run(3)) == 3


def test_only_rate_limits_are_waited_for(spark):
    asked = spark.createDataFrame([("T1", "wait"), ("T2", "bad")], "custom_id string, request string")
    made = {}

    def call(request: str) -> str:
        made[request] = made.get(request, 0) + 1
        if request == "bad":
            raise ValueError
        if made[request] < 3:
            raise RateLimited
        return str(made[request])

    routed = RoutedResponder(dict.fromkeys(("elicitation", "disambiguation", "description"), CallResponder(call, wait=0.01)))
    assert {r["custom_id"]: r["text"] for r in routed.answer("ner", asked).collect()} == {"T1": "3", "T2": None}


def test_config(tmp_path):
    roles = {r: {"model": "m"} for r in ("elicitation", "disambiguation", "description")}
    (tmp_path / "c.json").write_text(json.dumps(roles))
    assert load_config(str(tmp_path / "c.json")) == roles


def test_chat_requests_merge_into_the_first_user_message(spark):
    def line(*messages):
        return json.dumps({"custom_id": "T1", "body": {"model": "m", "input": [{"role": r, "content": c} for r, c in messages], "text": {"format": {"type": "json_schema", "name": "n", "strict": True, "schema": {"type": "object"}}}}})

    lines = [line(("developer", "s"), ("assistant", "a"), ("user", "u"), ("user", "v")), line(("developer", "s"), ("assistant", "a")), line(("user", "u"))]
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    bodies = [json.loads(r[0])["body"] for r in df.select(prompts.chat_request(F.col("value"), True, extra={"top_k": 5})).collect()]
    assert [[(m["role"], m["content"]) for m in b["messages"]] for b in bodies] == [[("assistant", "a"), ("user", "s\n\nu"), ("user", "v")], [("user", "s"), ("assistant", "a")], [("user", "u")]]
    assert bodies[0]["response_format"] == {"type": "json_schema", "json_schema": {"name": "n", "schema": {"type": "object"}, "strict": True}} and bodies[0]["top_k"] == 5
    plain = json.loads(df.select(prompts.chat_request(F.col("value"), structured=False)).first()[0])
    assert "response_format" not in plain["body"]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda name, default=None: default)
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=conf))
