"""Operators of the knowledge base on small tables."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.functions import capacity, ids
from factloom.operators import candidates, dedup, delta, queues, reuse, upsert, vectors
from factloom.schema import SIGNATURE, UNSURE

PICK = "triple_id string, subject_id string, subject_label string, predicate_id string, predicate_label string, object_id string, object_label string"


def ids_of(df, column):
    return sorted(r[column] for r in df.collect())


def test_numbers_are_dense_in_order(spark):
    df = spark.createDataFrame([(f"T{i}",) for i in range(57)], "id string").repartition(5)
    got = {r["id"]: r["nth"] for r in ids.numbered(df, ids.num(F.col("id"))).collect()}
    assert got == {f"T{i}": i for i in range(57)}
    assert ids.next_number(df, "id").first()[0] == 57
    assert ids.next_number(df.limit(0), "id").first()[0] == 0
    assert ids.numbered(df.limit(0), F.col("id")).count() == 0


def test_bad_ids_have_no_number(spark):
    got = [r[0] for r in spark.createDataFrame([("T9",), ("Tx",), (None,), ("",)], "id string").select(ids.num(F.col("id"))).collect()]
    assert got == [9, None, None, None]


def test_null_predicates_collide_only_null_safely(spark):
    table = spark.createDataFrame([("T1", "E1", "a", None, "p", "E9", "o")], PICK)
    picks = spark.createDataFrame([("T2", "E1", "a", None, "p", "E9", "o"), ("T10", "E2", "b", None, "p", "E9", "o"), ("T9", "E2", "b", None, "p", "E9", "o")], PICK)
    safe = {r["triple_id"]: r["is_duplicate"] for r in dedup.resolve_picks(picks, table).collect()}
    strict = {r["triple_id"]: r["is_duplicate"] for r in dedup.resolve_picks(picks, table, null_safe=False, by_number=True).collect()}
    assert safe == {"T2": True, "T10": False, "T9": True}  # by string, T10 comes before T9
    assert strict == {"T2": False, "T10": True, "T9": False}


def test_insert_or_ignore(spark):
    table = spark.createDataFrame([("a", "b")], "label string, description string")
    rows = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "c"), ("a", None), ("a", None)], "label string, description string")
    got = dedup.insert_or_ignore(rows, table, ["label", "description"]).collect()
    assert sorted(tuple(r) for r in got if r[1]) == [("a", "c")]
    assert sum(r[1] is None for r in got) == 2


def test_upsert_numbers_new_pairs_by_first_item(spark):
    table = spark.createDataFrame([("E0", "a", "x"), ("E4", "b", "y")], "id string, label string, description string")
    items = spark.createDataFrame([("T12", "n", "1"), ("T3", "m", "1"), ("T5", "n", "1"), ("T6", "a", "x"), ("T7", None, "x")], "triple_id string, label string, description string")
    got, new = upsert.upsert_pairs(items, table, "E")
    assert {r["triple_id"]: r["id"] for r in got.collect()} == {"T3": "E5", "T5": "E6", "T12": "E6", "T6": "E0"}
    assert {(r["id"], r["embedding_index"], r["first_appeared"]) for r in new.collect()} == {("E5", 5, "T3"), ("E6", 6, "T5")}


def test_consistent_objects(spark):
    rows = [("p", "o", "E1", "ne")] * 3 + [("p", "q", "E1", "ne"), ("p", "q", UNSURE, "ne"), ("p", "q", "E1", "ne"), ("p", "r", "E1", "literal")]
    df = spark.createDataFrame(rows, "predicate_label string, object_label string, object_id string, object_type string")
    assert [tuple(r) for r in reuse.consistent_objects(df, 2).collect()] == [("p", "o", 3, "E1")]
    assert reuse.consistent_objects(df, 3).count() == 0


def test_thinning_cuts_before_lowering(spark):
    df = spark.createDataFrame([("T2", " Ab cd"), ("T10", " aB xy"), ("T3", "abcde"), ("T4", None)], "triple_id string, predicate_label string")
    got = {r["norm"]: r["triple_id"] for r in reuse.thin_by_label(df, "predicate_label", "triple_id", 3).collect()}
    assert got == {"ab": "T2", "abc": "T3"}


def test_queue_limit_takes_least_numbers(spark):
    df = spark.createDataFrame([(f"T{i}", "pd_finished") for i in (10, 9, 9, 1)], "triple_id string, predicate_status string")
    assert ids_of(queues.ready(df, "pdg", 2), "triple_id") == ["T1", "T9"]
    got = {r["triple_id"]: r["batch_no"] for r in queues.chunked(queues.ready(df, "pdg"), "triple_id", 2).collect()}
    assert got == {"T1": 0, "T9": 0, "T10": 1}


def test_gates(spark):
    df = spark.createDataFrame([("b1", "pd", "in_progress"), ("b2", "cd", "completed")], "id string, job_type string, status string")
    assert {r["gate"]: r["open"] for r in queues.gates(df).collect()} == {"NED": True, "PD": False, "CD": True}


def test_updates_and_deletes(spark):
    table = spark.createDataFrame([("a", "1", None), ("b", "2", "z")], "id string, x string, y string")
    assert {tuple(r) for r in delta.update_map(table, spark.createDataFrame([("a", "9"), ("b", None)], "id string, x string"), "id").collect()} == {("a", "9", None), ("b", "2", "z")}
    assert {tuple(r) for r in delta.update_constant(table, table.filter("id = 'b'"), "id", y="w").collect()} == {("a", "1", None), ("b", "2", "w")}
    assert ids_of(delta.delete(table, table.filter("id = 'b'"), "id"), "id") == ["a"]
    assert {tuple(r) for r in delta.upsert(table, spark.createDataFrame([("b", "5", "5"), ("c", "6", "6")], table.schema), "id").collect()} == {("a", "1", None), ("b", "5", "5"), ("c", "6", "6")}


def test_pick_is_a_rank_among_the_left(spark):
    links = spark.createDataFrame([("T1", "E5", 0), ("T1", "E6", 1), ("T1", "E7", 2)], "triple_id string, candidate string, position int")
    table = spark.createDataFrame([("E5", "a", "d"), ("E7", "b", None)], "id string, label string, description string")
    found = candidates.ordered(links, "triple_id", "candidate", table)
    got = found.select(*[candidates.pick(F.col("candidates"), F.lit(c)).alias(str(c)) for c in (1, 2, 3)]).first()
    assert tuple(got) == ("E5", "E7", None)


def test_merge_keeps_exact_first(spark):
    schema = "triple_id string, candidate string, position int"
    exact = spark.createDataFrame([("T1", "E1", 0), ("T1", "E2", 1)], schema)
    near = spark.createDataFrame([("T1", "E2", 0), ("T1", "E3", 1), ("T1", "E4", 2), ("T1", "E5", 3), ("T1", "E6", 4), ("T2", "E1", 0)], schema)
    got = sorted((r["triple_id"], r["position"], r["candidate"]) for r in candidates.merged(exact, near, "triple_id").collect())
    assert got == [("T1", 0, "E1"), ("T1", 1, "E2"), ("T1", 2, "E3"), ("T1", 3, "E4"), ("T1", 4, "E5"), ("T2", 0, "E1")]


def brute_linkage(d, threshold):
    clusters = [[i] for i in range(len(d))]
    while len(clusters) > 1:
        pairs = [(np.mean([d[i, j] for i in a for j in b]), x, y) for x, a in enumerate(clusters) for y, b in enumerate(clusters) if x < y]
        low, x, y = min(pairs)
        if low >= threshold:
            break
        clusters[x] += clusters.pop(y)
    return {frozenset(c) for c in clusters}


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10_000), st.sampled_from([0.1, 0.3, 0.8]))
def test_average_linkage_equals_brute_force(n, seed, threshold):
    x = np.random.default_rng(seed).normal(size=(n, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - x @ x.T
    of = vectors.average_linkage(d, threshold)
    assert {frozenset(np.flatnonzero(of == c)) for c in set(of)} == brute_linkage(d, threshold)


def test_clusters_in_components(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(6, 8)), 4, axis=0) + rng.normal(size=(24, 8)) * 0.05
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(99, [0.0] * 8), (3, [float(v) for v in x[3]])]
    got = {r["idx"]: r["cluster"] for r in vectors.cluster_vectors(spark.createDataFrame(rows, "idx long, embedding array<float>"), 0.15).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {i: min(c) for c in brute_linkage(1 - u @ u.T, 0.15) for i in c} | {99: 99}
    assert got == want


def test_large_components_are_clustered_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST_LINKED", 3)
    for seed in (1, 2):
        rng = np.random.default_rng(seed)
        x = np.repeat(rng.normal(size=(3, 8)), 16, axis=0) + rng.normal(size=(48, 8)) * 0.3
        u = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)
        u[5] = u[9]  # one point of weight 2
        df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(u)], "idx long, embedding array<float>")
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        want = {i: min(c) for c in brute_linkage(1 - u @ u.T, 0.15) for i in c}
        assert {r["idx"]: r["cluster"] for r in vectors.cluster_vectors(df, 0.15).collect()} == want
        assert 3 < len(set(want.values())) < 40


def test_components_of_a_long_path(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101)]
    got = {r["idx"]: r["root"] for r in vectors.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_many_copies_are_one_point(spark):
    rows = [(i, [1.0, 0.0] if i < 500 else [0.0, 1.0]) for i in range(510)] + [(600, [1.0, 0.02])]
    got = {r["idx"]: r["cluster"] for r in vectors.cluster_vectors(spark.createDataFrame(rows, "idx long, embedding array<float>")).collect()}
    assert got == {i: 0 for i in range(500)} | {i: 500 for i in range(500, 510)} | {600: 0}
    assert vectors.cluster_vectors(spark.createDataFrame([], "idx long, embedding array<float>")).count() == 0


def test_exact_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4)).round(1)
    x[7] = 0
    x[9] = x[8]
    rows = [("e", i, [float(v) for v in row], "extra") for i, row in enumerate(x)] + [("e", 3, [float(v) for v in x[3]], "extra"), ("e", 70, None, None), ("p", 1, [1.0], None)]
    df = spark.createDataFrame(rows, "kind string, idx long, embedding array<float>, position string")
    got = {}
    for r in vectors.exact_topk(df, df, 3).orderBy("query", "position").collect():
        got.setdefault((r["kind"], r["query"]), []).append(r["neighbour"])
    u = x.astype(np.float32).astype(np.float64)
    norms = np.linalg.norm(u, axis=1)
    for i in range(60):
        if norms[i] == 0:
            assert ("e", i) not in got
            continue
        sims = sorted((-round(float(u[i] @ u[j] / norms[i] / norms[j]), 12), j) for j in range(60) if j != i and norms[j] > 0)
        assert got["e", i] == [j for _, j in sims[:3]]
    assert vectors.exact_topk(df.limit(0), df).count() == 0


def test_embedder_is_unit_and_repeatable():
    e = vectors.HashEmbedder(32)
    v = e.encode(["Ada", "Ada", "", "Bob"])
    assert np.allclose(np.linalg.norm(v, axis=1), 1) and (v[0] == v[1]).all()


def test_capacity():
    assert capacity.expected_rows(2_297_995)["triple"] == 38_450_135
    assert capacity.partitions(1) == 1
    assert capacity.expected_rows(1_000)["predicate"] == 136


@pytest.mark.parametrize("label", ["predicate_label", "object_label"])
def test_empty_tables(spark, label):
    df = spark.createDataFrame([], PICK + ", object_type string")
    assert reuse.consistent_objects(df).count() == 0
    assert reuse.thin_by_label(df, label, "triple_id", None).count() == 0
    assert dedup.keep_first(df, SIGNATURE, "triple_id").count() == 0
