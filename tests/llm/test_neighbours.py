"""Most similar vectors."""

from __future__ import annotations

import numpy as np
import pytest

from factloom.llm import neighbours

SCHEMA = "kind string, embedding_index long, embedding array<float>, rank string, idx int"


def frame(spark, x, kind="e"):
    return spark.createDataFrame([(kind, i, None if v is None else [float(a) for a in v], "r", 1) for i, v in enumerate(x)], SCHEMA).repartition(3)


def brute(x, k, least=-1.0):
    u = np.asarray(x, dtype=np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sims = np.round(u @ u.T, 7)
    out = {}
    for i in range(len(u)):
        order = sorted((-sims[i, j], j) for j in range(len(u)) if j != i and sims[i, j] >= least)
        out[i] = [j for _, j in order[:k]]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("index", "rank").collect():
        out.setdefault(r["index"], []).append(r["neighbour"])
    return out


def test_visits_cells_by_summed_distance():
    rng = np.random.default_rng(0)
    a, b = rng.random((6, 7)), rng.random((6, 5))
    sums = (a[:, :, None] + b[:, None, :]).reshape(6, -1)
    want = {(c, q) for q in range(6) for c in range(35) if sums[q, c] <= sums[q].min() + 0.4}
    got = [(cell, rows.tolist()) for cell, rows in neighbours.visited(a, b, 0.4)]
    assert {(c, q) for c, rows in got for q in rows} == want and len({c for c, _ in got}) == len(got)
    # one query: cells in the order of its sums
    alone = [cell for cell, _ in neighbours.visited(a[:1], b[:1], 0.4)]
    assert alone == [c for c in np.argsort(sums[0], kind="stable").tolist() if sums[0, c] <= sums[0].min() + 0.4]
    assert len(list(neighbours.visited(a, b, 9))) == 35


def test_equal_vectors_share_a_list(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 8))
    x[5:25] = x[5]
    got = lists(neighbours.similar(frame(spark, x), 3, slack=9))
    assert got == brute(x, 3)


@pytest.mark.parametrize("n", [1_500])
def test_recall(spark, n):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(n // 5, 16))
    x = np.repeat(centres, 5, axis=0) + rng.normal(size=(n, 16)) * 0.15
    want = {(i, j) for i, js in brute(x, 5, 0.85).items() for j in js}
    got = {(i, j) for i, js in lists(neighbours.similar(frame(spark, x), 5, 0.85)).items() for j in js}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.01 * len(want)


def test_recall_over_many_cells(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n = 4_000
    x = np.repeat(rng.normal(size=(n // 5, 16)), 5, axis=0) + rng.normal(size=(n, 16)) * 0.15
    monkeypatch.setattr(neighbours, "CELL_ROWS", 15)  # 16 centroids a half
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 200)  # several lots a cell
    want = {(i, j) for i, js in brute(x, 5, 0.85).items() for j in js}
    got = {(i, j) for i, js in lists(neighbours.similar(frame(spark, x), 5, 0.85)).items() for j in js}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.01 * len(want)


def test_a_vector_of_most_indexes(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HOT", 10)
    x = np.random.default_rng(7).normal(size=(40, 6))
    x[3:33] = x[3]
    x[35:37] = x[35]
    assert lists(neighbours.similar(frame(spark, x), 4, slack=9)) == brute(x, 4)


def test_dirty_rows(spark):
    x = [[1, 0], [1, 0.1], [0, 0], None, [float("nan"), 1], [3, 0.2], [1, 0, 0]]
    df = frame(spark, x).unionByName(frame(spark, x)).unionByName(spark.createDataFrame([(None, 1, [1.0, 0.0], "", 1), ("e", None, [1.0, 0.0], "", 1), ("f", 1, [1.0, 0.0], "", 1)], SCHEMA))
    assert {(r["kind"], r["index_a"], r["index_b"]) for r in neighbours.similar_pairs(df).collect()} == {("e", 0, 1), ("e", 0, 5), ("e", 1, 5)}
    assert neighbours.similar(df.limit(0)).count() == 0


def test_only_some_ask(spark):
    x = np.random.default_rng(4).normal(size=(40, 4))
    got = lists(neighbours.similar(frame(spark, x), 2, slack=9, every=10))
    want = brute(x, 2)
    assert got == {i: want[i] for i in (0, 10, 20, 30)}


def test_queries_travel_in_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_BYTES", 0)  # no more than the vectors have
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1_200, 8))
    x[100:110] = x[3]
    made, cut = [], neighbours.parts
    monkeypatch.setattr(neighbours, "parts", lambda homes, most: made.append((cut(homes, most), homes["bytes"], most)) or made[-1][0])
    assert lists(neighbours.similar(frame(spark, x), 4, slack=99)) == brute(x, 4)
    (numbers, size, most), = made
    assert numbers.nunique() > 2 and size.groupby(numbers).sum().max() < most + size.max()
    assert neighbours.similar(frame(spark, x[1:]), 4, every=5_000).count() == 4  # index 0 alone asks


def test_tidy_staging_leaves_no_shuffle(spark):
    from factloom import runtime

    sc, before = spark.sparkContext, spark.conf.get(runtime.CLEANUP)
    held = lambda: sc._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    there = held()
    out = runtime.staged(spark.range(1_000).repartition(7), tidy=True)
    assert out.count() == 1_000 and spark.conf.get(runtime.CLEANUP) == before
    runtime.staged(spark.range(1_000).repartition(7), tidy=True)
    assert held() <= there + 1  # of the count
