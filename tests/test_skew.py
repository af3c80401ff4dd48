"""Per-key results where a few keys hold most rows."""

from __future__ import annotations

from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.operators.skew import heavy_keys, key_profile, offset_chunks

SCHEMA = "k string, id string, s string, t long, __key string, rows long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), SCHEMA)


def brute(rows):
    out = {}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        late = sum(1 for a, b in zip(own, own[1:]) if a[3] is not None and b[3] is not None and b[3] < a[3])
        out[k] = (len(own), own[0][1], own[-1][1], len(list(groupby(r[2] for r in own))), late)
    return out


def profile(spark, rows, chunk):
    got = key_profile(frame(spark, rows), "k", "id", "s", "t", chunk).collect()
    return {r["label"]: (r["rows"], r["first_id"], r["last_id"], r["state_runs"], r["late_rows"]) for r in got}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "b", None]), st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, 3, None])), min_size=1, max_size=40))
def test_profile_equals_brute_force(spark, drawn):
    rows = [(k, f"T{i}", s, t, "clash", 7) for i, (k, s, t) in enumerate(drawn)]
    assert profile(spark, rows, 3) == brute(rows)


def test_numbers_are_exact_and_chunks_equal(spark):
    rows = [("hot" if i % 4 else f"k{i}", f"T{i}", "x", i, None, None) for i in range(400)]
    got = offset_chunks(frame(spark, rows, 7).drop("__key"), F.col("k"), 10).collect()
    hot = sorted((r["__no"], r["id"]) for r in got if r["k"] == "hot")
    assert [n for n, _ in hot] == list(range(300))
    assert [i for _, i in hot] == [r[1] for r in rows if r[0] == "hot"]
    sizes = {}
    for r in got:
        if r["k"] == "hot":
            sizes[r["__chunk"]] = sizes.get(r["__chunk"], 0) + 1
    assert set(sizes.values()) == {10}


def test_heavy_keys_share_ties_and_nulls(spark):
    rows = [("a", str(i), "x", i, None, None) for i in range(5)] + [(f"r{i}", "r", "x", i, None, None) for i in range(75)] + [(None, "n", None, None, None, None)] * 20
    got = {r["label"]: r["rows"] for r in heavy_keys(frame(spark, rows), "k", 0.05).collect()}
    assert got == {"a": 5}


@pytest.mark.parametrize("call", [lambda d: heavy_keys(d, "k"), lambda d: key_profile(d, "k", "id", "s", "t")])
def test_empty(spark, call):
    assert call(frame(spark, [], 1)).count() == 0
