"""Formatting copies, most frequent values."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.llm import format_copies, heavy_hitters
from factloom.llm.format_copies import canonical, collapse, runs

FORMS = {
    "memberOf": "memberof", "member Of": "memberof", "*member_of*": "memberof", "MEMBER–OF;": "memberof", " member\tOf\n": "memberof", "died at, buried at": "buriedat\u0001diedat",
    "Buried at | died-at": "buriedat\u0001diedat", "a1": "a1", "a2": "a2", "café": "café", "cafe": "cafe", "of member": "ofmember", "???": "\u0002???", "! !": "\u0002!!", "": "\u0002", "  ": "\u0002",
}


def test_canonical(spark):
    got = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in FORMS], "x string").select("x", canonical(F.col("x"))).collect()}
    assert got == FORMS
    assert spark.createDataFrame([(None,)], "x string").select(canonical(F.col("x"))).first()[0] is None


def brute(rows):
    groups: dict = {}
    for a, b, n in rows:
        if None not in (a, b, n):
            groups.setdefault((a, b), set()).add(n)
    return groups


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "", None]), st.sampled_from(["p", "p", "q", None]), st.one_of(st.none(), st.integers(0, 60))), max_size=120))
def test_runs_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(a, b, n, "c", 1) for a, b, n in rows], "a string, b string, n long, first_num string, __part int").repartition(3)
    want = brute(rows)
    got = sorted((r["a"], r["b"], r["first_num"], r["copy_num"]) for r in runs(df, ["a", "b"], "n").collect())
    assert got == sorted((*k, min(v), n) for k, v in want.items() for n in v)
    several = sorted((r["a"], r["b"], r["first_num"], r["copy_num"]) for r in runs(df, ["a", "b"], "n", singles=False).collect())
    assert several == sorted((*k, min(v), n) for k, v in want.items() if len(v) > 1 for n in v)


def test_one_group_spreads_over_partitions(spark):
    rows = [("h", i) for i in range(50_000)] + [(f"k{i}", i) for i in range(3)]
    df = spark.createDataFrame(rows, "a string, n long")
    found = runs(df, ["a"], "n")
    hot = found.filter("a = 'h'")
    assert hot.agg(F.min("first_num"), F.max("first_num"), F.count_distinct("copy_num")).first()[:] == (0, 0, 50_000)
    assert {r["a"]: r["copies"] for r in collapse(df, ["a"], "n").collect()} == {"h": 50_000, "k0": 1, "k1": 1, "k2": 1}


def test_very_long_keys_and_empty(spark):
    long = "x" * 2_000_000
    df = spark.createDataFrame([(long, 2), (long, 1), (long + "y", 3)], "a string, n long")
    assert sorted((len(r["a"]), r["first_num"], r["copy_num"]) for r in runs(df, ["a"], "n", False).collect()) == [(2_000_000, 1, 1), (2_000_000, 1, 2)]
    assert runs(df.limit(0), ["a"], "n").count() == 0


def test_number(spark):
    df = spark.createDataFrame([("T12",), (None,), ("x",), ("9" * 40,)], "x string")
    assert [r[0] for r in df.select(format_copies.number(F.col("x"))).collect()] == [12, None, None, None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=80), min_size=1, max_size=6), st.integers(1, 8))
def test_summaries_bound_every_count(parts, counters):
    whole = heavy_hitters.SpaceSaving(counters)
    for part in parts:
        one = heavy_hitters.SpaceSaving(counters)
        for i in range(0, len(part), 10):
            c = Counter(part[i : i + 10])
            one.add(list(c), list(c.values()), [0] * len(c))
        one.shrink()
        whole.add(list(one.kept), [u for u, _ in one.kept.values()], [e for _, e in one.kept.values()], one.floor)
    whole.shrink()
    true = Counter(x for part in parts for x in part)
    assert len(whole.kept) <= counters
    for x, n in true.items():
        if x in whole.kept:
            upper, error = whole.kept[x]
            assert upper - error <= n <= upper
        else:
            assert n <= whole.floor


def test_most_frequent_with_ties_nulls_and_clashing_columns(spark):
    rows = [("b", "x", 1)] * 3 + [("a", "x", 1)] * 3 + [("c", None, 2)] * 2 + [(None, None, 3)] * 9 + [("é", "", 0)]
    df = spark.createDataFrame(rows, "value string, field string, count int").repartition(4)
    got = sorted((r["field"], r["rank"], r["value"], r["count"]) for r in heavy_hitters.most_frequent(df, ["value", "field"], 2).collect())
    assert got == [("field", 1, "x", 6), ("field", 2, "", 1), ("value", 1, "a", 3), ("value", 2, "b", 3)]
    assert heavy_hitters.most_frequent(df.limit(0), ["value"], 2).count() == 0


@pytest.mark.parametrize("limit", [4, 64])
def test_flat_distributions_are_counted_exactly(spark, monkeypatch, limit):
    monkeypatch.setattr(heavy_hitters, "MOST_COUNTERS", limit)
    rows = [(f"v{i % 100:03d}",) for i in range(1000)] + [("v050",)]
    df = spark.createDataFrame(rows, "v string").repartition(5)
    got = heavy_hitters.most_frequent(df, ["v"], 3, counters=4).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in got] == [("v050", 11), ("v000", 10), ("v001", 10)]
