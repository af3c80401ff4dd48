"""The driver's contract, and queries against SQL on the smallest data where it is there."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test data")


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([(columns[i], None if r[i] is None or r[i] != r[i] else r[i]) for i in order]) for r in rows)


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@there
@pytest.mark.parametrize("name", ["consistent_object_map_low", "p1_found", "signature_dedup_nullsafe", "upsert_entities", "apply_ned1", "topk_neighbors"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for file in os.listdir(ROOT):
        db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{ROOT}/{file}')")
    db.execute(entry.oracle_sql()[name])
    want = plain(db.fetchall(), [d[0] for d in db.description])
    got = entry.queries()[name](spark, ROOT)
    assert plain([tuple(r) for r in got.collect()], got.columns) == want


@there
def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["predicate_label", "object_label", "facts", "object_id"]
