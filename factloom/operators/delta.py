"""Changes to tables, which are files: each gives the whole new table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_constant(table: DataFrame, ids: DataFrame, key: str, **values) -> DataFrame:
    """Set columns of the rows whose key is in ``ids``."""
    hit = ids.select(F.col(key)).distinct().withColumn("__hit", F.lit(True))
    there = F.col("__hit").isNotNull()
    marked = table.join(hit, key, "left")
    return marked.select(*[F.when(there, F.lit(values[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns])


def update_map(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Set the columns of ``changes`` by key; a null there leaves the old value. Keys of ``changes`` are distinct."""
    new = changes.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in changes.columns if c != key])
    joined = table.join(new, key, "left")
    return joined.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in changes.columns and c != key else F.col(c) for c in table.columns])


def update_where(table: DataFrame, condition: Column, **values) -> DataFrame:
    """Set columns of the rows that fulfil a condition."""
    return table.select(*[F.when(condition, F.lit(values[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns])


def delete(table: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """The table without the rows whose keys are in ``ids``."""
    return table.join(ids.select(*keys).distinct(), list(keys), "left_anti")


def upsert(table: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """The table with ``rows`` in place of those with their keys, or added."""
    return delete(table, rows, *keys).unionByName(rows.select(*table.columns))


def replace_links(links: DataFrame, new: DataFrame, item: str) -> DataFrame:
    """The candidate links with all links of the items of ``new`` replaced."""
    return delete(links, new, item).unionByName(new.select(*links.columns))


@dataclass
class Delta:
    """Changes of one stage, applied to a table at once: deletions, then updates by key, then additions."""

    deletes: dict[str, DataFrame] = field(default_factory=dict)
    updates: dict[str, list[DataFrame]] = field(default_factory=dict)
    inserts: dict[str, DataFrame] = field(default_factory=dict)

    def apply(self, name: str, table: DataFrame, key: str) -> DataFrame:
        if name in self.deletes:
            table = delete(table, self.deletes[name], key)
        for changes in self.updates.get(name, []):
            table = update_map(table, changes, key)
        if name in self.inserts:
            table = table.unionByName(self.inserts[name].select(*table.columns))
        return table

    @property
    def tables(self) -> set[str]:
        return {*self.deletes, *self.updates, *self.inserts}
