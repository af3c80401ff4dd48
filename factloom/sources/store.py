"""The store: tables as immutable Parquet snapshots, and a pointer to the current one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.ids import next_number
from factloom.operators.delta import Delta
from factloom.schema import KEYS, TABLES

#: Where exploration starts.
SEED = "Where the exploration starts"


class StaleState(RuntimeError):
    """Another writer committed since the state was read."""


class Store:
    """Tables under ``root``. A commit writes the changed tables beside the old ones and then a pointer of the next version, in
    one rename: a commit that ends early leaves the old state, and of two commits onto one version the later fails.
    Batches whose answers a snapshot holds are recorded in it, as the last number of each source."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointers(self) -> list[int]:
        """Versions that have a pointer, the oldest first."""
        at = self._fs_path(self.root)
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n.removeprefix("CURRENT.")) for n in names if n.startswith("CURRENT.") and n[8:].isdigit())

    def _pointed(self, version: int) -> dict:
        stream = self._fs.open(self._fs_path(f"{self.root}/CURRENT.{version}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _current(self) -> dict:
        versions = self._pointers()
        return self._pointed(versions[-1]) if versions else {"version": 0, "tables": {}, "applied": {}}

    def _point(self, state: dict) -> None:
        temporary, final = self._fs_path(f"{self.root}/_pointer-{uuid.uuid4().hex}"), self._fs_path(f"{self.root}/CURRENT.{state['version']}")
        stream = self._fs.create(temporary, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(temporary, final):
            self._fs.delete(temporary, False)
            raise StaleState(f"version {state['version']} is there already")

    def create(self) -> None:
        """Empty tables."""
        self.commit({n: self.spark.createDataFrame([], s) for n, s in TABLES.items()})

    def _read(self, state: dict, name: str) -> DataFrame:
        path = state["tables"].get(name)
        if path is None:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{path}")

    def read(self, name: str) -> DataFrame:
        return self._read(self._current(), name)

    def state(self) -> dict[str, DataFrame]:
        """All tables of one version."""
        state = self._current()
        return {n: self._read(state, n) for n in TABLES}

    def commit(self, tables: dict[str, DataFrame], applied: str | None = None, base: dict | None = None) -> int:
        """Write whole tables as the next snapshot; ``applied`` names the batch (``source/number``) whose answers they hold,
        ``base`` is the state they were made from. Raises StaleState if another one is current by then."""
        state = json.loads(json.dumps(self._current() if base is None else base))
        version = state["version"] + 1
        for name, df in tables.items():
            path = f"{name}/v={version}-{uuid.uuid4().hex[:8]}"
            df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name]]).write.parquet(f"{self.root}/{path}")
            state["tables"][name] = path
        state["version"] = version
        if applied:
            source, _, number = applied.rpartition("/")
            state["applied"][source] = int(number)
        self._point(state)
        return version

    def apply(self, delta: Delta, applied: str | None = None) -> int:
        """Commit the changes of a stage; a batch applied before changes nothing."""
        base = self._current()
        if applied and self._holds(base, applied):
            return base["version"]
        return self.commit({n: delta.apply(n, self._read(base, n), KEYS[n][0]) for n in delta.tables}, applied, base)

    def vacuum(self, keep: int = 2) -> int:
        """Remove snapshots that none of the last ``keep`` pointers needs, and older pointers; how many went. For times without
        a commit or reader under way."""
        versions = self._pointers()
        kept, old = versions[-keep:], versions[:-keep]
        needed = {path for v in kept for path in self._pointed(v)["tables"].values()}
        gone = 0
        for name in TABLES:
            at = self._fs_path(f"{self.root}/{name}")
            for f in self._fs.listStatus(at) if self._fs.exists(at) else []:
                if f"{name}/{f.getPath().getName()}" not in needed:
                    gone += bool(self._fs.delete(f.getPath(), True))
        for v in old:
            self._fs.delete(self._fs_path(f"{self.root}/CURRENT.{v}"), False)
        return gone

    @staticmethod
    def _holds(state: dict, batch: str) -> bool:
        source, _, number = batch.rpartition("/")
        return state["applied"].get(source, -1) >= int(number)

    def was_applied(self, batch: str) -> bool:
        return self._holds(self._current(), batch)

    def is_empty(self) -> bool:
        return not self._current()["tables"] or self.read("entity").isEmpty()

    def metadata(self) -> DataFrame:
        """``kind, vector_count, embedding_dim`` of the vectors there are."""
        v = self.read("vector")
        return v.groupBy("kind").agg(F.count("*").alias("vector_count"), F.max(F.size("embedding")).alias("embedding_dim"))

    def seed(self, label: str, description: str, embedder) -> None:
        """The first entity, the ``instanceOf`` predicate and the ``human`` class; only into an empty store."""
        if not self.is_empty():
            raise ValueError("the store holds a knowledge base already")
        rows = {
            "entity": ("E0", label, description),
            "predicate": ("P0", "instanceOf", "The subject is an instance of the class that is the object."),
            "concept": ("C0", "human", "A person."),
        }
        tables, vectors = {}, []
        for name, (ident, text, about) in rows.items():
            full = {"id": ident, "label": text, "description": about, "embedding_index": 0, "first_appeared": SEED, "status": "unexplored"}
            tables[name] = self.spark.createDataFrame([{f.name: full.get(f.name) for f in TABLES[name]}], TABLES[name])
            vectors.append((name, 0, [float(x) for x in embedder.encode([text])[0]]))
        tables["vector"] = self.spark.createDataFrame(vectors, TABLES["vector"])
        self.commit(tables)

    def add_seed(self, kind: str, label: str, description: str, embedder) -> str:
        """One more entity, predicate or concept; its id."""
        table = self.read(kind)
        n = next_number(table, "id").first()[0]
        ident = f"{kind[0].upper()}{n}"
        full = {"id": ident, "label": label, "description": description, "embedding_index": n, "first_appeared": SEED, "status": "unexplored"}
        row = self.spark.createDataFrame([{f.name: full.get(f.name) for f in TABLES[kind]}], TABLES[kind])
        vector = self.spark.createDataFrame([(kind, n, [float(x) for x in embedder.encode([label])[0]])], TABLES["vector"])
        self.commit({kind: table.unionByName(row), "vector": self.read("vector").unionByName(vector)})
        return ident
