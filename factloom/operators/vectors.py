"""Vectors: embedding of texts, exact neighbours in blocks, clusters of labels."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.runtime import staged

BLOCK_ROWS, LOT_ROWS, STEP = 8_192, 65_536, 1_024
#: Different vectors of a component up to which one task clusters it by all its distances; a larger one is clustered in rounds.
MOST_LINKED = 2_000


class Embedder(Protocol):
    """Unit vectors of texts."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder:
    """Offline stand-in for a model: hashed character n-grams, so similar spellings are near."""

    def __init__(self, dimensions: int = 64, sizes: tuple[int, ...] = (2, 3)):
        self.dimensions, self.sizes = dimensions, sizes

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions))
        for i, text in enumerate(texts):
            padded = f" {(text or '').lower()} "
            for n in self.sizes:
                for j in range(len(padded) - n + 1):
                    h = zlib.crc32(padded[j : j + n].encode())
                    out[i, h % self.dimensions] += 1 if h & 0x80000000 else -1
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0).astype(np.float32)


def embed(df: DataFrame, text: str, embedder: Embedder, name: str = "embedding") -> DataFrame:
    """``df`` with the vectors of a text column; null texts have a null vector."""

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        vectors = embedder.encode(texts.fillna("").tolist())
        return pd.Series([None if t is None else v.tolist() for t, v in zip(texts, vectors)])

    return df.withColumn(name, encode(text))


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), dtype=np.float64)
    norms = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)


def exact_topk(queries: DataFrame, base: DataFrame, k: int = 5, group: str = "kind", itself: bool = False) -> DataFrame:
    """``group, query, neighbour, position``: the ``k`` rows of ``base`` nearest to each query, by cosine similarity.

    Both have ``group, idx, embedding``; only rows of one group meet. Ties go by index; null and zero vectors have no
    neighbours and are none; a query is not its own neighbour unless ``itself``. The base is cut into blocks, the
    queries into lots, and each pair of them is one task of bounded size whose output is ``k`` rows a query.
    """

    def clean(df: DataFrame) -> DataFrame:
        norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        one = df.select(group, "idx", "embedding").dropna().groupBy(group, "idx").agg(F.min("embedding").alias("embedding"))
        return staged(one.filter(norm > 0))

    asked, there = clean(queries), clean(base)
    blocks = there.groupBy(group).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    lots = asked.groupBy(group).agg(F.ceil(F.count("*") / LOT_ROWS).cast("int").alias("lots"))
    shape = blocks.join(lots, group)
    shape = F.broadcast(staged(shape))  # a row a group of vectors
    entries = there.join(shape, group).select(
        group, F.pmod(F.xxhash64("idx"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "idx", "embedding"
    )
    needs = asked.join(shape, group).select(
        group, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("idx"), F.col("lots")).cast("int").alias("lot"), "idx", "embedding"
    )

    def search(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(e):
            e = e.sort_values("idx")
            x, ids, q_ids, y = _unit(e["embedding"]), e["idx"].to_numpy(), q["idx"].to_numpy(), _unit(q["embedding"])
            for i in range(0, len(y), STEP):
                sims = y[i : i + STEP] @ x.T
                if not itself:
                    sims[q_ids[i : i + STEP, None] == ids[None, :]] = -2
                take = min(k, len(ids))
                floor = -np.partition(-sims, take - 1, axis=1)[:, take - 1 : take]
                row, col = np.nonzero((sims >= floor) & (sims > -2))
                out.append(pd.DataFrame({group: q[group].iat[0], "query": q_ids[i + row], "neighbour": ids[col], "similarity": sims[row, col]}))
        return pd.concat(out) if out else pd.DataFrame({group: [], "query": [], "neighbour": [], "similarity": []})

    keys = [group, "block", "lot"]
    found = needs.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInPandas(search, f"{group} string, query long, neighbour long, similarity double")
    best = Window.partitionBy(group, "query").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("position", F.row_number().over(best) - 1).filter(F.col("position") < k).select(group, "query", "neighbour", "position", "similarity")


def average_linkage(distances: np.ndarray, threshold: float, weights: np.ndarray | None = None) -> np.ndarray:
    """Cluster numbers by agglomerative clustering with average linkage; merges at or above ``threshold`` don't happen.

    Nearest-neighbour chains: a pair that are each other's nearest is merged at once, which gives the same tree.
    ``weights`` says how many equal points each row stands for.
    """
    n = len(distances)
    d = distances.astype(np.float64).copy()
    np.fill_diagonal(d, np.inf)
    size, alive, of = np.ones(n) if weights is None else weights.astype(np.float64).copy(), np.ones(n, dtype=bool), np.arange(n)
    chain: list[int] = []
    merges = []
    while alive.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            row = np.where(alive, d[chain[-1]], np.inf)
            near = int(row.argmin())
            if len(chain) > 1 and row[chain[-2]] <= row[near]:
                near = chain[-2]
            if not np.isfinite(row[near]) or (len(chain) > 1 and near == chain[-2]):
                break
            chain.append(near)
        if len(chain) < 2:
            break
        a, b = sorted((chain.pop(), chain.pop()))
        merges.append((d[a, b], a, b))
        d[a] = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        d[:, a] = d[a]
        d[a, a] = np.inf
        size[a] += size[b]
        alive[b] = False
    for height, a, b in sorted(merges, key=lambda m: m[0]):
        if height < threshold:
            of[of == of[b]] = of[a]
    return of


def cluster_vectors(df: DataFrame, threshold: float = 0.15) -> DataFrame:
    """``idx, cluster`` of rows ``idx, embedding``: average linkage on cosine distance, cut at ``threshold``.

    A merge below the threshold needs a pair below it, so every cluster lies in one component of the graph of such pairs,
    and each component is clustered exactly. Equal vectors are one weighted point, so many copies don't make a component
    large; components of more than MOST_LINKED different vectors are clustered in rounds, with no limit of their size.
    ``cluster`` is the least member. Zero vectors are alone; null ones are left out. The pairs come from blocks of the
    whole queue, which suits the tens of thousands of labels that a round takes.
    """
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    one = staged(df.select("idx", "embedding").dropna().groupBy("idx").agg(F.min("embedding").alias("embedding")))
    points = staged(one.filter(norm > 0).groupBy("embedding").agg(F.min("idx").alias("idx"), F.count("*").alias("weight")))
    pairs = staged(near_pairs(points.select(F.lit("all").alias("kind"), "idx", "embedding"), 1 - threshold))
    roots = components(pairs)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        ids = pdf["idx"].to_numpy()
        x = _unit(pdf["embedding"])
        of = average_linkage(1 - x @ x.T, threshold, pdf["weight"].to_numpy())
        return pd.DataFrame({"idx": ids, "cluster": pd.Series(ids).groupby(of).transform("min").to_numpy()})

    large = staged(roots.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_LINKED).select("root"))
    small = points.join(roots.join(large, "root", "left_anti"), "idx")
    linked = small.groupBy("root").applyInPandas(link, "idx long, cluster long")
    if not large.isEmpty():
        members = roots.join(large, "root", "left_semi").select("idx")
        linked = linked.unionByName(linked_in_rounds(points.join(members, "idx", "left_semi"), pairs.join(members.toDF("a"), "a", "left_semi"), threshold))
    of_point = points.join(linked, "idx", "left").select("embedding", F.coalesce("cluster", "idx").alias("cluster"))
    return one.join(of_point, "embedding", "left").select("idx", F.coalesce("cluster", "idx").alias("cluster"))


def linked_in_rounds(points: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """``idx, cluster`` of those ``points`` (``idx, embedding, weight``) that average linkage puts under another one, where
    ``pairs`` (``a, b``) are all those below the threshold.

    In a round all clusters that are each other's nearest merge at once, which gives the tree of single merges, as average
    linkage is reducible. The distance of two clusters follows from the sums of their unit vectors, so nothing holds all
    distances. A pair at the threshold or above it is left out: a cluster that neither of two may join can't join both.
    """

    def unit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                yield pd.DataFrame({"idx": pdf["idx"], "total": list(_unit(pdf["embedding"]) * pdf["weight"].to_numpy(dtype=np.float64)[:, None]), "weight": pdf["weight"]})

    clusters = staged(points.select("idx", "embedding", "weight").mapInPandas(unit, "idx long, total array<double>, weight long"))
    edges, merged = pairs.select("a", "b"), None
    dot = F.aggregate(F.zip_with("a_total", "b_total", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    while True:
        a, b = (clusters.select(F.col("idx").alias(v), F.col("total").alias(f"{v}_total"), F.col("weight").alias(f"{v}_weight")) for v in "ab")
        apart = edges.join(a, "a").join(b, "b").select((1 - dot / F.col("a_weight") / F.col("b_weight")).alias("d"), "a", "b")
        edges = staged(apart.filter(F.col("d") < threshold))
        edge = F.struct("d", "a", "b").alias("edge")
        ends = edges.select(F.col("a").alias("idx"), edge).unionByName(edges.select(F.col("b").alias("idx"), edge))
        mutual = staged(ends.groupBy("idx").agg(F.min("edge").alias("edge")).groupBy("edge").agg(F.count("*").alias("n")).filter("n = 2").select("edge.a", "edge.b"))
        if mutual.isEmpty():  # the least pair of all is mutual, so none is left
            break
        merged = mutual if merged is None else merged.unionByName(mutual)
        other = mutual.join(b, "b").select(F.col("a").alias("idx"), "b_total", "b_weight")
        kept = clusters.join(ends.select("idx").distinct(), "idx", "left_semi").join(mutual.select(F.col("b").alias("idx")), "idx", "left_anti").join(other, "idx", "left")
        total = F.coalesce(F.zip_with("total", "b_total", lambda x, y: x + y), "total")
        clusters = staged(kept.select("idx", total.alias("total"), (F.col("weight") + F.coalesce("b_weight", F.lit(0))).alias("weight")))
        led = edges.join(mutual.toDF("a_to", "a"), "a", "left").join(mutual.toDF("b_to", "b"), "b", "left")
        led = led.select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b")).filter("a <> b")
        edges = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return points.select("idx").limit(0).withColumn("cluster", F.col("idx")) if merged is None else components(merged).withColumnRenamed("root", "cluster")


def components(pairs: DataFrame) -> DataFrame:
    """``idx, root`` for every end of ``pairs`` (``a, b``): the least member of its component.

    Each round takes the least root of the neighbours and then the root of that root, so paths shorten by halves.
    """
    edges = staged(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    roots = edges.groupBy(F.col("a").alias("idx")).agg(F.min(F.least("a", "b")).alias("root"))
    while True:
        roots = staged(roots)
        lower = edges.join(roots, F.col("b") == F.col("idx")).groupBy("a").agg(F.min("root").alias("low"))
        nearer = roots.join(lower, F.col("idx") == F.col("a")).select("idx", "root", F.least("root", "low").alias("low"))
        jump = roots.select(F.col("idx").alias("low"), F.col("root").alias("far"))
        moved = staged(nearer.join(jump, "low", "left").select("idx", F.least("low", F.coalesce("far", "low")).alias("root"), (F.least("low", F.coalesce("far", "low")) < F.col("root")).alias("moved")))
        roots = moved.select("idx", "root")
        if moved.filter("moved").isEmpty():
            return roots


def near_pairs(df: DataFrame, least: float) -> DataFrame:
    """``a, b`` with ``a < b``: rows ``kind, idx, embedding`` of cosine similarity above ``least``, by pairs of blocks."""
    there = staged(df.select("kind", "idx", "embedding"))
    blocks = there.groupBy("kind").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    blocked = there.join(F.broadcast(staged(blocks)), "kind").withColumn("own", F.pmod(F.xxhash64("idx"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = blocked.withColumn("other", every).filter("own <= other").select("kind", F.col("own").alias("p"), F.col("other").alias("q"), "idx", "embedding")
    right = blocked.withColumn("other", every).filter("other <= own").select(F.col("kind").alias("kind"), F.col("other").alias("p"), F.col("own").alias("q"), F.col("idx").alias("idx"), F.col("embedding").alias("embedding"))

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(y):
            u, v, i, j = _unit(x["embedding"]), _unit(y["embedding"]), x["idx"].to_numpy(), y["idx"].to_numpy()
            for s in range(0, len(u), STEP):
                row, col = np.nonzero(u[s : s + STEP] @ v.T > least)
                out.append(pd.DataFrame({"a": i[s + row], "b": j[col]}))
        whole = pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")
        return pd.DataFrame({"a": whole.min(axis=1), "b": whole.max(axis=1)})[whole["a"] != whole["b"]].drop_duplicates()

    keys = ["kind", "p", "q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a long, b long").distinct()
