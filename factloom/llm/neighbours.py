"""The most similar vectors of every vector.

Method: inverted multi-index. The two halves of a vector are quantised separately; a cell is a pair of centroids. For a
query, centroid pairs are traversed in the order of their summed distances with a heap until the sum exceeds the least
one by ``slack``, and the entries of the visited cells are reranked by their exact similarity. Queries of one home cell
share a traversal. ``slack`` is calibrated for each kind: sampled queries are compared with all entries, and it is what
their true neighbours need. There is no cap on visited cells or entries; cells are cut into blocks of bounded size, and
the queries that visit one into lots, so neither the index nor a cell has to fit into one task. A query travels once to
all cells of one first centroid that it visits; the queries are cut into parts by their home cells, one search after the
other, so that what travels at once takes no more disk than the vectors themselves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.runtime import staged

#: Vectors of a kind that the centroids are fitted on at most (all vectors are indexed), and rounds of fitting.
SAMPLE, ROUNDS = 20_000, 10
#: Entries a cell should have on average; with it the number of centroids grows as the square root of the collection.
CELL_ROWS, MOST_CENTROIDS = 512, 256
#: Entries compared at once, those of a block, queries that one block meets, and those compared at once.
BLOCK_ROWS, SHELF_ROWS, QUERY_ROWS, STEP = 4_096, 65_536, 65_536, 2_048
#: Bytes of queries that travel at once, where all vectors have fewer.
PART_BYTES = 1 << 28
#: Queries of a kind that ``slack`` is calibrated on, the share of their neighbours that must lie in visited cells, and the
#: allowance for the error of that share.
ASKED, REACHED, MARGIN = 512, 0.99, 1.15
#: Indexes of one vector from which on its list is broadcast to them, and most such lists.
HOT, MOST_HOT = 10_000, 100_000


def fit(sample: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Centroids by Lloyd's method; an empty one keeps its place."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), k, replace=False)].copy()
    for _ in range(ROUNDS):
        of = np.argmin(distances(sample, centres), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, sample)
        counts = np.bincount(of, minlength=k)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)


def visited(first: np.ndarray, second: np.ndarray, slack: float) -> Iterator[tuple[int, np.ndarray]]:
    """Cells and the queries that visit each: those for which the summed distance of its two centroids exceeds the least sum
    by at most ``slack``.

    ``first`` and ``second`` hold the distances of some queries, a row each, to the centroids of either half. Cells come in
    the order of what the nearest of the queries is away; the rest is cut off by it.
    """
    first, second = first - first.min(axis=1, keepdims=True), second - second.min(axis=1, keepdims=True)
    d1, d2 = first.min(axis=0), second.min(axis=0)
    by1, by2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    d1, d2, k = d1.tolist(), d2.tolist(), len(by2)
    heap = [(d1[by1[0]] + d2[by2[0]], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > slack:
            return
        rows = np.flatnonzero(first[:, by1[i]] + second[:, by2[j]] <= slack)
        if len(rows):
            yield by1[i] * k + by2[j], rows
        if i + 1 < len(by1) and j == 0:  # every pair is reached once: along the first centroid, then along the second
            heapq.heappush(heap, (d1[by1[i + 1]] + d2[by2[0]], i + 1, 0))
        if j + 1 < k:
            heapq.heappush(heap, (d1[by1[i]] + d2[by2[j + 1]], i, j + 1))


def _runs(cells: np.ndarray) -> tuple[list[int], list[int]]:
    """Where the runs of equal numbers begin and end, cut to BLOCK_ROWS at most."""
    edges = np.flatnonzero(np.diff(cells, prepend=-1)).tolist() + [len(cells)]
    begins = [b for one, end in zip(edges, edges[1:]) for b in range(one, end, BLOCK_ROWS)]
    return begins, [*begins[1:], len(cells)]


def parts(homes: pd.DataFrame, most: int) -> pd.Series:
    """Numbers of parts for home cells ``grp, home, bytes``, in that order: each part's queries travel with about ``most``
    bytes, or are those of one home cell."""
    ordered = homes.sort_values(["grp", "home"])
    return ((ordered["bytes"].cumsum() - ordered["bytes"]) // max(most, 1)).astype("int64").reindex(homes.index)


def matrix(column: pd.Series) -> np.ndarray:
    """The vectors of a column of bytes."""
    return np.frombuffer(b"".join(column), dtype=np.float32).reshape(len(column), -1)


def unit_vectors(df: DataFrame, kind: str, index: str, vector: str) -> DataFrame:
    """``grp, kind, idx, vec``: one unit vector per index as bytes; without nulls, zero and infinite vectors.

    Of several vectors under one index the least counts. ``grp`` keeps vectors of different length apart.
    """
    one = df.select(F.col(kind).cast("string").alias("kind"), F.col(index).cast("long").alias("idx"), F.col(vector).cast("array<float>").alias("v"))
    one = one.dropna().filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x))).groupBy("kind", "idx").agg(F.min("v").alias("v"))

    def scale(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            grp, vec, keep = [], [], []
            for kind_, v in zip(pdf["kind"], pdf["v"]):
                x = np.asarray(v, dtype=np.float64)
                norm = np.sqrt((x * x).sum()) if len(x) else 0.0
                keep.append(bool(norm > 0 and np.isfinite(norm)))
                grp.append(f"{len(x)}/{kind_}")
                vec.append((x / norm).astype(np.float32).tobytes() if keep[-1] else b"")
            yield pd.DataFrame({"grp": grp, "kind": pdf["kind"], "idx": pdf["idx"], "vec": vec})[keep]

    return one.mapInPandas(scale, "grp string, kind string, idx long, vec binary")


def _calibrated(placed: DataFrame, asking: DataFrame, centres: dict, sizes: dict, k: int, least: float) -> dict[str, float]:
    """``slack`` for each group: what the true neighbours of sampled queries need to lie in visited cells."""
    spark = placed.sparkSession
    asked: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for grp in sizes:
        if len(centres[grp][0]) > 1:
            some = asking.filter(F.col("grp") == grp).orderBy(F.xxhash64("idx", F.lit(5)), "idx").limit(ASKED).select("idx", "vec").toPandas()
            asked[grp] = some["idx"].to_numpy(), matrix(some["vec"])
    if not asked:
        return {}
    shared = spark.sparkContext.broadcast(asked)  # at most ASKED vectors a kind

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for grp, part in pdf[pdf["grp"].isin(list(shared.value))].groupby("grp"):
                ids, q = shared.value[grp]
                sims = q @ matrix(part["vec"]).T
                sims[ids[:, None] == part["idx"].to_numpy()[None, :]] = -2
                take = min(k, sims.shape[1])
                top = np.argpartition(-sims, take - 1, axis=1)[:, :take]
                row, col = np.nonzero(np.take_along_axis(sims, top, 1) >= max(least, -1.5))
                at = top[row, col]
                yield pd.DataFrame({"grp": grp, "q": row, "similarity": sims[row, at].astype(np.float64), "cell": part["cell"].to_numpy()[at]})

    met = placed.mapInPandas(compare, "grp string, q int, similarity double, cell int")
    best = Window.partitionBy("grp", "q").orderBy(F.desc("similarity"), "cell")
    found = met.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k).select("grp", "q", "cell").toPandas()  # at most ASKED * k rows a kind
    slack = {}
    for grp, part in found.groupby("grp"):
        (c1, c2), q = centres[grp], asked[grp][1][part["q"].to_numpy()]
        half, cell = c1.shape[1], part["cell"].to_numpy()
        d1, d2 = distances(q[:, :half], c1), distances(q[:, half:], c2)
        at = np.arange(len(q))
        need = d1[at, cell // len(c2)] + d2[at, cell % len(c2)] - d1.min(axis=1) - d2.min(axis=1)
        slack[grp] = float(np.quantile(need, REACHED)) * MARGIN
    return slack


def similar(df: DataFrame, k: int = 5, least: float = -1.0, slack: float | None = None, every: int = 1, kind: str = "kind", index: str = "embedding_index", vector: str = "embedding") -> DataFrame:
    """``kind, index, neighbour, rank, similarity``: the ``k`` most similar vectors of the same kind of each index.

    Cosine similarity of at least ``least``; ties go by the neighbour's index. ``every`` takes as queries the indexes
    divisible by it, against all. Vectors that are equal are one query and at most ``k + 1`` entries: no list of ``k``
    can hold more of them. Recall depends on ``slack``, calibrated if None; see README for measured values. An empty table
    gives no rows.
    """
    spark = df.sparkSession
    units = staged(unit_vectors(df, kind, index, vector), tidy=True)
    by_value = Window.partitionBy("grp", "vec").orderBy("idx")
    entries = units.withColumn("nth", F.row_number().over(by_value)).filter(F.col("nth") <= k + 1)  # limited before the shuffle
    sizes = {r["grp"]: r["n"] for r in units.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "kind string, index long, neighbour long, rank int, similarity double")
    centres: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for grp, n in sizes.items():
        sample = matrix(units.filter(F.col("grp") == grp).orderBy(F.xxhash64("idx"), "idx").limit(SAMPLE).select("vec").toPandas()["vec"])
        half = sample.shape[1] // 2
        c = min(len(np.unique(sample, axis=0)), MOST_CENTROIDS, max(4 if n > 1_000 else 1, round((n / CELL_ROWS) ** 0.5)))
        centres[grp] = (fit(sample[:, :half], c), fit(sample[:, half:], c))
    shared = spark.sparkContext.broadcast(centres)  # at most MOST_CENTROIDS vectors a kind

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for grp, part in pdf.groupby("grp"):
                x, (c1, c2) = matrix(part["vec"]), shared.value[grp]
                half = len(c1[0])
                cell = np.argmin(distances(x[:, :half], c1), axis=1) * len(c2) + np.argmin(distances(x[:, half:], c2), axis=1)
                yield part.assign(cell=cell.astype(np.int32))

    placed = staged(entries.select("grp", "idx", "vec").mapInPandas(place, "grp string, idx long, vec binary, cell int"), tidy=True)
    classes = units.groupBy("grp", "vec").agg(F.min("idx").alias("idx"), F.max(F.col("idx") % every == 0).alias("asks"), F.count("*").alias("members"))
    at_home = classes.mapInPandas(place, "grp string, vec binary, idx long, asks boolean, members long, cell int").withColumnRenamed("cell", "home")
    classes = staged(at_home.repartition("grp", "home").sortWithinPartitions("grp", "home"), tidy=True)  # queries of one home cell come together
    asking = classes.filter("asks").select("grp", "home", "idx", "vec")
    slacks = _calibrated(placed, asking, centres, sizes, k, least) if slack is None else dict.fromkeys(sizes, slack)

    def visits(pdf: pd.DataFrame) -> Iterator[tuple[str, int, int, np.ndarray, pd.DataFrame]]:
        """The queries of each home cell that visit some cell of a first centroid, its shelf."""
        for grp, part in pdf.groupby("grp"):
            x, (c1, c2) = matrix(part["vec"]), shared.value[grp]
            half = len(c1[0])
            d1, d2 = distances(x[:, :half], c1), distances(x[:, half:], c2)
            home = part["home"].to_numpy()
            order = np.argsort(home, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                those: dict[int, list[np.ndarray]] = {}
                for cell, some in visited(d1[rows], d2[rows], slacks.get(grp, 0.0)):
                    those.setdefault(cell // len(c2), []).append(some)
                for shelf, some in those.items():
                    yield grp, int(home[rows[0]]), shelf, rows[np.unique(np.concatenate(some))], part

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            numbers: dict[tuple[str, int, int], int] = {}
            for grp, home, shelf, rows, _ in visits(pdf):
                numbers[grp, home, shelf] = numbers.get((grp, home, shelf), 0) + len(rows)
            yield pd.DataFrame([(*key, n) for key, n in numbers.items()], columns=["grp", "home", "shelf", "visits"])

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            those: dict[tuple[str, int], list[np.ndarray]] = {}
            parts: dict[str, pd.DataFrame] = {}
            for grp, _, shelf, rows, part in visits(pdf):
                those.setdefault((grp, shelf), []).append(rows)
                parts[grp] = part
            arrays = {grp: (part["idx"].to_numpy(), matrix(part["vec"])) for grp, part in parts.items()}
            out = []
            for (grp, shelf), rows in those.items():
                ids, x = arrays[grp]
                at = np.concatenate(rows)
                for k in range(0, len(at), STEP):  # rows of bounded size, which the lots are made of
                    out.append((grp, shelf, ids[at[k : k + STEP]].tobytes(), x[at[k : k + STEP]].tobytes()))
                if len(out) >= 64:
                    yield pd.DataFrame(out, columns=["grp", "shelf", "ids", "vecs"])
                    out = []
            yield pd.DataFrame(out, columns=["grp", "shelf", "ids", "vecs"])

    seconds = F.broadcast(spark.createDataFrame([(grp, len(c[1])) for grp, c in centres.items()], "grp string, seconds int"))
    shelved = placed.join(seconds, "grp").withColumn("shelf", F.floor(F.col("cell") / F.col("seconds")).cast("int")).drop("seconds")
    held = staged(shelved.groupBy("grp", "shelf").agg(F.ceil(F.count("*") / SHELF_ROWS).cast("int").alias("blocks")))
    counted = staged(asking.mapInPandas(count, "grp string, home int, shelf int, visits long").groupBy("grp", "home", "shelf").agg(F.sum("visits").alias("visits")), tidy=True)
    group = ["grp", "shelf", "block", "lot"]

    def rerank(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(there):
            grp, shelf = asked["grp"].iat[0], int(asked["shelf"].iat[0])
            there = there.sort_values(["cell", "idx"])
            every, numbers, cells = matrix(there["vec"]), there["idx"].to_numpy(), there["cell"].to_numpy()
            q_ids = np.frombuffer(b"".join(asked["ids"]), dtype=np.int64)
            q = np.frombuffer(b"".join(asked["vecs"]), dtype=np.float32).reshape(len(q_ids), -1)
            c1, c2 = shared.value[grp]
            half = len(c1[0])
            for i in range(0, len(q), STEP):
                d1, d2 = distances(q[i : i + STEP, :half], c1), distances(q[i : i + STEP, half:], c2)
                away = (d1[:, shelf] - d1.min(axis=1))[:, None] + d2 - d2.min(axis=1, keepdims=True)
                best = []
                for begin, end in zip(*_runs(cells)):
                    here = i + np.flatnonzero(away[:, cells[begin] % len(c2)] <= slacks.get(grp, 0.0) + 1e-5)  # sums of another order may differ
                    if not len(here):
                        continue
                    e, ids = every[begin:end], numbers[begin:end]
                    take = min(k + 1, len(ids))
                    sims = q[here] @ e.T
                    near = sims >= least - 1e-6
                    if take < len(ids):
                        full = np.flatnonzero(near.sum(axis=1) > take)  # only where more than fit are near enough
                        if len(full):
                            near[full] &= sims[full] >= -np.partition(-sims[full], take - 1, axis=1)[:, take - 1 : take]
                    row, col = np.nonzero(near)
                    if len(row):
                        best.append((here[row], ids[col], np.einsum("ij,ij->i", q[here[row]].astype(np.float64), e[col].astype(np.float64))))
                if best:
                    row, ids, exact = (np.concatenate(x) for x in zip(*best))
                    order = np.lexsort((ids, -exact, row))
                    row, ids, exact = row[order], ids[order], exact[order]
                    keep = (np.arange(len(row)) - np.searchsorted(row, row) < k + 1) & (exact >= least)
                    out.append(pd.DataFrame({"grp": grp, "idx": q_ids[row[keep]], "neighbour": ids[keep], "similarity": exact[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"grp": [], "idx": [], "neighbour": [], "similarity": []}).astype({"grp": str, "idx": "int64", "neighbour": "int64"})

    def search(asking: DataFrame, counted: DataFrame) -> DataFrame:
        wanted = counted.groupBy("grp", "shelf").agg(F.ceil(F.sum("visits") / QUERY_ROWS).cast("int").alias("lots"))
        shelves = F.broadcast(staged(held.join(wanted, ["grp", "shelf"])))  # at most MOST_CENTROIDS a kind
        blocked = (
            shelved.join(shelves, ["grp", "shelf"])
            .withColumn("block", F.pmod(F.xxhash64("idx"), F.col("blocks")).cast("int"))
            .withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
            .select("grp", "shelf", "block", "lot", "cell", "idx", "vec")
        )
        # the queries of a batch that visit a shelf travel as one row
        queries = (
            asking.mapInPandas(visit, "grp string, shelf int, ids binary, vecs binary")
            .join(shelves, ["grp", "shelf"])
            .withColumn("lot", F.pmod(F.xxhash64("ids"), F.col("lots")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("grp", "shelf", "block", "lot", "ids", "vecs")
        )
        found = queries.groupBy(*group).cogroup(blocked.groupBy(*group)).applyInPandas(rerank, "grp string, idx long, neighbour long, similarity double")
        best = Window.partitionBy("grp", "idx").orderBy(F.desc("similarity"), "neighbour")
        return staged(found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1).select("grp", "idx", "neighbour", "similarity"), tidy=True)

    # a query is in one part, so each part's lists are whole
    homes = counted.join(F.broadcast(held), ["grp", "shelf"]).groupBy("grp", "home").agg(F.sum(F.col("visits") * F.col("blocks")).alias("visits")).toPandas()  # at most MOST_CENTROIDS squared a kind
    row_bytes = {grp: 4 * sum(c.shape[1] for c in centres[grp]) + 8 for grp in sizes}
    homes["bytes"] = homes["visits"] * homes["grp"].map(row_bytes)
    homes["part"] = parts(homes, max(PART_BYTES, sum(n * row_bytes[grp] for grp, n in sizes.items())))
    lists = None
    for part, those in homes.groupby("part"):
        here = F.broadcast(spark.createDataFrame(those[["grp", "home"]], "grp string, home int"))
        some = (asking, counted) if len(those) == len(homes) else (asking.join(here, ["grp", "home"], "left_semi"), counted.join(here, ["grp", "home"], "left_semi"))
        now = search(*some)
        lists = now if lists is None else lists.unionByName(now)
    if lists is None:  # nobody asks
        lists = units.select("grp", "idx", F.col("idx").alias("neighbour"), F.lit(0.0).alias("similarity")).limit(0)
    # each member of a class of equal vectors has the class's list without itself
    single = lists.join(classes.filter("members = 1 and asks").select("grp", "idx"), ["grp", "idx"], "left_semi").withColumn("member", F.col("idx"))
    several = classes.filter("members > 1 and asks").join(lists, ["grp", "idx"]).groupBy("grp", "vec", "members").agg(F.collect_list(F.struct("neighbour", "similarity")).alias("near"))
    those = units.filter(F.col("idx") % every == 0).select("grp", "vec", F.col("idx").alias("member"))
    hot = several.filter(F.col("members") > HOT).drop("members")
    if sum(sizes.values()) / HOT <= MOST_HOT:  # there can't be more of them
        hot = F.broadcast(hot)
    rest = several.filter(F.col("members") <= HOT).drop("members")
    shared_lists = those.join(hot, ["grp", "vec"]).unionByName(those.join(hot.select("grp", "vec"), ["grp", "vec"], "left_anti").join(rest, ["grp", "vec"]))
    shared_lists = shared_lists.select("grp", "member", F.explode("near").alias("near")).select("grp", "member", "near.*")
    each = single.select("grp", "member", "neighbour", "similarity").unionByName(shared_lists).filter(F.col("member") != F.col("neighbour"))
    own = Window.partitionBy("grp", "member").orderBy(F.desc("similarity"), "neighbour")
    ranked = each.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return ranked.select(F.regexp_replace("grp", r"^\d+/", "").alias("kind"), F.col("member").alias("index"), "neighbour", "rank", "similarity")


def similar_pairs(df: DataFrame, k: int = 5, least: float = 0.85, **options) -> DataFrame:
    """``kind, index_a, index_b`` with ``index_a < index_b``: pairs of which one is among the ``k`` most similar of the other."""
    found = similar(df, k, least, **options)
    return found.select("kind", F.least("index", "neighbour").alias("index_a"), F.greatest("index", "neighbour").alias("index_b")).distinct()
