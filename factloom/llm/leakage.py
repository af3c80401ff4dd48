"""Passages of held-out items inside a training corpus.

Method: winnowing. Of every ``WINDOW`` neighbouring hashes of ``GRAM`` words the least is kept, so any shared span of
``GRAM + WINDOW - 1`` = 12 words has a kept hash in common. Fingerprints of corpus and items are joined by hash, each hit
is extended word by word, and hits that reach 12 words (or the whole of a shorter item) count. Items of fewer words have
one fingerprint over all their words, which is looked for at every position.

Corpus fingerprints are first looked up in a bitmap of the items' hashes, whose size is fixed however many items there
are; only those that may match leave the worker, with the words around them, so no text is shuffled or read again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.runtime import staged

SPAN, GRAM = 12, 6
WINDOW = SPAN - GRAM + 1
#: Runs of letters or digits.
WORD = re.compile(r"[^\W_]+")
#: Slots of the bitmap per gram size, as a power of two.
SLOT_BITS = 23
#: Item fingerprints are broadcast up to this many, else joined by a shuffle.
BROADCAST_PRINTS = 200_000
#: Words remembered by a worker, and codepoints handled at once.
REMEMBERED, CHUNK = 500_000, 4_000_000
PRINTS = "ident long, size int, hash long, at int, inside int, words array<string>"


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def words_of(text: str) -> list[str]:
    """The words of a text: runs of letters or digits, in lower case."""
    return WORD.findall(text.lower())


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, np.uint64)
        for i in range(size):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        rolled ^= rolled >> np.uint64(31)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(29)
    return rolled


def _kept(rolled: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Positions of the least valid hash of each window, the last of equal ones; windows shorten at the end of a text."""
    n = len(rolled)
    if not n:
        return np.zeros(0, np.int64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    masked = np.append(np.where(valid, rolled, top), np.full(WINDOW - 1, top))
    least, at = masked[:n].copy(), np.arange(n)
    for i in range(1, WINDOW):
        other = masked[i : i + n]
        lower = (other <= least) & (other != top)
        least[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + i
    return np.unique(at[valid])


def _prints(idents: list, texts: list[str], short: set[int] | None, slots: dict[int, np.ndarray] | None) -> Iterator[tuple]:
    """Fingerprints of texts as rows of PRINTS, ``at`` counting words in the text.

    For items ``short`` is None: a text of fewer than SPAN words has one fingerprint over all of them. For a corpus it
    holds those sizes, and only fingerprints whose slot is set are given.
    """
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    lists = [words_of(t) for t in texts]
    words = [w for ws in lists for w in ws]
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(lists)), sizes)
    hashes = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    for size in sorted({GRAM} | (set(range(1, SPAN)) & set(sizes.tolist()) if short is None else short)):
        for whole in (False, True):  # kept hashes of long spans; hashes over all words of short items
            if (whole and short is not None and size not in short) or (not whole and size != GRAM):
                continue
            rolled = _rolled(hashes, size)
            valid = of[: len(rolled)] == of[size - 1 :] if len(rolled) else np.zeros(0, bool)
            if whole:
                at = np.flatnonzero(valid & (sizes[of[: len(rolled)]] == size)) if short is None else np.flatnonzero(valid)
            else:
                at = _kept(rolled, valid)
                if short is None:
                    at = at[sizes[of[at]] >= SPAN]
            tag = -size if whole else size
            if slots is not None:
                at = at[slots[tag][(rolled[at] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]] if tag in slots else at[:0]
            around = 0 if whole else SPAN - size
            for p in at.tolist():
                d = int(of[p])
                begin = int(ends[d] - sizes[d])
                a, b = max(begin, p - around), min(int(ends[d]), p + size + around)
                yield idents[d], tag, int(rolled[p].astype(np.int64)), p - begin, p - a, words[a:b]


def _fingerprints(df: DataFrame, ident: str, text: str, short: set[int] | None, shared) -> DataFrame:
    names = [x.split()[0] for x in PRINTS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value if shared is not None else None
        for batch in batches:
            idents, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held > CHUNK or i == len(texts) - 1:
                    rows = list(_prints(idents[first : i + 1], texts[first : i + 1], short, slots))
                    first, held = i + 1, 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return df.select(F.col(ident).cast("long"), F.col(text).cast("string")).dropna().mapInArrow(run, PRINTS)


def hits(corpus: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, first, last``: extended hits, as the range of the item's words that the document shares there.

    Null and empty texts and texts without words have no hits. Rows repeated give the same hits again.
    """
    spark = corpus.sparkSession
    prints = staged(_fingerprints(items, item_id, item_text, None, None).distinct())  # used three times
    size = prints.count()
    slot = F.shiftrightunsigned("hash", 64 - SLOT_BITS)
    slots: dict[int, np.ndarray] = {}
    for r in prints.select("size", slot.alias("slot")).distinct().groupBy("size").agg(F.collect_list("slot").alias("slots")).collect():
        slots[r["size"]] = np.zeros(1 << SLOT_BITS, dtype=bool)
        slots[r["size"]][np.array(r["slots"], dtype=np.int64)] = True
    short = {-s for s in slots if s < 0}
    found = _fingerprints(corpus, doc_id, doc_text, short, spark.sparkContext.broadcast(slots))
    there = prints.select("size", "hash", F.col("ident").alias("item"), F.col("at").alias("item_at"), F.col("inside").alias("item_inside"), F.col("words").alias("item_words"))
    joined = found.join(F.broadcast(there) if size <= BROADCAST_PRINTS else there, ["size", "hash"])

    def extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for x in pdf.itertuples(index=False):
                a, b, i, j, n = x.words, x.item_words, x.inside, x.item_inside, abs(x.size)
                if list(a[i : i + n]) != list(b[j : j + n]):
                    continue  # equal hashes of different words
                lo = hi = 0
                if x.size > 0:
                    while lo < min(i, j) and a[i - lo - 1] == b[j - lo - 1]:
                        lo += 1
                    while i + n + hi < len(a) and j + n + hi < len(b) and a[i + n + hi] == b[j + n + hi]:
                        hi += 1
                    if lo + n + hi < SPAN:
                        continue
                rows.append((x.ident, x.item, x.item_at - lo, x.item_at + n + hi))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "first", "last"])

    return joined.mapInPandas(extend, "doc_id long, item_id long, first int, last int")


def leaks(corpus: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """``doc_id, item_id, words``: leaked items per document and how many of the item's words the shared spans cover."""
    spans = hits(corpus, items, **columns).distinct()
    covered = F.size(F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(first, last - 1)")))))
    return spans.groupBy("doc_id", "item_id").agg(covered.alias("words"))
