"""Encoding of texts with a public byte-level BPE vocabulary.

Method: vectorised pre-tokenisation. Each codepoint of a batch is mapped to its class; where pieces begin is a scan of
transition functions over the classes. After any codepoint the state is the codepoint's class whatever it was before,
so the composition of two transition functions is the second one and the scan is a comparison of neighbours; only the
contractions ('s, 're, ...) look further and are patched in afterwards. No regular expression runs. The slices go
through pair merging once per distinct piece and worker, and ids are gathered by offsets, which also lead back from ids
to text.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LETTER, NUMBER, SPACE, OTHER, END = range(5)
#: Codepoints handled at once, and distinct pieces remembered by a worker.
CHUNK, REMEMBERED = 4_000_000, 300_000
#: White space of Unicode, and the endings split after an apostrophe.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each codepoint."""
    first = {"L": LETTER, "N": NUMBER}
    table = np.array([first.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)], dtype=np.uint8)
    table[WHITE_SPACE] = SPACE
    return table


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in ``points`` (codepoints of texts, each followed by one at a position of ``ends``) at which pieces begin.

    The positions of ``ends`` begin pieces of their own.
    """
    kind = classes()[points]
    kind[ends] = END
    before = np.concatenate(([END], kind[:-1]))
    after = np.concatenate((kind[1:], [END]))
    blank_before = np.concatenate(([False], (points[:-1] == 32) & (kind[:-1] == SPACE)))
    white = kind == SPACE
    start = (kind != before) & ~(blank_before & (kind != END))
    start |= white & (after != SPACE) & (after != END)  # the last blank before a word goes with the word
    start |= kind == END
    quotes = np.flatnonzero((points == 39) & start & (kind == OTHER) & ~blank_before)
    for ending in ENDINGS:
        at = quotes[quotes + len(ending) < len(points)]
        for i, c in enumerate(ending, 1):
            at = at[(points[at + i] == ord(c)) & (kind[at + i] == LETTER)]
        for i in range(1, len(ending) + 1):
            start[at + i] = False
        start[at[at + len(ending) + 1 < len(points)] + len(ending) + 1] = True
    return np.flatnonzero(start)


class Pieces(dict):
    """Piece to its number; a new piece is merged, and its ids appended to ``ids`` at ``offsets``."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.ids, self.offsets = ranks, [], [0]

    def __missing__(self, piece: str) -> int:
        self.ids += merge(piece.encode(), self.ranks)
        self.offsets.append(len(self.ids))
        self[piece] = n = len(self.offsets) - 2
        return n


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair of least rank is merged, the leftmost first, until no pair has a rank.

    Pairs wait in a heap over a linked list, so a piece of n bytes takes n log n steps however long it is.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        a = parts[i]
        if a is None or right[i] >= n or len(a) + len(parts[right[i]]) != size:
            continue  # one of the two has been merged since
        j = right[i]
        parts[i], parts[j] = a + parts[j], None
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            both = parts[i] + parts[k]
            if (r := ranks.get(both)) is not None:
                heapq.heappush(heap, (r, i, len(both)))
        if (h := left[i]) >= 0:
            both = parts[h] + parts[i]
            if (r := ranks.get(both)) is not None:
                heapq.heappush(heap, (r, h, len(both)))
    return [ranks[p] for p in parts if p is not None]


@lru_cache(2)
def ranks_of(path: str) -> dict[bytes, int]:
    """A rank file's byte strings and ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_pieces: dict[str, Pieces] = {}


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and the number of ids of each text."""
    known = _pieces.get(path)
    if known is None or len(known) > REMEMBERED:
        known = _pieces[path] = Pieces(ranks_of(path))
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1) - 1
    starts = piece_starts(points, ends)
    stops = np.append(starts[1:], len(points))
    text_of = np.searchsorted(ends, starts)
    real = starts < ends[text_of]
    starts, stops, text_of = starts[real], stops[real], text_of[real]
    numbers = np.fromiter(map(known.__getitem__, [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())]), dtype=np.int64, count=len(starts))
    offsets, flat = np.array(known.offsets), np.array(known.ids, dtype=np.int32)
    first, sizes = offsets[numbers], offsets[numbers + 1] - offsets[numbers]
    total = np.cumsum(sizes)
    at = np.repeat(first - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)
    return flat[at], np.bincount(text_of, weights=sizes, minlength=len(texts)).astype(np.int64)


def batches_of(texts: list[str]) -> Iterator[list[str]]:
    """The texts in lists of about CHUNK codepoints; a longer text comes alone."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > CHUNK:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encode(df: DataFrame, ident: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``ident`` and ``ids``, the ids of ``text`` without special tokens, one row per row of ``df``.

    A null or empty text gives an empty list; strings of special tokens are ordinary text. ``path`` is a rank file that
    every executor can read; it must hold all single bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for part in batches_of(texts):
                i, n = encode_texts(part, path)
                ids.append(i)
                counts.append(n)
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[ident, "ids"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(ident, F.col(text).cast("string")).mapInArrow(run, f"`{ident}` {kind}, ids array<int>")


def decode(df: DataFrame, ident: str = "doc_id", ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``ident`` and ``text``: the texts of lists of ids as ``encode`` makes them; null lists give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        for batch in batches:
            texts = [None if x is None else b"".join([by_id[i] for i in x]).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[ident, "text"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(ident, ids).mapInArrow(run, f"`{ident}` {kind}, text string")
