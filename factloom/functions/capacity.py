"""How much room a knowledge base of a given size needs."""

from __future__ import annotations

import math

#: Sizes of one built knowledge base, whose ratios are used (fixed values).
ENTITIES, PREDICATES, CONCEPTS, TRIPLES = 2_297_995, 207_633, 66_523, 38_450_135
TRIPLE_BYTES, HEADROOM = 1_024, 1.5
VECTOR_BYTES = 4_300


def expected_rows(entities: int) -> dict[str, int]:
    """Rows to expect of each table, with headroom."""
    return {
        "entity": math.ceil(entities * HEADROOM),
        "predicate": math.ceil(entities * PREDICATES / ENTITIES * HEADROOM),
        "concept": math.ceil(entities * CONCEPTS / ENTITIES * HEADROOM),
        "triple": math.ceil(entities * TRIPLES / ENTITIES),
    }


def expected_bytes(entities: int) -> dict[str, int]:
    """Bytes to expect of the facts and the vectors."""
    rows = expected_rows(entities)
    return {"triple": math.ceil(rows["triple"] * TRIPLE_BYTES * HEADROOM), "vectors": (rows["entity"] + rows["predicate"] + rows["concept"]) * VECTOR_BYTES}


def partitions(entities: int, partition_bytes: int = 128 << 20) -> int:
    """Partitions that keep the facts of one within ``partition_bytes``."""
    return max(1, math.ceil(expected_bytes(entities)["triple"] / partition_bytes))
