"""DataFrame helpers."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``unionByName`` of many frames as a balanced tree.

    A left-deep chain re-analyses the growing plan at every step (quadratic
    driver time for long suites); pairing keeps it at n·log n. Catalyst
    flattens the nested unions either way.
    """
    if not frames:
        raise ValueError("nothing to union")
    level = list(frames)
    while len(level) > 1:
        level = [level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0]
