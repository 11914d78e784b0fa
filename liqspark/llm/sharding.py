"""Histogram sort: documents into shards of equal bytes.

Documents are ordered by (hash of the text, hash of the doc_id), so copies lie
together. Each round counts exact bytes and rows below candidate boundaries in
one aggregation; cells that still hold a wanted splitter, or too many rows to
number in one task, get a finer grid of candidates in the next round. A group
of copies that fills a cell is probed by the second hash. When every splitter
is within tolerance the rows are exchanged once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import stored, text_or_empty

SHARDS = 8
TOLERANCE = 0.001  # of a shard's bytes
MIN_CELL_BITS, MAX_CELL_BITS = 12, 20  # first grid; the driver holds one row a cell
ROWS_PER_CELL = 20_000
HEAVY = 8  # times the mean rows of a cell
PROBE_BITS = 8  # candidates within a refined cell
ROUNDS = 12
KEY_BITS = 63


def key_columns() -> dict[str, Column]:
    """Order key (two non-negative 63-bit hashes) and size of a row."""
    text = text_or_empty()
    return {"_k1": F.shiftrightunsigned(F.xxhash64(text), 1),
            "_k2": F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("bigint")), 1),
            "_size": (F.octet_length(text) + 1).cast("bigint")}


def _paths(rows: DataFrame, grids: list[DataFrame], bits: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with the cell of each round: the first from the top bits of the
    key, later ones where the cell before was refined (else -1)."""
    rows = rows.withColumn("_c0", F.shiftright("_k1", KEY_BITS - bits))
    path = ["_c0"]
    for r, grid in enumerate(grids, 1):
        # a grid has a row per refined cell, far fewer than the first grid's bound
        rows = rows.join(F.broadcast(grid), path, "left").withColumn(f"_c{r}", F.coalesce(
            F.expr("shiftright(if(_second, _k2, _k1) - _low, _shift)"), F.lit(-1).cast("bigint"))).drop(
            "_second", "_low", "_shift")
        path.append(f"_c{r}")
    return rows, path


def _edges(leaves: list, shards: int, slack: float) -> list[int]:
    """For each wanted splitter the leaf that begins the next shard: the
    nearest edge, or within ``slack`` bytes the nearest that parts no group."""
    total, at, starts = sum(x["bytes"] for x in leaves), 0, []
    for x in leaves:
        starts.append(at)
        at += x["bytes"]
    starts.append(total)
    parts = [0 < i < len(leaves) and leaves[i - 1]["k1_max"] == leaves[i]["k1_min"] for i in range(len(leaves) + 1)]
    found, low = [], 0
    for j in range(1, shards):
        target, i = total * j / shards, low
        while i < len(leaves) and starts[i] < target:
            i += 1
        near = [e for e in range(low, len(starts)) if abs(starts[e] - target) <= slack] if slack else []
        whole = [e for e in near if not parts[e]]
        best = whole or [e for e in (i - 1, i) if e >= low]
        low = min(best, key=lambda e: abs(starts[e] - target))
        found.append(low)
    return found


def _unsettled(leaves: list, shards: int, slack: float, heavy: float) -> list:
    """Leaves to refine: those a splitter should cut while they weigh more than
    the tolerance, and those with too many rows for one task."""
    total, at, out = sum(x["bytes"] for x in leaves), 0, []
    targets: Iterable[float] = [total * j / shards for j in range(1, shards)]
    for x in leaves:
        inside = any(at < t < at + x["bytes"] for t in targets)
        at += x["bytes"]
        single = x["rows"] == 1 or (x["k1_min"] == x["k1_max"] and x["k2_min"] == x["k2_max"])
        if not single and (x["rows"] > heavy or inside and x["bytes"] > slack):
            out.append(x)
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text, null: none, plus 1),
    ``shard`` (0 to ``shards`` - 1, bytes near equal) and ``slot`` (gapless
    from 0 within the shard, in key order).

    Equal texts are neighbours and share a shard unless a splitter has to cut
    their group. Rows that repeat both doc_id and text can't be told apart by
    the key and stay together; null texts count as empty, null doc_ids as one
    id. With fewer rows than shards some shards are empty. Columns of ``docs``
    named like a result column are replaced.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    keyed = docs.select(*names, *[c.alias(n) for n, c in key_columns().items()])
    keys = stored(keyed.select("_k1", "_k2", "_size"), "shard-keys")
    count = keys.count()
    bits = min(MAX_CELL_BITS, max(MIN_CELL_BITS, (count // ROWS_PER_CELL).bit_length()))
    heavy = HEAVY * max(1.0, count / 2 ** bits)

    def histogram(rows: DataFrame, path: list[str]) -> list:
        return rows.groupBy(*path).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("_size").alias("bytes"), F.min("_k1").alias("k1_min"),
            F.max("_k1").alias("k1_max"), F.min("_k2").alias("k2_min"), F.max("_k2").alias("k2_max")).collect()

    def path_of(leaf: dict, n: int) -> list[int]:
        return [leaf.get(f"_c{i}", -1) for i in range(n)]

    grids: list[DataFrame] = []
    rows, path = _paths(keys, grids, bits)
    leaves = sorted((r.asDict() for r in histogram(rows, path)), key=lambda x: path_of(x, 1))  # one row a cell
    slack = tolerance * sum(x["bytes"] for x in leaves) / shards
    for _ in range(ROUNDS):
        refined = _unsettled(leaves, shards, slack, heavy)
        if not refined:
            break
        cells = []
        for x in refined:
            second = x["k1_min"] == x["k1_max"]
            low, high = (x["k2_min"], x["k2_max"]) if second else (x["k1_min"], x["k1_max"])
            cells.append((*path_of(x, len(path)), second, low, max(0, (high - low).bit_length() - PROBE_BITS)))
        schema = T.StructType([T.StructField(c, T.LongType()) for c in path] + [
            T.StructField("_second", T.BooleanType()), T.StructField("_low", T.LongType()),
            T.StructField("_shift", T.IntegerType())])
        grids.append(spark.createDataFrame(cells, schema))
        rows, path = _paths(keys, grids, bits)
        finer = [r.asDict() for r in histogram(rows.where(F.col(path[-1]) >= 0), path)]
        gone = {tuple(path_of(x, len(path) - 1)) for x in refined}
        leaves = sorted([x for x in leaves if tuple(path_of(x, len(path) - 1)) not in gone] + finer,
                        key=lambda x: path_of(x, len(path)))

    edges, table, shard, base = _edges(leaves, shards, slack), [], 0, 0
    for i, x in enumerate(leaves):
        while shard < shards - 1 and i >= edges[shard]:
            shard, base = shard + 1, 0
        table.append((*path_of(x, len(path)), i, shard, base))
        base += x["rows"]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in path] + [
        T.StructField("_leaf", T.LongType()), T.StructField("shard", T.IntegerType()),
        T.StructField("_base", T.LongType())])
    placed, _ = _paths(keyed, grids, bits)
    # at most 2 ** MAX_CELL_BITS cells, and PROBE_BITS more in each refined one
    placed = placed.join(F.broadcast(spark.createDataFrame(table, schema)), path)
    order = Window.partitionBy("_leaf").orderBy("_k1", "_k2", "doc_id")
    return placed.withColumn("slot", F.row_number().over(order) - 1 + F.col("_base")).select(
        *names, F.col("_size").alias("size"), "shard", F.col("slot").cast("bigint").alias("slot"))
