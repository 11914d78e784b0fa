"""SimHash near-duplicates with pivot distance tables.

Each distinct fingerprint gets a table of its Hamming distances to a set of
reference fingerprints. Two fingerprints at distance d differ by at most d in
every coordinate, so a pair whose largest coordinate difference is over the
limit is discarded before the distance itself is computed. The pairs shown to
the table are those that agree on all but ``max_bits`` of ``blocks`` bit
blocks, which every linked pair does; without such a key the table alone would
have to see all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, text_or_empty
from .components import components

SHINGLE_WORDS, MAX_BITS = 3, 2
SEED = 42  # fixed value
PIVOTS = 16
# Fingerprints in a bucket that are compared in it; members of fuller buckets
# are dealt again by finer blocks, whose buckets hold at most 2 ** FREE_BITS.
BUCKET = 256
FREE_BITS = 8
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash (as a signed integer) of the text's word shingles."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(parts), ROWS_AT_ONCE):
        some = parts[at:at + ROWS_AT_ONCE]
        h = np.fromiter((xxh64_intdigest(p, SEED) for p in some), "<u8", len(some))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(parts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text) and ``fp`` (bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(fps, pa.int64())],
                                             ["doc_id", "h", "fp"])

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return kept.withColumn("h", F.xxhash64("text")).mapInArrow(run, "doc_id bigint, h bigint, fp bigint")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Signed masks of all but ``max_bits`` of ``blocks`` even bit blocks."""
    at = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(at, at[1:])]
    masks = [sum(c) for c in combinations(one, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _blocks_for(count: int, max_bits: int) -> int:
    """Blocks whose keys have enough bits for few chance members in a bucket."""
    blocks = max_bits + 1
    while 64 * (blocks - max_bits) // blocks < 48 and count >> (64 * (blocks - max_bits) // blocks) > 4:
        blocks += 1
    return blocks


def _keyed(nodes: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    keys = [F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
            for i, m in enumerate(block_masks(blocks, max_bits))]
    return nodes.select("fp", "pivots", F.inline(F.array(*keys)))


def _links(keyed: DataFrame, max_bits: int, pivots: int) -> DataFrame:
    """Verified pairs of a bucket whose pivot distances are close enough."""
    a = keyed.select("block", "bits", F.col("fp").alias("a"), F.col("pivots").alias("pa"))
    b = keyed.select("block", "bits", F.col("fp").alias("b"), F.col("pivots").alias("pb"))
    near = F.col("a") < F.col("b")
    for i in range(pivots):
        near &= F.abs(F.col("pa")[i] - F.col("pb")[i]) <= max_bits
    near &= F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    on = (a["block"] == b["block"]) & (a["bits"] == b["bits"])
    return a.join(b, on & near).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    pivots: int = PIVOTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``h`` (hash of the text), ``fp``
    (signed), ``root`` (smallest fingerprint reachable over links of at most
    ``max_bits`` bits) and ``component_id`` (smallest doc_id so reachable).

    Texts without words have fingerprint 0 and are linked like any other.
    Equal fingerprints are one node whatever their number, so repeated rows
    and large groups of copies add no pairs. A group whose doc_ids are all
    null has a null component_id. An empty table gives no rows; other columns
    are ignored.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    table = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.xxhash64(F.lit(i)))) for i in range(pivots)])
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("pivots", table), "pivot-table")

    keyed = _keyed(nodes, _blocks_for(nodes.count(), max_bits), max_bits)
    full = keyed.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > BUCKET)
    full = stored(full.select("block", "bits"), "full-buckets")
    links = _links(keyed.join(full, ["block", "bits"], "left_anti"), max_bits, pivots)
    if not full.isEmpty():
        crowd = keyed.join(full, ["block", "bits"], "left_semi").select("fp", "pivots").distinct()
        links = links.unionByName(_links(_keyed(crowd, 64 * max_bits // FREE_BITS, max_bits), max_bits, pivots))
    roots = components(links)
    of = nodes.select("fp", "first").join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = of.groupBy("root").agg(F.min("first").alias("component_id"))
    named = of.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "h", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the
    smallest doc_id (rows without one come last), of several rows with that id
    the one with the smallest text hash, of equal rows one."""
    found = near_duplicates(docs, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h"))
    keep = found.groupBy("root").agg(first.alias("first")).select(
        F.col("first.doc_id").alias("__id"), F.col("first.h").alias("__of"))
    rows = docs.withColumn("__h", F.xxhash64(text_or_empty()))
    kept = rows.join(keep, rows["doc_id"].eqNullSafe(keep["__id"]) & (rows["__h"] == keep["__of"]), "left_semi")
    order = Window.partitionBy("doc_id", "__h").orderBy(F.xxhash64(*docs.columns))
    return kept.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(*docs.columns)
