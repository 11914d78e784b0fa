"""Interaction of filters, from a sparse document-term matrix.

Blocks of documents become shards of a matrix in compressed sparse rows, whose
columns number the shard's own words. One shuffle of the shards' word lists
gives every word of the corpus a global number, and each shard's columns are
renumbered by it. Row sums and numbers of nonzero columns decide the filters on
word counts; the other filters travel with the rows. All orders of the filters
are then read off the counts of every combination of failed filters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import slices, stored

FILTERS = "ABCDE"
# Bounds of the filters.
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SYMBOLS = 50, 65, 5, b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CONTINUED = bytes(range(0x80, 0xC0))  # bytes that begin no code point
# A shard ends with the document that reaches either number.
SHARD_WORDS, SHARD_DOCS = 1 << 21, 1 << 16
BUCKET_WORDS = 1 << 15  # rows of the shards' word lists in one bucket of the dictionary

SHARD = ("shard bigint, n_columns bigint, words binary, doc_id array<bigint>, part array<string>, digest array<binary>, "
         "fails_c array<boolean>, fails_d array<boolean>, indptr binary, steps binary, data binary")
MATRIX = ("shard bigint, doc_id array<bigint>, part array<string>, digest array<binary>, fails_c array<boolean>, "
          "fails_d array<boolean>, indptr binary, indices binary, data binary")
ROWS = ("doc_id bigint, part string, digest binary, n_words bigint, n_distinct bigint, fails_c boolean, fails_d boolean")


def hashes(words: list[bytes]) -> np.ndarray:
    """A number below 2^32 for each word, the same everywhere."""
    return np.fromiter(map(crc32, words), "<u8", len(words))


def build_shards(docs: DataFrame, shard_words: int = SHARD_WORDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Shards of the matrix (``SHARD``): a shard's words by hash, which is the
    order of its columns, joined by spaces (no word holds one); its rows as
    ``indptr`` (64-bit), ``steps`` (from each cell's column to the next one's,
    modulo 2^32) and ``data`` (32-bit); and what else the filters need."""
    schema = to_arrow_schema(StructType.fromDDL(SHARD))

    def shard(number: int, vocab: dict, meta: list, rows: list) -> pa.RecordBatch:
        words = list(vocab)
        order = np.argsort(hashes(words), kind="stable")
        column = np.empty(len(words), "<u4")
        column[order] = np.arange(len(words))
        cells = [np.unique(column[r], return_counts=True) for r in rows]
        at = np.concatenate([c for c, _ in cells]).astype("<u4")
        matrix = [np.cumsum([0, *[len(c) for c, _ in cells]], dtype="<i8"), np.diff(at, prepend=at[:1] * 0),
                  np.concatenate([n for _, n in cells]).astype("<u4")]
        arrays = [pa.array([number], pa.int64()), pa.array([len(words)], pa.int64()),
                  pa.array([b" ".join([words[i] for i in order])], pa.binary())] + [
            pa.array([list(c)], f.type) for c, f in zip(zip(*meta), list(schema)[3:8])] + [
            pa.array([m.tobytes()], pa.binary()) for m in matrix]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        vocab, meta, rows, size = {}, [], [], 0
        for b in slices(batches):
            for doc_id, part, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "part", "raw"))):
                words = raw.split()  # at ASCII white space alone
                for w in set(words).difference(vocab):
                    vocab[w] = len(vocab)
                rows.append(np.array(list(map(vocab.__getitem__, words)), "<u4"))
                chars, upper = len(raw.translate(None, CONTINUED)), len(raw) - len(raw.translate(None, UPPER))
                meta.append((doc_id, part, hashlib.sha256(raw).digest(), 100 * upper > MAX_UPPER * chars,
                             len(raw.translate(None, SYMBOLS)) < len(raw)))
                size += len(words)
                if size >= shard_words or len(meta) >= shard_docs:
                    yield shard(number, vocab, meta, rows)
                    number += 1
                    vocab, meta, rows, size = {}, [], [], 0
        if meta:
            yield shard(number, vocab, meta, rows)

    part = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), part.alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))
    return kept.mapInArrow(run, SHARD)


def number_words(shards: DataFrame) -> tuple[DataFrame, int]:
    """Global numbers of the shards' words: rows of ``shard``, ``first`` (a
    column), ``bucket`` and ``rank`` (32-bit, of that column's word and those
    after it), and the number of buckets. A word's number is its rank times
    that, plus its bucket.

    The hash range is cut into buckets of a bounded expected number of words, so
    each is a run of a shard's columns and travels as one row. Words are
    numbered in a bucket in their own order, which a repeated task keeps. A word
    that every shard has is there once a shard.
    """
    total = shards.agg(F.sum("n_columns")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_WORDS))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, joined in zip(b.column("shard").to_pylist(), b.column("words").to_pylist()):
                words = joined.split()
                bucket = (hashes(words) * np.uint64(buckets)) >> np.uint64(32)
                first = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
                ends = [*first[1:].tolist(), len(words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(first), pa.int64()), pa.array(first, pa.int64()),
                     pa.array(bucket[first].astype("<i8"), pa.int64()),
                     pa.array([b" ".join(words[x:y]) for x, y in zip(first.tolist(), ends)], pa.binary())],
                    ["shard", "first", "bucket", "words"])

    def number(key: tuple, rows: pa.Table) -> pa.Table:
        words = [x.split() for x in rows["words"].to_pylist()]
        coded = pa.array([w for x in words for w in x], pa.binary()).dictionary_encode()
        rank = np.empty(len(coded.dictionary), "<u4")
        rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
        parts = np.split(rank[coded.indices.to_numpy()], np.cumsum([len(x) for x in words])[:-1])
        return rows.drop_columns("words").append_column("rank", pa.array([p.tobytes() for p in parts], pa.binary()))

    pieces = shards.select("shard", "words").mapInArrow(split, "shard bigint, first bigint, bucket bigint, words binary")
    ranked = pieces.groupBy("bucket").applyInArrow(number, "shard bigint, first bigint, bucket bigint, rank binary")
    return ranked, buckets


def document_terms(docs: DataFrame, shard_words: int = SHARD_WORDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The shards with global word numbers (64-bit ``indices``) for columns.

    The shards are stored once; only their word lists are shuffled by word, and
    a shard's numbers then meet its rows again by shard number.
    """
    # rows of several MB: the size of a row group is looked at after each
    shards = stored(build_shards(docs, shard_words, shard_docs), "shards", compression="zstd", **{
        "parquet.block.size": 1 << 26, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1})
    schema = to_arrow_schema(StructType.fromDDL(MATRIX))
    ranked, buckets = number_words(shards)

    def renumber(key: tuple, numbered: pa.Table, shard: pa.Table) -> pa.Table:
        numbered = numbered.sort_by("first")
        ids = np.concatenate([np.zeros(0, "<i8")] + [
            np.frombuffer(r, "<u4").astype("<i8") * buckets + k
            for r, k in zip(numbered["rank"].to_pylist(), numbered["bucket"].to_pylist())])
        cells = [ids[np.cumsum(np.frombuffer(c, "<u4"), dtype="<u4")].tobytes() for c in shard["steps"].to_pylist()]
        return shard.drop_columns("steps").append_column("indices", pa.array(cells, pa.binary())).select(
            schema.names).cast(schema)

    return ranked.groupBy("shard").cogroup(shards.drop("words", "n_columns").groupBy("shard")).applyInArrow(renumber, MATRIX)


def row_counts(matrix: DataFrame) -> DataFrame:
    """``ROWS`` of the matrix: a document's words are its row's sum, its
    distinct words the row's nonzero columns."""
    schema = to_arrow_schema(StructType.fromDDL(ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1)
                indptr, data = (np.frombuffer(row.column(c)[0].as_py(), t) for c, t in (("indptr", "<i8"), ("data", "<u4")))
                sums = np.concatenate([[0], np.cumsum(data, dtype="<i8")])[indptr]
                flat = {c: row.column(c).flatten() for c in ("doc_id", "part", "digest", "fails_c", "fails_d")}
                yield pa.RecordBatch.from_arrays(
                    [flat["doc_id"], flat["part"], flat["digest"], pa.array(np.diff(sums)), pa.array(np.diff(indptr)),
                     flat["fails_c"], flat["fails_d"]], schema=schema)

    return matrix.drop("indices").mapInArrow(run, ROWS)


def failed_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (bit i: fails filter i), ``good``, ``toxic`` and
    ``n``: how many documents there are of each kind.

    Rows are counted before they meet anything, so copies and repeated rows of
    one source travel as few rows; a text's smallest doc_id is a grouped
    minimum joined back to such counts.
    """
    bit = lambda fails, i: F.when(fails, 1 << i).otherwise(0)
    mask = (bit(F.col("n_words") < MIN_WORDS, 0) + bit(100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words"), 1)
            + bit(F.col("fails_c"), 2) + bit(F.col("fails_d"), 3))
    one = row_counts(document_terms(docs)).groupBy("doc_id", "digest", "part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"))
    # rows without an id meet no label; their digest spreads them
    spread = lambda d, extra: d.withColumn("also", extra)
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    one = spread(one, F.when(F.col("doc_id").isNull(), F.col("digest")).otherwise(F.lit(b"")))
    one = one.join(spread(said, F.lit(b"")), ["doc_id", "also"], "left")
    known = F.col("doc_id").isNotNull()
    copies = stored(one.groupBy("digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                                F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("least")), "copies")
    first = copies.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    later = F.col("known") - F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask"), (F.col("n") - later).alias("n")),
                    F.struct((F.col("mask") + 16).alias("mask"), later.alias("n")))
    return copies.join(first, "digest").select("part", "good", "toxic", F.inline(split)).where("n > 0")


def interactions(kinds: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit's rows from counted kinds (``failed_filters``). A part has at
    most one cell for every combination of failed filters; all orders and steps
    are read off those cells."""
    cells = kinds.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = parts.select("part", "cells", F.explode(orders).alias("filter_order")).select(
        "part", "cells", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    place = {1 << i: F.instr("filter_order", f) for i, f in enumerate(filters)}
    bits = lambda when: sum(F.when(when(at), bit).otherwise(0) for bit, at in place.items())
    steps = steps.select("*", bits(lambda at: at == F.col("step")).alias("own"),
                         bits(lambda at: at < F.col("step")).alias("before"))

    def total(value, when) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda sum_, c: sum_ + F.when(when(c["mask"]), value(c)).otherwise(0))

    has = lambda mask, what: mask.bitwiseAND(F.col(what)) != 0
    here = lambda m: has(m, "own") & ~has(m, "before")
    n = lambda c: c["n"]
    # of the orders, a document's removal falls to each filter it fails in as many
    share = lambda c: (c["n"] * factorial(len(filters)) / F.bit_count(c["mask"])).cast("bigint")
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total(n, lambda m: ~has(m, "own") & ~has(m, "before")).alias("kept"), total(n, here).alias("removed"),
        total(n, lambda m: has(m, "own") & has(m, "before")).alias("redundant"),
        total(n, lambda m: m == F.col("own")).alias("unique_fails"), total(lambda c: c["good"], here).alias("good_lost"),
        total(lambda c: c["toxic"], here).alias("toxic_lost"),
        total(share, lambda m: has(m, "own")).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (source; null is the empty string), order of the five filters
    and step: documents ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost`` and the filter's ``shapley`` sum.

    A null or empty text has no words and fails A only (and E, if an earlier
    document has none). Without a doc_id a row has no earlier or later
    documents: it doesn't fail E, and nothing fails E by it; it has no labels.
    Rows of the same doc_id and text are no copies of each other. A doc_id with
    several labels is good or toxic if one says so. Other columns are ignored;
    an empty table gives no rows.
    """
    return interactions(failed_filters(docs, labels))
