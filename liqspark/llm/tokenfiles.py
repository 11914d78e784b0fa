"""Token ids as Arrow files of equal-length sequences.

Documents in ascending ``doc_id`` order form one stream of ids. Each file
holds a range of documents: record batches of fixed-size lists, so sequence
``i`` of a file lies at a computable place and is read without a copy from a
memory map. ``mask`` (a bit an id) tells ids from padding, which only the last
sequence of a file has; ``doc_ids`` and ``doc_ends`` list the documents that
end in a sequence and the place there of their last ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, text_or_empty, vocabulary
from .tokens import encoder

MANIFEST = "part bigint, path string, n_docs bigint, n_tokens bigint, n_sequences bigint"
DOCUMENT = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def file_schema(seq_len: int, vocab_size: int) -> pa.Schema:
    """Ids of two bytes where the vocabulary allows, else four."""
    ids = pa.uint16() if vocab_size <= 1 << 16 else pa.uint32()
    return pa.schema([("input_ids", pa.list_(ids, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)),
                      ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32()))])


class _Writer:
    """Sequences of one file, written batch by batch."""

    def __init__(self, sink, schema: pa.Schema, rows: int):
        self.schema, self.rows = schema, rows
        self.seq_len = schema.field("input_ids").type.list_size
        self.dtype = schema.field("input_ids").type.value_type.to_pandas_dtype()
        self.out = pa.ipc.new_file(sink, schema)
        self.ids: list[np.ndarray] = []
        self.held = self.docs = self.tokens = self.sequences = 0
        self.ends: list[tuple[int, int | None]] = []  # place in what is held, doc_id

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.docs += 1
        self.tokens += len(ids)
        self.ends.append((self.held - 1, doc_id))
        if self.held >= self.rows * self.seq_len:
            self._write(self.held // self.seq_len)

    def _write(self, n: int) -> None:
        size, flat = n * self.seq_len, np.concatenate(self.ids) if self.ids else np.zeros(0, self.dtype)
        taken, rest = flat[:size], flat[size:]
        ids = np.zeros(size, self.dtype)
        ids[:len(taken)] = taken
        here = [e for e in self.ends if e[0] < size]
        docs: list[list[int | None]] = [[] for _ in range(n)]
        places: list[list[int]] = [[] for _ in range(n)]
        for at, doc in here:
            docs[at // self.seq_len].append(doc)
            places[at // self.seq_len].append(at % self.seq_len)
        lists = pa.FixedSizeListArray.from_arrays
        columns = [lists(pa.array(ids), self.seq_len), lists(pa.array(np.arange(size) < len(taken)), self.seq_len),
                   pa.array(docs, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))]
        for batch in pa.Table.from_arrays(columns, schema=self.schema).to_batches(max_chunksize=self.rows):
            self.out.write_batch(batch)
        self.sequences += n
        self.ids, self.held = ([rest] if len(rest) else []), len(rest)
        self.ends = [(at - size, doc) for at, doc in self.ends[len(here):]]

    def close(self) -> None:
        if self.held:
            self._write(-(-self.held // self.seq_len))
        self.out.close()


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, folder: str, vocab_path: str | None = None, end_id: int = 1,
                      seq_len: int = 1024, rows: int = 256) -> DataFrame:
    """Writes the ids of every text of ``docs`` to ``folder`` (shared by all
    executors) and returns its manifest, one row a file in stream order, with
    ``base``: ids in the files before it.

    One exchange sorts the documents by range. A task writes its file under a
    name of its own and then renames it, so a repeated or speculative task
    leaves the same file. Null and empty texts are the end id alone; null
    doc_ids come first; rows that share a doc_id follow each other by text.
    An empty table gives no files. Other columns of ``docs`` are ignored.
    """
    vocab = vocab_path or vocabulary("word_bpe_49k.json")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, writer, sink = encoder(vocab), TaskContext.get().partitionId(), None, None
        end = np.array([end_id], "<u4").tobytes()
        fs, root = _file_system(folder)
        draft = f"{root}/.draft-{part:06d}-{uuid.uuid4().hex}"
        for b in slices(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(draft)
                    writer = _Writer(sink, file_schema(seq_len, enc.vocab_size), rows)
                writer.add(doc_id, np.frombuffer(enc.encode_bytes(text) + end, "<u4"))
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(draft, f"{root}/tokens-{part:06d}.arrow")
            yield pa.RecordBatch.from_pydict({
                "part": [part], "path": [f"{folder}/tokens-{part:06d}.arrow"], "n_docs": [writer.docs],
                "n_tokens": [writer.tokens], "n_sequences": [writer.sequences]})

    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    files = sorted(ordered.mapInArrow(write, MANIFEST).collect(), key=lambda r: r["part"])  # one row a file
    base, rows_out = 0, []
    for r in files:
        rows_out.append((*r, base))
        base += r["n_tokens"]
    return docs.sparkSession.createDataFrame(rows_out, f"{MANIFEST}, base bigint")


class TokenFile:
    """Random access to the sequences of one file, as views of the map."""

    def __init__(self, path: str):
        fs, name = _file_system(path)
        self.source = pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name)
        self.reader = pa.ipc.open_file(self.source)
        self.seq_len = self.reader.schema.field("input_ids").type.list_size

    def batches(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[int | None]]]:
        """Of each batch: its ids without padding, and of the documents that
        end in it the place after the last id, and the doc_id."""
        for i in range(self.reader.num_record_batches):
            b = self.reader.get_batch(i)
            ends = b.column("doc_ends")
            row = np.repeat(np.arange(b.num_rows), ends.value_lengths().to_numpy())
            yield (b.column("input_ids").flatten().to_numpy()[:b.column("mask").flatten().true_count],
                   row * self.seq_len + ends.flatten().to_numpy() + 1, b.column("doc_ids").flatten().to_pylist())

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``."""
        for k in range(self.reader.num_record_batches):
            b = self.reader.get_batch(k)
            if i < b.num_rows:
                ids, mask = (b.column(c).flatten().slice(i * self.seq_len, self.seq_len) for c in ("input_ids", "mask"))
                return ids.to_numpy(), mask
            i -= b.num_rows
        raise IndexError(i)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids before it in the
    stream), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    spark: SparkSession = manifest.sparkSession

    def documents(path: str, base: int) -> Iterator[tuple]:
        held: list[np.ndarray] = []
        start = base
        for ids, ends, docs in TokenFile(path).batches():
            at = 0
            for end, doc in zip(ends.tolist(), docs):
                held.append(ids[at:end].astype("<u4"))
                whole = b"".join([x.tobytes() for x in held])
                yield doc, start, len(whole) // 4, whole
                start, at, held = start + len(whole) // 4, end, []
            if at < len(ids):
                held.append(ids[at:].astype("<u4"))

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                rows: list[tuple] = []
                size = 0
                for row in documents(path, base):
                    rows.append(row)
                    size += row[2]
                    if size >= 1 << 20:  # ids in a batch
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                         schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                     schema=schema)

    files = max(1, manifest.count())
    return manifest.select("path", "base").repartition(min(files, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(
        read, DOCUMENT)
