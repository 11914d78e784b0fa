"""Fill-in-middle: a text's middle is moved to its end, between sentinels.

A text is cut between tokens (runs of ASCII letters, or single other code
points) into prefix, middle and suffix. One scan over its bytes finds the cuts;
the sentinels are inserted into a bytearray, and two neighbouring blocks change
places by three reversals. The same rotation, inverted, restores the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import slices

# Sentinels, and the shares of the forms in hundredths.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MOVED, SUFFIX_FIRST = 90, 20
SEED = 1

LETTERS = bytes([*range(65, 91), *range(97, 123)])
IS_LETTER = np.isin(np.arange(256), list(LETTERS))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers of a document; a null id is no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def token_starts(raw: bytes) -> np.ndarray:
    """First byte of each token of a UTF-8 text, and its length at the end."""
    b = np.frombuffer(raw, np.uint8)
    letter = IS_LETTER[b]
    first = (b & 0xC0) != 0x80  # of a code point
    first[1:] &= ~(letter[1:] & letter[:-1])
    return np.append(np.flatnonzero(first), len(raw))


def rotate(buf: bytearray, first: int, mid: int, end: int) -> None:
    """Blocks ``first:mid`` and ``mid:end`` change places, by three reversals."""
    for a, b in ((first, mid), (mid, end), (first, end)):
        buf[a:b] = buf[a:b][::-1]


def transform(raw: bytes, form: str, cut1: int, cut2: int) -> bytes:
    """The text with its middle ``cut1:cut2`` last, in form ``psm`` or ``spm``."""
    buf = bytearray(raw)
    for at, mark in ((cut2, SUFFIX), (cut1, MIDDLE), (0, PREFIX)):
        buf[at:at] = mark
    middle, suffix = cut1 + len(PREFIX), cut2 + len(PREFIX) + len(MIDDLE)
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return bytes(buf)


def invert(out: bytes, form: str) -> bytes:
    """The text that ``transform`` was given, from its result and form alone.
    No sentinel was in the text, so each is found where it was put."""
    if form == "plain":
        return out
    buf = bytearray(out)
    # where the rotated blocks begin and meet now
    first, meet = (buf.index(SUFFIX), buf.index(MIDDLE)) if form == "psm" else (0, buf.index(PREFIX))
    rotate(buf, first, meet, len(buf))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buf.index(mark)
        del buf[at:at + len(mark)]
    return bytes(buf)


def fill_in_middle(raw: bytes, doc_id: int | None, seed: int = SEED, moved: int = MOVED,
                   suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, bytes]:
    """Tokens, form, code points of prefix and middle (none if plain), output."""
    at = token_starts(raw)
    n, (h1, h2, h3, h4) = len(at) - 1, draws(doc_id, seed)
    if not raw or h3 % 100 >= moved or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, raw
    cut1, cut2 = sorted((int(at[h1 % (n + 1)]), int(at[h2 % (n + 1)])))
    form = "spm" if h4 % 100 < suffix_first else "psm"
    chars = [len(raw[a:b].decode()) for a, b in ((0, cut1), (cut1, cut2))]
    return n, form, *chars, transform(raw, form, cut1, cut2)


def transform_documents(docs: DataFrame, seed: int = SEED, moved: int = MOVED,
                        suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id``, ``n`` (tokens), ``form`` (``plain``, ``psm`` or ``spm``),
    ``prefix_chars``, ``middle_chars`` (code points; null if plain) and
    ``output`` of every row of ``docs``.

    Cuts and form follow from ``seed`` and doc_id alone, so repeated rows give
    equal rows; a null doc_id draws like an empty one. Null and empty texts, and
    those that hold a sentinel, stay as they are (``plain``). One pass without a
    shuffle; other columns are ignored, an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids = b.column("doc_id")
            done = [fill_in_middle(t or b"", i, seed, moved, suffix_first)
                    for i, t in zip(ids.to_pylist(), b.column("raw").to_pylist())]
            n, form, prefix, middle, out = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("raw"))
    return kept.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                "output string")


def restore_documents(moved: DataFrame) -> DataFrame:
    """``moved`` with ``restored``: the text rebuilt from ``output`` and
    ``form`` alone. Null outputs and forms count as an empty, plain text; any
    other column stays (one named ``restored`` is replaced)."""
    kept = moved.drop("restored")
    schema = StructType([*kept.schema.fields, StructField("restored", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            back = [invert((o or "").encode(), f or "plain").decode()
                    for o, f in zip(b.column("output").to_pylist(), b.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.string())], [*b.schema.names, "restored"])

    return kept.mapInArrow(run, schema)
