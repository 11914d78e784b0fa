"""Secret scan: fixed patterns plus a token-efficiency test.

A byte-level BPE vocabulary covers natural words with few tokens, while random
strings break into pieces of one or two characters. Runs of key-like characters
whose characters-per-token ratio is low are reported, and so are their parts
between separators; known digests, numbers and parts made of words that the
vocabulary covers in few tokens are set aside.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, vocabulary

# The base patterns and the order of their kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 8
# A run that fails its length is consumed whole, so "run, then length test" equals a minimum in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)  # MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512
# A part of a run: a UUID, or what lies between separators.
PART = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])|[A-Za-z0-9]+")
WORDS = re.compile(r"[A-Za-z]?[a-z]*(?:[A-Z][a-z]+)*\d{0,4}\Z|[A-Z]+\d{0,4}\Z")
# Lower-case dotted names after '://' or '@' with a top-level domain; what stands before a further '@' may be a key.
HOST = re.compile(r"(?:(?<=://)|(?<=@))[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}(?![A-Za-z0-9+_=@-]|:[^\s/@]*@)")
MIN_RANDOM = 16
MIN_MIXED = 12  # of a part with lower-case and upper-case letters and digits
FEW = 3  # letters of a part that no ratio can judge
MAX_RATIO = 2.3

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
_ENCODINGS: dict[str, object] = {}


def _encoding(path: str):
    """One tiktoken encoding a worker process."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                             special_tokens={})
    return _ENCODINGS[path]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns, leftmost and non-overlapping per kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def is_covered(part: str, encoding, max_ratio: float = MAX_RATIO) -> bool:
    """Known digests, UUIDs, numbers and words in few tokens are no secrets."""
    if "-" in part or part.isdigit() or DIGEST.match(part) and len(part) in DIGEST_LENGTHS:
        return True
    return bool(WORDS.match(part)) and (len(part) <= FEW or len(part) > max_ratio * len(encoding.encode_ordinary(part)))


def random_parts(run: str, encoding, max_ratio: float = MAX_RATIO) -> list[tuple[int, int]]:
    """Random stretches of a run: all of it, or what lies between its covered parts."""
    def is_random(s: str) -> bool:
        mixed = s.isalnum() and not WORDS.match(s) and all(any(map(kind, s)) for kind in (str.isdigit, str.islower, str.isupper))
        return len(s) >= (MIN_MIXED if mixed else MIN_RANDOM) and len(s) <= max_ratio * len(encoding.encode_ordinary(s))

    parts = [(m.start(), m.end(), is_covered(m[0], encoding, max_ratio)) for m in PART.finditer(run)]
    if all(covered for *_, covered in parts):
        return []
    if is_random(run):
        return [(0, len(run))]
    found, first, last = [], None, None
    for start, end, covered in [*parts, (len(run), len(run), True)]:
        if not covered:
            first, last = start if first is None else first, end
        elif first is not None and end - start not in range(1, FEW + 1):
            if is_random(run[first:last]):
                found.append((first, last))
            first = None
    return found


def random_spans(text: str, encoding, max_ratio: float = MAX_RATIO) -> list[tuple[str, int, int]]:
    """Key-like runs with at most ``max_ratio`` characters a token, whatever
    stands before them; the host names of URLs and mail addresses are left out."""
    found = []
    hosts = [m.span() for m in HOST.finditer(text)] if "://" in text or "@" in text else []
    at = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if text.startswith("://", start - 1):
            start += 2
        while at < len(hosts) and hosts[at][1] <= start:
            at += 1
        if at < len(hosts) and hosts[at][0] < end:  # a host's last label runs into the path
            start = min(hosts[at][1], end)
        found += [("random", start + a, start + b) for a, b in random_parts(text[start:end], encoding, max_ratio)]
    return found


def secret_spans(text: str | None, encoding, max_ratio: float = MAX_RATIO) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then kind; code points, end exclusive.
    A random run that meets a base span isn't reported twice."""
    if not text:
        return []
    base = base_spans(text)
    more = [s for s in random_spans(text, encoding, max_ratio) if not any(s[1] < b[2] and b[1] < s[2] for b in base)]
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame, vocab_path: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end) of every row of ``docs``.

    One pass without a shuffle; repeated rows and null doc_ids keep a row each,
    null and empty texts have no spans, other columns are ignored.
    """
    path = vocab_path or vocabulary("byte_bpe_50k.tiktoken")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(t, encoding, max_ratio)]
                    for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(scan, f"doc_id bigint, spans {SPAN_TYPE}")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, vocab_path: str | None = None, marker: str = "[SECRET]",
           max_ratio: float = MAX_RATIO) -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced by ``marker``
    (overlapping spans by one); ``n_chars``, if there, follows. Rows, other
    columns and texts without secrets stay as they are."""
    path = vocab_path or vocabulary("byte_bpe_50k.tiktoken")

    def clean(text: str | None, encoding) -> str | None:
        out, at = [], 0
        for _, start, end in secret_spans(text, encoding, max_ratio):
            if start >= at:
                out += [text[at:start], marker]
            at = max(at, end)
        return text if not out else "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for b in slices(batches):
            was = b.column("text").to_pylist()
            new = [clean(t, encoding) for t in was]
            for name, values in (("text", new), ("n_chars", None)):
                if name in b.schema.names:
                    i = b.schema.get_field_index(name)
                    if values is None:
                        values = [n if x == y else len(y) for n, x, y in zip(b.column(i).to_pylist(), was, new)]
                    b = b.set_column(i, b.schema.field(i), pa.array(values, b.schema.field(i).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
