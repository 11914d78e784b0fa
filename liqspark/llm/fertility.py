"""Quality rules: plain counts of a text, and how well public vocabularies
cover it.

The words of a text are tokenized under two public vocabularies. Characters per
token, the share of byte-fallback tokens and the entropy of the text's tokens
(as a share of what a text of that many tokens can reach) are held against a
band of the text's language, or of its script where the language has none.
"""

from __future__ import annotations

import base64
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import slices, vocabulary

SPACE = "\u2581"  # how pieces write a space
SPACES = b" \t\n\x0b\x0c\r"  # what separates words
CONTINUED = bytes(range(0x80, 0xC0))  # bytes that begin no code point
SYMBOLS = b"#*$%&|<>"
WINDOW = 5  # words of a window that repeats
MIN_WORDS, MAX_REPEATED = 10, 20  # words; hundredths of them in repeated windows
CACHE_WORDS = 400_000


@dataclass(frozen=True)
class Band:
    """What long texts of a language or script may measure. A text of n tokens
    may miss each bound by its slack over the square root of n, since the
    measures of short texts scatter that much more."""
    min_chars: float  # characters a token, under the piece vocabulary
    max_chars: float
    min_multi: float  # and under the multilingual one
    max_bytes: float  # share of byte-fallback tokens
    min_entropy: float  # share of the bits within reach: ``ENTROPY``, or log2(n) if less


ENTROPY = 6.7
SLACK_CHARS, SLACK_BYTES, SLACK_ENTROPY = 2.0, 0.5, 0.6
# Lower bounds of the four languages: just below what labelled good texts that
# aren't held out reach (sf0.1, about 2,500 texts). The other bounds, and the
# bands of scripts, are wide: nothing here to fit them on (see ``fit_bands``).
BANDS: dict[str, Band] = {
    "de": Band(1.95, 6.0, 2.17, 0.05, 0.86), "en": Band(1.95, 6.0, 2.15, 0.05, 0.86),
    "es": Band(1.80, 6.0, 2.10, 0.05, 0.86), "fr": Band(1.80, 6.0, 1.98, 0.05, 0.86),
    "latin": Band(1.20, 8.0, 1.40, 0.20, 0.70), "cyrillic": Band(0.80, 8.0, 0.80, 0.50, 0.60),
    "han": Band(0.25, 4.0, 0.25, 1.00, 0.50), "other": Band(0.20, 12.0, 0.20, 1.00, 0.40)}
# First and last code points of scripts, by their Unicode blocks.
SCRIPTS = {"latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)), "greek": ((0x370, 0x3FF),), "cyrillic": ((0x400, 0x52F),),
           "hebrew": ((0x590, 0x5FF),), "arabic": ((0x600, 0x6FF),), "devanagari": ((0x900, 0x97F),),
           "thai": ((0xE00, 0xE7F),), "hangul": ((0xAC00, 0xD7AF),), "kana": ((0x3040, 0x30FF),),
           "han": ((0x3400, 0x9FFF),)}


def counts(raw: bytes) -> tuple[list[bytes], int, int, int, int]:
    """Words of a UTF-8 text, code points in them, symbols, repeated lines and
    words in repeated windows."""
    words = raw.split()  # at ASCII white space alone
    chars = len(raw.translate(None, SPACES + CONTINUED))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return words, chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    name = ids  # of the window that begins at each word; longer by one word a step
    for k in range(1, window):
        name = np.unique(name[:-1] * len(number) + ids[k:], return_inverse=True)[1]
    often = np.bincount(name)[name] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(often), 1)
    np.add.at(edge, np.flatnonzero(often) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


class Vocabularies:
    """Tokens of words: ids under the piece vocabulary, how many under the
    multilingual one. A worker keeps a bounded number of words; what is met
    again moves to the newer of two generations, the older is dropped whole."""

    def __init__(self, piece_path: str, multi_path: str, cache_words: int = CACHE_WORDS):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.begins = np.array([self.pieces.id_to_piece(i).startswith(SPACE) for i in range(len(self.is_byte))])
        with open(multi_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.multi = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.new: dict[bytes, tuple[bytes, int]] = {}
        self.old: dict[bytes, tuple[bytes, int]] = {}
        self.limit = cache_words // 2

    def _add(self, missing: list[bytes]) -> None:
        known = [(w, self.old[w]) for w in missing if w in self.old]
        unknown = [w for w in missing if w not in self.old]
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new.update(known)
        text = [w.decode() for w in unknown]
        for w, t, ids in zip(unknown, text, self._piece_ids(text)):
            self.new[w] = (ids, len(self.multi.encode_ordinary(t)))

    def _piece_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers. One call
        encodes all: no piece goes beyond a space, so every word begins with a
        piece that does; if the numbers differ, each word has a call of its own."""
        if len(words) > 1:
            ids = np.array(self.pieces.encode(" ".join(words)), "<u4")
            first = np.flatnonzero(self.begins[ids])
            if len(first) == len(words) and not first[0] and not any(SPACE in w for w in words):
                raw, at = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
                return [raw[a:b] for a, b in zip(at, at[1:])]
        return [np.array(self.pieces.encode(w), "<u4").tobytes() for w in words]

    def measure(self, words: list[bytes], chars: int) -> tuple[float, float, float, float, int]:
        """Characters per token under both, byte-fallback share, entropy of the
        tokens in bits and their number; zeros without words."""
        if not words:
            return 0.0, 0.0, 0.0, 0.0, 0
        found = list(map(self.new.get, words))
        if None in found:
            self._add(list(dict.fromkeys([w for w, x in zip(words, found) if x is None])))
            found = [self.new.get(w) or self.old[w] for w in words]  # the generations may have changed
        ids, multi = zip(*found)
        ids, multi = np.frombuffer(b"".join(ids), "<u4"), sum(multi)
        n = len(ids)
        if not n:
            return 0.0, 0.0, 0.0, 0.0, 0
        kinds, often = np.unique(ids, return_counts=True)
        share = often / n
        return (chars / n, chars / max(multi, 1), float(often[self.is_byte[kinds]].sum() / n),
                float(max(0.0, -(share * np.log2(share)).sum())), n)


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def _vocabularies(piece_path: str, multi_path: str) -> Vocabularies:
    """One object a worker process and pair of vocabularies."""
    if (piece_path, multi_path) not in _LOADED:
        _LOADED[piece_path, multi_path] = Vocabularies(piece_path, multi_path)
    return _LOADED[piece_path, multi_path]


def script_of(text: str) -> str:
    """The script most letters of a text belong to, or ``other``."""
    found: Counter[str] = Counter()
    for c, n in Counter(text).items():
        if ord(c) > 0x40 and unicodedata.category(c)[0] in "LM":
            found[next((s for s, ranges in SCRIPTS.items() if any(a <= ord(c) <= b for a, b in ranges)), "other")] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "other"


def band_of(lang: str | None, text: str, bands: dict[str, Band]) -> str:
    """Name of the band: the language's (its first subtag), else the script's."""
    name = (lang or "").lower().replace("_", "-").split("-")[0]
    if name in bands:
        return name
    script = script_of(text)
    return script if script in bands else "other"


def fits(band: Band, chars: float, multi: float, fallback: float, entropy: float, n: int) -> bool:
    """Whether the measures of a text of ``n`` tokens lie in the band."""
    if not n:
        return True
    root, reach = math.sqrt(n), min(ENTROPY, math.log2(n))
    return (band.min_chars - SLACK_CHARS / root <= chars <= band.max_chars + SLACK_CHARS / root
            and multi >= band.min_multi - SLACK_CHARS / root and fallback <= band.max_bytes + SLACK_BYTES / root
            and entropy >= (band.min_entropy - SLACK_ENTROPY / root) * reach)


SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, band string, n_tokens bigint, chars_per_token double, "
          "multi_chars_per_token double, byte_share double, token_entropy double")


def judge_documents(docs: DataFrame, bands: dict[str, Band] = BANDS, piece_path: str | None = None,
                    multi_path: str | None = None) -> DataFrame:
    """Counts, measures and verdict of every row of ``docs``: ``base_failed``
    for under ``MIN_WORDS`` words or too many of them in repeated windows,
    ``kept`` if that isn't so and the measures lie in the text's band.

    ``lang`` is used if it is a column of ``docs``. Null and empty texts have no
    words and aren't kept; a null doc_id or lang and repeated rows give a row
    each. One pass over whole texts without a shuffle; other columns are
    ignored, an empty table gives no rows.
    """
    piece, multi = piece_path or vocabulary("piece_bpe_32k.model"), multi_path or vocabulary("byte_bpe_multi_50k.tiktoken")
    bands = {**{"other": BANDS["other"]}, **bands}
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = _vocabularies(piece, multi)
        for b in slices(batches):
            rows = []
            for doc_id, said, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                words, chars, symbols, lines, repeated = counts((text or "").encode())
                measures = vocabularies.measure(words, chars)
                failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
                name = band_of(said, text or "", bands)
                rows.append((doc_id, len(words), chars, symbols, lines, repeated, failed,
                             not failed and fits(bands[name], *measures), name, measures[-1], *measures[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(SCHEMA))
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lang.alias("lang"),
                       F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, SCHEMA)


def fit_bands(judged: DataFrame, names: list[str], out: float = 0.002) -> dict[str, Band]:
    """Bands for ``names`` (languages or scripts) from rows of
    ``judge_documents`` taken as good: at each bound a share ``out`` of a
    name's texts lies beyond, the slack of short texts counted in. A name
    without rows gets none. One aggregation over all rows; a row a name comes back."""
    root = F.sqrt("n_tokens")
    reach = F.least(F.lit(ENTROPY), F.log2("n_tokens"))
    at = lambda value, share: F.percentile_approx(value, share, 10_000)
    rows = judged.where(F.col("band").isin(names) & (F.col("n_tokens") > 1) & ~F.col("base_failed")).groupBy("band").agg(
        at(F.col("chars_per_token") + SLACK_CHARS / root, out).alias("min_chars"),
        at(F.col("chars_per_token") - SLACK_CHARS / root, 1 - out).alias("max_chars"),
        at(F.col("multi_chars_per_token") + SLACK_CHARS / root, out).alias("min_multi"),
        at(F.col("byte_share") - SLACK_BYTES / root, 1 - out).alias("max_bytes"),
        at(F.col("token_entropy") / reach + SLACK_ENTROPY / root, out).alias("min_entropy")).collect()
    return {r["band"]: Band(r["min_chars"], r["max_chars"], r["min_multi"], max(0.0, r["max_bytes"]), r["min_entropy"])
            for r in rows}
