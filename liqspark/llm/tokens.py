"""Tokenizing whole texts with the tokenizers library, a piece at a time.

Both public vocabularies split a text into pieces and merge within each, so
the ids of a text are the ids of its pieces. Pieces repeat, so each worker
keeps the ids of those it has met, a bounded number; every id comes from the
library. Text with characters whose case, normal form or class could differ
between engines is cut at spaces, and its odd parts are encoded in one call.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

SPECIAL = "<|"
# Letters and digits below U+0250, for which classes and case agree everywhere.
L, N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]|İ")
NOT_ODD = bytes([9, 10, 13, *range(32, 127), *range(161, 256)])  # of Latin-1
# The vocabularies' own splits, over those classes.
WORD_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\\s{L}{N}]+")
BYTE_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\\s{L}{N}]+|\\s+(?!\\S)|\\s+")
# A lone space between two visible characters always begins a piece.
LONE_SPACE = re.compile(r"(?<=\S)(?= \S)")
CACHE_PIECES = 400_000

_ENCODERS: dict[str, "Encoder"] = {}


def is_odd(text: str) -> bool:
    try:
        return bool(text.encode("latin-1").translate(None, NOT_ODD))
    except UnicodeEncodeError:
        return ODD.search(text) is not None


def byte_letters() -> list[str]:
    """The visible character that byte-level vocabularies use for each byte:
    itself if printable, else the next unused code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """``encode(text)``: the ids that ``Tokenizer.encode(text,
    add_special_tokens=False)`` gives."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # the pieces are kept here
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # two generations: what is met again moves to the newer, the older is dropped whole
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.limit = cache_pieces // 2
        self.letters = byte_letters()
        self.space = self.letters[32]
        before = kind.get("pre_tokenizer") or {}
        normal = [x.get("type") for x in (kind.get("normalizer") or {}).get("normalizers", [])]
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get(
            "add_prefix_space") and kind.get("normalizer") is None
        word_level = normal == ["NFC", "Replace", "Lowercase"] and [
            x.get("type") for x in before.get("pretokenizers", [])] == ["Split", "ByteLevel"]
        self.lower = word_level
        self.split = BYTE_SPLIT if byte_level else WORD_SPLIT if word_level else None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that isn't in the newer generation."""
        ids = self.old.get(piece)
        if ids is None:
            if not piece.isascii() or piece.isspace():
                raw = "".join([self.letters[b] for b in piece.encode("utf-8")])
            else:  # in visible ASCII pieces only a first space is shown otherwise
                raw = self.space + piece[1:] if piece[0] == " " else piece
            ids = array("I", [t.id for t in self.model.tokenize(raw)]).tobytes()
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[piece] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        pieces = self.split.findall(text.lower() if self.lower else text)
        ids = list(map(self.new.get, pieces))
        if None in ids:
            for i, x in enumerate(ids):
                if x is None:
                    ids[i] = self.new.get(pieces[i]) or self._piece(pieces[i])
        return b"".join(ids)

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split is None or SPECIAL in text:
            return self._whole(text)
        if not is_odd(text):
            return self._plain(text)
        return b"".join([self._whole(part) if is_odd(part) else self._plain(part) for part in LONE_SPACE.split(text)])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()


def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
