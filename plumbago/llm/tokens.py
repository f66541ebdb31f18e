"""Exact tokenisation by the tokenizers library, once for each distinct piece between white space.

Both public vocabularies that the operators use split a text before every run of white space that follows another
character, so the ids of a text are those of its pieces in order. Pieces repeat far more often than texts do.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa

from plumbago.llm.common import utf8

#: Pieces that a worker remembers before it forgets all; bounds its memory to some 100 MB.
REMEMBERED = 400_000

#: One word of Latin letters in UTF-8, with the space or line feed before it.
SINGLE = re.compile(rb"([ \n]?)((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)")

#: Marks that end a piece after a letter.
MARK = np.zeros(256, bool)
MARK[list(b".,;:!?")] = True

#: Byte-level vocabularies show a byte that is no visible Latin-1 character as one from U+0100 on.
SHOWN = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}


class Tokenizer:
    """encode() of whole texts; a null is an empty text."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer as Library

        self.library, self.remembered = Library.from_file(path), remembered
        self.library.encode_special_tokens = True  # control strings inside a text are ordinary text
        self.model, self.lower, self.direct = self.library.model, "Lowercase" in str(self.library.normalizer), True
        self.line_feed = self.library.encode("\n", add_special_tokens=False).ids
        probes = [b" The", b"word", b"\nOth\xc3\xa9r", b" \xc3\x89ti", b"a"]
        self.direct = self.ids_of(probes) == [self.library.encode(p.decode(), add_special_tokens=False).ids for p in probes]
        self.forget()

    def forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat, self.n_flat = np.empty(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def ids_of(self, pieces: list[bytes]) -> list[list[int]]:
        """Single words go straight to the library's model, which takes a fifth of the time; the rest through all its steps."""
        found: list = [None] * len(pieces)
        rest = []
        for k, piece in enumerate(pieces):
            word = SINGLE.fullmatch(piece)
            if word is None or not self.direct:
                rest.append(k)
                continue
            space, letters = word.groups()
            if self.lower:
                piece = letters.decode().lower().encode()
            elif space == b"\n":
                found[k] = self.line_feed + [t.id for t in self.model.tokenize(letters.decode("latin-1").translate(SHOWN))]
                continue
            found[k] = [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(SHOWN))]
        for k, e in zip(rest, self.library.encode_batch_fast([pieces[k].decode("utf-8", "replace") for k in rest], add_special_tokens=False), strict=True):
            found[k] = e.ids
        return found

    def learn(self, pieces: list[bytes]) -> None:
        found = self.ids_of(pieces)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        first, end = len(self.slots), self.n_flat + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.n_flat], np.empty(end, np.uint32)])
        if first + len(found) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.empty(first + len(found), np.int64)]) for x in (self.starts, self.lengths))
        self.flat[self.n_flat : end] = ids
        self.starts[first : first + len(found)] = self.n_flat + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(found)] = lengths
        self.n_flat = end
        self.slots.update(zip(pieces, range(first, first + len(found)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) one after another, and the n + 1 offsets of the texts in them."""
        data, offsets = utf8(texts)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        begins = piece_starts(data, offsets)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        if len(self.slots) > self.remembered:
            self.forget()
        distinct = pieces.dictionary.to_pylist()
        if missing := [p for p in distinct if p not in self.slots]:
            self.learn(missing)
        slot = np.fromiter(map(self.slots.__getitem__, distinct), np.int64, len(distinct))[np.asarray(pieces.indices)]
        lengths = self.lengths[slot]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[slot] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at], np.concatenate([[0], ends])[np.searchsorted(begins, offsets)]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts begin, and every space or line feed whose preceding character is certainly no white space."""
    cut = (data == 32) | (data == 10)
    before = np.empty_like(data)
    before[:1], before[1:] = 32, data[:-1]
    plain = (before > 32) & (before < 127)
    second, third = np.zeros_like(data), np.zeros_like(data)
    second[2:], third[3:] = data[:-2], data[:-3]
    # Beyond ASCII, white space is U+0085, U+00A0 or some character of three bytes that starts with E1, E2 or E3.
    wide = (before >= 128) & ~((second == 0xC2) & ((before == 0x85) | (before == 0xA0))) & ~((third >= 0xE1) & (third <= 0xE3))
    cut &= plain | wide
    # A mark that ends a word is in no token with its letters: A to Z, a to z, or a letter of C3 80 to C3 BF.
    letter = ((before | 32) >= 97) & ((before | 32) <= 122) | (second == 0xC3) & (before >= 128) & (before != 0x97) & (before != 0xB7)
    cut |= MARK[data] & letter
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One for each worker process and vocabulary."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]
