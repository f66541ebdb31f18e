"""Packing by best-fit decreasing: a segment tree over remaining capacities finds the tightest open window."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plumbago.llm.common import in_batches, slices
from plumbago.llm.tokens import tokenizer

#: Tokens that a task packs at once; bounds its memory.
BATCH_TOKENS = 4 << 20
#: A window that lacks more than this share of its length is filled up with cut pieces of the emptiest windows.
LOOSE = 1 / 64
PIECES = "array<struct<doc_id:bigint,start:bigint,length:bigint,doc_tokens:bigint,offset:bigint>>"


class Capacities:
    """A segment tree: leaf r counts the open windows with r free places; tightest() descends to the first leaf from s on."""

    def __init__(self, window: int):
        self.n = 1 << window.bit_length()
        self.counts = [0] * (2 * self.n)
        self.open: list[list[int]] = [[] for _ in range(self.n)]

    def add(self, free: int, window: int) -> None:
        self.open[free].append(window)
        k = free + self.n
        while k:
            self.counts[k] += 1
            k >>= 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the window with the fewest free places of at least size."""
        k = size + self.n
        while not self.counts[k]:
            while k & 1:  # a right child: nothing larger beside it
                k >>= 1
            if not k:
                return None
            k += 1
        while k < self.n:
            k = 2 * k if self.counts[2 * k] else 2 * k + 1
        free = k - self.n
        while k:
            self.counts[k] -= 1
            k >>= 1
        return free, self.open[free].pop()


def best_fit_decreasing(sizes: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (document, start, length). Documents are cut into full windows; what is left of each is placed by size, largest first.

    At the end, the emptiest windows are cut up to fill those that lack more than LOOSE of their length.
    """
    windows: list[list[tuple[int, int, int]]] = []
    rest = []
    for k, size in enumerate(sizes.tolist()):
        full = size - size % window
        windows += [[(k, at, window)] for at in range(0, full, window)]
        if size > full:
            rest.append((k, full, size - full))
    rest.sort(key=lambda p: (-p[2], p[0]))
    tree = Capacities(window)
    for piece in rest:
        if (found := tree.tightest(piece[2])) is None:
            free, w = window, len(windows)
            windows.append([])
        else:
            free, w = found
        windows[w].append(piece)
        if free > piece[2]:
            tree.add(free - piece[2], w)
    loose = [(free, w) for free, own in enumerate(tree.open) for w in own if free > window * LOOSE]
    loose.sort()
    taken: set[int] = set()
    while len(loose) > 1:
        _, donor = loose.pop()
        taken.add(donor)
        pieces, kept = windows[donor], []
        for doc, start, length in pieces:
            while length and loose:
                free, w = loose[0]
                part = min(free, length)
                windows[w].append((doc, start, part))
                start, length = start + part, length - part
                loose[0] = (free - part, w)
                if free == part:
                    loose.pop(0)
            if length:
                kept.append((doc, start, length))
        if kept:  # all others are full
            windows[donor] = kept
            taken.discard(donor)
            break
    return [w for k, w in enumerate(windows) if k not in taken]


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 2048, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Sequences of at most `window` tokens from docs (doc_id, text): sequence_id, n_tokens, padded_tokens, input_ids, pieces.

    input_ids are little-endian uint32, without the padding; padded_tokens is `window`, or n_tokens where that is a power of
    two. pieces tell which ids of which document lie where. A null text is empty and has only end_id; null and repeated
    doc_ids are packed like others; an empty table gives no sequences. Other columns are not read. There is no shuffle: each
    task packs what it reads, batch_tokens at a time, so a lost task is redone alone with the same result.
    """

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, next_id = tokenizer(tokenizer_path), TaskContext.get().partitionId() << 32
        doc_ids, held, n = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal doc_ids, held, n, next_id
            ids, sizes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            begins = np.cumsum(sizes) - sizes
            rows = best_fit_decreasing(sizes, window)
            for first in range(0, len(rows), 1000):
                names, totals, raw, pieces = [], [], [], []
                for row in rows[first : first + 1000]:
                    offset, own = 0, []
                    for doc, start, length in row:
                        own.append({"doc_id": doc_ids[doc], "start": start, "length": length, "doc_tokens": int(sizes[doc]), "offset": offset})
                        offset += length
                    names.append(next_id)
                    next_id += 1
                    totals.append(offset)
                    raw.append(np.concatenate([ids[begins[d] + s : begins[d] + s + m] for d, s, m in row]).astype("<u4").tobytes())
                    pieces.append(own)
                kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("doc_id", "start", "length", "doc_tokens", "offset")]))
                yield pa.RecordBatch.from_pydict({
                    "sequence_id": pa.array(names, pa.int64()), "n_tokens": pa.array(totals, pa.int64()), "padded_tokens": pa.array([t if t & (t - 1) == 0 else window for t in totals], pa.int64()),
                    "input_ids": pa.array(raw, pa.binary()), "pieces": pa.array(pieces, kind),
                })
            doc_ids, held, n = [], [], 0

        for batch in slices(batches, "text"):
            ids, offsets = encoder.encode(batch.column("text"))
            doc_ids += batch.column("doc_id").to_pylist()
            held.append((np.insert(ids, offsets[1:], np.uint32(end_id)), np.diff(offsets) + 1))
            n += len(held[-1][0])
            if n >= batch_tokens:
                yield from packed()
        if held:
            yield from packed()

    return docs.select("doc_id", "text").transform(in_batches, sequences, f"sequence_id long, n_tokens long, padded_tokens long, input_ids binary, pieces {PIECES}")


def piece_digests(sequences: DataFrame) -> DataFrame:
    """A row for each piece: where it lies, and the crc32 of its ids in input_ids."""
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_tokens")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                raw = memoryview(row["input_ids"])
                out += [(p["doc_id"], p["start"], p["length"], zlib.crc32(raw[4 * p["offset"] : 4 * (p["offset"] + p["length"])]), p["doc_tokens"], row["sequence_id"], p["offset"], row["n_tokens"], row["padded_tokens"]) for p in row["pieces"]]
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*out, strict=True) if out else [[]] * len(names), strict=True)})

    return sequences.transform(in_batches, digests, ", ".join(f"{n} long" for n in names))
