"""Token ids in files of Simple-8b words, in ascending order of the documents.

Simple-8b puts as many ids as fit into the 60 low bits of a 64-bit word; its 4 high bits select how many ids of how many
bits there are. Ids lie in blocks of BLOCK ids with the place of each block's first word, so blocks decode independently
and all words of one selector decode in one vector operation. Ids of 2**60 and more are escapes: the word holds 0, and
their places and values follow the words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plumbago.llm.common import partitions, slices, written
from plumbago.llm.tokens import tokenizer

BLOCK = 4096
#: Ids for each word by selector; selector 0 is not used, selector 1 stands for 120 zeros.
COUNTS = np.array([0, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
LARGEST = 1 << 60
MAGIC = b"PLS8B01\n"
#: Ids of a segment; a segment is one row of a file and what a reader holds at once.
SEGMENT_IDS = 1 << 20
SEGMENT_SCHEMA = "part int, seq int, base long, n_docs long, n_ids long, segment binary"


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the n + 1 word offsets of the blocks, and places and values of the escapes. Most ids to a word first."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // block)
    places = np.flatnonzero(ids >= LARGEST)
    values = ids[places]
    plain = np.where(ids >= LARGEST, np.uint64(0), ids) if len(places) else ids
    # Blocks are rows of a matrix that ends in 120 columns of zeros, which a block's last word may take in.
    width = np.zeros((blocks, block + 120), np.uint8)
    value = np.zeros((blocks, block + 120), np.uint64)
    length = np.zeros(n, np.uint8)
    left = plain.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = left >= np.uint64(1 << step)
        length[more] += step
        left[more] >>= np.uint64(step)
    length += left.astype(np.uint8)
    for k in range(blocks):
        part = slice(k * block, min(n, (k + 1) * block))
        width[k, : part.stop - part.start], value[k, : part.stop - part.start] = length[part], plain[part]
    selector = np.full((blocks, block), 15, np.uint8)
    widest, span = {1: width}, 1
    while span * 2 <= 64:
        a = widest[span]
        widest[span * 2] = np.maximum(a[:, :-span], a[:, span:])
        span *= 2
    for s in range(14, 0, -1):
        count = int(COUNTS[s])
        span = 1 << (count.bit_length() - 1)
        a = widest[span]
        most = np.maximum(a[:, :block], a[:, count - span : count - span + block])
        selector[most <= BITS[s]] = s
    ends = np.minimum(block, n - np.arange(blocks) * block)
    at, live, begins = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):  # one word of every block at a time
        begins.append(live * block + at[live])
        at[live] += COUNTS[selector[live, at[live]]]
        live = live[at[live] < ends[live]]
    begins = np.sort(np.concatenate(begins)) if begins else np.empty(0, np.int64)
    row, column = begins // block, begins % block
    chosen = selector[row, column]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        mine = np.flatnonzero(chosen == s)
        for k in range(int(COUNTS[s]) if len(mine) else 0):
            words[mine] |= value[row[mine], column[mine] + k] << np.uint64(BITS[s] * k)
    return words, np.searchsorted(row, np.arange(blocks + 1)), places, values


def unpack(words: np.ndarray, offsets: np.ndarray, places: np.ndarray, values: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    before = np.cumsum(counts) - counts
    first = offsets[:-1]
    row = np.repeat(np.arange(len(first)), np.diff(offsets))
    begins = before - before[first][row] + row * (block + 120) if len(words) else before
    out = np.zeros(len(first) * (block + 120), np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero(chosen == s)
        for k in range(int(COUNTS[s]) if len(mine) else 0):
            out[begins[mine] + k] = (words[mine] >> np.uint64(BITS[s] * k)) & np.uint64((1 << int(BITS[s])) - 1)
    ids = out.reshape(len(first), block + 120)[:, :block].reshape(-1)[:n]
    ids[places] = values
    return ids


def to_segment(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: a header, the documents, the blocks' offsets, the words, the escapes and a checksum."""
    words, offsets, places, values = pack(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [
        np.array([len(doc_ids), len(ids), len(words), len(places)], "<u8"), np.array([d or 0 for d in doc_ids], "<i8"), known, counts.astype("<u8"),
        offsets.astype("<u8"), words.astype("<u8"), places.astype("<u8"), values.astype("<u8"),
    ]
    body = b"".join(p.tobytes() for p in parts)
    return MAGIC + body + zlib.crc32(body).to_bytes(4, "little")


def from_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, numbers of ids of the documents, and all ids."""
    if data[:8] != MAGIC or zlib.crc32(memoryview(data)[8:-4]) != int.from_bytes(data[-4:], "little"):
        raise ValueError("not a segment, or damaged")
    n_docs, n_ids, n_words, n_escapes = (int(x) for x in np.frombuffer(data, "<u8", 4, 8))
    at = 40

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, n, at)
        at += found.nbytes
        return found

    doc_ids, known, counts = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs).astype(np.int64)
    offsets = take("<u8", -(-n_ids // BLOCK) + 1).astype(np.int64)
    words, places, values = take("<u8", n_words), take("<u8", n_escapes).astype(np.int64), take("<u8", n_escapes)
    return [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], counts, unpack(words, offsets, places, values, n_ids)


def write_token_file(docs: DataFrame, tokenizer_path: str, end_id: int, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Tokenise docs (doc_id, text) and write segments in ascending doc_id order to the shared folder; returns that table.

    One shuffle: a range partitioning by doc_id. A row of the table is a segment: part and seq give its order, base the ids
    before it in its part. A null text is empty and has only the end id; null doc_ids come first; rows with one doc_id
    are ordered by text. An empty table gives no segments. Other columns of docs are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        seq, base, held, n = 0, 0, [], 0

        def segment() -> pa.RecordBatch:
            nonlocal seq, base, held, n
            doc_ids, counts, ids = [d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "base": pa.array([base], pa.int64()), "n_docs": pa.array([len(doc_ids)], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64()), "segment": pa.array([to_segment(doc_ids, counts, ids)], pa.binary()),
            })
            seq, base, held, n = seq + 1, base + len(ids), [], 0
            return out

        for batch in slices(batches, "text", 4 << 20):
            ids, offsets = encoder.encode(batch.column("text"))
            counts = np.diff(offsets) + 1
            ids = np.insert(ids, offsets[1:], np.uint32(end_id))
            held.append((batch.column("doc_id").to_pylist(), counts, ids))
            n += len(ids)
            if n >= segment_ids:
                yield segment()
        if held:
            yield segment()

    spark = docs.sparkSession
    ordered = docs.select("doc_id", "text").repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(encode, SEGMENT_SCHEMA), "tokens", compression="uncompressed")


def read_token_file(segments: DataFrame) -> DataFrame:
    """Every document of the file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids (as little-endian uint32)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("segment").to_pylist(), strict=True):
                doc_ids, counts, ids = from_segment(data)
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(counts)
                for first in range(0, len(doc_ids), 2000):
                    part = slice(first, first + 2000)
                    own = [bytes(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends[part].tolist(), counts[part].tolist(), strict=True)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc_ids[part], pa.int64()), "start": pa.array(base + ends[part] - counts[part], pa.int64()), "n_tokens": pa.array(counts[part], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()), "ids": pa.array(own, pa.binary()),
                    })

    # A row for each part: the ids of all parts before it. The number of parts is that of the partitions, not of rows.
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    before, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in totals):
        before[part], total = total, total + n
    offset = F.element_at(F.create_map(*(F.lit(x) for item in before.items() for x in item)), F.col("part")) if before else F.lit(0)
    return segments.select((F.col("base") + offset.cast("long")).alias("base"), "segment").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
