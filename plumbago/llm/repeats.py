"""Repeated byte strings by prefix-free parsing, in three distributed steps.

Parsing. A hash of every K bytes is computed along the text; in each window of LENGTH bytes, the place of the least hash
(leftmost of equals) is the window's trigger. Triggers depend on the content alone, so equal windows have theirs at the
same place, and they cut the text into phrases: what stands left of a trigger is a suffix of a dictionary phrase, what
stands right of it is the parse that follows. All windows of one trigger lie in one stretch of text, its context.

Counting. Contexts are counted by trigger hash and content. A context that occurs twice is repeated whole; a trigger hash that occurs
once settles its context as unique. In highly repetitive text this settles nearly all, and no text is moved.

Combining. For contexts that differ but share a trigger, the phrase suffixes left of the trigger are sorted from the
trigger leftward and the parse contexts right of it rightward, both with the lengths of common prefixes of neighbours: the suffix
arrays of dictionary and parse. For each split of LENGTH bytes over the two sides, windows are in corpus order by the two ranks,
and equal neighbours there are repeated windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbago.llm.common import partitions, slices, written
from plumbago.llm.shingles import mixed

LENGTH, K = 200, 16
#: A place within a stretch must fit into the bits that the hash leaves.
PLACE_BITS = 24
STRETCH = 8 << 20
CONTEXT = np.dtype([("key", "<u8"), ("content", "<u8"), ("text", "S16"), ("lo", "<u4"), ("hi", "<u4"), ("at", "<u4"), ("n", "<u4")])
OPEN = np.dtype([("key", "<u8"), ("lo", "<u4"), ("hi", "<u4"), ("at", "<u4"), ("settled", "<u4")])


def triggers(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, at, key) of the contexts: windows that start from lo to hi have their trigger at `at`. ends: of the texts in data."""
    empty = np.empty(0, np.int64)
    n = len(data)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64)
    eight = data.astype(np.uint64)
    for step in (1, 2, 4):
        eight = eight[:-step] | (eight[step:] << np.uint64(8 * step))
    hashes = mixed(eight[:-8] * np.uint64(0x9E3779B97F4A7C15) + mixed(eight[8:]))  # of K bytes from each place on
    least = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    span, most = 1, length - K + 1
    while span * 2 <= most:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: n - length + 1], least[most - span : most - span + n - length + 1])
    place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    valid = np.ones(len(place), bool)
    for end in ends:  # a window must not go beyond its text
        valid[max(0, end - length + 1) : end] = False
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    return lo, hi, place[lo], hashes[place[lo]]


def _merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sorted runs of window starts, joined where they touch, as rows (lo, hi)."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order].astype(np.int64), np.maximum.accumulate(hi[order].astype(np.int64))
    new = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    return np.stack([lo[new], hi[np.concatenate([new[1:], [True]])]], 1).astype("<u4")


def contexts(texts: list[bytes], keys: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, dict[bytes, list[np.ndarray]]]:
    """One row for each distinct context with its number n, and the runs of windows that repeat among these texts."""
    rows = []
    group: list[tuple[int, int]] = []  # (text, first byte) of what one vectorised step takes
    size = 0

    def step() -> None:
        nonlocal group, size
        parts = [texts[t][at : at + STRETCH + length - 1] for t, at in group]
        raw = b"".join(parts)
        ends = np.cumsum([len(p) for p in parts])
        lo, hi, at, key = triggers(np.frombuffer(raw, np.uint8), ends, length)
        owner = np.searchsorted(ends, lo, "right")
        shift = np.array([a for _, a in group]) - (ends - [len(p) for p in parts])
        view = memoryview(raw)
        out = np.empty(len(lo), CONTEXT)
        out["key"], out["n"] = key, 1
        out["content"] = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist(), strict=True)), np.uint64, len(lo))
        out["text"] = np.array([keys[t] for t, _ in group], "S16")[owner] if len(lo) else b""
        for name, values in (("lo", lo), ("hi", hi), ("at", at)):
            out[name] = values + shift[owner]
        rows.append(out)
        group, size = [], 0

    for t, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), STRETCH):
            if size and size + len(text) - at > STRETCH:
                step()
            group.append((t, at))
            size += min(len(text) - at, STRETCH)
    if group:
        step()
    return settle(np.concatenate(rows) if rows else np.empty(0, CONTEXT))


def settle(rows: np.ndarray) -> tuple[np.ndarray, dict[bytes, list[np.ndarray]]]:
    """Adds up equal contexts. Those that occur twice or more have their windows returned; a row that stood for several has had them before."""
    rows = rows[np.lexsort((rows["content"], rows["key"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["content"][1:] != rows["content"][:-1])
    begins = np.flatnonzero(new)
    if not len(rows):
        return rows, {}
    totals = np.add.reduceat(rows["n"].astype(np.int64), begins)
    repeated = (totals[np.cumsum(new) - 1] > 1) & (rows["n"] == 1)
    kept = rows[begins].copy()
    kept["n"] = np.minimum(totals, 2)
    return kept, by_text(rows[repeated])


def _padded(key: bytes) -> bytes:
    return key.ljust(16, b"\0")  # numpy drops zeros at the end


def by_text(rows: np.ndarray) -> dict[bytes, list[np.ndarray]]:
    if not len(rows):
        return {}
    rows = rows[np.argsort(rows["text"], kind="stable")]
    cuts = np.flatnonzero(rows["text"][1:] != rows["text"][:-1]) + 1
    return {_padded(bytes(part["text"][0])): [_merged(part["lo"], part["hi"])] for part in np.split(rows, cuts)}


FOUND = "bucket int, kind int, text_key binary, data binary"
RUNS, CONTEXTS, UNSETTLED = 0, 1, 2


def _batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    bucket, kind, key, data = zip(*rows, strict=True) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(key, pa.binary()), pa.array(data, pa.binary())], ["bucket", "kind", "text_key", "data"])


def _parse(buckets: int, length: int):  # noqa: ANN202
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rows, runs = contexts(texts, batch.column("text_key").to_pylist(), length)
            dealt = (rows["key"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(dealt, kind="stable")
            found, at = np.unique(dealt[order], return_index=True)
            out = [(int(b), CONTEXTS, None, part.tobytes()) for b, part in zip(found, np.split(rows[order], at[1:]), strict=True)]
            yield _batch(out + [(int.from_bytes(k[:4], "little") % buckets, RUNS, k, v[0].tobytes()) for k, v in runs.items()])

    return parse


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All contexts of the buckets of this task: runs that are repeated, and contexts whose trigger others share."""
    held = []
    for batch in batches:
        kinds = np.asarray(batch.column("kind"))
        yield batch.filter(pa.array(kinds == RUNS))
        held += [np.frombuffer(x, CONTEXT) for x in batch.filter(pa.array(kinds == CONTEXTS)).column("data").to_pylist()]
    if not held:
        return
    rows, runs = settle(np.concatenate(held))
    del held
    yield _batch([(0, RUNS, k, v[0].tobytes()) for k, v in runs.items()])
    shared = np.zeros(len(rows), bool)
    same = rows["key"][1:] == rows["key"][:-1]
    shared[1:] |= same
    shared[:-1] |= same
    # Where all contexts of a trigger are repeated already, there is nothing to find.
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    single = np.add.reduceat((rows["n"] == 1).astype(np.int64), begins) > 0
    rows = rows[shared & single[np.cumsum(np.concatenate([[True], ~same])) - 1]]
    rows = rows[np.argsort(rows["text"], kind="stable")]
    for part in np.split(rows, np.flatnonzero(rows["text"][1:] != rows["text"][:-1]) + 1) if len(rows) else []:
        data = np.empty(len(part), OPEN)
        for name in ("key", "lo", "hi", "at"):
            data[name] = part[name]
        data["settled"] = part["n"] > 1
        yield _batch([(0, UNSETTLED, _padded(bytes(part["text"][0])), data.tobytes())])


def _batched(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _sides(buckets: int, length: int):  # noqa: ANN202
    """Cuts out what stands left and right of the trigger of every unsettled context, and deals it by trigger hash."""

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            dealt: dict[int, list[tuple]] = {}
            for key, text, parts in zip(batch.column("text_key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("parts").to_pylist(), strict=True):
                for part in parts:
                    for r in np.frombuffer(part, OPEN):
                        lo, hi, at = int(r["lo"]), int(r["hi"]), int(r["at"])
                        dealt.setdefault(int(r["key"]) % buckets, []).append((int(r["key"]), key, lo, hi, at, int(r["settled"]), text[lo:at], text[at : hi + length]))
            for bucket, rows in dealt.items():
                hashes, keys, lo, hi, at, settled, left, right = zip(*rows, strict=True)
                body = [np.array(hashes, "<u8").tobytes(), b"".join(keys), np.array([lo, hi, at, settled, [len(x) for x in left], [len(x) for x in right]], "<u4").tobytes(), b"".join(left), b"".join(right)]
                yield _batch([(bucket, CONTEXTS, None, len(rows).to_bytes(4, "little") + b"".join(body))])

    return sides


def _order(strings: list[bytes], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by (key, string), and for each rank the length of the prefix in common with the one before, -1 for another key."""
    order = np.array(sorted(range(len(strings)), key=lambda k: (key[k], strings[k])), np.int64)
    lengths = np.array([len(s) for s in strings])[order]
    width = max(1, int(lengths.max()))
    common = np.full(len(order), -1, np.int64)
    for first in range(0, len(order), 20_000):  # bounded memory
        part = range(max(0, first - 1), min(len(order), first + 20_000))
        table = np.frombuffer(b"".join(strings[order[k]].ljust(width, b"\0") for k in part), np.uint8).reshape(len(part), width)
        differ = np.concatenate([table[1:] != table[:-1], np.ones((len(part) - 1, 1), bool)], 1).argmax(1) if len(part) > 1 else np.empty(0, np.int64)
        begin = part.start + 1
        common[begin : part.stop] = np.minimum(differ, np.minimum(lengths[part.start : part.stop - 1], lengths[begin : part.stop]))
    sorted_key = key[order]
    common[1:][sorted_key[1:] != sorted_key[:-1]] = -1
    common[0] = -1
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, common


def combine(key: np.ndarray, left: list[bytes], right: list[bytes], least: np.ndarray, most: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every context and split a (bytes left of the trigger): whether that window has an equal among the others."""
    left_rank, left_common = _order([x[::-1] for x in left], key)
    right_rank, right_common = _order(right, key)
    found = np.zeros((len(key), int(most.max()) + 1), bool)
    for a in range(int(least.min()), int(most.max()) + 1):
        active = np.flatnonzero((least <= a) & (a <= most))
        if len(active) < 2:
            continue
        suffix = np.cumsum(left_common < a)[left_rank[active]]
        parse = np.cumsum(right_common < length - a)[right_rank[active]]
        code = suffix * (len(key) + 1) + parse
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        equal = np.zeros(len(order), bool)
        equal[1:] |= same
        equal[:-1] |= same
        found[active[order[equal]], a] = True
    return found


def _combine(length: int):  # noqa: ANN202
    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, texts, left, right, numbers = [], [], [], [], []
        for batch in batches:
            for data in batch.column("data").to_pylist():
                n = int.from_bytes(data[:4], "little")
                key.append(np.frombuffer(data, "<u8", n, 4))
                at = 4 + 8 * n
                texts += [data[at + 16 * k : at + 16 * (k + 1)] for k in range(n)]
                at += 16 * n
                table = np.frombuffer(data, "<u4", 6 * n, at).reshape(6, n)
                numbers.append(table)
                at += 24 * n
                for side, sizes in ((left, table[4]), (right, table[5])):
                    for size in sizes.tolist():
                        side.append(data[at : at + size])
                        at += size
        if not key:
            return
        keys = np.concatenate(key)
        lo, hi, at, settled, _, _ = np.concatenate(numbers, 1).astype(np.int64)
        found = combine(keys, left, right, at - hi, at - lo, length)
        runs: dict[bytes, list[tuple[int, int]]] = {}
        for k in np.flatnonzero(found.any(1) & (settled == 0)):
            for a in np.flatnonzero(found[k]):
                runs.setdefault(texts[k], []).append((int(at[k] - a), int(at[k] - a)))
        for text, own in runs.items():
            pairs = np.array(own, np.int64)
            yield _batch([(0, RUNS, text, _merged(pairs[:, 0], pairs[:, 1]).tobytes())])

    return combined


def _removed(text: bytes, parts: list[bytes], length: int) -> tuple[bytes, np.ndarray]:
    """What remains, and the maximal removed runs as rows (start, end)."""
    if not parts:
        return text, np.empty((0, 2), np.int64)
    runs = np.concatenate([np.frombuffer(p, "<u4").reshape(-1, 2) for p in parts]).astype(np.int64)
    runs[:, 1] += length  # to where the last window ends
    spans = _merged(runs[:, 0], runs[:, 1] - 1).astype(np.int64)
    spans[:, 1] += 1
    kept, at = [], 0
    for start, end in spans.tolist():
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]]), spans


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) and spans of every row of docs (doc_id, text).

    Each byte that lies in a string of `length` bytes (32 at least) that also starts anywhere else in the table is removed; texts are
    their UTF-8 bytes, a null text is empty, and no string crosses texts. Results belong to texts, so null and repeated doc_ids do no
    harm; a repeated row is a copy. An empty table gives no rows. Other columns are not read. A span may cut a character; kept is binary.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary"))))
    parsed = keyed.select("text", "text_key").mapInArrow(_parse(n, length), FOUND)
    counted = written(parsed.repartition(n, "bucket").mapInArrow(_count, FOUND), "repeats")
    unsettled = counted.where(F.col("kind") == UNSETTLED).groupBy("text_key").agg(F.collect_list("data").alias("parts"))
    sides = keyed.select("text", "text_key").join(unsettled, "text_key").select("text", "text_key", "parts").mapInArrow(_sides(n, length), FOUND)
    combined = written(sides.repartition(n, "bucket").mapInArrow(_combine(length), FOUND), "repeats")
    runs = counted.where(F.col("kind") == RUNS).union(combined).groupBy("text_key").agg(F.collect_list("data").alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "spans")}
            for text, parts in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("parts").to_pylist(), strict=True):
                kept, spans = _removed(text, parts or [], length)
                for name, value in zip(out, (len(text), len(text) - len(kept), len(spans), kept, spans.tolist()), strict=True):
                    out[name].append(value)
            kinds = {"kept": pa.binary(), "spans": pa.list_(pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items())], ["doc_id", *out])

    return keyed.join(runs, "text_key", "left").select("doc_id", "text", "parts").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<bigint>>")


def kept_digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
