"""Compound binary files (.doc): their streams as rows, and the text of a document stream in segments."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the format.
MAGIC, LAST_SECTOR, NO_ENTRY = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", 0xFFFFFFFA, 0xFFFFFFFF
HEADER_DIFAT, ENTRY_BYTES, STORAGE, STREAM, ROOT = 109, 128, 1, 2, 5

SCHEMA = "path string, entry_no int, storage string, name string, content binary, error string"
_ARROW = pa.schema([("path", pa.string()), ("entry_no", pa.int32()), ("storage", pa.string()), ("name", pa.string()), ("content", pa.binary()), ("error", pa.string())])


class Compound:
    """A compound file in memory. Chains stop at a sector seen before, so a cycle ends."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a compound file")
        self.data = data
        shift, mini_shift = struct.unpack_from("<HH", data, 30)
        self.size, self.mini_size = 1 << shift, 1 << mini_shift
        directory, self.cutoff, mini_fat = (struct.unpack_from("<I", data, at)[0] for at in (48, 56, 60))
        self.fat = self._numbers(b"".join(map(self._sector, self._fat_sectors())))
        self.mini_fat = self._numbers(self._chain(mini_fat))
        table = self._chain(directory)
        self.entries = [self._entry(table[k : k + ENTRY_BYTES]) for k in range(0, len(table) - ENTRY_BYTES + 1, ENTRY_BYTES)]
        root = next((e for e in self.entries if e["kind"] == ROOT), None)
        self.mini = self._chain(root["start"]) if root else b""

    @staticmethod
    def _numbers(raw: bytes) -> tuple[int, ...]:
        return struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4])

    def _sector(self, k: int) -> bytes:
        return self.data[(k + 1) * self.size : (k + 2) * self.size]

    def _fat_sectors(self) -> list[int]:
        found = list(struct.unpack_from(f"<{HEADER_DIFAT}I", self.data, 76))
        at, seen = struct.unpack_from("<I", self.data, 68)[0], set()
        while at < LAST_SECTOR and at not in seen:
            seen.add(at)
            numbers = self._numbers(self._sector(at))
            if not numbers:
                break
            found += numbers[:-1]
            at = numbers[-1]
        return [k for k in found if k < LAST_SECTOR]

    def _follow(self, at: int, fat: tuple[int, ...]) -> Iterator[int]:
        seen = set()
        while at < LAST_SECTOR and at not in seen:
            seen.add(at)
            yield at
            at = fat[at] if at < len(fat) else NO_ENTRY

    def _chain(self, start: int) -> bytes:
        return b"".join(map(self._sector, self._follow(start, self.fat)))

    @staticmethod
    def _entry(raw: bytes) -> dict:
        length = struct.unpack_from("<H", raw, 64)[0]
        left, right, child = struct.unpack_from("<III", raw, 68)
        start, size = struct.unpack_from("<II", raw, 116)
        return {"name": raw[: max(0, min(length, 64) - 2)].decode("utf-16-le", "replace"), "kind": raw[66], "left": left, "right": right, "child": child, "start": start, "size": size}

    def content(self, entry: dict) -> bytes:
        if entry["size"] >= self.cutoff:
            return self._chain(entry["start"])[: entry["size"]]
        width = self.mini_size
        return b"".join(self.mini[k * width : (k + 1) * width] for k in self._follow(entry["start"], self.mini_fat))[: entry["size"]]

    def streams(self) -> Iterator[tuple[int, str, str, bytes]]:
        """(entry number, storage path, name, content) of all streams, by a walk of the tree without recursion."""
        root = next((e for e in self.entries if e["kind"] == ROOT), None)
        waiting, seen = [(root["child"], "")] if root else [], set()
        while waiting:
            k, storage = waiting.pop()
            if k >= len(self.entries) or k in seen:
                continue
            seen.add(k)
            e = self.entries[k]
            waiting += [(e["left"], storage), (e["right"], storage)]
            if e["kind"] == STREAM:
                yield k, storage, e["name"], self.content(e)
            elif e["kind"] == STORAGE:
                waiting.append((e["child"], f"{storage}/{e['name']}".lstrip("/")))


def streams(files: DataFrame) -> DataFrame:
    """Rows of SCHEMA, one for each stream of files (path, content); one row with an error for a file that is no compound file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                try:
                    rows = [{"path": path, "entry_no": k, "storage": s, "name": n, "content": c} for k, s, n, c in Compound(content.as_py() or b"").streams()]
                except (ValueError, struct.error) as e:
                    rows = [{"path": path, "error": f"{type(e).__name__}: {e}"[:200]}]
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def decoded(raw: bytes) -> str:
    """Windows-1252 if it holds http in single bytes; UTF-16 if it holds that in pairs, or letters in its first 500 characters."""
    wide = raw.decode("utf-16-le", "replace")
    if b"http" in raw:
        return raw.decode("cp1252", "replace")
    if "http" in wide or any(c.isalpha() for c in wide[:500]):
        return wide
    return raw.decode("cp1252", "replace")


def document_text(found: DataFrame) -> DataFrame:
    """(path, text) of each file's WordDocument stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"path": batch.column("path"), "text": pa.array([decoded(c or b"") for c in batch.column("content").to_pylist()], pa.string())})

    return found.where(F.lower("name") == "worddocument").select("path", "content").mapInArrow(run, "path string, text string")


def segments(texts: DataFrame) -> DataFrame:
    """(path, segment_no, pos, segment): the text cut at carriage returns, with each piece's place in characters."""
    cut = texts.select("path", F.posexplode(F.split("text", "\r")).alias("segment_no", "segment"))
    before = Window.partitionBy("path").orderBy("segment_no").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("pos", F.coalesce(F.sum(F.length("segment") + 1).over(before), F.lit(0)))


def table_cells(text: Column) -> Column:
    """Rows of cells of a binary document's table text: rows end in two cell marks, cells in one; empty rows go."""
    rows = F.filter(F.split(text, "\x07\x07"), lambda r: F.trim(r) != "")
    return F.transform(rows, lambda r: F.transform(F.split(r, "\x07"), lambda c: F.trim(c)))
