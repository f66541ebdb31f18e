"""Sharding by sampled splitters, in DataFrame functions only.

Keys are drawn with a chance in proportion to the size of their record, the quantiles of the draw become splitters, and
records fall into the ranges between them. The exact bytes of every range are then counted; shards take ranges in key
order until each has its share. A range far above its share, as a key with very many records makes, is subdivided by a
second hash, so no task and no shard has to take it whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbago.llm.common import unused, written

#: Ranges for each shard, and expected draws for each range: the driver gets some shards * RANGES * DRAWS keys, whatever the input.
RANGES, DRAWS = 128, 16
#: A range with more than this many times its share is subdivided.
OVERFULL = 2.0


def _slot_in(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at most key: a search over every 64th, then over the 64 from there on."""
    step = max(1, math.isqrt(len(splitters)))
    coarse, fine = splitters[step - 1 :: step], [splitters[k : k + step] for k in range(0, len(splitters), step)]
    array = lambda xs: F.expr(f"array({', '.join(f'{x}L' if x > -(1 << 63) else 'bigint(-9223372036854775808)' for x in xs)})") if xs else F.expr("cast(array() as array<bigint>)")
    table = F.array(*(array(x) for x in [*fine, []]))
    first = F.size(F.filter(array(coarse), lambda s: s <= key))
    return first * step + F.size(F.filter(F.get(table, first), lambda s: s <= key))


def shard_records(records: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot of records (doc_id, text): shards of nearly equal bytes, slots from 0 without gaps.

    A record counts the UTF-8 bytes of its text plus 8; a null text has none and crc32 0 bytes. Equal texts have one key, so
    they follow each other and share a shard, unless there are so many that their range is overfull; then they are dealt
    over neighbouring shards by a hash of the doc_id and the row's number, so rows alike in everything are dealt out too. Ties are
    ordered by doc_id; null doc_ids come first, and all rows get different slots. An empty table gives no rows. Other columns are
    not read. Texts are read once and not shuffled: only keys, sizes and doc_ids are.
    """
    return _placed(records.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id")), shards).drop("row_id")


def _placed(records: DataFrame, shards: int) -> DataFrame:
    """shard_records() with the row_id that each record came with. The keys are written, so a row_id stays with its record."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    keyed = records.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.xxhash64("text", F.lit(1)).alias("key"), F.xxhash64("doc_id", "row_id", F.lit(2)).alias("second"), "row_id")
    keyed = written(keyed, "shard-keys")
    total, rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = shards * RANGES
    # A draw by a hash of the record: the same rows whenever a task is redone.
    chance = F.lit(ranges * DRAWS / max(total, 1)) * F.col("size")
    drawn = keyed.where(F.pmod(F.xxhash64("key", "second", F.lit(3)), F.lit(1 << 40)) < chance * (1 << 40)).select("key").collect() if rows else []
    drawn = sorted(r["key"] for r in drawn)
    splitters = sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)}) if drawn else []
    ranged = keyed.withColumn("range", _slot_in(F.col("key"), splitters)) if splitters else keyed.withColumn("range", F.lit(0))
    share = max(1.0, total / ranges)
    found = {r["range"]: r["bytes"] for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    parts = {r: math.ceil(b / share) for r, b in found.items() if b > OVERFULL * share}
    # For an overfull range, the key gives way to the second hash.
    sub = F.coalesce(F.pmod("second", F.element_at(F.create_map(*(F.lit(int(x)) for kv in parts.items() for x in kv)), F.col("range"))), F.lit(0)).cast("int") if parts else F.lit(0)
    cell = F.col("range"), F.col("sub")
    ranged = ranged.withColumn("sub", sub).withColumn("order", F.when(F.col("sub").isNotNull() & (F.lit(False) if not parts else F.col("range").isin(*parts)), F.col("second")).otherwise(F.col("key")))
    # Cells are at most shards * RANGES * 2 or so: their totals, in order, are the bytes and rows before each cell.
    ahead = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    cells = ranged.groupBy(*cell).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).select(*cell, F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy("range", "sub").orderBy("order")
    each = Window.partitionBy("range", "sub").orderBy("order", F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "row_id")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside.rangeBetween(Window.unboundedPreceding, 0))).withColumn("nth", F.row_number().over(each))
        .join(F.broadcast(cells), ["range", "sub"])
        # All records with one key end at the same byte, so they get the same shard.
        .withColumn("shard", F.floor((F.col("bytes_before") + F.col("upto") - 1) * F.lit(shards) / F.lit(max(total, 1))).cast("int"))
        .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
    )
    placed = written(placed.select("doc_id", "size", "text_crc32", "shard", "row", "row_id"), "shard-rows")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"), "row_id")


def write_shards(records: DataFrame, path: str, shards: int = 24) -> None:
    """The records themselves, with all their columns, each once: a folder shard=k for each shard that has any, its files ordered by slot.

    The records are written to the shared folder with a number first, by which each meets its place again; null and repeated
    doc_ids do no harm. Where records have a column shard or slot, those of the files get an underscore more. An empty table gives no folders.
    """
    names = {c: unused(records, c) for c in ("row_id", "shard", "slot")}
    kept = written(records.withColumn(names["row_id"], F.monotonically_increasing_id()), "shard-records")
    placed = _placed(kept.select("doc_id", "text", F.col(names["row_id"]).alias("row_id")), shards)
    placed = placed.select(*(F.col(c).alias(n) for c, n in names.items()))
    rows = kept.join(placed, names["row_id"]).drop(names["row_id"])
    rows.sortWithinPartitions(names["shard"], names["slot"]).write.partitionBy(names["shard"]).parquet(path)
