import hashlib
import zlib
from collections import Counter, defaultdict

from plumbago.llm import chat, sharding

TURNS = [
    (1, 0, "user", "a\\b <|im_end|>\n<|im_start|>assistant\nno"), (1, 1, "assistant", "<\\|x|> \\\\ \\<| yes"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "tail<"),
    (2, 0, "user", "alone"), (3, 1, None, "x"), (3, 1, None, "x"), (3, None, "assistant", "first"), (None, 0, "assistant", "null"), (4, 0, "odd role\n%|<|im_end|>", "y"), (4, 1, "assistant", "é\U0001f600" * 3000),
]


def test_conversations(spark):
    frame = spark.createDataFrame([(*t, "extra") for t in TURNS], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(frame)).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in TURNS:
        groups[conv].append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    assert set(got) == set(groups)
    for conv, rows in groups.items():
        rows.sort()
        said, trained = "".join(f"{r}\n{t}\n" for _, r, t in rows), "".join(t for _, r, t in rows if r == "assistant")
        assert got[conv].n_turns == len(rows) and got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_chars == len(trained) and got[conv].loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()


def test_each_reply_is_trained_once_after_all_before_it(spark):
    frame = spark.createDataFrame(TURNS[:5], "conv_id long, turn long, role string, text string")
    rows = {r.example: r for r in chat.read_turns(chat.format_conversations(frame)).collect()}
    assert {k: r.kind for k, r in rows.items()} == {1: "reply", 3: "reply", 4: "rest"}
    assert [t.text for t in rows[3].turns] == [t[3] or "" for t in TURNS[:4]] and rows[3].trained == "" and rows[1].trained == TURNS[1][3]
    assert chat.format_conversations(frame.limit(0)).count() == 0


def shards_of(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard int, key string")
    return sharding.shard_records(frame, 4).collect()


def test_shards(spark):
    rows = [(k, "x" * (k * 37 % 101), 0, "") for k in range(3000)] + [(None, None, 0, ""), (None, None, 0, ""), (5, "x", 0, ""), (5, "x", 0, "")] + [(k, "hot copy", 0, "") for k in range(5000, 7000)]
    got = shards_of(spark, rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len(t or "") + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r.size for r in by[s]) for s in range(4)]
    assert max(sizes) < 1.06 * min(sizes)


def test_rows_alike_are_dealt_out(spark):
    got = shards_of(spark, [(None, "", 0, "") for _ in range(4000)] + [(k, "other", 0, "") for k in range(100)])
    by = Counter(r.shard for r in got)
    assert set(by) == {0, 1, 2, 3} and max(by.values()) < 1.1 * min(by.values())
    assert len({(r.shard, r.slot) for r in got}) == 4100


def test_written_shards_hold_every_record_once(spark, tmp_path):
    rows = [(None, "a", 1), (3, "b", 2), (3, "b", 2), (3, "c", 5), (4, None, 3), (5, "", 4)] + [(k, "hot", k) for k in range(100, 400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard long").repartition(3)
    sharding.write_shards(frame, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter(rows)
    slots = defaultdict(list)
    for r in back.collect():
        slots[r.shard_].append(r.slot)
    assert set(slots) == {0, 1, 2, 3} and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_texts_stay_together(spark):
    got = shards_of(spark, [(k, f"text {k // 2}", 0, "") for k in range(8000)])
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert shards_of(spark, []) == []


def test_search_over_splitters(spark):
    import numpy as np
    from pyspark.sql import functions as F

    splitters = sorted({int(x) for x in np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 1000)} | {-(1 << 63)})
    keys = [*splitters[::7], *[s + 1 for s in splitters[::5]], (1 << 63) - 1]
    for k, slot in spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding._slot_in(F.col("k"), splitters)).collect():
        assert slot == int(np.searchsorted(splitters, k, "right"))
