import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from plumbago.llm import packing, queries, tokenbin
from plumbago.llm.tokens import Tokenizer

TEXTS = ["", None, "  a  b\n\n c\t d  e 　 f'll 's <|endoftext|> x<|startoftext|>", " \n \n", "x ̈y Σ a\r\n b", "  z é é", "a.b c.,d it's. É,é ×. x× . A.Σ ß,", "x" * 5000, "word " * 3000, "a", "a", "éè. Ça va?\nOui."]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_same_ids_as_the_library(name):
    own = Tokenizer(queries.vocabulary(name), remembered=20)
    assert own.direct
    for _ in range(2):
        ids, offsets = own.encode(pa.array(TEXTS))
        for k, text in enumerate(TEXTS):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == own.library.encode(text or "", add_special_tokens=False).ids


@settings(deadline=None, max_examples=40)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, (1 << 64) - 1)), max_size=600), st.integers(1, 300))
def test_words_round_trip(ids, block):
    ids = np.array(ids, np.uint64)
    packed = tokenbin.pack(ids, block)
    assert tokenbin.unpack(*packed, len(ids), block).tolist() == ids.tolist()


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part int, seq int, base long")


ROWS = [(3, "b c", 1, 1, 1), (1, None, 1, 1, 1), (2, "", 1, 1, 1), (None, "null id", 1, 1, 1), (5, "word " * 5000, 1, 1, 1), (4, "same", 1, 1, 1), (4, "same", 1, 1, 1)]


def test_token_file(spark):
    path = queries.vocabulary("word_bpe_49k.json")
    rows = sorted(tokenbin.read_token_file(tokenbin.write_token_file(documents(spark, ROWS), path, 2, segment_ids=100)).collect(), key=lambda r: (r.start, r.doc_id or 0))
    library, start = Tokenizer(path).library, 0
    for row, (doc_id, text, *_) in zip(rows, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokenbin.read_token_file(tokenbin.write_token_file(documents(spark, []), path, 2)).count() == 0


def test_damage_is_seen():
    data = bytearray(tokenbin.to_segment([1], np.array([3]), np.array([1, 2, 3])))
    assert tokenbin.from_segment(bytes(data))[2].tolist() == [1, 2, 3]
    data[-6] ^= 1
    with pytest.raises(ValueError):
        tokenbin.from_segment(bytes(data))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 300), max_size=60))
def test_windows_hold_every_token_once(sizes):
    seen = defaultdict(list)
    for row in packing.best_fit_decreasing(np.array(sizes, np.int64), 64):
        assert 0 < sum(p[2] for p in row) <= 64
        for doc, start, length in row:
            seen[doc].append((start, length))
    for doc, size in enumerate(sizes):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at and length > 0
            at += length
        assert at == size


def test_tightest_window():
    tree = packing.Capacities(2048)
    for free, window in ((5, 1), (100, 2), (2048, 3), (100, 4)):
        tree.add(free, window)
    assert [tree.tightest(s) for s in (6, 1, 100, 101, 1)] == [(100, 4), (5, 1), (100, 2), (2048, 3), None]


def test_packing(spark):
    path = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer(path).library
    pieces = packing.piece_digests(packing.pack_documents(documents(spark, ROWS), path, 1)).collect()
    ids = {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t, *_ in ROWS}
    assert sum(p.length for p in pieces) == sum(len(ids[d]) for d, *_ in ROWS)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for own in by.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:], strict=False)) and min(own)[0] == 0 and sum(n for _, n in own) <= 2048
    assert packing.pack_documents(documents(spark, []), path, 1).count() == 0
