import hashlib
import random
from collections import Counter

from plumbago.llm import repeats


def brute(texts, length):
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(60), text(30)
    texts = [text(rng.randint(1, 120)) for _ in range(40)]
    texts += [text(20) + passage[rng.randint(0, 30) :] + text(10) for _ in range(10)]
    texts += [text(rng.randint(0, 9)) + line[rng.randint(0, 9) :][: rng.randint(100, 220)] + text(3) for _ in range(20)]
    base = text(150).split()
    for _ in range(15):
        own = list(base)
        for _ in range(rng.randint(1, 4)):
            own[rng.randrange(len(own))] = text(1)
        texts.append(" ".join(own))
    return [*texts, texts[0], texts[1], "a" * 500, "ab" * 300, "", None, "x", base[0] * 400, "a" * 199, "a" * 200]


def test_same_as_brute_force(spark):
    for seed, length in ((1, 200), (2, 64)):
        texts = corpus(seed)
        frame = spark.createDataFrame([(k if k % 7 else None, t, b"extra") for k, t in enumerate(texts)], "doc_id long, text string, text_key binary").repartition(5)
        got = Counter(tuple(r)[1:] for r in repeats.kept_digest(repeats.remove_repeats(frame, length)).collect())
        assert got == Counter(brute([(t or "").encode() for t in texts], length))
    assert repeats.remove_repeats(frame.limit(0)).count() == 0


def test_long_texts_in_stretches(monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 1000)
    texts = [t.encode() for t in corpus(3) if t] + [b"".join(t.encode() for t in corpus(4) if t)] * 2
    rows, runs = repeats.contexts(texts, [b"%016d" % k for k in range(len(texts))], 64)
    for k in (len(texts) - 2, len(texts) - 1):
        spans = repeats._removed(texts[k], runs[b"%016d" % k], 64)[1]
        assert spans.tolist() == [[0, len(texts[k])]]
    covered = sum(int(r["hi"]) - int(r["lo"]) + 1 for r in rows if r["text"] == b"%016d" % 0)
    assert covered <= max(0, len(texts[0]) - 63)
