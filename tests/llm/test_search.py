"""op2, op4, op5, op6 and op10 against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from plumbago.llm import credentials, decontaminate, neardup, topk, toxicity
from plumbago.llm.shingles import gram_hashes, word_hashes


def grams(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def similar_texts(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([3, 4, 5, 8, 60, 120]))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    hot = [rng.choice(words) for _ in range(150)]
    for _ in range(60):  # one large group, larger than a block below
        own = list(hot)
        own[rng.randrange(150)] = rng.choice(words)
        texts.append(" ".join(own))
    return [*texts, "", None, "  ", "one", "One\n", texts[0], texts[0], texts[-1] + "  "]


def test_links_and_groups(spark):
    texts = similar_texts(5)
    rows = [(None if k == 7 else k, t, k, 0) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, set_key long, band int").repartition(4)
    got = {r.doc_id: r for r in neardup.near_duplicates(frame, block=16, recall=0.999999999).collect()}
    sets = [grams(t) for t in texts]
    link = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    parent = list(range(len(texts)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = defaultdict(int)
    for a in range(len(texts)):
        for b in range(a):
            if link(a, b):
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = defaultdict(lambda: 1 << 60)
    for k, (doc_id, *_) in enumerate(rows):
        least[top(k)] = min(least[top(k)], 1 << 60 if doc_id is None else doc_id)
    for k, (doc_id, *_) in enumerate(rows):
        assert got[doc_id].n_links == links[k], (k, texts[k])
        if doc_id is not None:
            assert got[doc_id].group_id == least[top(k)]
    kept = neardup.deduplicated(frame.drop("set_key"), recall=0.999999999).collect()
    assert len(kept) == len(least) and len({r.doc_id for r in kept}) == len(least)
    assert neardup.near_duplicates(frame.limit(0)).count() == 0



def test_null_and_repeated_ids_link_as_others(spark):
    """Near copies without a doc_id, or all of one doc_id, with the default recall; columns of any name."""
    rng = random.Random(9)
    base = [f"q{k}" for k in range(80)]
    texts = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(40)] + [" ".join(rng.sample(base, 60)) for _ in range(20)]
    for ids in ([None] * 60, [7] * 60, [None if k % 2 else 7 for k in range(60)]):
        frame = spark.createDataFrame([(d, t, "a", b"x", 0) for d, t in zip(ids, texts)], "doc_id long, text string, set_key string, own_key binary, `keeper.id` int").repartition(3)
        got = sorted(r.n_links for r in neardup.near_duplicates(frame).collect())
        sets = [grams(t) for t in texts]
        want = sorted(sum(len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets) if j != k) for k, a in enumerate(sets))
        assert got == want and max(want) > 20
        kept = neardup.deduplicated(frame)
        assert kept.columns == frame.columns and kept.count() == 21


def test_default_recall(spark):
    rng = random.Random(10)
    texts = []
    for k in range(120):  # pairs just above the threshold
        own = [f"p{k}_{j}" for j in range(100)]
        texts += [" ".join(own), " ".join([*own[:48], "x", *own[49:96]])]
    sets = [grams(t) for t in texts]
    got = {r.doc_id: r.n_links for r in neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(len(sets[k] & sets[k ^ 1]) >= 0.8 * len(sets[k] | sets[k ^ 1]) for k in range(240)) and sum(got.values()) == 240


def test_repeated_rows_leave_one(spark):
    frame = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "x y z"), (None, "x y z"), (2, "q")], "doc_id long, text string")
    assert sorted(neardup.deduplicated(frame).collect(), key=str) == sorted([(1, "a b c d e f"), (None, "x y z"), (2, "q")], key=str)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t.", max_size=30)), min_size=1, max_size=8))
def test_gram_hashes_tell_words_apart(texts):
    import pyarrow as pa

    found, offsets = gram_hashes(*word_hashes(pa.array(texts, pa.string())), 3)
    for k, text in enumerate(texts):
        assert len(set(found[offsets[k] : offsets[k + 1]].tolist())) == len(grams(text, 3))


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), [float(x) for x in rng.normal(size=6)]) for k in range(700)]
    rows += [(1000 + k, rows[0][1]) for k in range(20)] + [(50, None), (None, rows[1][1]), (2000, [1.0, None] * 3), (2001, [float("nan")] * 6), (2002, [float("inf")] * 6), (2003, []), (2050, [1.0, 2.0]), (2051, [3.0, 1.0])]
    rows = [r for r in rows if r[0] != 50 or r[1] is None]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(frame, frame.where("vec_id % 50 = 0")).collect()}
    good = [(k, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for k, v in rows if k is not None and v and None not in v and np.isfinite(v).all()]
    want = {}
    for k, v in good:
        if k % 50 == 0:
            best = sorted(((-int(v @ u), j) for j, u in good if j != k and len(u) == len(v)))[:5]
            want |= {(k, n + 1): (j, -s) for n, (s, j) in enumerate(best)}
    assert got == want
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-20, 20, (2000, 8)) + np.repeat(rng.integers(-300, 300, (20, 8)), 100, 0)
    queries, best = vectors[::100], topk.Best(20, 5)
    assert topk.search(queries, np.arange(0, 2000, 100), vectors, np.arange(2000), best, 100) < 20 * 2000 / 2
    scores = queries @ vectors.T
    for q in range(20):
        assert best.scores[q].tolist() == sorted(np.delete(scores[q], q * 100).tolist(), reverse=True)[:5]


def plain_base(text):
    found = []
    for kind, pattern, least in (("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 8), ("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


SECRETS = st.lists(st.sampled_from(["password", "PassWD=", "token", "ſecret", "secret=", '"', "'", " ", ":", "=", "api_key", "apikey:", "AKIA", "ABCD1234EFGH", "deadbeef" * 4, "0a", "hunter2x", "x7$Kq!zP2", " is ", "\n", "é", "AKIAAKIA", "qwertyuiop"]), max_size=14).map("".join)


@settings(deadline=None, max_examples=300)
@given(SECRETS)
def test_base_spans(text):
    assert credentials.joined(credentials.base_spans(text)).split(",") == (plain_base(text) or [""])
    spans = credentials.base_spans(text) + credentials.guessed_spans(text, credentials.words_of(None), 8.0)
    bare = credentials.redacted(text, spans)
    assert bare.count("<secret>") <= len(spans) and (spans or bare == text)


def test_guess_costs():
    words = credentials.words_of(None)
    for weak in ("password123", "qwertyuiop", "aaaaaaaaaaaaaaa", "abcabcabcabc", "19870412", "P@ssw0rd2024", "abcdefghij", "zxcvbnm"):
        assert credentials.guess_cost(weak, words) < 8, weak
    for strong in ("b7db7aa4a5fcc78305", "x7$Kq!zP2", "k2J9s8dLq0"):
        assert credentials.guess_cost(strong, words) >= 8 and credentials.guess_cost(strong, words, 8.0) >= 8


def plain_cost(value, words):
    """The least cost over all segmentations, segment by segment, without run tables."""
    lower = value.lower()
    plain, keys = lower.translate(credentials.LOOKALIKE), lower.translate(credentials.SHIFTED)

    def costs(i, j):
        size, part = j - i, value[i:j]
        out = [credentials._word_cost(part, lower[i:j], plain[i:j], words)] if 3 <= size <= 24 else []
        m = credentials.DATE.match(value, i)
        if m and m.end() == j:
            out.append(credentials.YEAR if size == 4 else credentials.DAY)
        if size >= 3 and (all(keys[k] in credentials.NEIGHBOURS.get(keys[k - 1], "") for k in range(i + 1, j)) or all(ord(value[k]) - ord(value[k - 1]) == 1 for k in range(i + 1, j)) or all(ord(value[k]) - ord(value[k - 1]) == -1 for k in range(i + 1, j))):
            out.append(credentials.run_cost(size))
        out += [credentials.run_cost(size, u) for u in (1, 2, 3, 4) if size % u == 0 and part == part[:u] * (size // u)]
        return min(out, default=math.inf)

    solid, brute = {0: 0.0}, {0: math.inf}
    for j in range(1, len(value) + 1):
        split = lambda i: credentials.SPLIT if i else 0
        brute[j] = min(brute[j - 1] + 1, solid[j - 1] + 1 + split(j - 1))
        solid[j] = min(min(solid[i], brute[i]) + split(i) + costs(i, j) for i in range(j))
    return min(solid[len(value)], brute[len(value)])


VALUES = st.lists(st.sampled_from(["a", "b", "ab", "1", "12", "123", "qwe", "rty", "567", "cba", "password", "P@ss", "2024", "19870412", "aaa", "xyx", "!", "K", "tgb", "zz", "monkey", "Q"]), max_size=9).map("".join)
WORDS = credentials.words_of(None)


@settings(deadline=None, max_examples=400)
@given(VALUES)
def test_guess_cost_is_the_least_of_all_segmentations(value):
    want = plain_cost(value, WORDS) if value else 0.0
    assert abs(credentials.guess_cost(value, WORDS) - want) < 1e-9
    assert (credentials.guess_cost(value, WORDS, 8.0) >= 8) == (want >= 8)


def test_long_values_take_time_in_proportion():
    for value in ("ab" * 40_000, "a" * 80_000, "qwertyuiop" * 8000, "x7$Kq!zP2" * 9000):
        began = time.time()
        assert credentials.guess_cost(value, WORDS, 8.0) > 0
        assert time.time() - began < 30
    assert credentials.guess_cost("1234567890password", WORDS) < 5 and credentials.guess_cost("ab" * 4000, WORDS) < 8


def test_redacted_keeps_all_columns(spark):
    frame = spark.createDataFrame([(1, "pwd is x7$Kq!zP2.", "s", 5, 1)], "doc_id long, text string, `od.d` string, spans int, kept int")
    got = credentials.find_secrets(frame, texts=True)
    assert {"doc_id", "text", "od.d", "kept", "spans", "redacted"} <= set(got.columns) and got.columns.count("spans") == 1
    assert got.first().redacted == "pwd is <secret>."


def test_secret_columns(spark):
    rows = [(1, "password=abcdefgh1 pwd is x7$Kq!zP2.", 0), (None, None, 0), (2, "", 0), (2, "AKIA" + "A" * 200_000, 0)]
    got = credentials.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert [(r.doc_id, r.n_assign, r.n_access, r.n_guess) for r in got] == [(1, 1, 0, 1), (None, 0, 0, 0), (2, 0, 0, 0), (2, 0, 1, 0)]
    assert got[0].spans == "assign:0:18,guess:26:35" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()


def plain_align(a, b):
    h, best = np.zeros((len(a) + 1, len(b) + 1), int), 0
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
            best = max(best, h[i + 1, j + 1])
    return best


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=20))
def test_alignment(a, b):
    score, start, end = decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))
    assert score == plain_align(a, b)
    if score:
        assert plain_align(a, b[start:end]) == score


def test_edited_copies_are_found(spark):
    rng = random.Random(2)
    words = [f"v{k}" for k in range(800)] + ["the", "of", "and"] * 60
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(text(40))) for k in range(20)] + [(90, None), (91, ""), (92, "lone word")]
    docs = [(k, " ".join(text(200)), "x") for k in range(200)]
    want = set()
    for k in range(20):
        own = items[k][1].split()
        for at in range(3, 40, 7):
            own[at] = rng.choice(words)
        own[20:20] = text(2)
        docs.append((500 + k, " ".join(text(50)) + ", " + " ".join(own).title() + "! " + " ".join(text(30)), "x"))
        want.add((500 + k, k))
    docs += [(None, items[3][1], "x"), (None, None, "x"), (7, "", "x"), (8, "Lone word.", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, hits string")
    found = decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, h.item_id) for r in found.collect() for h in r.hits}
    assert got == want | {(None, 3), (8, 92)}
    assert decontaminate.decontaminated(frame, spark.createDataFrame([], "item_id long, text string")).count() == len(docs)
    assert decontaminate.decontaminated(frame.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.integers(0, 9), min_size=4, max_size=14), min_size=1, max_size=4), st.lists(st.lists(st.integers(0, 9), max_size=40), min_size=1, max_size=5), st.sampled_from([0.5, 0.6, 0.8, 1.0]))
def test_no_item_is_missed(items, texts, least):
    items = [np.array(i, np.uint64) for i in items]
    words, offsets = np.array([w for t in texts for w in t], np.uint64), np.cumsum([0, *map(len, texts)])
    seeds = decontaminate.Seeds(np.concatenate(items))
    frequency = dict(zip(*np.unique(seeds.of_texts(words, offsets)[1], return_counts=True), strict=True))
    search = decontaminate.Search(items, seeds, frequency, least)
    got = {(d, k): hit[0] for d, k, places in search.candidates(words, offsets) if (hit := search.best(k, words[offsets[d] : offsets[d + 1]], places))[0] >= least}
    want = {(d, k): plain_align(i.tolist(), t) / (2 * len(i)) for d, t in enumerate(texts) for k, i in enumerate(items)}
    assert got == {pair: score for pair, score in want.items() if score >= least}


def edited(rng, own, words):
    """Words replaced, put in or left out here and there, or every so many words; often a part of the item only."""
    own, how = list(own), rng.randrange(5)
    if how == 0:
        own = own[rng.randrange(len(own) // 2) :]
    for k in reversed(range(len(own))):
        if how == 1 and k % 3 == 2 or how != 1 and rng.random() < 0.15:
            own[k : k + 1] = rng.choice([[rng.choice(words)], [], [own[k], rng.choice(words)]]) if how != 1 else [rng.choice(words)]
        elif how == 2 and k:
            own[k:k] = [rng.choice(words)]
    return own


def test_every_item_against_every_text(spark, monkeypatch):
    """Brute force: the hits are those whose alignment, over the whole text, scores enough; also with the items in several parts."""
    rng = random.Random(11)
    words = [f"z{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([4, 5, 9, 16, 30])))) for k in range(12)] + [(50, "z1 z2"), (51, "z1 z2"), (52, None)]
    docs = []
    for k in range(240):
        own = edited(rng, rng.choice(items[:12])[1].split(), words) if rng.random() < 0.5 else []
        docs.append((k, " ".join([*(rng.choice(words) for _ in range(rng.randrange(25))), *own, *(rng.choice(words) for _ in range(rng.randrange(25)))]), k, "x"))
    docs += [(k, items[3][1], k, "x") for k in range(900, 1000)] + [(None, "Z1, z2!", 0, None), (None, "z1 z2", 0, None), (7, None, 0, None), (7, "", 0, None)]
    want = sorted((str(d), i, round(plain_align(t.split(), x.split()) / (2 * len(t.split())), 6)) for d, x, *_ in docs if x and x[0] != "Z" for i, t in items if t and (plain_align(t.split(), x.split()) >= len(t.split()) if len(t.split()) > 3 else t == x))
    want = sorted([*want, ("None", 50, 1.0), ("None", 51, 1.0)])
    frame = spark.createDataFrame(docs, "doc_id long, text string, hits_0 long, `_hits` string").repartition(3)
    for bytes_ in (1 << 20, 200):
        monkeypatch.setattr(decontaminate, "ITEM_BYTES", bytes_)
        found = decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
        assert found.columns == [*frame.columns, "hits"]
        got = sorted((str(r.doc_id), h.item_id, round(h.score, 6)) for r in found.collect() for h in r.hits)
        assert got == want
    assert {i for _, i, _ in want} == {*range(12), 50, 51}
    kept = decontaminate.decontaminated(frame.withColumnRenamed("_hits", "hits"), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "hits_0", "hits"] and kept.count() == len(docs) - len({(d, k) for k, (d, x, *_) in enumerate(docs) if x and any(w[0] == str(d) for w in want) and (d is not None or "2" in x)})


def test_items_in_many_rows_are_found(spark):
    """However many rows hold an item, and in a table of one."""
    item = " ".join(f"u{k}" for k in range(16))
    edited = item.replace("u7", "other")
    for copies, others in ((30, 60), (30, 0), (1, 0)):
        docs = [(k, item) for k in range(copies)] + [(500, edited)] + [(1000 + k, f"plain text of row {k}") for k in range(others)] + [(8, "Lone word.")]
        found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item), (92, "lone word")], "item_id long, text string"))
        got = {(r.doc_id, h.item_id): h.score for r in found.collect() for h in r.hits}
        assert got == {(k, 1): 1.0 for k in range(copies)} | {(500, 1): 29 / 32, (8, 92): 1.0}


def toxic_corpus(seed):
    rng = random.Random(seed)
    plain, bad = [f"w{k}" for k in range(400)], [f"vile{k}" for k in range(12)]
    rows = []
    for k in range(600):
        toxic = k % 5 == 0
        rows.append((k, " ".join(rng.choice(bad) if toxic and rng.random() < 0.06 else rng.choice(plain) for _ in range(150)), int(toxic)))
    return rows


def learned(spark, rows, labels, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), **more)


def test_held_out_accuracy(spark):
    rows = toxic_corpus(1)
    docs, model = learned(spark, [(k, t, "s") for k, t, _ in rows] + [(None, None, "s"), (9999, "", "s")], [(k, y) for k, _, y in rows if k % 3] + [(None, 1), (1, None)])
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert np.mean([got[k].predicted == y for k, _, y in rows if k % 3 == 0]) > 0.97
    assert 0 <= got[9999].score < 0.3 and got[None].score == got[9999].score
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    nothing = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score_documents(docs, nothing).collect()} == {0.0}
    one_kind = toxicity.learn(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score_documents(docs, one_kind).collect()} == {1.0}


def plain_scores(rows, labels):
    """The method, by brute force over plain dictionaries: score and evidence of every text."""
    label = defaultdict(int)
    for d, y in labels:
        label[d] = max(label[d], y)
    texts = defaultdict(list)
    for d, t, *_ in rows:
        if d in label:
            texts[t or ""].append((label[d], d))
    terms = lambda t: Counter(x for w in re.findall(r"[^\W_]+", (t or "").lower()) for x in [w, *(w[:n] + "*" for n in (5,) if len(w) > n)])
    own = {t: terms(t) for t in texts}
    vocabulary = set().union(*own.values())
    share = {t: sum(y for y, _ in v) / len(v) for t, v in texts.items()}
    df, n1 = Counter(), sum(share.values())
    for _, t, *_ in rows:
        df.update(vocabulary & set(terms(t)))
    n0 = len(share) - n1
    sure = {}
    for x in vocabulary:
        a, b = sum(share[t] for t in texts if x in own[t]), sum(1 - share[t] for t in texts if x in own[t])
        p = (a + b + 1) / (n0 + n1 + 2)
        sure[x] = max(0, (a / n1 - b / n0) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)))
    weight = {x: (1 + math.log((len(rows) + 1) / (df[x] + 1))) * ((sure[x] / max(sure.values())) ** 2 + 0.01) for x in vocabulary}

    def vector(t):
        v = {x: (1 + math.log(c)) * weight[x] for x, c in terms(t).items() if x in vocabulary}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()}

    vectors = {t: vector(t) for t in texts}
    toxic, total = {t: float(sum(y for y, _ in v)) for t, v in texts.items()}, {t: float(len(v)) for t, v in texts.items()}
    prior = sum(toxic.values()) / sum(total.values())

    def votes(v, leave=None):
        near = sorted(((-sum(w * e.get(x, 0) for x, w in v.items()), t) for t, e in vectors.items() if t != leave), key=lambda p: p[0])
        near = [(-c, t) for c, t in near[:24] if c < 0]
        close = [c**4 / (0.05 + max(0, 1 - c)) for c, _ in near]
        return (sum(w * share[t] for w, (_, t) in zip(close, near)) + 0.1 * prior) / (sum(close) + 0.1), near

    raw = {t: votes(vectors[t], t)[0] for t in texts}
    pools = []
    for t in sorted(texts, key=lambda t: raw[t]):
        pools.append([raw[t] * total[t], toxic[t], total[t]])
        while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2] or pools[-2][0] / pools[-2][2] >= pools[-1][0] / pools[-1][2]):
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    out = []
    for d, t, *_ in rows:
        value, near = votes(vector(t))
        out.append((d, float(np.interp(value, [x / w for x, _, w in pools], [y / w for _, y, w in pools])), [min(d for _, d in texts[t]) for _, t in near[:3]], [c for c, _ in near[:4]]))
    return out


def test_scores_are_those_of_brute_force_in_any_order(spark):
    """Also with equal texts whose labels clash, nulls, empty texts and repeated doc_ids."""
    rows = [(k, t, "s") for k, t, _ in toxic_corpus(3)[:160]]
    rows += [(1000 + k, rows[k][1], "copy") for k in range(30)] + [(2000, None, None), (2001, "", "x"), (3, "another text of a repeated id", "y"), (None, rows[5][1], "z"), (2002, "unknown", ""), (2003, "vile3 " * 3000, "")]
    labels = [(k, int(k % 5 == 0)) for k in range(160) if k % 4] + [(1000 + k, int(k % 3 == 0)) for k in range(30)] + [(2000, 0), (2001, 1), (3, 1)]
    want = plain_scores(rows, labels)
    answers = []
    for a, b in ((rows, labels), (rows[::-1], labels[::-1])):
        docs, model = learned(spark, a, b)
        answers.append(toxicity.score_documents(docs.repartition(3), model).collect())
    got, other = ({(str(r.doc_id), r.text): r for r in rows_} for rows_ in answers)
    assert {k: (r.score, r.evidence) for k, r in got.items()} == {k: (r.score, r.evidence) for k, r in other.items()}
    for (d, t, _), (_, score, evidence, cosines) in zip(rows, want, strict=True):
        r = got[str(d), t]
        assert abs(r.score - score) < 1e-9, (d, r.score, score)
        if all(a - b > 1e-9 for a, b in zip(cosines, cosines[1:])):
            assert r.evidence == evidence


def test_a_few_labels_are_enough(spark):
    """A near copy of a toxic example without any telling word is near to it; small tables have telling words too."""
    rows = toxic_corpus(5)[:100]
    docs, model = learned(spark, [(k, t, "") for k, t, _ in rows] + [(500, " ".join(rows[0][1].split()[:-5]), "")], [(k, y) for k, _, y in rows if k % 4])
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert np.mean([got[k].predicted == y for k, _, y in rows if k % 4 == 0]) > 0.85
    assert got[500].score == got[500].score and len(got[500].evidence) == 3


def test_examples_are_bounded(spark):
    rows = toxic_corpus(6)
    _, model = learned(spark, [(k % 7, f"{t} {k}", "") for k, t, _ in rows], [(k, k % 2) for k in range(7)], examples=5)
    assert model.entries == 10


def test_nearest_is_exact():
    rng = np.random.default_rng(4)
    model = toxicity.Model(np.zeros(0, np.uint64), np.ones(30))
    dense = np.where(rng.random((500, 30)) < 0.15, rng.random((500, 30)) + 0.1, 0)
    dense /= np.maximum(1e-9, np.sqrt((dense**2).sum(1)))[:, None]
    owner, number = np.nonzero(dense)
    model.index(owner, number, dense[owner, number], 500)
    for q in range(60):
        terms = np.flatnonzero(dense[q])
        cosines = dense @ dense[q]
        for leave in (-1, q):
            if leave >= 0:
                cosines[leave] = 0
            places, found = model.nearest(terms, dense[q, terms], 10, leave)
            want = np.lexsort((np.arange(500), -np.round(cosines, 9)))[:10]
            want = want[cosines[want] > 0]
            assert places.tolist() == want.tolist() and np.allclose(found, cosines[want])
