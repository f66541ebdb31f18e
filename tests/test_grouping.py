"""The grouping plan against plain Python, header fields of binary documents, and payload names."""

import io
import math
import os
import random
import re
import zipfile
from collections import Counter

from pyspark.sql import functions as F

from plumbago import config
from plumbago.functions import payload
from plumbago.operators import similarity
from plumbago.plans import binary, grouping
from plumbago.sinks import payloads

STOPS = ["the", "and", "of"]


def terms(text):
    words = [w for w in re.findall(r"\b\w\w+\b", text.lower()) if w not in STOPS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def vectors(texts, sublinear):
    counts = [Counter(terms(t)) for t in texts]
    df = Counter(x for c in counts for x in c)
    out = []
    for c in counts:
        v = {x: ((1 + math.log(n)) if sublinear else n) * (math.log((1 + len(texts)) / (1 + df[x])) + 1) for x, n in c.items()}
        norm = math.sqrt(sum(w * w for w in v.values())) or 1.0
        out.append({x: w / norm for x, w in v.items()})
    return out


def dot(a, b):
    return sum(w * b.get(x, 0) for x, w in a.items())


def linked(sim, k):
    groups = [[i] for i in range(len(sim))]
    while len(groups) > k:
        mean = lambda a, b: sum(1 - min(1, max(0, sim[i][j])) for i in a for j in b) / (len(a) * len(b))
        _, a, b = min((round(mean(groups[a], groups[b]), 9), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        groups[a] += groups.pop(b)
    return groups


def test_grouped_is_that_of_plain_python(spark):
    rng = random.Random(8)
    topics = [["invoice", "posting", "vendor", "check"], ["payroll", "salary", "employee", "review"], ["asset", "retirement", "depreciation", "ledger"], ["zebra", "quilt", "lantern", "harbour"]]
    docs = {}
    for k in range(14):
        topic = topics[k % 4] + [f"word{j}" for j in range(6)]
        docs[f"doc{k:02}"] = [" ".join(rng.choice(topic) for _ in range(rng.randint(4, 9))) for _ in range(rng.randint(4, 9))]
    docs |= {"short": ["invoice posting"], "none": []}
    steps = spark.createDataFrame([(p, n, s) for p, own in docs.items() for n, s in enumerate(own)], "path string, step_no int, step string").repartition(3)
    paths = spark.createDataFrame([(p,) for p in docs], "path string")
    got = {r.path: (r.group_name, r.lines) for r in grouping.grouped(steps, paths, STOPS).collect()}
    active = sorted(p for p in docs if len(" ".join(docs[p]).split()) >= config.MIN_WORDS)
    v = vectors([" ".join(docs[p]) for p in active], True)
    sim = [[round(dot(a, b), 9) for b in v] for a in v]
    expand = lambda s: " ".join(config.SYNONYMS.get(w, w) for w in s.lower().split())
    for group in linked(sim, similarity.cluster_count(len(active))):
        members = sorted(active[i] for i in group)
        freq, first = Counter(), {}
        for n, w in enumerate(re.findall(r"\b[a-z]{4,}\b", " ".join(s for p in members for s in docs[p]))):
            if w not in config.SKIP:
                freq[w] += 1
                first.setdefault(w, n)
        rank = sorted(freq, key=lambda w: (-freq[w], first[w]))
        verb, noun = next((w for w in rank if w in config.VERBS), None), next((w for w in rank if w in config.NOUNS), None)
        name = f"{noun} {verb}" if verb and noun else f"{verb} Process" if verb else f"{noun} Processing" if noun else " ".join(rank[:2])
        every = [(p, s) for p in members for s in docs[p]]
        w = vectors([expand(s) for _, s in every], False)
        for p in members:
            best = [(max([dot(w[i], w[j]) for j, (q, _) in enumerate(every) if q != p], default=0), s) for i, (o, s) in enumerate(every) if o == p]
            hits = [(int(round(x, 9) * 100), s) for x, s in sorted(best, key=lambda b: -round(b[0], 9)) if x >= config.TFIDF_THRESHOLD and len(members) > 1]
            lines = [f"• {s}  [{x}% match]" if x else f"• {s}" for x, s in (hits or [(0, s) for s in docs[p]])[: config.TOP_STEPS]]
            assert got[p] == (name.title().replace("'S", "'s"), lines), p
    assert {p for p, (name, _) in got.items() if name == grouping.REFERENCE} == {"short", "none"}
    rows = grouping.grouped(steps, paths, STOPS)
    assert grouping.summary(rows).orderBy("group_no").collect()[-1].group_name == grouping.REFERENCE
    assert grouping.banner(rows).first().n_documents == len(docs)
    few = grouping.grouped(steps.where("path = 'short'"), paths.where("path in ('short', 'none')"), STOPS).collect()
    assert {r.group_name for r in few} == {grouping.REFERENCE}


def test_names_without_words_and_cluster_counts(spark):
    rows = spark.createDataFrame([(0, 0, "1 2"), (2, 1, None), (5, 2, "vendor data")], "g int, n int, t string")
    assert {r.g: r.group_name for r in similarity.name_groups(rows, "g", "t", "n").collect()} == {0: "Group 1", 2: "Group 3", 5: "Vendor Processing"}
    assert [similarity.cluster_count(*a) for a in ((10, 1), (10, 99), (10, 0), (2, 0), (1, 0), (30, 0))] == [2, 9, 3, 2, 1, 8]


def test_binary_header(spark):
    text = "\x07".join(["Organisation: Us\x01", "SOP No: 7", "x", "", "", "", "", "Bad\\label: 1", "Late: one", "sop no: 8", "Note: two", ":".join("y" * 150)])
    got = [(r["at"], r.label, r.value) for r in binary.header_fields(spark.createDataFrame([("a", text), ("b", None), ("c", "One: 1")], "path string, text string")).orderBy("path", "at").collect()]
    assert got == [(0, "Organisation", "Us"), (1, "SOP No", "7"), (0, "One", "1")]


def test_payload_names_do_not_meet(spark, tmp_path):
    names = ["a:b", "a?b", "x.bin", "X.bin", "x_2.bin", "x.bin", None, "..."]
    rows = spark.createDataFrame([("f/", n, k, str(k).encode()) for k, n in enumerate(names)], "folder string, name string, payload_no int, content binary").repartition(4)
    payloads.write(payloads.named(rows), str(tmp_path))
    found = {name: open(tmp_path / "f_" / name, "rb").read() for name in os.listdir(tmp_path / "f_")}
    assert sorted(found.values()) == [str(k).encode() for k in range(8)] and len({n.lower() for n in found}) == 8
    assert found["a_b"] == b"0" and found["x.bin"] == b"2" and found["x_2.bin"] == b"4"


def test_workbooks_are_verified():
    def book(view="", sheet="<sheet><c r='A1'/></sheet>", parts=("xl/workbook.xml",)):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for part in parts:
                z.writestr(part, f"<w:workbook xmlns:w='u'><w:workbookView {view}/></w:workbook>")
            z.writestr("xl/worksheets/sheet1.xml", sheet)
        return out.getvalue()

    assert payload.verified(book(), ".xlsx")[0] and payload.verified(book(), ".xlsx")[1].endswith("1 cells)")
    assert payload.verified(book(view="visibility='hidden'"), ".XLSX") == (False, payload.HIDDEN)
    assert payload.verified(book(sheet="<sheet/>"), ".xlsm") == (False, payload.NO_DATA)
    assert payload.verified(book(parts=()), ".xlsx") == (False, payload.NO_BOOK)


def test_step_matches_compare_each_bag_of_terms_once(spark):
    """Many copies of few steps: the pairs that are compared grow with distinct steps, and the matches are those of plain Python."""
    texts = ["post the vendor invoice", "review the asset ledger", "post a supplier bill", "water all green plants", None, ""]
    rows = [(f"p{(k // 7) % 5}", k, texts[k % 6]) for k in range(360)] + [("q", 0, "count the blue cars"), ("q", 1, "count the blue cars"), ("r", 0, "count the red cars"), ("r", 0, "review cars")]
    steps, groups = spark.createDataFrame(rows, "path string, step_no int, step string"), spark.createDataFrame([(p, 1) for p in ("p0", "p1", "p2", "p3", "p4", "q", "r")], "path string, `group` int")
    expand = lambda s: " ".join(config.SYNONYMS.get(w, w) for w in (s or "").lower().split())
    bags = {}
    for p, n, s in rows:
        bags.setdefault((p, n), Counter()).update(terms(expand(s)))
    df, n, units = Counter(x for c in bags.values() for x in c), len(rows), {}
    for key, c in bags.items():
        w = {x: f * (math.log((1 + n) / (1 + df[x])) + 1) for x, f in c.items()}
        units[key] = {x: v / math.sqrt(sum(y * y for y in w.values())) for x, v in w.items()}
    best = {k: max(round(dot(v, u), 9) for (q, _), u in units.items() if q != k[0]) for k, v in units.items()}
    want = set()
    for path in {p for p, _, _ in rows}:
        own = sorted(((-best[p, no], no, s) for p, no, s in rows if p == path and best[p, no] >= config.TFIDF_THRESHOLD), key=lambda x: x[:2])[: config.TOP_STEPS]
        want |= {(path, k + 1, int(-sim * 100)) for k, (sim, _, _) in enumerate(own)}
    found = grouping.step_matches(steps, groups, STOPS)
    assert {(r.path, r["rank"], r.pct) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2(" in plan and "path#" not in "".join(line for line in plan.split("\n") if "Join Inner" in line and "term" in line)  # bags are joined, not steps


def test_binary_header_sorts_a_row_for_each_text(spark):
    """Two texts of one path are one document, groups part at a gap, and the plan has one window and one shuffle."""
    cells = lambda *given: "\x07".join(given)
    rows = [("a", cells("Note: x", "y", "", "", "", "SOP No:: 1", "Title: a\x01b")), ("a", cells("", "", "", "", "", "", "", "title : c", "SOP NO: 2")), ("b", cells("q", "Late: 1", "", "", "", "", "Other: 2")), ("c", "x")]
    found = binary.header_fields(spark.createDataFrame(rows, "path string, text string").repartition(3))
    assert sorted(tuple(r) for r in found.collect()) == [("a", 5, "SOP No", ": 1"), ("a", 6, "Title", "ab"), ("b", 1, "Late", "1"), ("b", 6, "Other", "2")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Aggregate" not in plan


def test_names_are_the_same_for_numbers_and_other_orders(spark):
    """Words are counted without a sort where the order is an integer, negative, large or null; ties go to the first place and position, then by word."""
    rows = [(0, -5, "zeta posting alpha"), (0, 2**62, "alpha zeta vendor"), (1, None, "late words"), (1, -9, "early words here"), (2, 3, "gamma delta"), (2, 3, "beta"), (3, 7, "payment invoice depreciation"), (4, 1, "a b")]
    numbered = spark.createDataFrame(rows, "g int, n long, t string").repartition(3)
    names = lambda order: {r.g: r.group_name for r in similarity.name_groups(numbered, "g", "t", order).collect()}
    assert names("n") == names(F.struct("n")) == {0: "Vendor Posting", 1: "Words Late", 2: "Beta Gamma", 3: "Payment Payment", 4: "Group 5"}
    plan = similarity.name_groups(numbered, "g", "t", "n")._jdf.queryExecution().executedPlan().toString()
    assert "min(struct(_place" not in plan and "WindowGroupLimit" in plan
