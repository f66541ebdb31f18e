"""Toxicity by the nearest labelled examples under the exact TF-IDF cosine, searched in a block-max inverted index.

A text's terms are all its words, runs of letters and digits in lower case, and the beginnings of longer ones; the examples' terms are the vocabulary, without a limit.
A term's inverse document frequency is counted over all documents, and multiplied by how surely its share among toxic
examples differs from that among others; no term's factor is 0, so texts without any telling word have near examples too.
Examples with equal texts are one entry with its label counts. Postings lie in blocks of entries with the greatest weight in
each; a query opens blocks from the highest bound down until the bound is below the k-th cosine. Votes weighted by
closeness give a raw score, and a monotone fit on votes of left-out examples calibrates it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plumbago.llm.common import extended, in_batches, slices, written
from plumbago.llm.shingles import mixed, string_hashes

#: Labelled doc_ids of each label that are learned from at most, chosen by a hash of the doc_id, and half the number of different
#: texts among theirs; their counts are weighed by how many they stand for. The index holds no more, so it is safe to broadcast.
EXAMPLES = 500
#: Letters of a word's beginnings.
PREFIXES = (5,)
#: The factor of a term that tells nothing; that of the most telling one is 1 more.
FLOOR = 0.01
K, BLOCK = 24, 64
#: What the share of toxic examples counts for among the votes.
PRIOR = 0.1
THRESHOLD = 0.3
def _ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each begin to its end, one after another."""
    many = ends - begins
    upto = np.cumsum(many)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins - upto + many, many)


def _added(owner: np.ndarray, value: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (owner, value) in order, with the sums of their times."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    begins = np.flatnonzero(new)
    return owner[begins], value[begins], np.add.reduceat(times[order], begins) if len(begins) else times[:0]


def text_terms(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, times) of all texts' terms: 64-bit hashes, or the numbers of those in the sorted known hashes. A null text is empty."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\pL\pN]+", " ")
    split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(plain))
    coded = split.flatten().dictionary_encode()
    offsets = np.asarray(split.offsets).astype(np.int64)
    owner, word, times = np.repeat(np.arange(len(split)), np.diff(offsets)), np.asarray(coded.indices).astype(np.int64), np.ones(len(coded), np.int64)
    size = np.asarray(pc.utf8_length(coded.dictionary)).astype(np.int64)
    owner, word, times = (x[size[word] > 0] for x in (owner, word, times)) if len(word) else (owner, word, times)
    code, times = np.unique(owner * max(1, len(size)) + word, return_counts=True)
    owner, word = code // max(1, len(size)), code % max(1, len(size))
    found = []
    for n in (0, *PREFIXES):
        terms = string_hashes(pc.utf8_slice_codeunits(coded.dictionary, 0, n) if n else coded.dictionary)
        terms = mixed(terms + np.uint64(n))  # a beginning is another term than a word of the same letters
        use = size > n
        if known is not None:
            place = np.minimum(np.searchsorted(known, terms), max(0, len(known) - 1))
            use = use & (known[place] == terms) if len(known) else np.zeros(len(terms), bool)
            terms = place
        mine = use[word]
        found.append((owner[mine], terms[word[mine]], times[mine]))
    return _added(*(np.concatenate(x) for x in zip(*found, strict=True)))


@dataclass
class Model:
    """Entries with their votes, and the postings of their terms in runs: what one term has in one block."""

    terms: np.ndarray  # sorted hashes
    weight: np.ndarray  # of each term
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    total: np.ndarray = field(default_factory=lambda: np.zeros(0))
    witness: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    prior: float = 0.0
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    runs: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # where each term's runs begin
    run_block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    run_most: np.ndarray = field(default_factory=lambda: np.zeros(0))
    run_begin: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # where each run's postings begin
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, the unit vector of (1 + log count) times term weight, by term number; a text without known terms has none."""
        owner, number, times = text_terms(texts, self.terms)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [(number[a:b], self.unit(number[a:b], times[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def unit(self, numbers: np.ndarray, times: np.ndarray) -> np.ndarray:
        values = (1 + np.log(times)) * self.weight[numbers]
        return values / max(1e-12, float(np.sqrt((values**2).sum())))

    def index(self, owner: np.ndarray, number: np.ndarray, value: np.ndarray, entries: int) -> None:
        """Postings from the entries' vectors, given as rows (entry, term number, value); entries' places are their order."""
        order = np.lexsort((owner, number))
        owner, number, self.value = owner[order], number[order], value[order]
        self.place = owner.astype(np.int32)
        block = owner // BLOCK
        new = np.ones(len(owner), bool)
        new[1:] = (number[1:] != number[:-1]) | (block[1:] != block[:-1])
        begins = np.flatnonzero(new)
        self.run_begin = np.append(begins, len(owner))
        self.run_block = block[begins].astype(np.int32)
        self.run_most = np.maximum.reduceat(self.value, begins) if len(begins) else np.zeros(0)
        self.runs = np.searchsorted(number[begins], np.arange(len(self.weight) + 1))
        self.blocks, self.entries = -(-entries // BLOCK), entries

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int = K, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of the highest cosines above 0 and those cosines; ties to the first. leave: an entry to pass over."""
        scores, places = np.empty(0), np.empty(0, np.int64)
        if not len(numbers):
            return places, scores
        first, last = self.runs[numbers], self.runs[numbers + 1]
        run, weight = _ranges(first, last), np.repeat(weights, last - first)
        block = self.run_block[run]
        bounds = np.bincount(block, weight * self.run_most[run], self.blocks)
        order = np.argsort(-bounds, kind="stable")
        at, step = 0, 4
        while at < len(order):
            opened = order[at : at + step]
            opened = opened[(bounds[opened] >= (scores[-1] if len(scores) == k else 0.0) - 1e-9) & (bounds[opened] > 0)]
            if not len(opened):
                break
            mine = np.zeros(self.blocks, bool)
            mine[opened] = True
            own = mine[block]
            begins, ends = self.run_begin[run[own]], self.run_begin[run[own] + 1]
            posting = _ranges(begins, ends)
            found = np.bincount(self.place[posting], np.repeat(weight[own], ends - begins) * self.value[posting], self.entries)
            if leave >= 0:
                found[leave] = 0
            new = np.flatnonzero(found > 0)
            scores, places = np.concatenate([scores, found[new]]), np.concatenate([places, new])
            best = np.lexsort((places, -np.round(scores, 9)))[:k]
            scores, places = scores[best], places[best]
            at, step = at + step, step * 2
        return places, scores

    def votes(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Toxic share of the entries, each weighted by its cosine to the fourth power over distance, and of the prior."""
        closeness = cosines**4 / (0.05 + np.maximum(0, 1 - cosines))
        share = self.toxic[places] / np.maximum(self.total[places], 1e-12)
        return float((closeness @ share + PRIOR * self.prior) / (closeness.sum() + PRIOR))

    def calibrate(self, raw: np.ndarray, toxic: np.ndarray, total: np.ndarray) -> None:
        """Pool adjacent violators: the monotone fit of toxic shares to raw votes, straight between the pools' means."""
        pools: list[list[float]] = []
        for k in np.argsort(raw, kind="stable"):
            pools.append([raw[k] * total[k], toxic[k], total[k]])
            while len(pools) > 1 and (pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2] or pools[-2][0] * pools[-1][2] >= pools[-1][0] * pools[-2][2]):
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.steps = np.array([x / w for x, _, w in pools]), np.array([t / w for _, t, w in pools])

    def score(self, numbers: np.ndarray, weights: np.ndarray) -> tuple[float, list[int]]:
        places, cosines = self.nearest(numbers, weights)
        raw = self.votes(places, cosines)
        return min(1.0, max(0.0, float(np.interp(raw, *self.steps)))), self.witness[places[:3]].tolist()


def _document_counts(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of docs each term stands, and the number of docs; summed up in tasks before the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, rows = shared.value, 0
        totals = np.zeros(len(terms) + 1, np.int64)
        for batch in slices(batches, "text"):
            totals += np.bincount(text_terms(batch.column("text"), terms)[1], minlength=len(totals))
            rows += batch.num_rows
        totals[-1] = rows  # the last number is no term's
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(totals[some], pa.int64())], ["term", "n"])

    totals = np.zeros(len(terms) + 1, np.int64)
    found = docs.select("text").transform(in_batches, count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    totals[np.asarray(found.column("term"))] = np.asarray(found.column("n"))
    return totals[:-1], int(totals[-1])


def _labelled(docs: DataFrame, labels: DataFrame, examples: int) -> tuple[DataFrame, list[int]]:
    """Rows (text, toxic, n, witness, key), one for each different text, and how many doc_ids have each label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for t in (0, 1)]
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")  # at most 2 * examples rows of two numbers
    once = sample.groupBy("text").agg(F.sum("toxic").cast("long").alias("toxic"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("witness")).withColumn("key", F.sha2("text", 256))
    # A repeated doc_id may bring any number of texts; of these too, a hash chooses.
    return written(once.orderBy(F.xxhash64("text"), "key").limit(2 * examples), "examples"), [counts.get(t, 0) for t in (0, 1)]


def _terms_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        owner, terms, times = text_terms(batch.column("text"))
        cuts = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (terms.view(np.int64), times)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "toxic", "n", "witness")), *lists], ["key", "toxic", "n", "witness", "terms", "times"])


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """A model of docs (doc_id, text) and labels (doc_id, toxic 0 or 1), the same for any order of their rows.

    Null labels, null doc_ids and labels of unknown doc_ids are not used; of several labels of a doc_id, the highest holds.
    A null text is an empty one. Equal texts are one example with all their labels. Learns from at most `examples` doc_ids of each label and
    twice as many texts; document frequencies are those over all of docs. Without labels, every score is 0; with one kind only, it is that one.
    """
    once, counts = _labelled(docs, labels, examples)
    found = once.transform(in_batches, _terms_in, "key string, toxic long, n long, witness long, terms array<long>, times array<long>").toArrow().combine_chunks()
    if not found.num_rows:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    found = found.sort_by([("witness", "ascending"), ("key", "ascending")])
    toxic, n = (np.asarray(found.column(c)).astype(float) for c in ("toxic", "n"))
    terms, times = (found.column(c).combine_chunks() for c in ("terms", "times"))
    size = np.diff(np.asarray(terms.offsets))
    names, number = np.unique(np.asarray(terms.flatten()).view(np.uint64), return_inverse=True)
    times, owner = np.asarray(times.flatten()), np.repeat(np.arange(len(size)), size)
    frequency, rows = _document_counts(docs, names)

    # How surely a term's share among toxic examples is higher than among others, in standard errors, with half an example more of each.
    share = toxic / n
    texts = max(1e-9, share.sum()), max(1e-9, (1 - share).sum())
    with_term = np.bincount(number, share[owner], len(names)), np.bincount(number, (1 - share)[owner], len(names))
    overall = (with_term[0] + with_term[1] + 1) / (sum(texts) + 2)
    sure = np.maximum(0, (with_term[0] / texts[0] - with_term[1] / texts[1]) / np.sqrt(overall * (1 - overall) * (1 / texts[0] + 1 / texts[1])))
    telling = (sure / max(1e-9, sure.max(initial=0))) ** 2 if min(texts) > 0.5 else np.zeros(len(names))
    model = Model(names, (1 + np.log((rows + 1) / (frequency + 1))) * (telling + FLOOR))

    # Entries with like strongest terms lie side by side, so that blocks have low maxima for most terms.
    cuts = np.concatenate([[0], np.cumsum(size)])
    value = np.concatenate([model.unit(number[a:b], times[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    strongest = [tuple(number[a:b][np.argsort(-value[a:b], kind="stable")[:2]].tolist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    entry = np.array(sorted(range(len(size)), key=lambda k: (strongest[k], k)), np.int64)
    at = np.empty(len(size), np.int64)
    at[entry] = np.arange(len(size))
    stands_for = [c / max(1, min(c, examples)) for c in counts]
    model.toxic = (toxic * stands_for[1])[entry]
    model.total = model.toxic + ((n - toxic) * stands_for[0])[entry]
    model.witness = np.asarray(found.column("witness"))[entry]
    model.prior = float(model.toxic.sum() / model.total.sum())
    model.index(at[owner], number, value, len(size))

    keys = found.column("key").to_pylist()
    shared = docs.sparkSession.sparkContext.broadcast((model, {keys[k]: place for place, k in enumerate(entry.tolist())}))

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, places = shared.value
        for batch in slices(batches, "text"):
            own = [places[k] for k in batch.column("key").to_pylist()]
            raw = [model.votes(*model.nearest(*vector, leave=place)) for vector, place in zip(model.vectors(batch.column("text")), own, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(raw, pa.float64())], ["place", "raw"])

    raw = np.zeros(len(size))
    for r in once.transform(in_batches, left_out, "place long, raw double").collect():
        raw[r["place"]] = r["raw"]
    model.calibrate(raw, model.toxic, model.total)
    return model


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with all their columns and score (0 to 1), predicted (1 if score >= threshold) and evidence (doc_ids of the nearest three examples).

    Every whole text is scored, without a shuffle; a null or empty text, and one of which the examples have no term, gets the calibrated
    score of no votes. Null and repeated doc_ids do no harm. Columns of docs with these three names are replaced, others may have any name.
    An empty table gives no rows.
    """
    docs = docs.drop("score", "predicted", "evidence")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            coded = batch.column("text").dictionary_encode()  # copies often follow each other
            own = [model.score(*vector) for vector in model.vectors(coded.dictionary)] + [model.score(*model.vectors(pa.array([""]))[0])]
            out = [own[k] for k in np.asarray(pc.fill_null(coded.indices, len(own) - 1)).tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([s for s, _ in out], pa.float64()), pa.array([int(s >= threshold) for s, _ in out], pa.int32()), pa.array([e for _, e in out], pa.list_(pa.int64()))],
                [*batch.schema.names, "score", "predicted", "evidence"],
            )

    return docs.transform(in_batches, score, extended(docs, "score double, predicted int, evidence array<bigint>"))
