"""Benchmark decontamination: rare n-gram seeds lead to candidates, Smith-Waterman alignment of words decides.

A seed is a pair of neighbouring words of an item; in a text it stands as two words with at most one between them. A local
alignment that scores a share `least` of a full copy's score joins so many of an item's words without a larger gap that it
must hold `held` of its seeds (Search.__init__ has the count). So of all seeds but held - T, the rarest ones, T stand in the
alignment's part of the text, whose length is bounded too. Where they do, the text around them is aligned to the item.
Rarity, counted over the whole corpus, settles how many candidates are tried, and never which items are found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbago.llm.common import extended, in_batches, quoted, slices, unused
from plumbago.llm.shingles import word_hashes

#: Items of fewer words are found in texts of just these words.
N = 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words from a seed's first to its second in a text, at most.
REACH = 2
#: A candidate holds one in PART of the item's words as rare seeds, or as many as an alignment must hold.
PART = 8
#: Places of items' seeds that are sorted at once, or those of one text.
PLACES = 1 << 20
#: Alignments that a worker remembers: groups of copies bring the same text again and again.
REMEMBERED = 4096
#: Items beyond this much text are handled a part at a time, each part broadcast to one pass over the texts.
ITEM_BYTES = 4 << 20
HITS = "array<struct<item_id:bigint,score:double,start_word:bigint,end_word:bigint>>"


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes without punctuation and signs, and the texts' offsets."""
    return word_hashes(pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), r"[\pP\pS]+", " "))


def align(item: np.ndarray, text: np.ndarray, least: float = 0) -> tuple[int, int, int]:
    """The best local alignment's score, and where it starts and ends in text (end exclusive); (0, 0, 0) for a score below least."""

    def end_of(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        along = np.arange(1, len(b) + 1) * -GAP
        above, best, end = np.zeros(len(b) + 1, np.int64), 0, 0
        for word in a:
            row = np.zeros(len(b) + 1, np.int64)
            step = np.maximum(above[:-1] + np.where(b == word, MATCH, MISMATCH), above[1:] + GAP)
            # A gap in the item costs -GAP for each place: the running maximum of what a place would be worth at the origin.
            row[1:] = np.maximum(np.maximum.accumulate(np.maximum(step, 0) + along) - along, 0)
            if row.max() > best:
                best, end = int(row.max()), int(row.argmax())
            above = row
        return best, end

    best, end = end_of(item, text)
    if best < least:
        return 0, 0, 0
    back = end_of(item[::-1], text[:end][::-1])[1] if best else 0
    return best, end - back, end


class Seeds:
    """Pairs of words by number: the pair of the words a and b of `known` is a * len(known) + b."""

    def __init__(self, words: np.ndarray) -> None:
        self.known = np.unique(words)

    def of_item(self, item: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.known, item)
        return place[:-1] * len(self.known) + place[1:]

    def of_texts(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, seed) of all pairs of known words up to REACH words apart, in no text's end and another's beginning."""
        if not len(self.known) or not len(words):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        number = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        mine = self.known[number] == words
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        places, seeds = [], []
        for step in range(1, REACH + 1):
            at = np.flatnonzero(mine[:-step] & mine[step:] & (owner[:-step] == owner[step:]))
            places.append(at)
            seeds.append(number[at] * len(self.known) + number[at + step])
        return np.concatenate(places), np.concatenate(seeds)


def places_among(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Each value's place in the sorted known ones, or -1."""
    if not len(known):
        return np.full(len(values), -1, np.int64)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[place] == values, place, -1)


def count_seeds(docs: DataFrame, seeds: Seeds, counted: np.ndarray) -> np.ndarray:
    """How often each of these (sorted) seeds stands in docs. Counted over all of docs, summed up before the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast((seeds, counted))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, counted = shared.value
        totals = np.zeros(len(counted), np.int64)
        for batch in slices(batches, "text"):
            place = places_among(counted, seeds.of_texts(*plain_words(batch.column("text")))[1])
            totals += np.bincount(place[place >= 0], minlength=len(counted))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some], pa.int64())], ["seed", "n"])

    totals = np.zeros(len(counted), np.int64)
    for r in docs.select("text").transform(in_batches, count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():
        totals[r["seed"]] = r["n"]
    return totals


class Search:
    """The items, and the rare seeds that lead to them.

    How many seeds an alignment holds: let m words match, with gaps between them. A gap that skips or replaces words of the
    item costs 1 for each of those words, u in all; any other gap of two words or more in the text costs 2 or more, w such gaps
    stand there; all remaining ones are seeds. From 2m - u - 2w >= S (the score asked for) and m + u <= n (the item's words),
    the seeds m - 1 - u - w are at least 2S/3 - n/3 - 1: from n = 4 on and for least = 0.5, one or more.
    """

    def __init__(self, items: list[np.ndarray], seeds: Seeds, frequency: dict[int, int], least: float) -> None:
        self.items, self.seeds = items, seeds
        sizes = np.array([len(i) for i in items], np.int64)
        #: Words that match at least, and words between the first and the last match at most, in an alignment of a score of `least`.
        self.need = np.maximum(1, np.ceil(least * sizes - 1e-9).astype(np.int64))
        self.span = sizes + np.maximum(0, np.floor(MATCH * (sizes - least * sizes) + 1e-9).astype(np.int64))
        self.enough = MATCH * least * sizes - 1e-6
        held = np.maximum(1, np.ceil((4 * least - 1) * sizes / 3 - 1 - 1e-9).astype(np.int64))
        self.lead = np.minimum(np.maximum(1, sizes // PART), held)
        self.kinds = [np.unique(i, return_counts=True) for i in items]
        self.remembered: dict = {}
        #: Items of fewer than N words, by their words.
        self.short: dict[bytes, list[int]] = {}
        owners: dict[int, set[int]] = {}
        for k, item in enumerate(items):
            if self.need[k] > sizes[k]:
                continue  # no alignment scores that much
            if sizes[k] < N:
                self.short.setdefault(item.tobytes(), []).append(k)
                continue
            own = seeds.of_item(item)
            order = np.argsort([frequency.get(x, 0) for x in own.tolist()], kind="stable")
            for seed in own[order][: sizes[k] - 1 - held[k] + self.lead[k]].tolist():
                owners.setdefault(seed, set()).add(k)
        chosen = sorted(owners)
        self.chosen = np.array(chosen, np.int64)
        self.begins = np.cumsum([0, *(len(owners[x]) for x in chosen)])
        self.owners = np.array([k for x in chosen for k in sorted(owners[x])], np.int64)

    def candidates(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, item, places): the places in the text where `lead` of the item's rare seeds begin within its span."""
        for text in np.flatnonzero((np.diff(offsets) > 0) & (np.diff(offsets) < N)) if self.short else ():
            for k in self.short.get(words[offsets[text] : offsets[text + 1]].tobytes(), ()):
                yield int(text), k, np.zeros(1, np.int64)
        at, found = self.seeds.of_texts(words, offsets)
        place = places_among(self.chosen, found)
        at, place = at[place >= 0], place[place >= 0]
        if not len(at):
            return
        order = np.argsort(at * len(self.chosen) + place, kind="stable")
        at, place = at[order], place[order]
        many = self.begins[place + 1] - self.begins[place]
        upto = np.concatenate([[0], np.cumsum(many)])
        edges = np.searchsorted(at, offsets)  # the texts' edges among the places
        first = 0
        while first < len(offsets) - 1:
            last = max(first + 1, int(np.searchsorted(upto[edges], upto[edges[first]] + PLACES, "right")) - 1)
            part = slice(edges[first], edges[last])
            own = np.repeat(self.begins[place[part]] - upto[part], many[part]) + np.arange(upto[part.start], upto[part.stop])
            item, where = self.owners[own], np.repeat(at[part], many[part])
            doc = np.searchsorted(offsets, where, "right") - 1
            order = np.lexsort((where, item, doc))
            item, where, doc = item[order], where[order], doc[order]
            once = np.ones(len(item), bool)  # a place counts once, though a pair of neighbours and one with a word between may start there
            once[1:] = (item[1:] != item[:-1]) | (where[1:] != where[:-1])
            item, where, doc = item[once], where[once], doc[once]
            end = np.arange(len(item)) + self.lead[item] - 1
            safe = np.minimum(end, len(item) - 1)
            good = np.flatnonzero((end == safe) & (item[safe] == item) & (doc[safe] == doc) & (where[safe] - where < self.span[item]))
            cuts = np.flatnonzero((np.diff(doc[good]) != 0) | (np.diff(item[good]) != 0)) + 1
            for own in np.split(good, cuts) if len(good) else []:
                yield int(doc[own[0]]), int(item[own[0]]), where[own] - offsets[doc[own[0]]]
            first = last

    def may_score(self, k: int, text: np.ndarray) -> bool:
        """False only where no alignment with item k scores enough, by two bounds.

        Every word of the text between the ends of an alignment is a match, or lowers its score; and in a part of the span's
        length, a word matches at most as often as the item has it.
        """
        item, span = self.items[k], int(self.span[k])
        kinds, times = self.kinds[k]
        kind = np.minimum(np.searchsorted(kinds, text), len(kinds) - 1)
        mine = kinds[kind] == text
        sums = np.concatenate([[0], np.cumsum(np.where(mine, MATCH, GAP))])
        if (sums - np.minimum.accumulate(sums)).max() < self.enough[k]:
            return False
        places = np.flatnonzero(mine)
        kind = kind[places]
        order = np.argsort(kind, kind="stable")
        sorted_kind, sorted_place = kind[order], places[order]
        before = np.arange(len(order)) - times[sorted_kind]
        same = (before >= 0) & (sorted_kind[np.maximum(before, 0)] == sorted_kind)
        # A place counts for the parts that begin behind the one as many times before as the item has its word, and hold the place.
        begin = np.maximum(np.where(same, sorted_place[np.maximum(before, 0)], -1), np.maximum(sorted_place - span, -1)) + 1
        counted = np.cumsum(np.bincount(begin, minlength=len(text) + 1) - np.bincount(sorted_place + 1, minlength=len(text) + 1))
        return bool(counted.max() >= self.need[k])

    def best(self, k: int, text: np.ndarray, places: np.ndarray) -> tuple[float, int, int]:
        """Score, start and end of the best local alignment of item k, among those of the text around these places."""
        item, span, need = self.items[k], int(self.span[k]), int(self.need[k])
        if len(item) < N:
            return (1.0, 0, len(text)) if np.array_equal(item, text) else (0.0, 0, 0)
        best = (0.0, 0, 0)
        for own in np.split(places, np.flatnonzero(np.diff(places) > 2 * span) + 1):
            first, last = max(0, int(own[0]) - span), min(len(text), int(own[-1]) + span)
            if (found := self.remembered.get(key := (k, xxhash.xxh3_128_digest(text[first:last].tobytes())))) is None:
                if len(self.remembered) >= REMEMBERED:
                    self.remembered.clear()
                found = self.remembered[key] = align(item, text[first:last], self.enough[k]) if self.may_score(k, text[first:last]) else (0, 0, 0)
            score, start, end = found
            if score > best[0] * MATCH * len(item):
                best = (score / (MATCH * len(item)), first + start, first + end)
        return best


def _matches(docs: DataFrame, corpus: DataFrame, item_ids: list[int], texts: list[str], least: float, column: str) -> DataFrame:
    """docs with a column of hits for these items; seeds are counted over corpus."""
    words, offsets = plain_words(pa.array(texts, pa.string()))
    items = [words[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    full = [k for k, item in enumerate(items) if len(item)]
    seeds = Seeds(words)
    counted = np.unique(np.concatenate([np.empty(0, np.int64), *(seeds.of_item(items[k]) for k in full)]))
    frequency = dict(zip(counted.tolist(), count_seeds(corpus, seeds, counted).tolist(), strict=True)) if len(counted) else {}
    shared = docs.sparkSession.sparkContext.broadcast((Search([items[k] for k in full], seeds, frequency, least), [item_ids[k] for k in full]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, item_ids = shared.value
        for batch in slices(batches, "text"):
            words, offsets = plain_words(batch.column("text"))
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for doc, item, places in search.candidates(words, offsets):
                score, start, end = search.best(item, words[offsets[doc] : offsets[doc + 1]], places)
                if end and score >= least:
                    hits[doc].append({"item_id": item_ids[item], "score": score, "start_word": start, "end_word": end})
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, kind)], [*batch.schema.names, column])

    return docs.transform(in_batches, find, extended(docs, f"`{column}` {HITS}"))


def contamination(docs: DataFrame, items: DataFrame, least: float = 0.5) -> DataFrame:
    """docs with all their columns and `hits`: item_id, score, start_word and end_word of the test items that a text holds.

    items: (item_id, text). score is the best local word alignment's, 1 for a full copy; all hits of `least` and more are
    reported, whatever the size of docs and however often an item stands in it (for a least below 0.5: those that hold a
    seed). Words are those between white space, punctuation and signs, in lower case. A text or item that is null or has
    no words has no hits; an item of fewer than N words is found in texts of just these words; repeated items give a hit
    each; null and repeated doc_ids do no harm; a column of docs named hits is replaced, any other may have any name. Empty
    tables give empty results. The items' text is measured first: beyond ITEM_BYTES it is broadcast part by part, and each part's
    seeds are counted over docs and looked for in the one pass over docs that the result takes.
    """
    docs = docs.drop("hits")
    sized = items.where(F.length("text") > 0).select("item_id", "text")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // ITEM_BYTES)
    found, names = docs, []
    for part in range(parts):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        if not rows:
            continue
        names.append(unused(found, f"hits_{part}"))
        found = _matches(found, docs, [r["item_id"] for r in rows], [r["text"] for r in rows], least, names[-1])
    hits = F.concat(*(quoted(n) for n in names)) if names else F.array().cast(HITS)
    return found.select(*(quoted(c) for c in docs.columns), hits.alias("hits"))


def decontaminated(docs: DataFrame, items: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that hold no test item, with all columns of docs; every case is that of contamination()."""
    hits = unused(docs, "hits")
    found = contamination(docs.withColumnRenamed("hits", hits), items, least)
    return found.where(F.size("hits") == 0).drop("hits").withColumnRenamed(hits, "hits")
