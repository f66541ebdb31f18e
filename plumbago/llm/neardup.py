"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets, without a row for each pair of a group.

Rows with equal n-gram sets form a class at once. Each class has BANDS hashes of ROWS MinHash values each; classes that share
a band's hash meet in a bucket. A pair is looked at only in the first band in which it meets. Buckets are cut into blocks,
and each pair of blocks is a group of bounded size, in which all pairs are counted by one product of incidence matrices; a group
returns, for each class, its number of links and one class to which it is connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbago.llm.common import extended, in_batches, partitions, slices, unused, written
from plumbago.llm.shingles import gram_hashes, mixed, word_hashes


def bands_for(similarity: float, recall: float, rows: int = 5) -> int:
    """The least number of bands of `rows` rows that find a pair of this similarity with this chance."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


N, SIMILARITY, ROWS, RECALL = 5, 0.8, 5, 0.9999
BANDS = bands_for(SIMILARITY, RECALL, ROWS)
#: Classes of a block; a group has at most about twice as many.
BLOCK = 256


def gram_sets(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram hashes of each text, and the texts' offsets."""
    grams, offsets = gram_hashes(*word_hashes(texts), n)
    sets = [np.unique(grams[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.concatenate(sets) if sets else grams, np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)


def band_hashes(grams: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A row of band hashes (int64) for each text. A text without n-grams has those of the largest values."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    seeds = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
    for band in range(bands):
        for row in range(rows):
            k = band * rows + row
            least = np.full(len(offsets) - 1, np.iinfo(np.uint64).max)
            if len(full):
                least[full] = np.minimum.reduceat(grams * (seeds[2 * k] | np.uint64(1)) + seeds[2 * k + 1], offsets[full])
            out[:, band] = mixed(out[:, band] * np.uint64(31) + least + np.uint64(row + 1))
    return out.view(np.int64)


def signatures(docs: DataFrame, n: int = N, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, set_key (of the n-gram set) and bands of every document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            grams, offsets = gram_sets(batch.column("text"), n)
            keys = [xxhash.xxh3_128_digest(grams[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            found = band_hashes(grams, offsets, bands, rows)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * bands, pa.int32()), pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), values], ["doc_id", "set_key", "bands"])

    return docs.select("doc_id", "text").transform(in_batches, sign, "doc_id long, set_key binary, bands array<long>")


def _with_key(n: int):  # noqa: ANN202
    """Puts the key of its text's set into each row that has none."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = batch.column("set_key").to_pylist()
            if missing := [k for k, own in enumerate(keys) if own is None]:
                grams, offsets = gram_sets(batch.column("text").take(pa.array(missing)), n)
                for k, at, end in zip(missing, offsets[:-1], offsets[1:], strict=True):
                    keys[k] = xxhash.xxh3_128_digest(grams[at:end].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("text")], ["set_key", "text"])

    return key


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gid, in batches that hold whole groups: about `most` bytes, or one group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        gids = np.asarray(whole.column("gid"))
        cut = int(np.searchsorted(gids, gids[-1], "left"))
        if cut:
            yield whole.slice(0, cut)
        held = [pa.Table.from_batches([whole.slice(cut)]).to_batches()[0]]
        size = held[0].nbytes if cut else 0  # a group larger than `most` gathers on
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("bands").flatten()).reshape(batch.num_rows, -1)


def _first_meetings(bands: np.ndarray, band: int, sides: np.ndarray, diagonal: bool) -> np.ndarray:
    """Whether two rows meet in this band and in none before, each pair of a group once."""
    meet = bands[:, None, band] == bands[None, :, band]
    for k in range(band):
        meet &= bands[:, None, k] != bands[None, :, k]
    meet &= np.tri(len(bands), k=-1, dtype=bool) if diagonal else (sides[:, None] < sides[None, :])
    return meet


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that meet another of their group for the first time there."""
    for batch in _groups(batches, 8 << 20):
        gids, bands = np.asarray(batch.column("gid")), _matrix(batch)
        band, side, diagonal = (np.asarray(batch.column(c)) for c in ("band", "side", "diagonal"))
        begins = np.append(np.flatnonzero(np.concatenate([[True], gids[1:] != gids[:-1]])), len(gids))
        sizes = np.diff(begins)
        keep = np.zeros(len(gids), bool)
        pairs = begins[:-1][(sizes == 2) & (diagonal[begins[:-1]] == 1)]
        if len(pairs):  # by far the most groups: two rows, all at once
            earlier = np.arange(bands.shape[1])[None, :] < band[pairs][:, None]
            fresh = pairs[~((bands[pairs] == bands[pairs + 1]) & earlier).any(1)]
            keep[fresh] = keep[fresh + 1] = True
        for g in np.flatnonzero((sizes > 2) | (sizes == 2) & (diagonal[begins[:-1]] == 0)):
            part = slice(begins[g], begins[g + 1])
            meet = _first_meetings(bands[part], int(band[begins[g]]), side[part], bool(diagonal[begins[g]]))
            keep[part] = meet.any(0) | meet.any(1)
        yield batch.filter(pa.array(keep))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairs' intersections: incidence over the n-grams that two sets or more have, some columns at a time."""
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(places, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    kept = shared[places]
    owners, columns = owners[kept], column[places[kept]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(columns, [first, first + width])
        incidence = np.zeros((len(sets), width), np.float32)
        incidence[owners[a:b], columns[a:b] - first] = 1
        total += incidence @ incidence.T
    return total


def _verified(n: int, similarity: float):  # noqa: ANN202
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, 16 << 20):
            gids, bands = np.asarray(batch.column("gid")), _matrix(batch)
            band, side, diagonal, copies = (np.asarray(batch.column(c)) for c in ("band", "side", "diagonal", "copies"))
            keys = batch.column("set_key").to_pylist()
            # Sets of some texts at a time: hashing holds many times a text's size.
            parts = [gram_sets(part.column("text"), n) for part in slices(iter([batch.select(["text"])]), "text")]
            grams = np.concatenate([g for g, _ in parts])
            offsets = np.append(0, np.cumsum(np.concatenate([np.diff(o) for _, o in parts])))
            begins = np.append(np.flatnonzero(np.concatenate([[True], gids[1:] != gids[:-1]])), len(gids))
            out: dict[str, list] = {"set_key": [], "root": [], "links": []}
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                # A repeated doc_id may bring the text of another class, or a class twice.
                seen: dict[bytes, int] = {}
                for k in range(a, b):
                    if xxhash.xxh3_128_digest(grams[offsets[k] : offsets[k + 1]].tobytes()) == keys[k]:
                        seen.setdefault(keys[k], k)
                rows = np.fromiter(seen.values(), np.int64, len(seen))
                if len(rows) < 2:
                    continue
                sets = [grams[offsets[k] : offsets[k + 1]] for k in rows]
                sizes = np.array([len(s) for s in sets], np.float32)
                common = _overlaps(sets) if len(rows) > 2 else np.array([[0, w := len(np.intersect1d(*sets, assume_unique=True))], [w, 0]], np.float32)
                linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-4
                linked &= _first_meetings(bands[rows], int(band[a]), side[rows], bool(diagonal[a]))
                linked |= linked.T
                counts = linked @ copies[rows]
                root = np.arange(len(rows))
                while True:  # labels fall to the least of each row's neighbours until nothing changes
                    least = np.minimum(root, np.where(linked, root[None, :], len(rows)).min(1))
                    if (least == root).all():
                        break
                    root = least
                for k in np.flatnonzero(counts):
                    out["set_key"].append(keys[rows[k]])
                    out["root"].append(keys[rows[root[k]]])
                    out["links"].append(int(counts[k]))
            yield pa.RecordBatch.from_pydict({"set_key": pa.array(out["set_key"], pa.binary()), "root": pa.array(out["root"], pa.binary()), "links": pa.array(out["links"], pa.int64())})

    return verify


def components(edges: DataFrame) -> DataFrame:
    """set_key and component (its least set_key) of edges (set_key, root): labels fall along edges and jump to their label's label.

    Each round is written to the shared folder; rounds grow with the logarithm of a component's diameter. Only a count of
    changes comes to the driver.
    """
    both = written(edges.where("set_key <> root").select("set_key", "root").union(edges.where("set_key <> root").select("root", "set_key")).distinct(), "edges")
    labels = written(both.groupBy("set_key").agg(F.least(F.col("set_key"), F.min("root")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("set_key").alias("root"), "component"), "root").groupBy("set_key").agg(F.min("component").alias("near"))
        jump = labels.select(F.col("set_key").alias("component"), F.col("component").alias("far"))
        new = labels.join(near, "set_key", "left").join(jump, "component", "left")
        new = written(new.select("set_key", F.least("component", "near", "far").alias("component"), (F.least("near", "far") < F.col("component")).alias("changed")), "labels")
        labels = new.drop("changed")
        if not new.where("changed").limit(1).count():
            return labels


def near_duplicates(docs: DataFrame, n: int = N, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, n_links, group_id and keeper of every row of docs (doc_id, text).

    class_id: the least doc_id among the rows with the same n-gram set; n_links: the other rows, copies included, whose set has
    a Jaccard similarity of `similarity` or more; group_id: the least doc_id among all rows to which links lead; keeper: whether
    this doc_id and class are chosen to stand for the group. A pair of that similarity is found with the chance `recall` at
    least; nothing that is reported is below it. Words are delimited by white space, in lower case. A text of fewer than n words has one
    n-gram of all of them; texts without words (a null text too) are one class. Null doc_ids count as rows and give null ids;
    repeated rows are copies. An empty table gives no rows. Other columns are not read.
    """
    bands = bands_for(similarity, recall, rows)
    spark = docs.sparkSession
    signed = written(signatures(docs, n, bands, rows), "signatures")
    classes = written(signed.groupBy("set_key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "classes")
    places = classes.select("set_key", F.posexplode("bands").alias("band", "hash"))
    id_hash = lambda seed: F.bit_xor(F.xxhash64("set_key", F.lit(seed)))
    buckets = places.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size"), id_hash(1).alias("a"), id_hash(2).alias("b")).where("size > 1")
    # Of buckets with the same classes (128 bits of their ids' hashes tell), only the first band's has first meetings.
    buckets = buckets.groupBy("size", "a", "b").agg(F.min(F.struct("band", "hash")).alias("first")).select("first.*", "size")
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("set_key"), blocks).cast("int")
    members = (
        # The classes' bands join after most places, which are alone in their bucket, have gone.
        places.join(buckets, ["band", "hash"]).join(classes, "set_key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(F.xxhash64("band", "hash", F.least("own", "other"), F.greatest("own", "other")).alias("gid"), "band", (F.col("own") > F.col("other")).cast("int").alias("side"), (F.col("own") == F.col("other")).cast("int").alias("diagonal"), "set_key", "class_id", "copies", "bands")
    )
    schema = "gid long, band int, side int, diagonal int, set_key binary, class_id long, copies long, bands array<long>"
    needed = written(members.repartition(partitions(spark), "gid").sortWithinPartitions("gid").transform(in_batches, _needed, schema), "meetings")
    # Each class that meets another brings one text. A null or repeated doc_id may stand for several classes: the keys of its rows are
    # computed again, so that they meet their own class only. All texts are shuffled once, those of meeting classes once more.
    meeting = needed.select("set_key", "class_id").distinct()
    shared = signed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("shared_id"), F.lit(True).alias("shared"))
    wanted = meeting.join(shared, F.col("class_id").eqNullSafe(F.col("shared_id")), "left")
    wanted = wanted.select(F.col("class_id").alias("wanted_id"), F.when(F.col("shared").isNull(), F.col("set_key")).alias("set_key")).distinct()
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("set_key", "text")
    brought = texts.transform(in_batches, _with_key(n), "set_key binary, text string").dropDuplicates(["set_key"])
    joined = needed.join(brought, "set_key")
    links = written(joined.repartition(partitions(spark), "gid").sortWithinPartitions("gid").transform(in_batches, _verified(n, similarity), "set_key binary, root binary, links long"), "links")
    labels = components(links)
    counts = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    described = classes.drop("bands").join(counts, "set_key", "left").join(labels, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    # The class with the least doc_id stands for its component; nulls last, ties to the lesser set_key.
    chosen = described.groupBy("component").agg(F.min(F.struct(F.col("class_id").isNull().alias("none"), "class_id", "set_key")).alias("least")).select("component", F.col("least.class_id").alias("group_id"), F.col("least.set_key").alias("keeper_key"))
    described = described.join(chosen, "component").select("set_key", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "group_id", (F.col("set_key") == F.col("keeper_key")).alias("stands"))
    return signed.select("doc_id", "set_key").join(described, "set_key").select(
        "doc_id", "class_id", "n_links", "group_id", (F.col("stands") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("keeper"), "set_key"
    )


def deduplicated(docs: DataFrame, **parameters) -> DataFrame:  # noqa: ANN003
    """The rows of docs that stand for their group, one for each; all columns stay, whatever their names.

    Rows of one doc_id are told apart by their n-gram sets; of rows alike in both, any one stays. Null doc_ids and texts are as in
    near_duplicates(); an empty table gives no rows.
    """
    n = parameters.get("n", N)
    keepers = written(near_duplicates(docs, **parameters).where("keeper").select("doc_id", "set_key").distinct(), "keepers")
    doc_id, set_key = unused(docs, "keeper_id"), unused(docs, "keeper_key")
    keepers = keepers.toDF(doc_id, set_key)
    same = lambda name: docs["doc_id"].eqNullSafe(F.col(name))
    repeated = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(unused(docs, "repeated_id")))
    single = docs.join(repeated, same(repeated.columns[0]), "left_anti").join(keepers, same(doc_id), "left_semi")
    several = docs.join(repeated, same(repeated.columns[0]), "left_semi")
    own = unused(docs, "own_key")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            grams, offsets = gram_sets(batch.column("text"), n)
            keys = [xxhash.xxh3_128_digest(grams[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, own])

    one = several.transform(in_batches, keyed, extended(several, f"`{own}` binary")).dropDuplicates(["doc_id", own])
    return single.unionByName(one.join(keepers, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(own) == F.col(set_key)), "left_semi").drop(own))
