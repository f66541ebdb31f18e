"""TF-IDF vectors, cosine pairs, best matches, average-linkage clusters and group names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from plumbago import config


def tfidf(terms: DataFrame, key: str = "doc_id", term: str = "term", sublinear: bool = True, most: int | None = config.MAX_FEATURES) -> DataFrame:
    """(key, term, weight) of unit length: tf or 1 + ln tf, times ln((1 + n) / (1 + df)) + 1. most: the terms of the highest counts, ties by term."""
    counts = terms.groupBy(key, term).agg(F.count(F.lit(1)).alias("tf"))
    n = terms.select(key).distinct().agg(F.count(F.lit(1)).alias("n"))
    per_term = counts.groupBy(term).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    if most is not None:
        per_term = per_term.orderBy(F.col("total").desc(), term).limit(most)
    idf = per_term.crossJoin(F.broadcast(n)).select(term, (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))  # n is one row
    tf = (1 + F.log("tf")) if sublinear else F.col("tf").cast("double")
    weighed = counts.join(idf, term).withColumn("w", tf * F.col("idf"))
    return weighed.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))).select(key, term, "weight")


def cosine_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, term: str = "term") -> DataFrame:
    """(left_key, right_key, sim) of all pairs that share a term. Rows of both: key, term, weight."""
    a, b = left.select(left_key, term, F.col("weight").alias("_a")), right.select(right_key, term, F.col("weight").alias("_b"))
    return a.join(b, term).groupBy(left_key, right_key).agg(F.sum(F.col("_a") * F.col("_b")).alias("sim"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def best_matches(pairs: DataFrame, key: str, other: str, threshold: float, top: int = config.TOP_STEPS) -> DataFrame:
    """The top others of each key whose similarity reaches the threshold, with pct, the similarity in whole hundredths, cut off."""
    order = Window.partitionBy(key).orderBy(F.col("sim").desc(), other)
    return pairs.where(F.col("sim") >= threshold).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("pct", (F.col("sim") * 100).cast("int"))


def cluster_count(n: int, asked: int = 0) -> int:
    """The number asked for, or a third of n and 8 at most; less than n but 2 at least, and 1 for a single row."""
    return min(n, max(2, min(asked or max(2, min(8, n - 1, round(n / 3))), n - 1)))


def average_linkage(similarity: np.ndarray, k: int) -> np.ndarray:
    """Labels 0.. of k clusters: the two with the least mean distance merge until k are left; ties go to the lowest pair."""
    n = len(similarity)
    distance = 1.0 - np.clip(similarity, 0, 1)
    np.fill_diagonal(distance, np.inf)
    size, label, live = np.ones(n), np.arange(n), n
    while live > k:
        a, b = np.unravel_index(int(distance.argmin()), distance.shape)
        a, b = min(a, b), max(a, b)
        merged = (size[a] * distance[a] + size[b] * distance[b]) / (size[a] + size[b])
        distance[a], distance[:, a] = merged, merged
        distance[a, a], distance[b], distance[:, b] = np.inf, np.inf, np.inf
        size[a] += size[b]
        label[label == b] = a
        live -= 1
    return np.unique(label, return_inverse=True)[1]


def cluster(vectors: DataFrame, group: str, key: str, vector: str, asked: int = 0, most: int = 5000) -> DataFrame:
    """(group, key, cluster) by average linkage within each group. It takes the square of a group's size; more than `most` rows is an error."""

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > most:
            raise ValueError(f"a group of {len(pdf)} rows; average linkage is for {most} at most")
        pdf = pdf.sort_values(key)
        x = np.stack(pdf[vector].to_numpy()).astype(float)
        x /= np.maximum(1e-12, np.linalg.norm(x, axis=1, keepdims=True))
        return pd.DataFrame({group: pdf[group].to_numpy(), key: pdf[key].to_numpy(), "cluster": average_linkage(x @ x.T, cluster_count(len(pdf), asked)).astype(np.int64)})

    kinds = dict(vectors.dtypes)
    return vectors.select(group, key, vector).groupBy(group).applyInPandas(label, f"{group} {kinds[group]}, {key} {kinds[key]}, cluster long")


def cluster_pairs(keys: DataFrame, pairs: DataFrame, key: str, other: str, asked: int = 0, most: int = 5000) -> DataFrame:
    """(key, cluster) of all keys by average linkage over pairs (key, other, sim); a pair that is not given has 0. Clusters count up by their first key.

    In one task, with the square of the number of keys as memory; more than `most` keys are an error.
    """
    kind = dict(keys.dtypes)[key]
    rows = keys.select(F.lit(0).alias("g"), key, F.lit(None).cast(kind).alias(other), F.lit(0.0).alias("sim")).unionByName(pairs.select(F.lit(0).alias("g"), key, other, "sim"))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        single = pdf[other].isna()
        names = sorted(pdf.loc[single, key])
        if len(names) > most:
            raise ValueError(f"{len(names)} rows; average linkage is for {most} at most")
        place = {name: k for k, name in enumerate(names)}
        similarity = np.zeros((len(names), len(names)))
        a, b = pdf.loc[~single, key].map(place).to_numpy(int), pdf.loc[~single, other].map(place).to_numpy(int)
        similarity[a, b] = similarity[b, a] = np.round(pdf.loc[~single, "sim"].to_numpy(float), 9)
        return pd.DataFrame({key: names, "cluster": average_linkage(similarity, cluster_count(len(names), asked)).astype(np.int64)})

    return rows.groupBy("g").applyInPandas(label, f"{key} {kind}, cluster long")


def name_groups(steps: DataFrame, group: str, text: str, order: str | Column) -> DataFrame:
    """(group, group_name): frequent noun and verb of its steps, or its two most frequent words; ties by first occurrence, then by word; `Group n` (n is the
    number group, from 0, plus 1) where there are no words, as far as group is a number.

    Words are counted in a hash table of fixed-width values where order is an integer; other orders sort the words of a task.
    Of the counts, each task keeps two of a group and kind before they are dealt out; no group is collected.
    """
    place = order if isinstance(order, Column) else F.col(order)
    base = steps.select(group, place.alias("_place"), F.col(text).alias("_text"))
    words = base.select(group, "_place", F.posexplode(F.regexp_extract_all(F.lower("_text"), F.lit(r"\b([a-z]{4,})\b"), 1)).alias("pos", "word")).where(~F.col("word").isin(*config.SKIP))
    kind = base.schema["_place"].dataType
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):  # place and position in one number; null places come first
        first = F.min(F.col("_place").cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)"))
        counts = words.groupBy(group, "word").agg(F.count(F.lit(1)).alias("n"), first.alias("first"), F.min(F.when(F.col("_place").isNull(), F.col("pos"))).alias("bare"))
        counts = counts.withColumn("first", F.struct(F.col("bare").isNull(), "bare", "first")).drop("bare")
    else:
        counts = words.groupBy(group, "word").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_place", "pos")).alias("first"))
    kinds = F.filter(F.array(F.lit("any"), F.when(F.col("word").isin(*config.VERBS), "verb"), F.when(F.col("word").isin(*config.NOUNS), "noun")), lambda k: k.isNotNull())
    ranked = counts.select(group, "word", "n", "first", F.explode(kinds).alias("kind")).withColumn("nth", F.row_number().over(Window.partitionBy(group, "kind").orderBy(F.col("n").desc(), "first", "word")))
    one = lambda test, name: F.max(F.when(test, F.initcap("word"))).alias(name)
    is_nth = lambda kind, nth: (F.col("kind") == kind) & (F.col("nth") == nth)
    tops = ranked.where("nth <= 2").groupBy(group).agg(one(is_nth("verb", 1), "v"), one(is_nth("noun", 1), "n"), one(is_nth("any", 1), "a"), one(is_nth("any", 2), "b"))
    verb, noun = F.col("v"), F.col("n")
    name = F.when(verb.isNotNull() & noun.isNotNull(), F.concat_ws(" ", noun, verb)).when(verb.isNotNull(), F.concat_ws(" ", verb, F.lit("Process"))).when(noun.isNotNull(), F.concat_ws(" ", noun, F.lit("Processing"))).when(F.col("a").isNotNull(), F.concat_ws(" ", "a", "b"))
    number = F.concat(F.lit("Group "), (F.expr(f"try_cast(cast(`{group}` as string) as bigint)") + 1).cast("string"))
    return base.select(group).distinct().join(tops, group, "left").select(group, F.coalesce(name, number).alias("group_name"))


def encode(df: DataFrame, text: str, encoder, name: str = "vector") -> DataFrame:  # noqa: ANN001
    """df with unit vectors of a pluggable encoder: a function that makes one, once for each worker, that maps lists of texts to an array."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encoder()
        for texts in batches:
            x = np.asarray(model(texts.fillna("").tolist()), float)
            yield pd.Series(list(x / np.maximum(1e-12, np.linalg.norm(x, axis=1, keepdims=True))))

    return df.withColumn(name, F.pandas_udf(run, "array<double>")(F.col(text)))
