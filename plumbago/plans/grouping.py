"""Documents grouped by their steps: gate, similarity, clusters, names, matched steps, and the report's rows."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbago import config
from plumbago.functions import text as T
from plumbago.operators import ordered, similarity

REFERENCE = "Reference Documents"
NO_STEPS = "Process steps not found or too short"


def stop_words(spark) -> list[str]:  # noqa: ANN001
    """Spark's English stop words, the default of the plans below; any other list may be given."""
    return StopWordsRemover.loadDefaultStopWords("english")


def grams(text: Column, stops: list[str]) -> Column:
    """The words of two characters and more that are no stop words, and pairs of those that follow each other."""
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b(\w\w+)\b"), 1), lambda w: ~w.isin(*stops) if stops else F.lit(True))
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda k: F.concat_ws(" ", F.get(words, k - 1), F.get(words, k)))
    return F.when(F.size(words) > 1, F.concat(words, pairs)).otherwise(words)


def gated(steps: DataFrame, paths: DataFrame, least: int = config.MIN_WORDS) -> DataFrame:
    """(path, text, active): a document's steps in a row; active where they have `least` words. paths brings documents without steps."""
    texts = steps.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step_no", "step"))), lambda x: x["step"]), " ").alias("text"))
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return paths.select("path").distinct().join(texts, "path", "left").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("active", words >= least)


def clusters(active: DataFrame, stops: list[str], asked: int = 0) -> DataFrame:
    """(path, cluster) of two active documents or more: average linkage over the cosines of sublinear TF-IDF vectors.

    The cosines are joined on shared terms; the linkage itself, whose result needs all pairs, runs in one task: it is for
    some thousand documents, as similarity.cluster() says.
    """
    terms = active.select("path", F.explode(grams(F.col("text"), stops)).alias("term"))
    weights = similarity.tfidf(terms, "path", "term")
    pairs = similarity.cosine_pairs(weights, weights.withColumnRenamed("path", "other"), "path", "other").where("path < other")
    return similarity.cluster_pairs(active.select("path"), pairs, "path", "other", asked)


def step_matches(steps: DataFrame, groups: DataFrame, stops: list[str], threshold: float = config.TFIDF_THRESHOLD, top: int = config.TOP_STEPS) -> DataFrame:
    """(path, rank, step, pct): each document's steps that best match a step of another document of its group.

    Rows: steps (path, step_no, step), groups (path, group). Weights are fitted on each group's steps, with synonyms
    expanded. A document of which no step reaches the threshold has its first steps with pct 0.

    Steps of the same terms are alike to all others, so each bag of terms is compared once in its group, however many steps
    have it: the pairs grow with the square of a group's distinct bags. Of its matches a bag keeps the best two of distinct
    owners; an owner is the only document with the other bag, null if there are several. One of the two, or both, stand in
    another document than any given one. A bag goes by its SHA-256. The pairs are dealt out over all partitions, as their input
    is small beside them, and sides with a row for each step are merged, as they may be large when unpacked.
    """
    words = grams(T.expand_synonyms(F.col("step")), stops)
    own = steps.join(groups, "path").withColumn("_t", words)
    n = own.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    keyed = own.groupBy("group", "path", "step_no").agg(F.array_sort(F.flatten(F.collect_list("_t"))).alias("_bag"), F.collect_list(F.struct("step")).alias("_steps"))
    keyed = keyed.withColumn("_id", F.unhex(F.sha2(F.array_join("_bag", "\n"), 256)))
    placed = keyed.groupBy("group", "_id", "_bag", "path").agg(F.count(F.lit(1)).alias("m"))
    bags = placed.groupBy("group", "_id", "_bag").agg(F.sum("m").alias("m"), F.when(F.min("path") == F.max("path"), F.min("path")).alias("owner"))
    counts = bags.select("group", "_id", "m", "owner", F.explode("_bag").alias("term")).groupBy("group", "_id", "m", "owner", "term").agg(F.count(F.lit(1)).alias("tf"))
    idf = counts.groupBy("group", "term").agg(F.sum("m").alias("df")).join(n, "group").select("group", "term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    weighed = counts.join(idf, ["group", "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    unit = F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("group", "_id")))
    a = weighed.select("group", "term", "_id", "owner", unit.alias("_a"))
    b = a.select("group", "term", F.col("_id").alias("_other"), "owner", F.col("_a").alias("_b"))
    wide = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sims = a.drop("owner").repartition(wide, "group", "term").join(b.hint("merge"), ["group", "term"]).groupBy("group", "_id", "_other", "owner").agg(F.sum(F.col("_a") * F.col("_b")).alias("sim"))
    owned = sims.groupBy("group", "_id", "owner").agg(F.max("sim").alias("sim"))
    two = owned.withColumn("_k", F.row_number().over(Window.partitionBy("group", "_id").orderBy(F.col("sim").desc(), "owner"))).where("_k <= 2")
    best = placed.join(two, ["group", "_id"]).where("owner is null or owner <> path").groupBy("group", "_id", "path").agg(F.round(F.max("sim"), 9).alias("sim"))
    scored = keyed.join(best.hint("merge"), ["group", "_id", "path"], "left").select("path", "step_no", "sim", F.inline("_steps"))
    scored = scored.withColumn("hit", F.coalesce(F.col("sim") >= threshold, F.lit(False)))
    any_hit = F.max("hit").over(Window.partitionBy("path"))
    scored = scored.withColumn("any", any_hit).where(F.col("hit") | ~F.col("any"))
    order = Window.partitionBy("path").orderBy(F.when(F.col("any"), F.col("sim")).desc_nulls_last(), "step_no")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("path", "rank", "step", F.when(F.col("any"), (F.col("sim") * 100).cast("int")).otherwise(0).alias("pct"))


def line(step: Column, pct: Column) -> Column:
    """A step as the report shows it."""
    return F.when(pct > 0, F.format_string("• %s  [%d%% match]", step, pct)).otherwise(F.concat(F.lit("• "), step))


def grouped(steps: DataFrame, paths: DataFrame, stops: list[str] | None = None, asked: int = 0) -> DataFrame:
    """(group_name, path, lines), one row for each of paths: clusters of like names are one group, documents below the gate are REFERENCE.

    With fewer than two documents above the gate, all are REFERENCE. Rows: steps (path, step_no, step), paths (path).
    """
    stops = stop_words(steps.sparkSession) if stops is None else stops
    gate = gated(steps, paths)
    active = gate.where("active")
    if active.limit(2).count() < 2:
        return gate.select(F.lit(REFERENCE).alias("group_name"), "path", F.array(F.lit(NO_STEPS)).alias("lines"))
    found = clusters(active, stops, asked)
    names = similarity.name_groups(steps.join(found, "path"), "cluster", "step", F.struct("path", "step_no"))
    matched = step_matches(steps, found.withColumnRenamed("cluster", "group"), stops)
    lines = matched.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", line(F.col("step"), F.col("pct")).alias("line")))), lambda x: x["line"]).alias("lines"))
    rows = found.join(names, "cluster").join(lines, "path").select("group_name", "path", "lines")
    return rows.unionByName(gate.where("NOT active").select(F.lit(REFERENCE).alias("group_name"), "path", F.array(F.lit(NO_STEPS)).alias("lines")))


def summary(rows: DataFrame) -> DataFrame:
    """(group_name, n_documents, group_no) of grouped() rows: groups by name, the REFERENCE group last."""
    counts = rows.groupBy("group_name").agg(F.count(F.lit(1)).alias("n_documents"))
    return ordered.autonumber(counts.withColumn("g", F.lit(0)), ["g"], [F.col("group_name") == REFERENCE, "group_name"], 1).drop("g").withColumnRenamed("number", "group_no")


def banner(rows: DataFrame) -> DataFrame:
    """One row: the groups but REFERENCE, and the documents."""
    return rows.agg(F.countDistinct(F.when(F.col("group_name") != REFERENCE, F.col("group_name"))).alias("n_groups"), F.count(F.lit(1)).alias("n_documents"))
