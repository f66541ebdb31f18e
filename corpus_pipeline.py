"""The corpus pipeline: five stages over documents, each one operator of plumbago.llm, written and reread in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbago.llm import common, credentials, decontaminate, neardup, packing, queries, toxicity


def kept(result: DataFrame, docs: DataFrame) -> DataFrame:
    """result with the columns of docs, whatever their names, and no others."""
    return result.select(*(common.quoted(c) for c in docs.columns))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts to be toxic go; those with a score below the threshold stay."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    scored = toxicity.score_documents(docs.withColumnsRenamed(RENAMED), model)
    return kept(scored.where(F.col("predicted") == 0).drop(*ADDED).withColumnsRenamed(BACK), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least doc_id."""
    return kept(neardup.deduplicated(docs), docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item or an edited copy of one go."""
    return decontaminate.decontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; each secret in a text becomes <secret>, and n_chars is that of the new text."""
    found = credentials.find_secrets(docs.withColumnsRenamed(RENAMED), queries.vocabulary("byte_bpe_50k.json"), texts=True)
    changed = F.col("spans") != ""
    found = found.withColumn("text", F.when(changed, F.col("redacted")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(changed, F.length("redacted").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept(found.drop(*ADDED).withColumnsRenamed(BACK), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in sequences of 2048 tokens."""
    return packing.piece_digests(packing.pack_documents(docs, queries.vocabulary("byte_bpe_50k.json"), end_id=1))


#: The columns that operators add; those of docs with these names go by others meanwhile.
ADDED = ("score", "predicted", "evidence", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "redacted")
RENAMED = {c: f"own {c}" for c in ADDED}
BACK = {v: k for k, v in RENAMED.items()}

STAGES = [("toxicity", toxic_documents), ("near duplicates", near_duplicates), ("benchmark decontamination", benchmark_leaks), ("secrets", secrets), ("packing", packed)]

#: Learned scores, MinHash groups, alignments and tokens have no SQL; tests/llm/test_pipeline.py holds what each stage keeps and changes against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
