"""A training-data pipeline over `documents`: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import common, minhash, packing, pii, quality, suffix
from framewright.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR_PERCENT = 80  # op4's own contract says 85


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier; every row is judged by its own text, and a null or empty text fails."""
    model = quality.train(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality.judge_documents(docs, model, carry=COLUMNS[1:]).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity from NEAR_PERCENT on): that with the smallest id.

    Rows that share an id stay or go together; texts without words, and rows with a null id, have no copies and stay.
    """
    kept = minhash.near_duplicates(docs, percent=NEAR_PERCENT).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(*COLUMNS)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut out; every document stays (a null text becomes empty)."""
    left = suffix.remove_repeats(docs, carry=("lang", "source")).withColumnRenamed("kept_text", "text")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; every row stays, a null text stays null, repeated rows are rewritten alike."""
    new = pii.replace_entities(docs)
    return new.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a null or empty text is one piece with the end id only."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("suffix dedup", repeat_removal),
    ("pii surrogates", pii_surrogates),
    ("packing", pack_sequences),
]

#: A classifier, hash surrogates and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
QUERY_SQL: dict[str, str] = {}
