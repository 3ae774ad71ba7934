"""From raw documents to packed sequences: five stages, each a table for the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutela.llm import minhash, packing, pii, quality_rules, substring
from tutela.llm.queries import vocabulary
from tutela.session import keep


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Other columns than a document's under names that no operator gives, and these names."""
    names = {c: f"__input_{c}" for c in docs.columns if c not in DOCUMENT}
    return docs.withColumnsRenamed(names), names


def _back(found: DataFrame, docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return found.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject; rows that repeat are judged alike. Columns of
    the input come back as they were, whatever they are called (so in all stages but the last)."""
    rows, names = _aside(docs)
    return _back(quality_rules.judge(rows).filter("kept"), docs, names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked at a similarity of 0.80 or more (a pair
    at 0.80 misses all bands with a probability of 6e-5). Of rows that repeat one stays."""
    return minhash.survivors(docs, percent=80)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; those that have none keep their text as it is. Rows that
    repeat are repeated passages of each other."""
    rows, names = _aside(docs)
    found = substring.remove_repeats(rows)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _back(_measured(found.withColumn("text", text)), docs, names)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal numbers and dates; rows that repeat get the same."""
    rows, names = _aside(docs)
    key = pii.session_key(spark, pii.DEMONSTRATION_KEY)
    return _back(_measured(pii.pseudonyms(rows, key)), docs, names)


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), added=True)


STAGES = [("quality rules", quality), ("near duplicates", near_dedup),
          ("repeated passages", substring_dedup), ("pseudonyms", pseudonyms),
          ("packing", packing_plan)]

#: Robust estimates, permutations and the plan are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
