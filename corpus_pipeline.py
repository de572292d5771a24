"""A corpus made ready for training: five stages over all documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, minhash, packing, pii, quality_model
from millrace.llm.frames import prepare, stored, table, without
from millrace.llm.queries import RANKS, TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates; those without an id or a word stay."""
    return without(docs, minhash.near_duplicates(docs).where("not kept").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    return without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, n_chars counted anew."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence."""
    return packing.pack(docs, TOKENIZER, RANKS)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", packing_stage),
]

# Fitted models and a genetic algorithm; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
