"""From raw documents to token ids, in five stages; each works on what the one before it kept.

Toxic documents go, one of each group of near copies stays, documents that leak benchmark items go,
personal data is named by its kind, and the texts become token ids. All stages but the last return the
columns of documents. Rows of null or empty text pass all filters and end as empty lists of ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import bpe, decontaminate, jaccard_join, personal_data, toxicity
from marketlake.session import fresh_path


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model, learned from the labelled rows, does not reject."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingle sets of Jaccard similarity 0.8 or more."""
    return jaccard_join.one_of_each(docs, width=5, share=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold less than 0.8 of every benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; n_chars is that of the new text."""
    return personal_data.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids: the texts as token ids of the byte-level vocabulary."""
    import public_tokenizers

    return bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", not_toxic),
    ("jaccard_join", distinct),
    ("decontamination", uncontaminated),
    ("personal_data", redacted),
    ("bpe", encoded),
]

#: Stages that learn or read contexts are not SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
