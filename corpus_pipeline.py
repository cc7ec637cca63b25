"""A corpus from raw documents to token files: filter, deduplicate, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import quality
from tidemark.llm.decontaminate import remove_contaminated
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.neardup import one_of_each_text
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.tokens import token_digest, write_tokens
from tidemark.session import work_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled rows of ``docs``, does not reject."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate texts; ids may be null or repeated."""
    return one_of_each_text(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a document may come twice, or not at all."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, and per row what is read back from them."""
    path = work_path(spark, "corpus-tokens")
    write_tokens(docs, path, vocabulary())
    return token_digest(spark, path)


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicates", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing", mixed),
    ("token files", token_files),
]

#: Trained models, hashing and tokenizers are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows stored before the next."""
    docs = table(spark, sf_dir, "documents")
    path = work_path(spark, "corpus")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{i}")
        docs = spark.read.parquet(f"{path}/{i}")
    return docs
