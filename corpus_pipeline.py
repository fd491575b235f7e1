"""A corpus pipeline over ``documents``; each stage's rows are written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cytoframe.llm import decontamination, language, packing, privacy, similarity
from cytoframe.llm.tables import read_table, scratch_folder, tables_made


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without one go.

    Null and empty texts, texts without a letter and those of no clear language
    go.  Repeated rows stay, texts of any length and columns of any name too; an
    empty table gives none.
    """
    return language.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: a row with the least id, nulls last.

    Of repeated rows one stays; null texts and texts without words all stay;
    texts are compared as a whole; other columns pass through; an empty table
    gives none.
    """
    return similarity.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts have none and stay; repeated rows stay or go alike;
    texts are scanned as a whole; other columns pass through; an empty table
    gives none, an empty benchmark takes none.
    """
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data.

    Null texts stay null, clean ones as they are; repeated rows and equal
    entities change alike; texts and entities of any length are replaced as a
    whole; other columns pass through; an empty table gives none.
    """
    return privacy.anonymise(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens.

    Null and empty texts are the end token alone; repeated rows are packed each;
    texts of any length are cut into full sequences; other columns are not read;
    an empty table gives none.
    """
    return packing.pack(docs)


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", privacy_stage),
    ("packing", packing_stage),
]
#: Context trees, chosen paths and tokenisers are beyond SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, read from its files; those of the stages before it are removed once they were used."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{scratch_folder(spark)}/corpus-{uuid.uuid4().hex}"
    try:
        for k, (_, stage) in enumerate(STAGES):
            with tables_made(spark):  # what a stage wrote on its way goes with it, personal data too
                stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            if k:
                _remove(spark, f"{folder}/{k - 1}")
            docs = spark.read.parquet(f"{folder}/{k}")
    except BaseException:
        _remove(spark, folder)
        raise
    return docs
