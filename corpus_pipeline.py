"""The corpus pipeline: rules, line dedup, near-dedup, mixing and packing of ``documents``.

Every stage gets what its predecessor kept, written as Parquet and read again. All but
the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from olapflow.llm import lines, mixing, packing, queries, rules, simhash
from olapflow.llm.base import ORACLE, QUERIES, documents, settle, stored

__all__ = ["ORACLE", "ORACLE_SQL", "QUERIES", "STAGES", "run"]


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that a quality rule rejects."""
    settle(spark)
    marked = rules.quality_rules(docs.select("text", F.struct(*docs.columns).alias("row")))
    return marked.where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that three or more documents share, except in one of them."""
    settle(spark)
    return _with_length(lines.dedup_lines(docs).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    settle(spark)
    return simhash.distinct_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and cut the sources to their target weights."""
    settle(spark)
    return _with_length(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mix into sequences: one row per piece."""
    settle(spark)
    return queries.piece_digest(packing.pack(docs, queries.word_bpe()))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_dedup", near_dedup),
    ("source_mix", source_mix),
    ("curve_packing", pack),
]

#: Hash functions, the curve and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
