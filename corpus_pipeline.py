"""The corpus pipeline: raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads what it wrote. All but the last
return the columns of documents. Rows with nulls in any column go through all stages as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutlens.llm import lines, mixing, neardup, packing, quality
from boutlens.llm.common import cut, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from the labels table."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; those that consist of such lines go."""
    return lines.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return neardup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words each source gives to the mix, document by document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 1024 tokens."""
    packed = packing.pack_documents(docs, digest=F.crc32("ids"))
    return packed.select("doc_id", "piece", "start", "length", F.col("digest").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: Hashes, a trained model and a packing can't be written in SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
