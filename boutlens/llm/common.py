"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import checkpointed as cut  # noqa: F401
from ..joins import small  # noqa: F401

#: White space as the contracts define it: space and the bytes 9 to 13.
SPACE = "\x20\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: Column) -> list[Column]:
    """Two hashes that tell rows apart by the given columns (nulls included)."""
    null = [c.isNull() for c in cols]
    return [
        F.xxhash64(F.lit("one"), *null, *cols).alias("__key1"),
        F.xxhash64(F.lit("two"), *null, *cols).alias("__key2"),
    ]


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct ``row``, so that columns made beside it can't clash with any of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of the struct ``row``, some of them changed."""
    return df.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in columns])


def text_batches(spark: SparkSession, rows: int = 500) -> None:
    """Lets Arrow batches hold ``rows`` rows at most, where the session allows more: texts can be long, and Python workers
    hold whole batches. The setting stays in the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def partitions(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def empty_if_null(df: DataFrame, col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
