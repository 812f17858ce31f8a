"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import fresh_path, materialize, work_dir

__all__ = ["table", "fresh_path", "materialize", "work_dir", "whole_text", "ascii_lower", "text_key", "small", "ranked", "arrow_rows", "wrapped", "unwrapped"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A table is broadcast only if its measured rows and bytes stay below these.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 48 << 20
RANK_BUCKETS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that on texts of one byte per character."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_key(text: Column) -> Column:
    """A digest that stands for the text; equal texts share it."""
    return F.sha2(text, 256)


def wrapped(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` as one struct column ``row``, and columns computed from it: no name of theirs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in columns.items()])


def unwrapped(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row``, some of them replaced."""
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns])


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """At most so many rows go to a Python worker at once: texts are long, and both sides hold a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def small(df: DataFrame, *texts: str, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is small enough to broadcast: rows and bytes of its text columns are counted."""
    total = F.lit(0)
    for name in texts:
        total = total + F.coalesce(F.octet_length(name), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total + 32), F.lit(0)).alias("b")).first()
    return found["n"] <= rows and found["b"] <= size


def ranked(rows: DataFrame, keys: list[str], order: list[Column], spread: Column, name: str = "rank", buckets: int = RANK_BUCKETS) -> DataFrame:
    """Numbers the rows of each key from 0 without a gap, a hot key spread over ``buckets`` tasks.

    ``spread`` (0 .. buckets-1) cuts a key into buckets; rows are numbered
    within a bucket by ``order`` and each bucket starts where the ones before
    it end. The number of buckets is fixed, so the table of bucket sizes is
    bounded by ``buckets`` rows a key. ``rows`` must be a written table or
    deterministic, as it is read twice.
    """
    cut = rows.withColumn("_b", spread)
    sizes = cut.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_b", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order)
    numbered = cut.withColumn("_r", F.row_number().over(inside).cast("bigint") - 1)
    return numbered.join(starts, [*keys, "_b"]).withColumn(name, F.col("_r") + F.col("_start")).drop("_b", "_r", "_start")
