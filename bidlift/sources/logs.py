"""Partitioned bid and session logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize


def read_log(
    spark: SparkSession,
    root: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    producttypes: tuple[str, ...] | None = None,
    schema: T.StructType | None = None,
    row_key: str | None = None,
) -> DataFrame:
    """A log partitioned by ``date`` (and ``producttype``), days ``start`` to ``end`` inclusive.

    The root is read with partition predicates, so only the matching folders
    are listed into the scan and the partition columns are kept. ``row_key``
    names a column to add that tells rows apart (see ``with_row_key``).
    """
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    log = reader.parquet(root)
    if start is not None:
        log = log.where(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        log = log.where(F.col("date") <= F.lit(str(end)).cast("date"))
    if producttypes is not None:
        log = log.where(F.col("producttype").isin(*producttypes))
    return log if row_key is None else with_row_key(log, row_key)


def with_row_key(log: DataFrame, name: str = "row_key") -> DataFrame:
    """Adds a bigint that tells rows apart, also those equal in all columns.

    ``log`` comes straight from files, at most filtered. A row's number is its
    place in its file plus the rows of the files before, by path, so it is the
    same on every read while the files are the same. The table of files has one
    short row a file.
    """
    placed = log.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))
    files = placed.groupBy("_path").agg((F.max("_at") + 1).alias("_n"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(files.select("_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "files")
    return placed.join(starts, "_path").withColumn(name, F.col("_start") + F.col("_at")).drop("_path", "_at", "_start")


def _parts(log: DataFrame) -> list[str]:
    return [c for c in ("producttype", "date") if c in log.columns]


def ingest_window(log: DataFrame, root: str, today: dt.date, days: int) -> None:
    """Full load: copy the ``days`` days before ``today`` into a partitioned log.

    The rebalance hint gathers a partition's rows for few files, and splits a
    partition that is too large for one task.
    """
    first, last = today - dt.timedelta(days=days), today - dt.timedelta(days=1)
    window = log.where(F.col("date").between(F.lit(first), F.lit(last)))
    parts = _parts(log)
    window.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(root)


def refresh_partitions(log: DataFrame, root: str, today: dt.date, days_back: int = 10) -> None:
    """Replace the partitions of today and the ``days_back`` days before it; others stay.

    This is how late rows get in: a day is replaced whole, so a retry gives the same log.
    """
    first = today - dt.timedelta(days=days_back)
    window = log.where(F.col("date").between(F.lit(first), F.lit(today)))
    parts = _parts(log)
    (
        window.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(root)
    )
