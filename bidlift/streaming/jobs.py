"""Streaming forms of counting and scoring.

The counting sinks keep a commit log, so that every source file counts once
whatever is retried or lost. The scoring sink writes a micro-batch under its
batch id and overwrites it when the batch is retried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path, materialize
from ..sources import tables
from .commits import CommitLog

LATE = "11 days"

COUNTS = {"sessions": "bigint", "clicks": "bigint", "actives": "bigint"}
DAY_COUNTS = {"sessions": "bigint", "actives": "bigint"}
SEEN = T.StructType([T.StructField("newest", T.TimestampType())])


def read_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """A stream of parquet files with a fixed schema; ``_file`` names the file of a row."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("_file", F.col("_metadata.file_path"))


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process what is there and stop; a later run with the same checkpoint goes on from here."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_sink(score: Callable[[DataFrame], DataFrame], out: str) -> Callable[[DataFrame, int], None]:
    """Score each micro-batch of requests with the batch scorer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def ad_log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, root, {"ad_id": "bigint"}, COUNTS)


def count_sink(out: str) -> Callable[[DataFrame, int], None]:
    """Counters per ad, as one version a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        log = ad_log(batch.sparkSession, out)
        fresh = materialize(log.fresh(batch), "batch")
        counts = fresh.groupBy("ad_id").agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("has_click").cast("bigint").alias("clicks"),
            F.sum("has_active").cast("bigint").alias("actives"),
        )
        log.commit(counts, fresh.select("_file").distinct())

    return write


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    return ad_log(spark, out).current()


def day_log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, root, {"day": "timestamp", "ad_id": "bigint"}, DAY_COUNTS)


def daily_sink(out: str, late: str = LATE) -> Callable[[DataFrame, int], None]:
    """Sessions and actives per ad and day, split at a watermark.

    A day is closed once it ended ``late`` before the newest event of the
    versions before the batch. Rows of closed days change no counts; they go to
    the table ``late``, so that counts and late rows together are all rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = day_log(spark, out)
        fresh = materialize(log.fresh(batch), "batch")
        newest = log.read("seen", SEEN).agg(F.max("newest")).first()[0]
        day = F.date_trunc("day", "ts")
        closed = F.lit(False) if newest is None else day + F.expr("interval 1 day") <= F.lit(newest) - F.expr(f"interval {late}")
        split = fresh.withColumns({"day": day, "_late": F.coalesce(closed, F.lit(False))})
        counts = split.where(~F.col("_late")).groupBy("day", "ad_id").agg(
            F.count(F.lit(1)).alias("sessions"), F.sum("has_active").cast("bigint").alias("actives")
        )
        log.commit(
            counts, fresh.select("_file").distinct(), late=split.where("_late").drop("_late", "_file"),
            seen=fresh.agg(F.max("ts").alias("newest")),
        )

    return write


def late_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Rows that came after their day was closed. ``schema``: that of the stream with ``day``."""
    return day_log(spark, out).read("late", schema)


class ModelHandle:
    """The models of the latest published run, loaded again when a newer one is there."""

    def __init__(self, spark: SparkSession, root: str, load: Callable[[SparkSession, str, str], object]):
        self.spark, self.root, self.load = spark, root, load
        self.run: str | None = None
        self.models: object = None

    def current(self) -> object:
        newest = tables.latest_run(self.spark, self.root)
        if newest != self.run:
            self.models, self.run = self.load(self.spark, self.root, newest), newest
        return self.models


def event_sessions(events: DataFrame) -> DataFrame:
    """Events as sessions: clicks are clicks, purchases are conversions."""
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        (F.lit(100000) + F.col("user_id") % 10).alias("ad_id"),
        (F.col("event_type") == "click").cast("int").alias("has_click"),
        (F.col("event_type") == "purchase").cast("int").alias("has_active"),
        *[c for c in ["_file"] if c in events.columns],
    )


def count_stream(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run the counter job over what is there and give the counters."""
    out = fresh_path(spark, "ad-counts")
    run_available(stream, count_sink(f"{out}/state"), f"{out}/checkpoint")
    return latest_counts(spark, f"{out}/state")


def daily_stream(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run the daily job over what is there and give the counts of every day."""
    out = fresh_path(spark, "daily")
    run_available(stream, daily_sink(f"{out}/state"), f"{out}/checkpoint")
    return day_log(spark, f"{out}/state").current()


def score_stream(spark: SparkSession, stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score what is there and give the scored requests of all batches."""
    out = fresh_path(spark, "scored")
    run_available(stream, score_sink(score, f"{out}/rows"), f"{out}/checkpoint")
    return spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows").drop("batch_id")
