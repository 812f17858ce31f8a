"""State, model and snapshot tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AD_NAMES, AD_STATE
from ..session import materialize

# Tables of up to this many rows are written as one file.
ONE_FILE_ROWS = 1_000_000
MANIFEST_NAME = "manifest"
MANIFEST = T.StructType(
    [T.StructField("run_ts", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType()))]
)


def load_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one if nothing is there. Other errors surface."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def save_small(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Write one file when the table is small, else as many as there are partitions."""
    table = materialize(df, "small")
    if table.count() <= ONE_FILE_ROWS:
        table = table.coalesce(1)
    table.write.mode("overwrite").options(**options).format(fmt).save(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return load_table(spark, path, AD_STATE)


def save_state(state: DataFrame, path: str) -> None:
    save_small(state.select([f.name for f in AD_STATE.fields]), path)


def read_ad_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, escape='"', schema=AD_NAMES)


def write_report_csv(report: DataFrame, path: str) -> None:
    save_small(report, path, "csv", header=True, escape='"')


def write_report(report: DataFrame, path: str) -> None:
    save_small(report, path)


class Buckets(NamedTuple):
    """How a table is stored for joins on ``keys``: by their hash in ``number`` buckets, one file each, sorted."""

    keys: Sequence[str]
    number: int


def _table_name(path: str, buckets: Buckets) -> str:
    """A name of the session's catalog for the folder; the folder alone is what lasts."""
    return f"stored_{hashlib.md5(repr((path, buckets)).encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, buckets: Buckets) -> None:
    """Write ``df`` to ``path`` so that joins on its keys need no shuffle of it."""
    # Buckets follow the hash of a shuffle, so each task holds whole buckets.
    dealt = df.repartition(buckets.number, *buckets.keys)
    writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets.number, *buckets.keys).sortBy(*buckets.keys)
    writer.option("path", path).saveAsTable(_table_name(path, buckets))


def read_bucketed(spark: SparkSession, path: str, buckets: Buckets) -> DataFrame:
    """The table at ``path`` with its buckets known to the planner, in any session."""
    name = _table_name(path, buckets)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        keys = ", ".join(f"`{k}`" for k in buckets.keys)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets.number)} BUCKETS LOCATION '{place}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def publish_snapshot(
    tables: dict[str, DataFrame], root: str, run_ts: str, buckets: dict[str, Buckets] | None = None
) -> None:
    """Write each table under its name and the run's timestamp, and last the run's manifest.

    A run never overwrites what another run, or its own reader, is using, and is
    seen only once all of its tables are there. ``buckets`` names the tables
    that are stored for joins.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        path = f"{root}/{name}/run_ts={run_ts}"
        if buckets and name in buckets:
            write_bucketed(df, path, buckets[name])
        else:
            df.write.mode("overwrite").parquet(path)
    manifest = spark.createDataFrame([(run_ts, sorted(tables))], MANIFEST)
    manifest.coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST_NAME}")


def _runs(spark: SparkSession, root: str) -> DataFrame:
    return load_table(spark, f"{root}/{MANIFEST_NAME}", MANIFEST)


def has_run(spark: SparkSession, root: str) -> bool:
    return not _runs(spark, root).isEmpty()


def is_published(spark: SparkSession, root: str, run_ts: str) -> bool:
    return not _runs(spark, root).where(F.col("run_ts") == run_ts).isEmpty()


def table_names(spark: SparkSession, root: str, run_ts: str) -> list[str]:
    """Names of a published run's tables, from its manifest."""
    return _runs(spark, root).where(F.col("run_ts") == run_ts).first()["tables"]


def latest_run(spark: SparkSession, root: str) -> str:
    """The latest run whose manifest is written: one short row per run is read."""
    found = _runs(spark, root).agg(F.max("run_ts")).first()[0]
    if found is None:
        raise ValueError(f"no run is published in {root}")
    return found


def read_snapshot(
    spark: SparkSession, root: str, name: str, run_ts: str | None = None, buckets: Buckets | None = None
) -> DataFrame:
    """A table of one run, or of the latest; ``buckets`` as it was published with."""
    path = f"{root}/{name}/run_ts={run_ts or latest_run(spark, root)}"
    return read_bucketed(spark, path, buckets) if buckets else spark.read.parquet(path)


def model_registry(meta: DataFrame, sizes: DataFrame) -> DataFrame:
    """Model records of all eras with the width of their dictionaries."""
    widths = sizes.groupBy("ad_id").agg(F.sum("size").alias("cols"))
    return meta.join(widths, "ad_id", "left")
