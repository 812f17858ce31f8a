"""Text forms: id lists, JSON maps, part files and sparse rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_ids(ads: DataFrame, path: str) -> None:
    """One id per line; an empty list gives an empty folder."""
    ads.select(F.col("ad_id").cast("string").alias("value")).write.mode("overwrite").text(path)


def json_objects(df: DataFrame, key: str, value: str, objects: int = 1) -> DataFrame:
    """(key, value) rows as so many JSON objects; an empty map gives ``{}``.

    One object, as a reader of one object expects, is made in one task; give
    more for a large map. ``read_json_map`` reads any number of them as one map.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))))
    made = df.groupBy(F.pmod(F.xxhash64(key), F.lit(objects)).cast("bigint").alias("_p")).agg(
        F.to_json(F.map_from_entries(entries)).alias("value")
    )
    numbers = df.sparkSession.range(objects).withColumnRenamed("id", "_p")
    return numbers.join(made, "_p", "left").select(F.coalesce("value", F.lit("{}")).alias("value"))


def write_json_map(df: DataFrame, key: str, value: str, path: str, objects: int = 1) -> None:
    json_objects(df, key, value, objects).write.mode("overwrite").text(path)


def read_json_map(spark: SparkSession, path: str, value_type: str = "bigint") -> DataFrame:
    """(id, value) rows of JSON objects in text; the text keys become numbers."""
    parsed = spark.read.text(path).select(F.from_json("value", f"map<string,{value_type}>").alias("m"))
    return parsed.select(F.explode("m").alias("id", "value")).withColumn("id", F.col("id").cast("bigint"))


def read_text_parts(spark: SparkSession, path: str, prefix: str = "part", contains: str = "") -> DataFrame:
    """Trimmed lines of all part files below ``path``."""
    glob = f"{prefix}*{contains}*" if contains else f"{prefix}*"
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter=glob)
    return lines.select(F.trim("value").alias("line"))


def write_libsvm(encoded: DataFrame, path: str, label: str = "has_active", idx: str = "idx") -> None:
    """Rows of ones as libsvm text: the label, then 1-based ``index:1`` pairs.

    Built as text columns, so rows stay in the JVM.
    """
    pairs = F.transform(idx, lambda i: F.concat((i + 1).cast("string"), F.lit(":1")))
    line = F.concat_ws(" ", F.coalesce(F.col(label), F.lit(0)).cast("string"), F.array_join(pairs, " "))
    encoded.select(F.trim(line).alias("value")).write.mode("overwrite").text(path)


def read_libsvm(spark: SparkSession, paths: list[str] | str, width: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", width).load(paths)
