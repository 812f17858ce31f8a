"""A commit log of counter versions for streaming sinks.

Every micro-batch becomes one version: its partial counts, the source files
they come from, and further tables of the sink. Tables are written first, the
version's entry in the manifest last, and a version is seen only through its
entry; one that was broken off is written over by the next. Files that a
version holds are left out of later batches, so a batch that is retried, or a
whole stream that starts again without its checkpoint, counts every file once.
Now and then the running sums are written as one table, which later readers
start from. One writer at a time is assumed, as a stream's sink is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import tables

FILES = T.StructType([T.StructField("_file", T.StringType())])
COMPACT_AFTER = 16


class CommitLog:
    """``keys`` and ``values`` (name: type) describe the counters; values are summed."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str], values: dict[str, str], compact_after: int = COMPACT_AFTER):
        self.spark, self.root, self.compact_after = spark, root, compact_after
        self.keys, self.values = list(keys), list(values)
        self.schema = T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in {**keys, **values}.items()))

    def _manifest(self) -> DataFrame:
        return tables.load_table(self.spark, f"{self.root}/{tables.MANIFEST_NAME}", tables.MANIFEST)

    def latest(self, name: str | None = None) -> str | None:
        """The latest version, or the latest that holds table ``name``."""
        entries = self._manifest()
        if name:
            entries = entries.where(F.array_contains("tables", name))
        return entries.agg(F.max("run_ts")).first()[0]

    def read(self, name: str, schema: T.StructType, after: str | None = None) -> DataFrame:
        """Table ``name`` of all committed versions after ``after``."""
        entries = self._manifest().where(F.array_contains("tables", name)).select("run_ts")
        if after is not None:
            entries = entries.where(F.col("run_ts") > after)
        versioned = T.StructType([*schema.fields, T.StructField("run_ts", T.StringType())])
        parts = tables.load_table(self.spark, f"{self.root}/{name}", versioned)
        return parts.join(entries.distinct(), "run_ts", "left_semi").drop("run_ts")

    def current(self) -> DataFrame:
        """The counters: the latest sums and the partial counts after them."""
        base = self.latest("sums")
        parts = self.read("counts", self.schema, base)
        if base is not None:
            parts = tables.read_snapshot(self.spark, self.root, "sums", base).unionByName(parts)
        return parts.groupBy(*self.keys).agg(*[F.sum(v).cast(self.schema[v].dataType).alias(v) for v in self.values])

    def fresh(self, batch: DataFrame) -> DataFrame:
        """Rows of files that no version holds. The batch names its files in ``_file``."""
        return batch.join(self.read("files", FILES), "_file", "left_anti")

    def commit(self, counts: DataFrame, files: DataFrame, **more: DataFrame) -> None:
        version = int(self.latest() or 0) + 1
        tables.publish_snapshot({"counts": counts, "files": files, **more}, self.root, f"{version:012d}")
        if version % self.compact_after == 0:
            self.compact()

    def compact(self) -> None:
        """Write the sums of all versions as one more version."""
        sums = self.current()
        tables.publish_snapshot({"sums": sums}, self.root, f"{int(self.latest() or 0) + 1:012d}")
