"""Rows of many models packed into slices of bounded size, for passes that repeat.

A slice holds up to about ``ROWS`` rows of one model as flat arrays: a hash, the
number of active columns, the columns, target and weight of each row. Slices are
written once in the order of their models, so a small model lies in one task and
a hot one in many, and every pass of an iterative fit reads them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

ROWS = 4096
SLICES_PER_BATCH = 16
FLAT = ("h", "lens", "cols", "y", "weight")


def slices(rows: DataFrame, keys: list[str], columns: str = "idx") -> DataFrame:
    """(keys, slice, h, lens, cols, y, weight) of a written table of (keys, row_key, columns, y, weight).

    Rows of a slice are ordered by hash, so that equal inputs give equal slices.
    A NULL list of columns is an empty one.
    """
    if keys:
        sized = rows.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
    else:
        sized = rows.withColumn("_n", F.lit(max(rows.count(), 1)))
    dealt = sized.select(
        *keys,
        F.pmod(F.xxhash64(F.col("row_key"), F.lit("slice")), F.ceil(F.col("_n") / ROWS)).alias("slice"),
        F.struct(
            F.xxhash64("row_key").alias("h"), F.coalesce(F.col(columns), F.array().cast("array<int>")).alias("c"),
            F.col("y").cast("double").alias("y"), F.col("weight").cast("double").alias("w"),
        ).alias("r"),
    )
    packed = dealt.groupBy(*keys, "slice").agg(F.sort_array(F.collect_list("r")).alias("r")).select(
        *keys, "slice",
        F.transform("r", lambda r: r["h"]).alias("h"), F.transform("r", lambda r: F.size(r["c"])).alias("lens"),
        F.flatten(F.transform("r", lambda r: r["c"])).alias("cols"), F.transform("r", lambda r: r["y"]).alias("y"),
        F.transform("r", lambda r: r["w"]).alias("weight"),
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(packed.repartitionByRange(tasks, *keys, "slice"), "slices")


def few_at_once(df: DataFrame) -> None:
    """Slices go to Python workers a few at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SLICES_PER_BATCH))


def listed(column: pa.Array | pa.ChunkedArray, k: int) -> np.ndarray:
    """The list in row ``k`` as an array."""
    one = column.slice(k, 1)
    return (one.combine_chunks() if isinstance(one, pa.ChunkedArray) else one).flatten().to_numpy(zero_copy_only=False)


class Slice:
    """Rows of one model in a worker."""

    def __init__(self, *parts: tuple[pa.RecordBatch | pa.Table, int]):
        h, lens, self.cols, self.y, self.weight = (np.concatenate([listed(b.column(n), k) for b, k in parts]) for n in FLAT)
        self.h = h.view(np.uint64)
        self.row = np.repeat(np.arange(len(lens)), lens)

    def __len__(self) -> int:
        return len(self.y)

    def step(self, node: np.ndarray, splits: np.ndarray) -> np.ndarray:
        """The next node of each row: right where the node's column is active; rows at a negative split stay."""
        want = splits[node]
        hit = np.zeros(len(self), bool)
        hit[self.row[self.cols == want[self.row]]] = True
        return np.where(want >= 0, node * 2 + hit, node)

    def walk(self, splits: np.ndarray, depth: int) -> np.ndarray:
        """The node each row is in after ``depth`` steps."""
        node = np.ones(len(self), np.int64)
        for _ in range(depth):
            if not (splits[node] >= 0).any():
                break
            node = self.step(node, splits)
        return node


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit hashes of 64-bit numbers (splitmix64, fixed values)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chosen(x: np.ndarray, share: float, seed: int, round: int) -> np.ndarray:
    """A fixed sample: about ``share`` of the numbers, another one each round."""
    salt = mixed(np.array([seed * 1_000_003 + round], np.uint64))
    return (mixed(x ^ salt) % np.uint64(10_000)).astype(np.int64) < int(share * 10_000)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sum of each value under them."""
    if not len(key):
        return (key, *values)
    low = int(key.min())
    size = int(key.max()) - low + 1
    if size <= 8 * len(key):
        found = np.flatnonzero(np.bincount(key - low, minlength=size))
        return (found + low, *(np.bincount(key - low, v, size)[found] for v in values))
    found, at = np.unique(key, return_inverse=True)
    return (found, *(np.bincount(at, v, len(found)) for v in values))


def repeated(batch: pa.RecordBatch, names: list[str], k: int, n: int) -> list[pa.Array]:
    """Row ``k`` of some columns, ``n`` times."""
    at = pa.array(np.full(n, k))
    return [batch.column(name).take(at) for name in names]


def by_model(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Rows of a batch that belong to one model."""
    for batch in batches:
        rows: dict[tuple, list[int]] = {}
        columns = [batch.column(key).to_pylist() for key in keys]
        for k in range(batch.num_rows):
            rows.setdefault(tuple(c[k] for c in columns), []).append(k)
        for at in rows.values():
            yield batch, at
