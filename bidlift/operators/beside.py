"""Rows beside the table entries of their model, in numpy: for steps that look up many entries a row.

A table of few rows goes to every task whole, and rows stay where they are.
Else rows and table are dealt to parts by model, once each. A model of many
rows is dealt to several parts, each of which gets all entries of that model.
No row is exploded in either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .lookup import BROADCAST_ROWS

PART_ROWS = 50_000  # of one model that are in a part, about
PART_ENTRIES = 1_000_000  # of all models that are in a part, about

Prepare = Callable[[pa.Table], Any]
Run = Callable[[pa.Table, Any], pa.Table]


def _whole(rows: DataFrame, table: DataFrame, prepare: Prepare, run: Run, schema: T.StructType) -> DataFrame:
    sink = pa.BufferOutputStream()
    found = table.toArrow()
    with pa.ipc.new_stream(sink, found.schema) as out:
        out.write_table(found)
    sent = rows.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = None
        for batch in batches:
            if batch.num_rows:
                if ready is None:
                    ready = prepare(pa.ipc.open_stream(sent.value).read_all())
                yield from run(pa.Table.from_batches([batch]), ready).to_batches()

    return rows.mapInArrow(each, schema)


def _in_parts(rows: DataFrame, table: DataFrame, entries: int, key: str, prepare: Prepare, run: Run, schema: T.StructType, part_rows: int) -> DataFrame:
    spark = rows.sparkSession
    counted = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "models")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    # At most total / part_rows of these.
    large = F.broadcast(materialize(counted.where(F.col("_n") > part_rows).select(key, F.ceil(F.col("_n") / part_rows).alias("_copies")), "large"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_rows), -(-entries // PART_ENTRIES))
    part = F.pmod(F.xxhash64(key, "_copy"), F.lit(parts)).cast("int").alias("_part")
    turn = F.monotonically_increasing_id()
    # Rows without a model meet no entry, wherever they are.
    copy = F.when(F.col(key).isNull(), turn).otherwise(F.coalesce(turn % F.col("_copies"), F.lit(0).cast("bigint")))
    left = rows.join(large, key, "left").withColumn("_copy", copy).select(*rows.columns, part)
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_copies", F.lit(1).cast("bigint")) - 1)
    right = table.join(large, key, "left").withColumn("_copy", F.explode(copies)).select(*table.columns, part)

    def each(rows: pa.Table, entries: pa.Table) -> pa.Table:
        return run(rows, prepare(entries))

    return left.groupBy("_part").cogroup(right.groupBy("_part")).applyInArrow(each, schema)


def beside(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    prepare: Prepare,
    run: Run,
    schema: T.StructType,
    entries: int,
    max_rows: int = BROADCAST_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``run`` on pieces of ``rows`` with the prepared entries of all their models, at least; a table of ``schema``.

    ``rows`` and ``table`` share the column ``key`` and should be written;
    ``entries`` is the number of the table's rows.
    """
    if entries <= max_rows:
        return _whole(rows, table, prepare, run, schema)
    return _in_parts(rows, table, entries, key, prepare, run, schema, part_rows)
