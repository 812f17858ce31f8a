"""Token files: ids in ascending document order, range-coded in independent, checksummed blocks.

A file holds segments, one a row of a Parquet container, so that Spark's own
writers commit it on any store and a lost task is simply run again. A segment
holds whole documents up to about ``SEGMENT`` ids (a longer document has its
own): their ids and lengths, and the ids of all of them in blocks of ``BLOCK``.
Its ``prior`` states how frequent ids are in it (some kilobytes). Every block
starts from a model reset to that and carries its number of ids and the CRC-32
of them, which is checked on reading, so any block can be read alone.
Documents are range-partitioned by id, so segments stand in ascending order.

Defined results: a NULL or empty text is the end id alone. NULL ids come first,
equal ids are ordered by the digest of their text, repeated rows stay repeated.
No rows give an empty file. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .coder import decode_blocks, encode_blocks, make_prior
from .common import arrow_rows, fresh_path, materialize, whole_text
from .tokens import ARROW_ROWS, encoder, groups

END = 1
BLOCK, SEGMENT = 2048, 6_000_000
CLASSES = 193  # high bytes of the vocabulary's ids
FILE = (
    "part int, segment bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "counts array<bigint>, checks array<bigint>, blocks array<binary>, prior binary"
)
INDEX = "part int, segment bigint, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_token_file(docs: DataFrame, path: str, end: int = END, tokenizer: str | None = None, lead: str = "", block: int = BLOCK, segment: int = SEGMENT, classes: int = CLASSES, id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of every document's whole text and the end id to a new folder ``path``."""
    vocabulary = tokenizer or public_tokenizers.path("word_bpe_49k.json")

    def packed(number: int, keys: list, sizes: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.concatenate(ids).astype(np.int64)
        prior = make_prior(whole, classes)
        counts = [min(block, len(whole) - i) for i in range(0, len(whole), block)]
        row = {
            "segment": number, "doc_ids": keys, "n_tokens": sizes, "counts": counts,
            "checks": [_crc(whole[i : i + block]) for i in range(0, len(whole), block)],
            "blocks": encode_blocks(whole, block, classes, prior), "prior": prior,
        }
        kinds = {"segment": pa.int64(), "blocks": pa.list_(pa.binary()), "prior": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kinds.get(k, pa.list_(pa.int64()))) for k, v in row.items()], list(row)
        )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, lead)
        number, held, keys, sizes, ids = 0, 0, [], [], []
        for batch in batches:
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in groups(texts):
                found, lengths = enc.encode(texts[a:b])
                stops = np.cumsum(lengths)
                whole = np.insert(found, stops, np.uint32(end))
                for key, n in zip(names[a:b], lengths.tolist()):
                    keys.append(key)
                    sizes.append(n + 1)
                ids.append(whole)
                held += len(whole)
                if held >= segment:
                    yield packed(number, keys, sizes, ids)
                    number, held, keys, sizes, ids = number + 1, 0, [], [], []
        if keys:
            yield packed(number, keys, sizes, ids)

    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    spread = rows.withColumn("tie", F.xxhash64("text"))
    arrow_rows(docs.sparkSession, ARROW_ROWS)
    ordered = spread.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    coded = ordered.mapInArrow(code, FILE.removeprefix("part int, "))
    coded.select(F.spark_partition_id().alias("part"), "*").write.parquet(path)


def read_token_file(spark: SparkSession, path: str, classes: int = CLASSES, with_ids: bool = False) -> DataFrame:
    """A row per document: its part and segment, place among the segment's ids, id, number of ids, their CRC-32, and the ids if asked for."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = decode_blocks(row["blocks"], row["counts"], classes, row["prior"])
                for k, (ids, check) in enumerate(zip(parts, row["checks"])):
                    if _crc(ids) != check:
                        raise ValueError(f"block {k} of segment {row['segment']} of part {row['part']} is damaged")
                whole = np.concatenate(parts).astype("<u4")
                sizes = np.array(row["n_tokens"], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                n = len(sizes)
                columns = [
                    pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int64()),
                    pa.array(starts), pa.array(row["doc_ids"], pa.int64()), pa.array(sizes),
                    pa.array([zlib.crc32(whole[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()),
                ]
                names = ["part", "segment", "at", "doc_id", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(starts, ends[-1]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(whole.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    arrow_rows(spark, 1)  # a row is a whole segment
    stored = spark.read.schema(FILE).parquet(path)
    return stored.mapInArrow(decode, INDEX + (", ids array<bigint>" if with_ids else ""))


def token_index(spark: SparkSession, path: str, classes: int = CLASSES) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, as read back from the file."""
    index = materialize(read_token_file(spark, path, classes), "index")
    segments = index.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n"))
    parts = segments.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row per written file: as many as the write had tasks.
    part_start = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("p"))
    segment_start = segments.select(
        "part", "segment", F.coalesce(F.sum("n").over(before.partitionBy("part").orderBy("segment")), F.lit(0)).alias("s")
    )
    starts = materialize(segment_start.join(part_start, "part"), "starts")
    return index.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("p") + F.col("s") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame) -> DataFrame:
    """Writes the token file of ``docs`` to the shared folder and reads it back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_token_file(docs, path)
    return token_index(spark, path)
