"""Line deduplication: repeated lines stay in the first document that holds them.

A line's key is the line without white space at its ends and with A-Z in lower
case. Every line whose key is long enough becomes a record (128-bit hash,
document, position). Records are range-partitioned by hash, document and
position and sorted alike, so that a task streams whole runs of equal hashes
in the order of documents: the first document of a run keeps its lines, the
later ones lose theirs. Since the ranges also cut by document, a line that a
third of all documents share is spread over many tasks; a task does not know
whether its first run began in an earlier one, so it sends that run's rows on
with a mark, and every task reports where its last run began. These reports,
one row a task, decide the marked rows.

What comes out is one compressed bitmap a document, not text: bit i says
whether line i stays. ``apply_bitmaps`` turns bitmaps and documents into texts.

Defined results: a NULL or empty text is one empty line and stays; a NULL
``doc_id`` comes before all others and all such rows are one document; rows
that share a ``doc_id`` are one document, and never lose lines to each other;
a line repeated within its document alone stays; an empty table gives an empty
one; further columns are ignored by ``line_bitmaps`` and kept by
``dedup_lines``. Keys are compared by 128 bits of hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, ascii_lower, materialize, unwrapped, whole_text

BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS = 10
NO_ID = -(1 << 63)
RECORDS_PER_BATCH = 65536
TEXTS_PER_BATCH = 512

RECORD = "high bigint, low bigint, doc bigint, part bigint, line int"
STREAMED = "kind int, high bigint, low bigint, doc bigint, part bigint, line int, first bigint"
DROP, OPEN, LAST = 0, 1, 2  # a line to drop; a line of a task's first run; where a task's last run began


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _doc_columns(text: Column, doc_id: Column) -> dict[str, Column]:
    """What names a row: its document, and its text among rows of one ``doc_id``."""
    return {"doc": F.coalesce(doc_id.cast("bigint"), F.lit(NO_ID)), "part": F.xxhash64(text)}


def line_records(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(high, low, doc, part, line) of every line whose key has ``least`` code points or more."""
    text = whole_text()
    lines = docs.select(
        *[v.alias(k) for k, v in _doc_columns(text, F.col("doc_id")).items()],
        F.posexplode(F.split(text, "\n", -1)).alias("line", "_text"),
    )
    key = F.col("_key")
    return (
        lines.select("doc", "part", "line", line_key(F.col("_text")).alias("_key"))
        .where(F.char_length("_key") >= least)
        .select(F.xxhash64(key).alias("high"), F.xxhash64(F.lit("line"), key).alias("low"), "doc", "part", "line")
    )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to drop from records sorted by (high, low, doc, line), with one run carried between batches."""
    names = [f.split()[0] for f in STREAMED.split(", ")]

    def out(kind, columns, first):
        n = len(columns[0])
        kinds = np.full(n, kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (kinds, *columns, first)], names)

    run = opening = None  # (high, low, first document) of the current run; (high, low) of the task's first
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        high, low, doc = columns[:3]
        starts = np.empty(len(high), bool)
        starts[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        starts[0] = run is None or (int(high[0]), int(low[0])) != run[:2]
        at = np.maximum.accumulate(np.where(starts, np.arange(len(high)), -1))
        first = np.where(at >= 0, doc[np.maximum(at, 0)], 0 if run is None else run[2])
        if opening is None:
            opening = (high[0], low[0])
        open_run = (high == opening[0]) & (low == opening[1])
        drop = (doc > first) & ~open_run
        if open_run.any():
            yield out(OPEN, [c[open_run] for c in columns], first[open_run])
        if drop.any():
            yield out(DROP, [c[drop] for c in columns], first[drop])
        run = (int(high[-1]), int(low[-1]), int(first[-1]))
    if run is not None:
        last = [np.array([v], t) for v, t in zip((*run, 0, 0), (np.int64, np.int64, np.int64, np.int64, np.int32))]
        yield out(LAST, last, np.array([run[2]], np.int64))


def dropped_lines(records: DataFrame) -> DataFrame:
    """(doc, part, line) of the lines to drop: those whose key a smaller document holds."""
    arrow_rows(records.sparkSession, RECORDS_PER_BATCH)
    order = ["high", "low", "doc", "line"]
    ranged = records.repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = materialize(ranged.mapInArrow(_stream, STREAMED), "lines")
    # One report a task: a bounded table.
    reports = streamed.where(F.col("kind") == LAST).groupBy("high", "low").agg(F.min("first").alias("began"))
    opened = streamed.where(F.col("kind") == OPEN).join(F.broadcast(reports), ["high", "low"], "left")
    late = opened.where(F.col("doc") > F.least("first", F.coalesce("began", "first")))
    cut = ["doc", "part", "line"]
    return streamed.where(F.col("kind") == DROP).select(*cut).unionByName(late.select(*cut))


def pack_bits(dropped: np.ndarray) -> bytes:
    """Compressed bitmap of the lines that stay, whole bytes through the last dropped line; lines beyond it stay."""
    kept = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
    kept[dropped] = False
    return zlib.compress(np.packbits(kept).tobytes(), 6)


def unpack_bits(bitmap: bytes, n: int) -> np.ndarray:
    """Whether each of a text's ``n`` lines stays."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n].astype(bool)
    return np.concatenate([bits, np.ones(n - len(bits), bool)])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bitmaps = [pack_bits(lines.values.to_numpy(zero_copy_only=False)) for lines in batch.column("lines")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("part"), batch.column("n_dropped"), pa.array(bitmaps, pa.binary())],
            ["doc", "part", "n_dropped", "bitmap"],
        )


def line_bitmaps(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(doc, part, n_dropped, bitmap) of the documents that lose lines.

    The bitmap ends with the last dropped line; all lines after it stay. Only
    the positions of one document's dropped lines meet in a group.
    """
    dropped = dropped_lines(line_records(docs, least)).distinct()
    lines = dropped.groupBy("doc", "part").agg(F.collect_list("line").alias("lines"), F.count(F.lit(1)).alias("n_dropped"))
    packed = lines.select("doc", "part", "n_dropped", "lines").mapInArrow(_pack, "doc bigint, part bigint, n_dropped bigint, bitmap binary")
    return materialize(packed, "bitmaps")


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, bitmap in zip(batch.column("text").to_pylist(), batch.column("bitmap").to_pylist()):
            if bitmap is not None:
                lines = text.split("\n")
                text = "\n".join([line for line, stays in zip(lines, unpack_bits(bitmap, len(lines))) if stays])
            texts.append(text)
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, text, absent, n_lines, n_dropped): each row of ``docs`` with its kept text.

    ``row`` holds the other columns, ``absent`` tells a NULL text, which is
    taken as empty. Texts move once, to meet their bitmaps.
    """
    arrow_rows(docs.sparkSession, TEXTS_PER_BATCH)
    text = whole_text()
    n_lines = (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(
        others.alias("row"), text.alias("text"), F.col("text").isNull().alias("absent"), n_lines.alias("n_lines"),
        *[v.alias(k) for k, v in _doc_columns(text, F.col("doc_id")).items()],
    )
    joined = rows.join(bitmaps, ["doc", "part"], "left").select(
        "row", "text", "absent", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), "bitmap"
    )
    return joined.mapInArrow(_keep, joined.schema).drop("bitmap")


def dedup_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``; a NULL text stays NULL."""
    found = apply_bitmaps(docs, line_bitmaps(docs, least))
    return unwrapped(found, docs.columns, text=F.when(~F.col("absent"), F.col("text")))


def deduped(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    slim = docs.select("doc_id", "text")
    found = apply_bitmaps(slim, line_bitmaps(slim, least))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
