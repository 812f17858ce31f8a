"""Best-fit packing by patterns: few-document length patterns fitted to the length histogram.

A document is its ids and an end id; one of more than ``width`` ids is cut from
its end into pieces of ``width``, so that only its first piece may be shorter.
The histogram of piece lengths has at most ``width`` rows, whatever the data.
All patterns of one to three lengths that fill a sequence are enumerated, the
number of times each is used is fitted to the histogram by non-negative least
squares (coordinate descent from nought, pairs before triples, which leaves
few patterns in use, until no count moves by a thousandth of the largest),
rounded down, and bounded by what is there. What remains is packed best-fit
decreasing, also on the histogram. Triples can take short pieces that long ones
need later, so the plan is made with patterns of up to three, two, one and no
lengths, and the one with the fewest sequences holds. The result is a table of
runs: ranks [a, b) among the pieces of one length lie at one offset in
consecutive sequences. Pieces are ranked within their length by a two-step
count, so a length that a third of all pieces share is spread over many tasks.

Defined results: a NULL or empty text is the end id alone. Repeated rows and
NULL ids are packed like any other. No rows give no sequence. Only the id and
the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, ranked
from .tokens import ARROW_ROWS, encoder, groups

WIDTH = 1024
END = 2
SWEEPS = 100  # a guard: the descent ends by itself
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, spread bigint"


def cut_lengths(total: int, width: int) -> list[int]:
    first = total % width or min(total, width)
    return [first] + [width] * ((total - first) // width)


def pieces(docs: DataFrame, width: int = WIDTH, end: int = END, tokenizer: str | None = None, lead: str = " ", with_ids: bool = False, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, and with ``with_ids`` the ids themselves."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, turn = encoder(path, lead), 0
        for batch in batches:
            texts, keys = [t or "" for t in batch.column("text").to_pylist()], batch.column("doc_id").to_pylist()
            for a, b in groups(texts):
                ids, sizes = enc.encode(texts[a:b])
                rows: list[list] = [[] for _ in range(7)]
                at = 0
                for key, n in zip(keys[a:b], sizes.tolist()):
                    whole = np.append(ids[at : at + n], np.uint32(end)).astype("<u4")
                    at, start = at + n, 0
                    for k, size in enumerate(cut_lengths(n + 1, width)):
                        part = whole[start : start + size]
                        turn += 1
                        for out, v in zip(rows, (key, k, start, size, zlib.crc32(part.tobytes()), turn, part if with_ids else None)):
                            out.append(v)
                        start += size
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "spread"]
                arrays = [pa.array(v, k) for v, k in zip(rows, kinds)]
                if with_ids:
                    names, arrays = [*names, "ids"], [*arrays, pa.array(rows[6], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    narrow = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(cut, PIECES + (", ids array<bigint>" if with_ids else ""))


def patterns(lengths: list[int], width: int) -> list[tuple[int, ...]]:
    """Every one, two or three lengths, in falling order, that fill a sequence; fewest lengths first."""
    there = set(lengths)
    singles = [(width,)] if width in there else []
    pairs = [(a, width - a) for a in sorted(there, reverse=True) if a >= width - a > 0 and width - a in there]
    triples = [
        (a, b, width - a - b)
        for a in sorted(there, reverse=True)
        for b in sorted((x for x in there if x <= a and (width - a) / 2 <= x < width - a), reverse=True)
        if width - a - b in there
    ]
    return singles + pairs + triples


def fit(shapes: list[tuple[int, ...]], count: dict[int, int], width: int) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared difference between the pattern lengths used and the histogram."""
    rest = [0.0] * (width + 1)
    for n, c in count.items():
        rest[n] = float(c)
    x = [0.0] * len(shapes)
    weights = [[(n, s.count(n)) for n in dict.fromkeys(s)] for s in shapes]
    norms = [float(sum(k * k for _, k in w)) for w in weights]
    still = max(0.25, max(count.values(), default=0) / 1000)
    for _ in range(SWEEPS):
        moved = 0.0
        for j, w in enumerate(weights):
            step = sum(k * rest[n] for n, k in w) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, k in w:
                    rest[n] -= k * step
        if moved <= still:
            break
    return np.array(x)


Runs = list[tuple[int, int, int, int, int]]


def plan(count: dict[int, int], width: int = WIDTH) -> tuple[Runs, int]:
    """Runs (length, first rank, number, first sequence, offset) for a histogram, and the number of sequences.

    The work depends on the number of different lengths, not on the counts.
    """
    return min((plan_with(count, width, most) for most in (3, 2, 1, 0)), key=lambda p: p[1])


def plan_with(count: dict[int, int], width: int, most: int) -> tuple[Runs, int]:
    """The plan with patterns of up to ``most`` lengths."""
    left, taken = dict(count), {n: 0 for n in count}
    runs: Runs = []
    sequences = 0

    def take(length: int, number: int, sequence: int, offset: int) -> None:
        runs.append((length, taken[length], number, sequence, offset))
        taken[length] += number
        left[length] -= number

    shapes = [s for s in patterns([n for n in count if count[n]], width) if len(s) <= most]
    x = fit(shapes, count, width)
    for j in np.argsort(-x, kind="stable").tolist():
        there = min(left[n] // shapes[j].count(n) for n in shapes[j])
        number = min(int(x[j] + 1e-9), there)
        if number <= 0:
            continue
        offset = 0
        for n in shapes[j]:
            take(n, number, sequences, offset)
            offset += n
        sequences += number
    # Residuals, longest first, into the least room that holds them: room -> [(first sequence, number)].
    rooms: dict[int, list[tuple[int, int]]] = {}
    for n in sorted(left, reverse=True):
        while left[n]:
            room = min((r for r in rooms if r >= n), default=None)
            if room is None:
                number = left[n]
                # No open sequence holds it: open enough, each with as many of this length as fit.
                per = min(width // n, number)
                full, sequence = number // per, sequences
                for k in range(per):
                    take(n, full, sequence, k * n)
                sequences += full
                rooms.setdefault(width - per * n, []).append((sequence, full))
                continue
            sequence, have = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
            number = min(have, left[n])
            take(n, number, sequence, width - room)
            if number < have:
                rooms.setdefault(room, []).append((sequence + number, have - number))
            rooms.setdefault(room - n, []).append((sequence, number))
    return runs, sequences


def pack(cut: DataFrame, width: int = WIDTH) -> DataFrame:
    """Adds sequence_id and offset to the written table ``cut`` of pieces."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``width`` rows
    runs, _ = plan(histogram, width)
    runs.sort()
    starts = np.array([n * (1 << 50) + a for n, a, _, _, _ in runs], np.int64)
    table = np.array([(a, s, o) for _, a, _, s, o in runs], np.int64).reshape(-1, 3)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "spread"), F.lit(buckets))
    numbered = ranked(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32"), F.col("spread")], spread, "rank", buckets)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = table[np.searchsorted(starts, length * (1 << 50) + rank, "right") - 1] if len(starts) else table[:0]
            held = batch.drop_columns(["rank"])
            sequence, offset = run[:, 1] + rank - run[:, 0], run[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array(sequence), pa.array(offset)], names=[*held.schema.names, "sequence_id", "offset"]
            )

    kept = numbered.drop("spread")
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.drop("rank").dtypes) + ", sequence_id bigint, offset bigint"
    return kept.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, width: int = WIDTH, end: int = END, tokenizer: str | None = None, lead: str = " ", with_ids: bool = False, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    arrow_rows(docs.sparkSession, ARROW_ROWS)
    return pack(materialize(pieces(docs, width, end, tokenizer, lead, with_ids, id, text), "pieces"), width)
