"""Phrase collocations by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z) and cut into pieces and words with numpy on the
bytes of a whole batch: one prefix polynomial over the bytes gives the hash of
every word, a second over these gives the fingerprint of every run of up to
four words, all modulo 2^64 with odd bases, whose powers have inverses there.

* Counting goes by length. The fingerprints of a length are counted per task,
  shuffled and summed; those found often enough set bits of a table of fixed
  size. A longer run can be frequent only if both runs one word shorter are, so
  the next length's fingerprints outside that table stay at home. The table
  lets too much through where it is crowded, never too little.
* Collisions are checked against the text. A last pass takes every occurrence
  of a frequent fingerprint; per batch each is compared, word by word, with the
  occurrence its fingerprint points to, and those that differ are counted as
  phrases of their own. Only these phrases become text, and are summed as text
  with the smallest document that holds them. Counts are therefore exact.

Everything is per ``lang`` (NULL: ``und``). Defined results: a NULL or empty
text has no words; a NULL ``doc_id`` counts like any other; repeated rows count
again; an empty table gives no rows; further columns are ignored. Phrases tie
by score, count and UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, materialize, whole_text

LONGEST = 4  # words
LEAST = 30  # occurrences of a candidate
TOP = 2000
COVERED = 80  # percent of its occurrences in one longer candidate at which a phrase goes
FILTER_BITS = 26
CHUNK_BYTES = 4 << 20  # whole texts are taken together up to so many bytes
HELD = 1 << 22  # fingerprints a task counts together
TEXTS_PER_BATCH = 1024
SLICES = 64

# Two odd bases, and the mixing constants of splitmix64 (fixed values).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

COUNTED = "fp bigint, n bigint"
FOUND = "lang string, words int, phrase string, n bigint, doc bigint"


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


class Polynomial:
    """Hashes of all spans of a sequence from one prefix sum of value * base^position, modulo 2^64."""

    def __init__(self, base: int):
        self.base = base
        self.powers = self.inverse = np.ones(1, np.uint64)

    def spans(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(values):
            size = 1 << int(len(values)).bit_length()
            steps = np.full(size, self.base, np.uint64)
            steps[0] = 1
            self.powers = np.cumprod(steps)
            steps[1:] = pow(self.base, -1, 1 << 64)
            self.inverse = np.cumprod(steps)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=prefix[1:])
        return (prefix[end] - prefix[start]) * self.inverse[start]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form and kind (0 word, 1 blank, 2 end of a piece) of each byte."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09]] = 1
    kind[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
    return lower, kind


class Words:
    """The words of some consecutive whole texts: bytes, piece and text of each."""

    LOWER, KIND = _tables()

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = self.LOWER[data]
        kind = self.KIND[data]
        first = np.zeros(len(data), bool)
        first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        inside = kind == 0
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | first[1:]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:]
        self.inside = inside
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.piece = np.cumsum((kind == 2) | first)[self.start]
        self.text = np.searchsorted(offsets, self.start, "right") - 1

    def __len__(self) -> int:
        return len(self.start)

    def runs(self, n: int) -> np.ndarray:
        """Whether ``n`` words of one piece begin at each word."""
        good = np.zeros(len(self), bool)
        if len(self) >= n:
            good[: len(self) - n + 1] = self.piece[n - 1 :] == self.piece[: len(self) - n + 1]
        return good

    def dictionary(self) -> pa.DictionaryArray:
        """The words as text, equal ones under one index."""
        offsets = np.zeros(len(self) + 1, np.int32)
        np.cumsum(self.end - self.start, out=offsets[1:])
        text = pa.Array.from_buffers(
            pa.string(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[self.inside])]
        )
        return text.dictionary_encode()


class Fingerprints:
    """Fingerprints of the runs of words of a chunk, seeded by language and length."""

    def __init__(self):
        self.bytes, self.words = Polynomial(BYTE_BASE), Polynomial(WORD_BASE)

    def begin(self, words: Words, seeds: np.ndarray) -> None:
        self.hashes = mixed(self.bytes.spans(words.data.astype(np.uint64) + np.uint64(1), words.start, words.end))
        self.seeds = seeds[words.text]

    def of(self, n: int) -> np.ndarray:
        """Of the ``n`` words from each word on; the last n - 1 have none and get 0."""
        fps = np.zeros(len(self.hashes), np.uint64)
        size = len(self.hashes) - n + 1
        if size > 0:
            at = np.arange(size)
            fps[:size] = mixed(self.words.spans(self.hashes, at, at + n) ^ self.seeds[:size] ^ np.uint64(n))
        return fps


def _member(bits: np.ndarray, fps: np.ndarray) -> np.ndarray:
    slot = fps & np.uint64(len(bits) * 64 - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """Whole texts of at most ``size`` bytes together (a longer one alone), their words and language seeds."""
    import zlib

    for batch in batches:
        text = batch.column("text")
        if not batch.num_rows:
            continue
        wide = pa.types.is_large_string(text.type)
        buffers = text.buffers()
        offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        langs = batch.column("lang").dictionary_encode()
        codes = [zlib.crc32(x.encode()) * 0x100000001 + len(x) for x in langs.dictionary.to_pylist()]
        seeds = mixed(np.array(codes, np.uint64) << np.uint64(3))[langs.indices.to_numpy()]
        row = 0
        while row < len(text):
            last = max(int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1, row + 1)
            part = offsets[row : last + 1]
            words = Words(data[part[0] : part[-1]], part - part[0])
            if len(words):
                yield batch.slice(row, last - row), words, seeds[row:last]
            row = last


def _counter(n: int, before):
    """Counts of the fingerprints of ``n`` words; ``before``: the bits of those one word shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if before is None else np.frombuffer(before.value, np.uint64)
        prints, held, size = Fingerprints(), [], 0

        def counted():
            fps, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.array(count.astype(np.int64))], ["fp", "n"])

        for _, words, seeds in _chunks(batches, CHUNK_BYTES):
            prints.begin(words, seeds)
            good = words.runs(n)
            if bits is not None:
                known = _member(bits, prints.of(n - 1))
                good[:-1] &= known[:-1] & known[1:]
            held.append(prints.of(n)[good])
            size += len(held[-1])
            if size >= HELD:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    return run


def _finder(tables: list):
    """Phrases of the frequent fingerprints, each occurrence compared with the one its fingerprint points to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [np.frombuffer(t.value, np.uint64) for t in tables]
        prints = Fingerprints()
        for batch, words, seeds in _chunks(batches, CHUNK_BYTES):
            prints.begin(words, seeds)
            langs = batch.column("lang").dictionary_encode()
            lang_of = langs.indices.to_numpy()[words.text]
            doc_of = batch.column("doc").to_numpy()[words.text]
            words_as = words.dictionary()
            word_of = words_as.indices.to_numpy()

            def rows(n: int, at: np.ndarray, count: np.ndarray, doc: np.ndarray):
                texts = [words_as.dictionary.take(pa.array(word_of[at + k])) for k in range(n)]
                phrase = pc.binary_join_element_wise(*texts, " ") if n > 1 else texts[0]
                return pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(lang_of[at])), pa.array(np.full(len(at), n, np.int32)), phrase,
                        pa.array(count.astype(np.int64)), pa.array(doc),
                    ],
                    ["lang", "words", "phrase", "n", "doc"],
                )

            per_lang = np.bincount(lang_of, minlength=len(langs.dictionary))
            size = len(per_lang)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary, pa.array(np.zeros(size, np.int32)), pa.array([""] * size, pa.string()),
                    pa.array(per_lang.astype(np.int64)), pa.array([None] * size, pa.int64()),
                ],
                ["lang", "words", "phrase", "n", "doc"],
            )
            good = None
            for n, bits in enumerate(filters, 1):
                fps = prints.of(n)
                frequent = words.runs(n) & _member(bits, fps)
                if good is not None:
                    frequent[:-1] &= good[:-1] & good[1:]
                good = frequent
                at = np.flatnonzero(frequent)
                if not len(at):
                    break
                _, first, group, count = np.unique(fps[at], return_index=True, return_inverse=True, return_counts=True)
                pointed = at[first][group]
                differs = lang_of[at] != lang_of[pointed]
                for k in range(n):
                    differs |= word_of[at + k] != word_of[pointed + k]
                doc = np.full(len(first), np.iinfo(np.int64).max)
                same = ~differs
                np.minimum.at(doc, group[same], doc_of[at[same]])
                yield rows(n, at[first], count - np.bincount(group[differs], minlength=len(first)), doc)
                if differs.any():  # another phrase under the same fingerprint
                    own = at[differs]
                    yield rows(n, own, np.ones(len(own)), doc_of[own])

    return run


def _filter_bits(fps: DataFrame, size: int) -> bytes:
    """A table of 2^size bits, those of the given fingerprints set. Its bound does not depend on the data."""
    slot = F.col("fp").bitwiseAND(F.lit((1 << size) - 1))
    cells = fps.groupBy(F.shiftright(slot, 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(fp & 63 AS int))")).alias("bits")
    )
    table = cells.toArrow()
    bits = np.zeros(1 << (size - 6), np.int64)
    bits[table.column("cell").to_numpy()] = table.column("bits").to_numpy()
    return bits.tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f, first_doc) of all phrases found ``least`` times or more, and (lang, n) of all words."""
    spark = docs.sparkSession
    arrow_rows(spark, TEXTS_PER_BATCH)
    texts = docs.select(
        whole_text().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("doc"),
    )
    tables = []
    for n in range(1, longest + 1):
        found = texts.select("text", "lang").mapInArrow(_counter(n, tables[-1] if tables else None), COUNTED)
        frequent = materialize(found.groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("fp"), "fingerprints")
        tables.append(spark.sparkContext.broadcast(_filter_bits(frequent, filter_bits)))
    found = texts.mapInArrow(_finder(tables), FOUND)
    counted = materialize(
        found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"), F.min("doc").alias("first_doc"))
        .where((F.col("f") >= least) | (F.col("words") == 0)),
        "phrases",
    )
    first = F.nullif("first_doc", F.lit((1 << 63) - 1))
    phrases = counted.where(F.col("words") > 0).withColumn("first_doc", first)
    return phrases, counted.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))


def _wide(name: str):
    return F.col(name).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, longest: int = LONGEST, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, first_doc): the ``top`` phrases of each language."""
    phrases, totals = phrase_counts(docs, least, longest, filter_bits)
    candidates = phrases.where(F.col("words") >= 2).withColumn("w", F.split("phrase", " ", -1))
    # Parts of a candidate are at least as frequent, so all are in ``phrases``.
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = candidates.select(
        "lang", "phrase", "words", F.col("f").alias("a"), "first_doc", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select("lang", "phrase", "a", "first_doc", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr("(cast(2000000 AS decimal(7,0)) * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "first_doc")).alias("b")
    ).select("lang", "phrase", "b.*")
    # The phrases inside a longer candidate, with that one's count.
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1), lambda start: F.array_join(F.slice("w", start, size), " ")
            ),
        )
    )
    longer = (
        candidates.where(F.col("words") > 2)
        .select("lang", "f", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * covered)
    )
    # Cut per slice first, so that no task orders all phrases of a large language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    first = F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = sliced.withColumn("rank", first).where(F.col("rank") <= top).withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc"
    )
