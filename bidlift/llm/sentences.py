"""Substring deduplication by sliding sentence spans.

A text is cut into sentences at line ends and after ``.``, ``!`` or ``?``
before white space. The shortest runs of at least two sentences and ``words``
words (a sentence of twice as many words is a run by itself) that start and
that end at every sentence are hashed, white space squeezed. Together they
cover each longer run: where the rest of a run from one of its sentences is too
short, the shortest run that ends with it holds that sentence. Runs are joined
globally by their 128-bit hash: the first by (id, digest of the text, position)
stays, and every sentence that another covers is removed, copies within one
document included.

Defined results: a NULL text has no sentence and stays NULL. Rows of equal id
and text are one document and get the same result each. NULL ids come first.
Texts without a repeated run stay as they are, byte for byte; in others the
kept sentences stay as they stand with the white space after them. No rows give
no rows. Other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from struct import unpack

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, whole_text, wrapped

SENTENCE = re.compile(r"\S.*?(?:(?<=[.!?])(?=\s)|(?=\n)|\Z)\s*", re.S)
LEAST_SENTENCES, LEAST_WORDS = 2, 20
HOT, SALTS = 1000, 64
LOW = (1 << 32) - 1


def sentences(text: str) -> list[str]:
    """The sentences with the white space after them. White space at the text's start belongs to none."""
    return SENTENCE.findall(text)


def runs(found: list[str], least: int, words: int) -> Iterator[tuple[int, int]]:
    """(first, last) of the run from every sentence that has one."""
    sizes = [len(s.split()) for s in found]
    last, held = -1, 0
    for i in range(len(found)):
        while last + 1 < len(found) and not _enough(last - i + 1, held, least, words):
            last += 1
            held += sizes[last]
        if _enough(last - i + 1, held, least, words):
            # Without its last sentence a run is too short, or else that sentence is the second.
            yield i, last
        held -= sizes[i]


def covering(found: list[str], least: int, words: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest runs that start and that end at each sentence, each once."""
    end = len(found) - 1
    ending = {(end - b, end - a) for a, b in runs(found[::-1], least, words)}
    return sorted(ending.union(runs(found, least, words)))


def _enough(count: int, held: int, least: int, words: int) -> bool:
    return held >= words and (count >= least or held >= 2 * words)


def spans(docs: DataFrame, least: int = LEAST_SENTENCES, words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, key, run, high, low) of every run of ``docs`` (doc_id, key, text).

    All runs are shuffled, so a record is five numbers:
    ``run`` holds the first sentence above the last, ``high`` and ``low`` the hash.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            out: list[list] = [[], [], [], [], []]
            for id, key, text in zip(ids, keys, batch.column("text").to_pylist()):
                found = sentences(text or "")
                plain = [" ".join(s.split()) for s in found]
                for a, b in covering(found, least, words):
                    high, low = unpack(">qq", xxhash.xxh3_128_digest("\n".join(plain[a : b + 1])))
                    for column, value in zip(out, (id, key, a << 32 | b, high, low)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], ["doc_id", "key", "run", "high", "low"])

    return docs.mapInArrow(make, "doc_id bigint, key bigint, run bigint, high bigint, low bigint")


def removals(found: DataFrame) -> DataFrame:
    """(doc_id, key, cut): for each document that loses sentences, the runs that are not the first of their kind.

    Runs that hold a thousandth of all repeated places or more are at most a
    thousand; these few are broadcast, and their places are spread over many
    tasks before they meet the run's first place.
    """
    place = F.struct("doc_id", "key", "run")
    repeated = materialize(
        found.groupBy("high", "low")
        .agg(F.min(place).alias("earliest"), F.max(place).alias("latest"), F.count(F.lit(1)).alias("n"))
        .where("earliest <> latest")
        .select("high", "low", "earliest", "n"),
        "repeated",
    )
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.col("n") * HOT >= F.lit(total)
    known = F.broadcast(repeated.where(hot).select("high", "low", F.lit(True).alias("hot")))
    dealt = found.join(known, ["high", "low"], "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "key", "run"), F.lit(SALTS)).cast("int")).otherwise(0)
    )
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    firsts = repeated.select("high", "low", "earliest", F.explode(salts).alias("salt"))
    # Always by a shuffle: the number of repeated runs grows with the documents.
    later = dealt.join(firsts.hint("merge"), ["high", "low", "salt"]).where(place != F.col("earliest"))
    return later.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("run")).alias("cut"))


def dedup_sentences(docs: DataFrame, least: int = LEAST_SENTENCES, words: int = LEAST_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_dedup`` (text, n_sentences, n_removed, removed_words); all columns stay."""
    key = F.xxhash64(whole_text(text))
    arrow_rows(docs.sparkSession, 1000)
    narrow = docs.select(F.col(id).cast("bigint").alias("doc_id"), key.alias("key"), F.col(text).alias("text"))
    cut = removals(spans(narrow, least, words))
    cut = materialize(cut, "cut").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("cut").alias("_cut"))
    rows = wrapped(docs, i=F.col(id).cast("bigint"), text=F.col(text), k=key)
    joined = rows.join(cut.hint("merge"), F.col("i").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_key")), "left")
    joined = joined.select("row", "text", "_cut")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("removed_words", pa.int64())])
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column("_cut").to_pylist()):
                found = sentences(text or "")
                gone = {k for c in cuts or () for k in range(c >> 32, (c & LOW) + 1)}
                kept = "".join(s for k, s in enumerate(found) if k not in gone) if gone else text
                out.append({
                    "text": kept, "n_sentences": len(found), "n_removed": len(gone),
                    "removed_words": sum(len(found[k].split()) for k in gone),
                })
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, kind)], ["row", "_dedup"])

    schema = f"row {joined.schema['row'].dataType.simpleString()}, _dedup struct<text:string,n_sentences:bigint,n_removed:bigint,removed_words:bigint>"
    return joined.mapInArrow(apply, schema).select("row.*", "_dedup")


def deduped(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed_words, changed, and the text that is left."""
    found = dedup_sentences(docs.select("doc_id", "text"), **options)
    return found.select(
        "doc_id", "_dedup.n_sentences", "_dedup.n_removed", "_dedup.removed_words",
        (F.col("_dedup.n_removed") > 0).alias("changed"), F.col("_dedup.text").alias("text"),
    )
