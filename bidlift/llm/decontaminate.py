"""Benchmark decontamination: test windows as a broadcast hash set, scanned over all training windows.

Words are runs of digits, a-z (A-Z is lower-cased first) and characters from
U+0080 on. Every ``n`` consecutive words of a benchmark item form a window; an
item of fewer words, but not none, is one window. The distinct windows are
written, measured, and broadcast if small; otherwise the same join shuffles.
A first pass looks up blocks of half a window at every block-length-th word,
one of which lies inside any window, and so leaves the texts that can hold one.
These are scanned window by window; that join compares the words themselves,
so it verifies the hit. Texts are told apart by their digest: copies are
scanned once, and no text but a candidate's is shuffled.

Defined results: a NULL or empty text has no words and no hits. An item with a
NULL or empty text has no window. Windows of an item with a NULL ``item_id``
hit words but count as no item. Equal item rows count once by ``item_id``.
Repeated document rows each give a row. A table without rows gives no hits or
no rows. Only ``text`` and the id are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, small, text_key, unwrapped, whole_text, wrapped

# What is not a word character.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same over a text whose A-Z are not yet lower-cased: a word, and what is not.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_ANY_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def grams_of(words: Column, length: int, step: int, made) -> Column:
    """``made(position, words of the gram)`` at every ``step``-th position that has ``length`` words."""
    return F.when(
        F.size(words) >= length,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - length, F.lit(step)),
            lambda i: made(i, F.slice(words, i + 1, F.lit(length))),
        ),
    )


def joined(*arrays: Column, kind: str) -> Column:
    empty = F.array().cast(f"array<{kind}>")
    return F.concat(empty, *[F.coalesce(a, empty) for a in arrays])


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (gram, len, item) of the items' windows."""
    words = benchmark.select(F.col(item).alias("item_id"), words_of(whole_text(text)).alias("words"))
    words = words.where(F.size("words") > 0).withColumn("m", F.least(F.size("words"), F.lit(n)))
    gram = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.size("words") - F.col("m")),
            lambda i: F.array_join(F.slice(F.col("words"), i + 1, F.col("m")), " "),
        )
    )
    return words.select("item_id", F.col("m").alias("len"), gram.alias("gram")).distinct()


def seed_length(length: int) -> int:
    """A window of ``length`` words holds a whole block of this many words that starts at one of its multiples."""
    return (length + 1) // 2


def benchmark_seeds(windows: DataFrame) -> DataFrame:
    """Distinct hashes of all blocks that windows hold."""
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())  # at most n values
    words = windows.select("len", F.split("gram", " ").alias("words"))
    made = [
        F.when(F.col("len") == m, grams_of(F.col("words"), seed_length(m), 1, lambda _, g: F.xxhash64(g))) for m in lengths
    ]
    return words.select(F.explode(joined(*made, kind="bigint")).alias("seed")).distinct()


def seeded(docs: DataFrame, windows: DataFrame, seeds: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The short columns ``keep``, text_key, n_words, first, hit: one first row per document, and a hit row per block met.

    Only every fifth block of five words is looked up for windows of ten, since
    one of them lies inside any window.
    """
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())
    words = docs.select(*keep, text_key(whole_text(text)).alias("text_key"), words_of(whole_text(text)).alias("words"))
    made = [
        grams_of(F.col("words"), s, s, lambda _, g: F.xxhash64(g)) for s in sorted({seed_length(m) for m in lengths})
    ]
    flat = words.select(
        *keep, "text_key", F.size("words").cast("bigint").alias("n_words"),
        F.posexplode_outer(joined(*made, kind="bigint")).alias("k", "seed"),
    )
    known = seeds.withColumn("hit", F.lit(True))
    if small(seeds):
        known = F.broadcast(known)
    met = flat.join(known, "seed", "left")
    first = F.coalesce(F.col("k"), F.lit(0)) == 0
    hit = F.coalesce("hit", F.lit(False))
    return met.where(first | hit).select(*keep, "text_key", "n_words", first.alias("first"), hit.alias("hit"))


def scan(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """text_key, hits (pos, len of each window that occurs, by position), grams (their ids) of the texts with any.

    ``texts`` (text_key, text) has no repeats, nor has the written table
    ``windows`` (gram, gram_id, len).
    """
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())
    words = texts.select("text_key", words_of(F.col("text")).alias("words"))
    made = [
        grams_of(
            F.col("words"), m, 1,
            lambda i, g, m=m: F.struct(i.alias("pos"), F.lit(m).alias("len"), F.array_join(g, " ").alias("gram")),
        )
        for m in lengths
    ]
    flat = words.select("text_key", F.explode(joined(*made, kind="struct<pos:int,len:int,gram:string>")).alias("w"))
    known = windows.select("gram", "gram_id")
    if small(windows, "gram"):
        known = F.broadcast(known)
    met = flat.select("text_key", F.struct("w.pos", "w.len").alias("hit"), F.col("w.gram").alias("gram")).join(known, "gram")
    return met.groupBy("text_key").agg(
        F.array_sort(F.collect_list("hit")).alias("hits"), F.collect_set("gram_id").alias("grams")
    )


def covered(hits: str = "hits") -> Column:
    """Number of words inside the union of the hits, which are sorted by position."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))

    def step(acc, h):
        end = h["pos"] + h["len"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["sum"] + F.greatest(F.lit(0), end - F.greatest(h["pos"], acc["end"]))).alias("sum"),
        )

    return F.aggregate(hits, start, step, lambda acc: acc["sum"]).cast("bigint")


def search(docs: DataFrame, benchmark: DataFrame, n: int, keep: list[str], text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: keep, text_key, n_words), (found: text_key, hits, grams), (pairs: gram_id, item_id), all written tables."""
    pairs = materialize(benchmark_windows(benchmark, n).withColumn("gram_id", F.xxhash64("gram")), "windows")
    # The id only leads from a gram to its items; the gram itself decides a hit.
    grams = materialize(pairs.select("gram", "len", "gram_id").distinct(), "grams")
    seeds = materialize(benchmark_seeds(grams), "seeds")
    looked = materialize(seeded(docs, grams, seeds, keep, text), "seeded")
    hit = materialize(looked.where("hit").select("text_key").distinct(), "candidates")
    texts = docs.select(text_key(whole_text(text)).alias("text_key"), whole_text(text).alias("text"))
    # Always by a shuffle: the number of candidates grows with the documents.
    texts = texts.join(hit.hint("merge"), "text_key", "left_semi").dropDuplicates(["text_key"])
    found = materialize(scan(texts, grams), "found")
    return looked.where("first").drop("first", "hit"), found, pairs


def judged(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, items (sorted ids as strings), contaminated, hits."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    rows, found, pairs = search(docs, benchmark, n, ["doc_id"])
    items = (
        found.select("text_key", F.explode("grams").alias("gram_id"))
        .join(pairs.where(F.col("item_id").isNotNull()).select("gram_id", "item_id"), "gram_id")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    verdicts = materialize(
        found.join(items, "text_key", "left").select("text_key", covered().alias("n_hit"), "items", "hits"), "verdicts"
    )
    return rows.join(verdicts, "text_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"), "hits",
    )


def without_spans(text: Column, words: Column, hits: Column) -> Column:
    """The text without the words inside hits; what stands between words stays."""
    pieces = F.split(text, ANY_WORD)
    inside = F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1)))
    return F.array_join(
        F.transform(
            pieces,
            lambda p, i: F.concat(
                p, F.when((i < F.size(words)) & ~F.array_contains(inside, i), F.get(words, i)).otherwise("")
            ),
        ),
        "",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, action: str = "drop", text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents (``drop``) or without the words that hits cover (``spans``).

    The verdict depends on the text alone, so it is joined by the text's
    digest: repeated rows and NULL ids need no care. All columns stay.
    """
    if action not in ("drop", "spans"):
        raise ValueError(f"unknown action {action!r}")
    _, found, _ = search(docs, benchmark, n, [], text)
    keyed = wrapped(docs, text_key=text_key(whole_text(text)))
    if action == "drop":
        return unwrapped(keyed.join(found, "text_key", "left_anti"), docs.columns)
    joined = keyed.join(found.select("text_key", "hits"), "text_key", "left")
    whole = whole_text(F.col("row")[text])
    words = F.array_remove(F.split(whole, NOT_ANY_WORD), "")
    cleaned = F.when(F.col("hits").isNull(), F.col("row")[text]).otherwise(without_spans(whole, words, F.col("hits")))
    return unwrapped(joined, docs.columns, **{text: cleaned})
