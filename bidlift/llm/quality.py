"""Quality rules whose thresholds come from the corpus: mergeable quantile sketches per language and source.

Every document gives four whole-number measures: symbols per 1000 word
characters, repeated lines per 1000 lines, words in repeated three-word windows
per 1000 words, and characters per 10 words. The first three take their counts
less three standard deviations (three roots of the count), nought at least, so
that a chance symbol or line in a short text is no fault. A sketch counts a
measure's values in buckets of at most 1/32 relative width, so that sketches
merge by adding counts, in any order, and its size depends on the range of
values only. Sketches hold the documents that the base rules pass: under 50
words, or more than half of the words in repeated windows, fails beforehand.

Each (language, source) group is merged with the sketch of its language, scaled
to ``prior`` documents, so that small groups lean on their language without any
switch of rule. A threshold comes from that mixture alone: with its median and
its quantile at the measure's level, a document fails above
quantile + reach * (quantile - median), and for word length also below the
mirror image. Where quantile and median are one, the room is one bucket of the
sketch. A level states which share of a group's documents a measure may find
faulty, not a value of the measure.

Defined results: a NULL text has no words and fails. NULL languages and sources
form the group of the empty string. Repeated rows count each. No rows give no
rows. Other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, materialize, unwrapped, wrapped

SYMBOL = re.compile(r"[#*$%&|<>]")  # fixed value
SPACES = " \t\n\x0b\x0c\r"
LEAST_WORDS, PRIOR, REACH, DEVIATIONS = 50, 20, 3, 3
# Measure: level of its quantile in percent, and whether low values fail too.
MEASURES = {"symbols": (75, False), "dup_lines": (98, False), "repeats": (98, False), "word_length": (98, True)}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
STATS = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def count_text(text: str) -> tuple[int, int, int, int, int, int]:
    """The counts of one text, in the order of ``COUNTS``; n_lines counts lines with a word."""
    words = text.encode().split()  # splits at exactly the six ASCII spaces
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    n, repeated = len(words), 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times, until = Counter(windows), 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    return n, chars, len(SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated, len(lines)


def with_counts(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` and a struct of the counts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(c, pa.int64()) for c in COUNTS])
        for batch in batches:
            at = batch.schema.get_field_index(text)
            rows = [count_text(t or "") for t in batch.column(at).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
            found = pa.StructArray.from_arrays(columns, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])

    arrow_rows(docs.sparkSession, 1000)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(add, f"{fields}, `{name}` {STATS}")


def measures(c: Column) -> dict[str, Column]:
    """Whole-number measures of a struct of counts."""

    def per(scale: int, count: Column, size: str) -> Column:
        return F.floor(F.try_divide(F.lit(scale) * count, F.greatest(c[size], F.lit(1)))).cast("bigint")

    def sure(name: str) -> Column:
        return F.greatest(c[name] - DEVIATIONS * F.sqrt(c[name]), F.lit(0.0))

    return {
        "symbols": per(1000, sure("n_symbols"), "word_chars"),
        "dup_lines": per(1000, sure("n_dup_lines"), "n_lines"),
        "repeats": per(1000, sure("n_repeat_words"), "n_words"),
        "word_length": per(10, c["word_chars"], "n_words"),
    }


def bucket(value: Column) -> Column:
    """The least value of the bucket: all but the five leading bits are cleared."""
    step = width(value)
    return F.floor(value / step).cast("bigint") * step


def width(value: Column) -> Column:
    """The width of the value's bucket, a power of two."""
    return F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 5, F.lit(0))).cast("bigint")


def sketches(counted: DataFrame, counts: str = "counts", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, measure, value, n): the sketch of every group and measure, over the rows that pass the base rules."""
    values = measures(F.col(counts))
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("value")) for k, v in values.items()]))
    return (
        counted.where(~base_failed(F.col(counts)))
        .select(group(lang).alias("lang"), group(source).alias("source"), pairs.alias("m"))
        .groupBy("lang", "source", F.col("m.measure").alias("measure"), F.col("m.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def group(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def thresholds(sketch: DataFrame, prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """(lang, source, and high_ and low_ of each measure) from the written table of sketches.

    The mixture of a group and ``prior`` documents of its language is kept in
    whole numbers: a value weighs n * language total + prior * language count.
    """
    by_lang = sketch.groupBy("lang", "measure", "value").agg(F.sum("n").alias("ln"))
    totals = sketch.groupBy("lang", "measure").agg(F.sum("n").alias("lt"))
    groups = sketch.groupBy("lang", "source", "measure").agg(F.sum("n").alias("gt"))
    spread = groups.join(by_lang, ["lang", "measure"]).join(totals, ["lang", "measure"])
    mixed = spread.join(sketch, ["lang", "source", "measure", "value"], "left").select(
        "lang", "source", "measure", "value",
        (F.coalesce("n", F.lit(0)) * F.col("lt") + prior * F.col("ln")).alias("w"),
        ((F.col("gt") + prior) * F.col("lt")).alias("total"),
    )
    upto = Window.partitionBy("lang", "source", "measure").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    run = mixed.withColumn("cum", F.sum("w").over(upto))
    level = F.create_map(*[F.lit(v) for name, (percent, _) in MEASURES.items() for v in (name, percent)])[F.col("measure")]

    def least(percent: Column) -> Column:
        return F.min(F.when(100 * F.col("cum") >= percent * F.col("total"), F.col("value")))

    quantiles = run.withColumn("level", level).groupBy("lang", "source", "measure").agg(
        least(100 - F.col("level")).alias("low"), least(F.lit(50)).alias("median"), least(F.col("level")).alias("high")
    )
    above = F.col("high") + F.greatest(reach * (F.col("high") - F.col("median")), width(F.col("high")))
    below = F.col("low") - F.greatest(reach * (F.col("median") - F.col("low")), width(F.col("low")))
    out = []
    for name, (_, both) in MEASURES.items():
        out.append(F.max(F.when(F.col("measure") == name, above)).alias(f"high_{name}"))
        if both:
            out.append(F.max(F.when(F.col("measure") == name, below)).alias(f"low_{name}"))
    return quantiles.groupBy("lang", "source").agg(*out)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def judged(counted: DataFrame, limits: DataFrame, counts: str = "counts", lang: str = "lang", source: str = "source") -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``; ``limits`` is the written table of thresholds.

    A group whose documents all fail the base rules has no thresholds and needs none.
    """
    limits = limits.select(*[F.col(c).alias(f"_limit_{c}") for c in limits.columns])
    joined = counted.join(
        limits, (group(lang) == F.col("_limit_lang")) & (group(source) == F.col("_limit_source")), "left"
    )
    failed = base_failed(F.col(counts))
    kept = ~failed
    for name, value in measures(F.col(counts)).items():
        kept = kept & (value <= F.col(f"_limit_high_{name}"))
        if MEASURES[name][1]:
            kept = kept & (value >= F.col(f"_limit_low_{name}"))
    return joined.select(*counted.columns, failed.alias("base_failed"), kept.alias("kept"))


def score_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """A row per document row: doc_id, the counts, base_failed and kept."""
    narrow = docs.select(
        F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source")
    )
    counted = materialize(with_counts(narrow, "counts").drop("text"), "counted")
    limits = materialize(thresholds(materialize(sketches(counted), "sketch")), "limits")
    return judged(counted, limits).select("doc_id", *[f"counts.{c}" for c in COUNTS[:5]], "base_failed", "kept")


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns. The texts are counted twice instead of being stored twice."""
    narrow = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    sketch = materialize(sketches(with_counts(narrow, "counts")), "sketch")
    limits = materialize(thresholds(sketch), "limits")
    inner = wrapped(docs, text=F.col(text), lang=F.col(lang), source=F.col(source))
    return unwrapped(judged(with_counts(inner, "counts"), limits).where("kept"), docs.columns)
