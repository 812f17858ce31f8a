"""Looking facts up in a key-unique table, whatever its size and whatever the skew."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# At most this many rows of a lookup table are ever broadcast. Rows hold a few
# numbers and at most one short string, so this is some hundred megabytes.
BROADCAST_ROWS = 1_000_000
SHORT_TEXT = 128
# A key is frequent among sampled facts if it holds one of so many of them, so at most this many are.
FREQUENT = 1000


def direct(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table that can be counted cheaply, to be broadcast if it has at most ``max_rows`` rows."""
    return F.broadcast(table) if table.count() <= max_rows else table


@dataclass(frozen=True)
class Summary:
    """What decides the way of a lookup: rows of the table, total popularity, and whether all texts are short."""

    rows: int
    total: float | None
    short: bool


def _short(table: DataFrame) -> Column:
    # Keys decide the way of a row; other texts are broadcast along and count as well.
    out = F.lit(True)
    for f in table.schema.fields:
        if f.dataType.simpleString() == "string":
            out = out & (F.coalesce(F.octet_length(f.name), F.lit(0)) <= SHORT_TEXT)
    return out


def summarize(table: DataFrame, popularity: str) -> Summary:
    """One scan of the table. Stored beside a published table, it spares every later lookup that scan."""
    found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(popularity).alias("total"), F.bool_and(_short(table)).alias("short")).first()
    return Summary(found["n"], None if found["total"] is None else float(found["total"]), found["short"] is not False)


def frequent_keys(sample: DataFrame, keys: list[str], most: int = FREQUENT) -> DataFrame:
    """Keys that hold at least 1/``most`` of the sampled facts: a written table of at most ``most`` rows."""
    counted = materialize(sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "sampled")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    return materialize(counted.where(F.col("_n") * most >= total).select(*keys), "frequent")


def lookup_left(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    popularity: str,
    max_rows: int = BROADCAST_ROWS,
    summary: Summary | None = None,
    frequent: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """``facts`` left join ``table``. Both should be written tables, as they are read more than once.

    A table of at most ``max_rows`` rows is broadcast. A larger one is split by
    ``popularity``, the number of training rows or weight behind each key: keys
    holding at least 1/``max_rows`` of the total are at most ``max_rows`` in
    number, so these are broadcast, which takes the frequent keys out of the
    shuffle, and only facts with rare or unknown keys are joined by shuffling.

    A table stored in buckets by ``keys`` is not shuffled then, but neither does
    adaptive execution split the facts dealt to a bucket. ``frequent`` gives
    the few keys that are frequent among the facts, known to the table or not
    (see ``frequent_keys``); their facts leave the shuffle too. It is called
    only if the table is too large to be broadcast, and decides nothing but the way.
    """
    short = _short(table)
    summary = summary or summarize(table, popularity)
    lean = table.drop(popularity)
    if summary.rows <= max_rows and summary.short:
        return facts.join(F.broadcast(lean), keys, "left")
    # A NULL popularity is none: such keys stay in the shuffled half.
    hot = short & F.coalesce(F.col(popularity) * max_rows >= F.lit(summary.total), F.lit(False))
    hot_rows = table.where(hot).drop(popularity)
    cold = table.where(~hot).drop(popularity)
    if frequent is not None:
        often = frequent()
        some = materialize(hot_rows.unionByName(cold.join(F.broadcast(often), keys, "left_semi")), "direct")
        unknown = often.join(some, keys, "left_anti")
        hot_rows = some.unionByName(unknown, allowMissingColumns=True)
    hot_keys = F.broadcast(hot_rows)
    found = facts.join(hot_keys, keys, "inner")
    rest = facts.join(hot_keys.select(*keys), keys, "left_anti").join(cold, keys, "left")
    return found.unionByName(rest.select(found.columns))
