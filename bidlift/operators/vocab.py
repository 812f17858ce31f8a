"""Tokens, vocabularies and row encoding, for all ads at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import active_weight, field_name
from ..functions.derive import feature_arrays
from ..schemas import FEATURE_FIELDS, FIELD_POS, FIRST_MULTI_POS, MULTI_FIELDS, SINGLE_FIELDS
from .beside import beside
from .lookup import BROADCAST_ROWS, Summary, lookup_left, summarize
from ..session import materialize

# Fixed value: the vocabulary of a model.
VOCABULARY = 20_000
_SPREAD = 64
_PREFIX = 3  # hex digits: 4,096 buckets per field


def tokenize(rows: DataFrame, keep: list[str], marker: bool = False) -> DataFrame:
    """One row per (row, field position, value). NULL values and NULL arrays vanish.

    ``marker`` adds one token per row that no vocabulary holds (position -1), so
    that rows without any feature are not lost in later joins.
    """
    entries = feature_arrays()
    if marker:
        entry = F.struct(F.lit(-1).alias("pos"), F.array(F.lit("")).alias("values"))
        entries = F.concat(entries, F.array(entry))
    return (
        rows.select(*keep, F.explode(entries).alias("f"))
        .select(*keep, F.col("f.pos").alias("field_pos"), F.explode("f.values").alias("value"))
        .where(F.col("value").isNotNull())
    )


def token_weights(rows: DataFrame, key: str | None = "ad_id", weight: Column | None = None) -> DataFrame:
    """Weight of every token, per ad. Summed before the shuffle; no row is replicated."""
    w = active_weight() if weight is None else weight
    keys = [key] if key else []
    return (
        tokenize(rows.withColumn("w", w), [*keys, "w"])
        .groupBy(*keys, "field_pos", "value")
        .agg(F.sum("w").alias("weight"))
    )


def token_distinct(rows: DataFrame) -> DataFrame:
    """Distinct tokens over all rows, without weights or cut."""
    return tokenize(rows, []).distinct()


def top_tokens(weights: DataFrame, k: int) -> DataFrame:
    """The ``k`` heaviest tokens of every ad, with their rank.

    Two steps keep a hot ad out of a single task: the best ``k`` of each of 64
    hash slices, then the best ``k`` of these. Both limits also run before the
    shuffle, per partition.
    """
    order = [F.desc("weight"), F.asc("field_pos"), F.asc("value")]
    sliced = weights.withColumn("_s", F.pmod(F.xxhash64("field_pos", "value"), F.lit(_SPREAD)))
    part = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("ad_id", "_s").orderBy(*order)))
    best = part.where(F.col("rank") <= k).drop("_s", "rank")
    final = best.withColumn("rank", F.row_number().over(Window.partitionBy("ad_id").orderBy(*order)))
    return final.where(F.col("rank") <= k)


def cutoff_weight(top: DataFrame) -> DataFrame:
    """Weight at the cut, and how many tokens an ad kept."""
    return top.groupBy("ad_id").agg(F.min("weight").alias("cutoff"), F.count(F.lit(1)).alias("kept"))


def feature_dict(top: DataFrame) -> DataFrame:
    """Number the kept tokens of each ad: fields in order, within a field heaviest first.

    ``local_idx`` counts from 1 in single-valued and from 0 in multi-valued
    fields, ``global_idx`` from 0 over the ad. Empty values of multi-valued
    fields are dropped after the cut. An ad has at most the cut's number of rows.
    """
    kept = top.where((F.col("field_pos") < FIRST_MULTI_POS) | (F.col("value") != ""))
    in_field = Window.partitionBy("ad_id", "field_pos").orderBy(F.desc("weight"), "value")
    in_ad = Window.partitionBy("ad_id").orderBy("field_pos", F.desc("weight"), "value")
    start = F.when(F.col("field_pos") < FIRST_MULTI_POS, 1).otherwise(0)
    return kept.select(
        "ad_id",
        "field_pos",
        field_name(F.col("field_pos")).alias("field"),
        "value",
        "weight",
        (F.row_number().over(in_ad) - 1).cast("bigint").alias("global_idx"),
        (F.row_number().over(in_field) - 1 + start).cast("bigint").alias("local_idx"),
    )


def global_dict(tokens: DataFrame) -> DataFrame:
    """Dense numbers for an uncut vocabulary shared by all ads.

    Numbering runs inside (field, hash prefix) buckets and adds the running
    count of earlier buckets, so no task sees the whole vocabulary.
    """
    kept = tokens.where((F.col("field_pos") < FIRST_MULTI_POS) | (F.col("value") != ""))
    kept = kept.withColumn("_b", F.substring(F.md5("value"), 1, _PREFIX))
    kept = materialize(kept, "tokens")
    sizes = kept.groupBy("field_pos", "_b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("field_pos", "_b").rowsBetween(Window.unboundedPreceding, -1)
    # At most fields x 4,096 rows go through this one window.
    starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    in_bucket = Window.partitionBy("field_pos", "_b").orderBy("value")
    return (
        kept.withColumn("_r", F.row_number().over(in_bucket))
        .join(starts, ["field_pos", "_b"])
        .select(
            "field_pos",
            field_name(F.col("field_pos")).alias("field"),
            "value",
            (F.col("start") + F.col("_r") - 1).alias("global_idx"),
        )
    )


def field_sizes(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("ad_id", "field_pos", "field").agg(F.count(F.lit(1)).alias("size"))


def field_offsets(sizes: DataFrame) -> DataFrame:
    """First index of each field: the sizes of the fields before it. At most 42 rows per ad."""
    before = (
        Window.partitionBy("ad_id").orderBy("field_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))


def encode_rows(
    rows: DataFrame,
    dictionary: DataFrame,
    row_keys: list[str],
    model: str | None = "ad_id",
    cross_exclude: tuple[str, ...] = (),
    max_rows: int = BROADCAST_ROWS,
    summary: Summary | None = None,
) -> DataFrame:
    """Active indices of every row, sorted and without repeats, as ``idx``.

    ``row_keys`` are the columns to carry along, each row on its own even if all
    of them are equal in two rows: a row is told by its place in the table.
    ``model`` names the column that picks the dictionary, None for a global
    one. Unknown values are dropped, a row without known values keeps an empty
    array. With ``cross_exclude``, ``cross_idx`` holds the indices without those
    fields. Both inputs should be written tables. Rows are not exploded: a
    dictionary of at most ``max_rows`` rows meets them where they are, a larger
    one in parts by model (see ``beside``).
    """
    lookup = dictionary
    if "weight" not in lookup.columns:
        lookup = lookup.withColumn("weight", F.lit(1))
    keys = ["field_pos", "value"]
    if model:
        lookup = lookup.withColumnRenamed("ad_id", model)
        keys = [model, *keys]
    lookup = lookup.select(*keys, "weight", "global_idx")
    carried = [c for c in row_keys if c != model] + ([model] if model else [])
    summary = summary or summarize(lookup, "weight")
    if model or summary.rows <= max_rows:
        return _encode_beside(rows, lookup, carried, model, cross_exclude, max_rows, summary.rows)
    # A global vocabulary too large to be sent whole has no models to deal rows by. Tokens carry
    # the row's number only; the other columns join back once per row.
    numbered = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    tokens = tokenize(numbered, ["_row"], marker=True)
    found = lookup_left(tokens, lookup, keys, "weight", max_rows, summary)
    index = F.col("global_idx").cast("int")
    out = [F.array_sort(F.collect_set(index)).alias("idx")]
    if cross_exclude:
        excluded = [FIELD_POS[f] for f in cross_exclude]
        out.append(
            F.array_sort(F.collect_set(F.when(~F.col("field_pos").isin(excluded), index))).alias("cross_idx")
        )
    indices = found.groupBy("_row").agg(*out)
    return numbered.select("_row", *carried).join(indices, "_row").drop("_row")


class _Vocabulary:
    """Entries (_model, field_pos, value, global_idx) by field, for lookups of whole columns."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.models = pc.unique(table["_model"])
        rank = pc.index_in(table["_model"], value_set=self.models).to_numpy()
        pos, idx = table["field_pos"].to_numpy(), table["global_idx"].to_numpy()
        self.fields = {}
        for p in np.unique(pos):
            mine = np.flatnonzero(pos == p)
            own = table["value"].take(pa.array(mine))
            values = pc.unique(own)
            code = rank[mine].astype(np.int64) * len(values) + pc.index_in(own, value_set=values).to_numpy()
            order = np.argsort(code, kind="stable")
            self.fields[int(p)] = values, code[order], idx[mine][order].astype(np.int64)

    def ranks(self, models: pa.ChunkedArray) -> np.ndarray:
        return _places(models, self.models)

    def found(self, pos: int, rank: np.ndarray, texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``texts``, index) of every entry; ``rank`` is that of the text's model, -1 without one."""
        if pos not in self.fields or not len(texts):
            return (np.zeros(0, np.int64),) * 2
        values, codes, idx = self.fields[pos]
        value = _places(texts, values)
        at = np.flatnonzero((value >= 0) & (rank >= 0))
        code = rank[at] * len(values) + value[at]
        first, last = np.searchsorted(codes, code), np.searchsorted(codes, code, "right")
        n = last - first
        entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(at, n), idx[entry]


def _places(column: pa.ChunkedArray, values: pa.Array) -> np.ndarray:
    """The place of each in ``values``, -1 for NULL and what is not there."""
    return pc.fill_null(pc.index_in(column, value_set=values), -1).to_numpy().astype(np.int64)


def _listed(n: int, row: np.ndarray, idx: np.ndarray) -> pa.Array:
    """Of each of ``n`` rows its indices, sorted and without repeats."""
    both = np.unique((row << 32) + idx + (1 << 31))
    ends = np.cumsum(np.bincount(both >> 32, minlength=n))
    values = (both & ((1 << 32) - 1)) - (1 << 31)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values, pa.int32()))


def _encode_beside(
    rows: DataFrame, lookup: DataFrame, carried: list[str], model: str | None, cross_exclude: tuple[str, ...], max_rows: int, entries: int
) -> DataFrame:
    key = F.col(model).cast(lookup.schema[model].dataType) if model else F.lit(0)
    known = lookup.select(
        (F.col(model) if model else F.lit(0)).alias("_model"), F.col("field_pos").cast("int").alias("field_pos"), "value", F.col("global_idx").cast("int").alias("global_idx")
    ).dropna()
    fields = [F.col(f).cast("string").alias(f"_f{pos}") for pos, f in enumerate(SINGLE_FIELDS)]
    fields += [F.col(f).cast("array<string>").alias(f"_f{FIRST_MULTI_POS + pos}") for pos, f in enumerate(MULTI_FIELDS)]
    asked = rows.select(*carried, key.alias("_model"), *fields)
    excluded = {FIELD_POS[f] for f in cross_exclude}

    def encode(batch: pa.Table, known: _Vocabulary) -> pa.Table:
        batch = batch.combine_chunks()
        rank = known.ranks(batch["_model"])
        at, idx, crossed = [], [], []
        for pos in range(len(FEATURE_FIELDS)):
            column = batch[f"_f{pos}"]
            if column.null_count == len(column):
                continue
            if pos < FIRST_MULTI_POS:
                row, found = known.found(pos, rank, column)
            else:
                parent = pc.list_parent_indices(column).to_numpy().astype(np.int64)
                place, found = known.found(pos, rank[parent], pc.list_flatten(column))
                row = parent[place]
            at.append(row)
            idx.append(found)
            crossed.append(np.full(len(row), pos not in excluded))
        row, found, keep = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((at, np.int64), (idx, np.int64), (crossed, bool)))
        out = batch.select(carried).append_column("idx", _listed(len(batch), row, found))
        return out.append_column("cross_idx", _listed(len(batch), row[keep], found[keep])) if cross_exclude else out

    listed = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ["idx", *(["cross_idx"] if cross_exclude else [])]]
    schema = T.StructType([*(rows.schema[c] for c in carried), *listed])
    return beside(asked, known, "_model", _Vocabulary, encode, schema, entries, max_rows)


def decode_features(encoded: DataFrame, dictionary: DataFrame, keep: list[str]) -> DataFrame:
    """Indices back to (field, value)."""
    exploded = encoded.select(*keep, "ad_id", F.explode("idx").alias("global_idx"))
    names = dictionary.select("ad_id", F.col("global_idx").cast("int").alias("global_idx"), "field", "value", "weight")
    return lookup_left(exploded, names, ["ad_id", "global_idx"], "weight")
