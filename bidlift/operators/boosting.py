"""Boosted trees on rows of active indices, for any number of models in one run.

Features are 0/1, so a split of a node is "index i is active". Rows lie in
slices (see ``slices``). A level is one job: a pass over the slices walks each
row to its node and sums gradients per (model, node, index), Spark adds these
up and picks the best split of every node. Between trees only the margins move,
and these are written anew after every ``FLUSH`` trees; until then a pass adds
the newest trees itself. The loop runs over trees and levels, never over models,
rows or features. Split gain and leaf weights follow the published second-order
boosting formulas (Chen and Guestrin, 2016).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import slices as S

FLUSH = 5
LEAST_GAIN = 1e-6
# A model of at most so many slices is grown whole by one task; larger ones level
# by level over all tasks. Both follow the same sums and samples.
WHOLE = 16
TOTAL = -1  # stands for the index of a node's totals


@dataclass(frozen=True)
class BoostParams:
    """The settings of the conversion model; the price model uses 100 trees and squared loss."""

    trees: int = 10
    depth: int = 5
    rate: float = 0.08
    row_share: float = 0.9
    column_share: float = 0.5
    l2: float = 1.0
    min_child_weight: float = 1.0
    base: float = 0.0
    loss: str = "logistic"
    seed: int = 0


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _step(node: Column, split: Column, idx: str) -> Column:
    """Where a row goes from ``node``: it stays at a leaf, else turns right if the split's index is active."""
    child = node * 2 + F.array_contains(idx, split).cast("int")
    return F.when(split < 0, node).otherwise(child)


def _walk(splits: Column, depth: int, idx: str = "idx") -> Column:
    """The node a row ends in. ``splits``: index per node, -1 at a leaf; node 1 is the root.

    Built as an expression of ``depth`` steps over a literal sequence, so each
    step is evaluated once.
    """
    levels = F.sequence(F.lit(1), F.lit(depth))
    return F.aggregate(levels, F.lit(1), lambda node, _: _step(node, F.get(splits, node), idx))


def _as_array(nodes: DataFrame, keys: list[str], value: str, size: int, default: Column) -> Column:
    entries = F.map_from_entries(F.collect_list(F.struct("node", value)))
    positions = F.sequence(F.lit(0), F.lit(size - 1))
    return F.transform(positions, lambda n: F.coalesce(F.try_element_at(entries, n), default))


def _splits(nodes: DataFrame, keys: list[str], size: int) -> DataFrame:
    """One row per model: the split index by node. At most 2^depth nodes go into a group."""
    return nodes.where(F.col("split") >= 0).groupBy(*keys).agg(
        _as_array(nodes, keys, "split", size, F.lit(-1)).alias("splits")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _children(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Gradient sums of the two children of every split node."""
    left = F.struct(
        (F.col("node") * 2).alias("node"),
        (F.col("gs") - F.col("gr")).alias("gs"),
        (F.col("hs") - F.col("hr")).alias("hs"),
    )
    right = F.struct((F.col("node") * 2 + 1).alias("node"), F.col("gr").alias("gs"), F.col("hr").alias("hs"))
    return (
        nodes.where("split >= 0")
        .select(*keys, F.explode(F.array(left, right)).alias("c"))
        .select(*keys, "c.node", "c.gs", "c.hs")
    )


# Trees in a worker: the current one's splits by node, and (splits, values) of those not yet in the margins.
Trees = tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]


def _gradients(s: S.Slice, margin: np.ndarray, p: BoostParams) -> tuple[np.ndarray, np.ndarray]:
    if p.loss == "logistic":
        prob = 1 / (1 + np.exp(-margin))
        return s.weight * (prob - s.y), s.weight * prob * (1 - prob)
    return s.weight * (margin - s.y), s.weight


def _margins(s: S.Slice, start: np.ndarray, newer: list[tuple[np.ndarray, np.ndarray]], p: BoostParams) -> np.ndarray:
    for splits, values in newer:
        start = start + values[s.walk(splits, p.depth)]
    return start


class _Sampled:
    """Gradients of a slice and the entries that a tree may look at: sampled rows and sampled columns."""

    def __init__(self, s: S.Slice, margin: np.ndarray, tree: int, p: BoostParams):
        self.s = s
        self.g, self.h = _gradients(s, margin, p)
        self.kept = S.chosen(s.h, p.row_share, p.seed, tree)
        live = self.kept[s.row] & S.chosen(s.cols.astype(np.uint64), p.column_share, ~p.seed & 0xFFFF, tree)
        self.row, self.cols = s.row[live], s.cols[live]

    def totals(self) -> tuple[float, float]:
        return float(self.g[self.kept].sum()), float(self.h[self.kept].sum())

    def cells(self, node: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient sums by (node, index) of a level, node-major."""
        at = node[self.row] - (1 << level)
        open_ = at >= 0
        row = self.row[open_]
        return S.summed((at[open_] << 32) + self.cols[open_], self.g[row], self.h[row])


def _histogram(keys: list[str], level: int, tree: int, p: BoostParams, trees_of: Callable[[pa.RecordBatch, int], Trees]):
    """(keys, node, i, gr, hr): gradient sums of a level's nodes per index; at the root also their totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in S.by_model(batches, keys):
            splits, newer = trees_of(batch, rows[0])
            parts = []
            for k in rows:
                s = S.Slice((batch, k))
                sampled = _Sampled(s, _margins(s, S.listed(batch.column("margin"), k), newer, p), tree, p)
                parts.append(sampled.cells(s.walk(splits, level), level))
                if level == 0:
                    g, h = sampled.totals()
                    parts.append((np.full(1, TOTAL), np.array([g]), np.array([h])))
            cell, gr, hr = S.summed(*(np.concatenate(c) for c in zip(*parts)))
            if len(cell):
                total = cell == TOTAL
                node = np.where(total, 1, (cell >> 32) + (1 << level)).astype(np.int32)
                index = np.where(total, TOTAL, cell & 0xFFFFFFFF).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*S.repeated(batch, keys, rows[0], len(cell)), pa.array(node), pa.array(index), pa.array(gr), pa.array(hr)],
                    [*keys, "node", "i", "gr", "hr"],
                )

    return run


def _tree_of(s: S.Slice, margin: np.ndarray, tree: int, p: BoostParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree of a model whose rows are all here: splits and values by node, and the rows' nodes."""
    size = 2 ** (p.depth + 1)
    splits, gs, hs = np.full(size, -1), np.full(size, np.nan), np.full(size, np.nan)
    sampled = _Sampled(s, margin, tree, p)
    gs[1], hs[1] = sampled.totals()
    node = np.ones(len(s), np.int64)
    for level in range(p.depth):
        cell, gr, hr = sampled.cells(node, level)
        at = (cell >> 32) + (1 << level) if len(cell) else cell
        gl, hl = gs[at] - gr, hs[at] - hr
        gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - gs[at] * gs[at] / (hs[at] + p.l2)
        gain[(hl < p.min_child_weight) | (hr < p.min_child_weight)] = -np.inf
        for n in np.unique(at):
            low, high = np.searchsorted(at, [n, n + 1])
            best = low + int(np.argmax(gain[low:high]))
            if gain[best] > LEAST_GAIN:
                splits[n] = cell[best] & 0xFFFFFFFF
                gs[2 * n : 2 * n + 2] = gl[best], gr[best]
                hs[2 * n : 2 * n + 2] = hl[best], hr[best]
        if not (splits[1 << level :] >= 0).any():
            break
        node = s.step(node, splits)
    return splits, -p.rate * gs / (hs + p.l2), node


def _forest(keys: list[str], p: BoostParams):
    """All trees of a model from its few slices."""

    def run(table: pa.Table) -> pa.Table:
        s = S.Slice(*((table, k) for k in range(table.num_rows)))
        margin, parts = np.full(len(s), float(p.base)), []
        for tree in range(p.trees):
            splits, values, node = _tree_of(s, margin, tree, p)
            margin = margin + values[node]
            parts.append(_node_arrays(tree, splits, values))
        tree, node, split, value = (np.concatenate(c) for c in zip(*parts))
        model = table.select(keys).take(pa.array(np.zeros(len(tree), np.int64)))
        columns = {"tree": tree, "node": node, "split": split, "value": value}
        return pa.table([*model.columns, *map(pa.array, columns.values())], names=[*keys, *columns])

    return run


def _node_arrays(tree: int, splits: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
    found = np.flatnonzero(~np.isnan(values)).astype(np.int32)
    return np.full(len(found), tree, np.int32), found, splits[found].astype(np.int32), values[found]


def _flush(p: BoostParams, trees_of: Callable[[pa.RecordBatch, int], Trees]):
    """The slices with the newest trees in their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for k in range(batch.num_rows):
                s = S.Slice((batch, k))
                margins.append(_margins(s, S.listed(batch.column("margin"), k), trees_of(batch, k)[1], p))
            at = batch.schema.get_field_index("margin")
            yield batch.set_column(at, "margin", pa.array(margins, pa.list_(pa.float64())))

    return run


def _key_types(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)


def _sums(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.groupBy(*keys, "node", "i").agg(F.sum("gr").alias("gr"), F.sum("hr").alias("hr"))


def _best(hist: DataFrame, keys: list[str], p: BoostParams) -> DataFrame:
    """The best split of every node, ``b`` (i, gr, hr). ``hist`` has gr, hr and the node's gs, hs; ties go to the smallest index."""
    gl, hl = F.col("gs") - F.col("gr"), F.col("hs") - F.col("hr")
    gain = (
        gl * gl / (hl + p.l2)
        + F.col("gr") * F.col("gr") / (F.col("hr") + p.l2)
        - F.col("gs") * F.col("gs") / (F.col("hs") + p.l2)
    )
    good = (F.col("i") >= 0) & (hl >= p.min_child_weight) & (F.col("hr") >= p.min_child_weight)
    rated = hist.withColumn("gain", F.when(good, gain))
    top = F.struct(F.when(F.col("gain") > LEAST_GAIN, F.col("gain")).alias("gain"), -F.col("i"))
    return rated.groupBy(*keys, "node").agg(
        F.max_by(F.struct("gain", "i", "gr", "hr"), top).alias("b"), F.first("gs").alias("gs"), F.first("hs").alias("hs")
    )


def _with_totals(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Root sums joined to every index. The sums are read twice from one shuffle."""
    total = F.col("i") == TOTAL
    totals = hist.groupBy(*keys).agg(F.sum(F.when(total, F.col("gr"))).alias("gs"), F.sum(F.when(total, F.col("hr"))).alias("hs"))
    return hist.join(totals, keys)


def _split_nodes(best: DataFrame, keys: list[str]) -> DataFrame:
    good = F.col("b.gain") > LEAST_GAIN
    return best.select(
        *keys, "node", F.when(good, F.col("b.i")).otherwise(F.lit(-1)).alias("split"), "gs", "hs",
        F.when(good, F.col("b.gr")).alias("gr"), F.when(good, F.col("b.hr")).alias("hr"),
    )


def _grow(
    slices: DataFrame, keys: list[str], tree: int, p: BoostParams, newer: DataFrame | None
) -> DataFrame:
    """One tree per model: (keys, node, split, value). The nodes found so far are a written table, at most 2^(depth + 1) a model."""
    schema = f"{_key_types(slices, keys)}, node int, i int, gr double, hr double"
    known: DataFrame | None = None
    nodes: DataFrame | None = None
    for level in range(p.depth):
        at = slices
        if newer is not None:
            at = at.join(newer, keys, "left")
        if known is not None:
            at = at.join(_splits(known, keys, 2 ** (p.depth + 1)), keys)

        def trees_of(batch, k, level=level):
            splits = S.listed(batch.column("splits"), k) if level else np.full(2, -1)
            return splits, _newer(batch, k)

        hist = _sums(at.mapInArrow(_histogram(keys, level, tree, p, trees_of), schema), keys)
        hist = _with_totals(hist, keys) if nodes is None else hist.join(nodes, [*keys, "node"])
        found = _split_nodes(_best(hist, keys, p), keys)
        if nodes is not None:  # nodes without any index stay leaves
            found = nodes.join(found.drop("gs", "hs"), [*keys, "node"], "left").select(
                *keys, "node", F.coalesce("split", F.lit(-1)).alias("split"), "gs", "hs", "gr", "hr"
            )
        known = materialize(found if known is None else known.unionByName(found), "nodes")
        nodes = _children(known.where(F.col("node") >= 2**level), keys)
    last = nodes.withColumn("split", F.lit(-1))
    value = F.lit(-p.rate) * F.col("gs") / (F.col("hs") + p.l2)
    every = known.select(*keys, "node", "split", "gs", "hs").unionByName(last.select(*keys, "node", "split", "gs", "hs"))
    return materialize(every.select(*keys, "node", "split", value.alias("value")), "tree")


def _newer(batch: pa.RecordBatch, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if "trees" not in batch.schema.names:
        return []
    trees = batch.column("trees")[k].as_py() or []
    return [(np.array(t["splits"]), np.array(t["values"])) for t in trees]


def _grow_one(slices: DataFrame, tree: int, p: BoostParams, newer: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One tree of a single model: its splits and values by node. At most 2^level best splits reach the driver."""
    size = 2 ** (p.depth + 1)
    splits, gs, hs = np.full(size, -1), np.full(size, np.nan), np.full(size, np.nan)
    for level in range(p.depth):
        run = _histogram([], level, tree, p, lambda batch, k, now=splits.copy(): (now, newer))
        hist = _sums(slices.mapInArrow(run, "node int, i int, gr double, hr double"), [])
        if level == 0:
            hist = _with_totals(hist, ["node"])
        else:
            by_node = {n: F.array(*[F.lit(float(x)) for x in v[2**level : 2 ** (level + 1)]]) for n, v in (("gs", gs), ("hs", hs))}
            hist = hist.withColumns({n: F.get(v, F.col("node") - 2**level) for n, v in by_node.items()})
        for r in _split_nodes(_best(hist, [], p), []).toArrow().to_pylist():
            n = r["node"]
            splits[n], gs[n], hs[n] = r["split"], r["gs"], r["hs"]
            if r["split"] >= 0:
                gs[2 * n : 2 * n + 2] = r["gs"] - r["gr"], r["gr"]
                hs[2 * n : 2 * n + 2] = r["hs"] - r["hr"], r["hr"]
        if not (splits[2**level : 2 ** (level + 1)] >= 0).any():
            break
    return splits, -p.rate * gs / (hs + p.l2)


def nested(trees: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """One row per model: an array of trees in order, each with its splits and values by node."""
    size = 2 ** (depth + 1)
    one = trees.groupBy(*keys, "tree").agg(
        _as_array(trees, keys, "split", size, F.lit(-1)).alias("splits"),
        _as_array(trees, keys, "value", size, F.lit(0.0)).alias("values"),
    )
    return one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tree", "splits", "values"))).alias("trees"))


def leaves(trees: str, depth: int, idx: str = "idx") -> Column:
    """The node a row ends in, for each tree of a nested array."""
    return F.transform(trees, lambda t: _walk(t["splits"], depth, idx))


def margin(trees: str, depth: int, base: float = 0.0, idx: str = "idx") -> Column:
    """Sum of the leaf values over the trees."""
    values = F.transform(trees, lambda t: F.get(t["values"], _walk(t["splits"], depth, idx)))
    return F.aggregate(values, F.lit(float(base)), lambda a, v: a + v)


def _with_margin(packed: DataFrame, p: BoostParams) -> DataFrame:
    return packed.withColumn("margin", F.transform("y", lambda _: F.lit(float(p.base))))


def fit(rows: DataFrame, keys: list[str], p: BoostParams = BoostParams(), whole: int = WHOLE) -> DataFrame:
    """Boosted trees of every model: (keys, tree, node, split, value), as a written table.

    ``rows`` is a written table of (keys, row_key, idx, y, weight).
    """
    packed = S.slices(rows, keys)
    S.few_at_once(packed)
    sizes = materialize(packed.groupBy(*keys).agg((F.count(F.lit(1)) <= whole).alias("_whole")), "sizes")
    parts = packed.join(sizes, keys)
    schema = f"{_key_types(rows, keys)}, tree int, node int, split int, value double"
    grown = [materialize(parts.where("_whole").drop("_whole").groupBy(*keys).applyInArrow(_forest(keys, p), schema), "trees")]
    if sizes.where(~F.col("_whole")).isEmpty():
        return grown[0]
    current = _with_margin(parts.where(~F.col("_whole")).drop("_whole"), p)
    for tree in range(p.trees):
        recent = grown[1:][tree - tree % FLUSH :]
        newer = nested(_union(recent), keys, p.depth) if recent else None
        nodes = _grow(current, keys, tree, p, newer).withColumn("tree", F.lit(tree))
        grown.append(nodes.select(*keys, "tree", "node", "split", "value"))
        if (tree + 1) % FLUSH == 0 and tree + 1 < p.trees:
            newer = nested(_union(grown[-FLUSH:]), keys, p.depth)
            flush = _flush(p, lambda batch, k: (None, _newer(batch, k)))
            with_trees = current.join(newer, keys, "left")
            current = materialize(with_trees.mapInArrow(flush, with_trees.schema).drop("trees"), "boost")
    return materialize(_union(grown), "trees")


def fit_one(rows: DataFrame, p: BoostParams = BoostParams(), whole: int = WHOLE) -> DataFrame:
    """Boosted trees of a single model over all rows: (tree, node, split, value).

    Its trees, whose size the parameters bound, travel with the jobs, so that a
    level is one job without a table.
    """
    spark = rows.sparkSession
    packed = S.slices(rows, [])
    S.few_at_once(packed)
    schema = "tree int, node int, split int, value double"
    if packed.limit(whole + 1).count() <= whole:
        return materialize(packed.withColumn("model", F.lit(0)).groupBy("model").applyInArrow(_forest([], p), schema), "trees")
    current = _with_margin(packed, p)
    trees: list[tuple[np.ndarray, np.ndarray]] = []
    for tree in range(p.trees):
        trees.append(_grow_one(current, tree, p, trees[tree - tree % FLUSH :]))
        if (tree + 1) % FLUSH == 0 and tree + 1 < p.trees:
            recent = trees[-FLUSH:]
            current = materialize(current.mapInArrow(_flush(p, lambda batch, k: (None, recent)), current.schema), "boost")
    parts = [_node_arrays(tree, splits, values) for tree, (splits, values) in enumerate(trees)]
    nodes = list(zip(*(np.concatenate(c).tolist() for c in zip(*parts))))
    return spark.createDataFrame(nodes, schema)
