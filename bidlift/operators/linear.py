"""L1 logistic models of many ads at once, by proximal Newton steps.

Every model minimises  sum w log(1 + exp(-y z)) + penalty |coefs|_1  over its
own rows, independently of all others: its own step size, its own stop.

* Columns whose weights add up to no more than the penalty can never leave zero
  (no gradient exceeds that sum), so they are left out, exactly.
* State is one row a model. A round is one job: a pass over the slices gives
  loss and gradient at each model's point, and second derivatives among its
  working columns; Spark adds the parts up in two levels; a model that gained
  enough takes its next step, by coordinate descent with soft thresholds on the
  quadratic model of its working columns, one that did not halves the last.
* The working columns are all of a model's, or, past ``WORKING`` of them, the
  active ones and those that violate the optimum most; they change by round.
* A model stops once no column violates the conditions of the optimum by more
  than ``TOLERANCE`` of the penalty, and its slices are not read again.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import slices as S

WORKING = 384
TOLERANCE = 1e-4
ROUNDS = 200
SWEEPS = 200
PARTS = 64  # of the first level in which a model's sums are added

STATE = (
    "live array<int>, base array<double>, point array<double>, work array<int>, loss double, slope double, share double, "
    "round int, violation double, done boolean"
)
STATE_NAMES = [f.split()[0] for f in STATE.split(", ")]


def live_columns(rows: DataFrame, keys: list[str], columns: str, penalty: float) -> DataFrame:
    """(keys, live): the columns of each model that can become active, heaviest first. At most its width of them."""
    weights = rows.select(*keys, "weight", F.explode(columns).alias("col")).groupBy(*keys, "col").agg(F.sum("weight").alias("w"))
    heavy = weights.where(F.col("w") > penalty).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(-F.col("w"), "col"))).alias("l"))
    return heavy.select(*keys, F.transform("l", lambda x: x["col"]).alias("live"))


def _pass(keys: list[str]):
    """Loss, gradient and second derivatives at each model's point, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in S.by_model(batches, keys):
            live, point, work = (S.listed(batch.column(n), rows[0]) for n in ("live", "point", "work"))
            order = np.argsort(live)
            place = np.full(len(live), -1)
            place[work] = np.arange(len(work))
            loss, grad, curve = 0.0, np.zeros(len(live)), np.zeros((len(work), len(work)))
            for k in rows:
                s = S.Slice((batch, k))
                at = np.minimum(np.searchsorted(live, s.cols, sorter=order), len(live) - 1)
                known = live[order[at]] == s.cols
                cols, row = order[at[known]], s.row[known]
                z = np.bincount(row, point[cols], len(s))
                loss += float(s.weight @ (np.logaddexp(0, z) - s.y * z))
                prob = 1 / (1 + np.exp(-z))
                grad += np.bincount(cols, (s.weight * (prob - s.y))[row], len(live))
                mine = place[cols] >= 0
                x = np.zeros((len(s), len(work)))
                x[row[mine], place[cols[mine]]] = 1
                curve += x.T @ (x * (s.weight * prob * (1 - prob))[:, None])
            part = S.repeated(batch, keys, rows[0], 1) + S.repeated(batch, ["slice"], rows[0], 1)
            yield pa.RecordBatch.from_arrays([*part, pa.array([pickle.dumps((loss, grad, curve))])], [*keys, "slice", "sums"])

    return run


def _added(table: pa.Table) -> tuple[float, np.ndarray, np.ndarray]:
    total = None
    for piece in table.column("sums"):
        part = pickle.loads(piece.as_py())
        total = part if total is None else tuple(a + b for a, b in zip(total, part))
    return total


def _add(table: pa.Table) -> pa.Table:
    return table.slice(0, 1).drop_columns(["sums"]).append_column("sums", pa.array([pickle.dumps(_added(table))]))


def newton_direction(base: np.ndarray, grad: np.ndarray, curve: np.ndarray, penalty: float) -> np.ndarray:
    """argmin of grad d + d curve d / 2 + penalty |base + d|, by coordinate descent with soft thresholds."""
    d, pull = np.zeros(len(base)), np.zeros(len(base))
    diagonal = np.maximum(curve.diagonal(), 1e-9)
    for sweep in range(SWEEPS):
        moved = 0.0
        # After a full sweep, only columns that are active or pulled away from zero can move.
        if sweep % 10 == 0:
            order = range(len(base))
        else:
            order = np.flatnonzero((base + d != 0) | (np.abs(grad + pull) > penalty))
        for j in order:
            u = base[j] + d[j]
            v = u - (grad[j] + pull[j]) / diagonal[j]
            new = np.sign(v) * max(abs(v) - penalty / diagonal[j], 0.0)
            if new != u:
                d[j] += new - u
                pull += curve[:, j] * (new - u)
                moved = max(moved, abs(new - u) * np.sqrt(diagonal[j]))
        if moved < 1e-7 and sweep % 10 == 0 or moved < 1e-9:
            break
    return d


def violations(point: np.ndarray, grad: np.ndarray, penalty: float) -> np.ndarray:
    """How far each column is from the conditions of the optimum."""
    return np.where(point != 0, np.abs(grad + penalty * np.sign(point)), np.maximum(np.abs(grad) - penalty, 0))


def _step(keys: list[str], penalty: float, working: int):
    def run(sums: pa.Table, state: pa.Table) -> pa.Table:
        row = {n: state.column(n)[0].as_py() for n in STATE_NAMES}
        loss, grad, curve = _added(sums)
        base, point, work = (np.array(row[n]) for n in ("base", "point", "work"))
        loss += penalty * np.abs(point).sum()
        row["round"] += 1
        if row["loss"] is not None and loss > row["loss"] + 1e-3 * row["share"] * row["slope"] + 1e-12 * abs(row["loss"]):
            row["share"] /= 2
            row["point"] = base + (point - base) / 2
            row["done"] = row["share"] < 1e-12  # nothing left to gain within rounding
            if row["done"]:
                row["point"] = base
        else:
            off = violations(point, grad, penalty)
            row["violation"], row["loss"], row["base"], row["share"] = float(off.max()), loss, point, 1.0
            row["done"] = row["violation"] <= TOLERANCE * penalty
            if not row["done"]:
                d = newton_direction(point[work], grad[work], curve, penalty)
                after = point.copy()
                after[work] += d
                row["slope"] = float(grad[work] @ d + penalty * (np.abs(after).sum() - np.abs(point).sum()))
                row["point"] = after
                if len(point) > working:
                    violated = np.argsort(-off, kind="stable")[: working // 2]
                    others = np.lexsort((-off, after == 0))
                    others = others[~np.isin(others, violated)][: working - len(violated)]
                    row["work"] = np.sort(np.concatenate([violated, others]))
        out = state.slice(0, 1).select(keys)
        types = {f.name: f.type for f in state.schema}
        for n in STATE_NAMES:
            value = row[n].tolist() if isinstance(row[n], np.ndarray) else row[n]
            out = out.append_column(n, pa.array([value], types[n]))
        return out

    return run


def fit(rows: DataFrame, keys: list[str], columns: str = "cols", penalty: float = 10.0, working: int = WORKING) -> DataFrame:
    """(keys, cols, coefs, rounds, violation) of every model, cols ascending; a written table.

    ``rows`` is a written table of (keys, row_key, columns, y, weight). A model
    whose columns all stay zero has empty arrays.
    """
    spark = rows.sparkSession
    models = rows.select(*keys).distinct()
    live = models.join(live_columns(rows, keys, columns, penalty), keys, "left").withColumn(
        "live", F.coalesce("live", F.array().cast("array<int>"))
    )
    zeros = F.transform("live", lambda _: F.lit(0.0))
    none = F.lit(None).cast("double")
    state = materialize(
        live.select(
            *keys, "live", zeros.alias("base"), zeros.alias("point"),
            F.slice(F.transform("live", lambda _, i: i), 1, working).alias("work"),
            none.alias("loss"), F.lit(0.0).alias("slope"), F.lit(1.0).alias("share"), F.lit(0).alias("round"),
            none.alias("violation"), (F.size("live") == 0).alias("done"),
        ),
        "linear",
    )
    packed = S.slices(rows, keys, columns)
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    part = F.pmod(F.col("slice"), F.lit(PARTS)).alias("part")
    finished = [state.where("done")]
    for _ in range(ROUNDS):
        state = state.where(~F.col("done"))
        if state.isEmpty():
            break
        S.few_at_once(packed)
        at = packed.join(state.select(*keys, "live", "point", "work"), keys)
        sums = at.mapInArrow(_pass(keys), f"{types}, slice bigint, sums binary").select(*keys, part, "sums")
        sums = sums.groupBy(*keys, "part").applyInArrow(_add, sums.schema)
        stepped = sums.groupBy(*keys).cogroup(state.groupBy(*keys)).applyInArrow(_step(keys, penalty, working), f"{types}, {STATE}")
        state = materialize(stepped, "linear")
        finished.append(state.where("done"))
    else:
        finished.append(state.where(~F.col("done")))
    every = finished[0]
    for more in finished[1:]:
        every = every.unionByName(more)
    active = F.array_sort(F.filter(F.arrays_zip("live", "base"), lambda x: x["base"] != 0))
    return materialize(
        every.withColumn("a", active).select(
            *keys, F.transform("a", lambda x: x["live"]).alias("cols"), F.transform("a", lambda x: x["base"]).alias("coefs"),
            F.col("round").alias("rounds"), "violation",
        ),
        "coefs",
    )


def margin(row: Column, cols: Column, coefs: Column) -> Column:
    """Sum of the coefficients of a row's columns. A model's active columns are met within the row; nothing is exploded."""
    shared = F.array_intersect(row, cols)
    return F.aggregate(shared, F.lit(0.0), lambda z, c: z + F.get(coefs, (F.array_position(cols, c) - 1).cast("int")))
