"""Boosted trees and pooled logistic models on planted rules."""

import math
import random

import pytest
from fixtures import by

from bidlift.operators import boosting, linear, metrics, models, sampling
from bidlift.operators.boosting import BoostParams
from bidlift.plans import training
from bidlift.session import materialize
from pyspark.sql import functions as F

FEW = BoostParams(trees=3, depth=3)
ADS = {1: 5, 2: 9, 3: 14}  # the index that converts, per ad


def _rows(spark, n=500):
    rnd = random.Random(4)
    out = []
    for ad, key in ADS.items():
        for r in range(n):
            idx = sorted(rnd.sample(range(20), 6))
            y = int(rnd.random() < (0.85 if key in idx else 0.1))
            out.append((f"{ad}-{r}", ad, idx, y, y))
    return materialize(
        spark.createDataFrame(out, "row_key string, ad_id bigint, idx array<int>, has_active int, click_active int")
    )


def test_first_split_is_the_exact_best(spark):
    """Whole rows and columns, depth 1: the split and the leaf values follow from sums."""
    rows = _rows(spark).select("row_key", "ad_id", "idx", F.col("has_active").cast("double").alias("y"), F.lit(1.0).alias("weight"))
    p = BoostParams(trees=1, depth=1, row_share=1.0, column_share=1.0)
    got = by(boosting.fit(materialize(rows), ["ad_id"], p), "ad_id", "node")
    data = rows.collect()
    for ad in ADS:
        mine = [r for r in data if r.ad_id == ad]
        g = [0.5 - r.y for r in mine]
        total, hs = sum(g), 0.25 * len(mine)

        def gain(i):
            inside = [k for k, r in enumerate(mine) if i in r.idx]
            gr, hr = sum(g[k] for k in inside), 0.25 * len(inside)
            return gr**2 / (hr + 1) + (total - gr) ** 2 / (hs - hr + 1), gr, hr

        best = max(range(20), key=lambda i: gain(i)[0])
        _, gr, hr = gain(best)
        assert got[(ad, 1)]["split"] == best == ADS[ad]
        assert got[(ad, 3)]["value"] == pytest.approx(-0.08 * gr / (hr + 1))
        assert got[(ad, 2)]["value"] == pytest.approx(-0.08 * (total - gr) / (hs - hr + 1))


def _walk(nodes, idx):
    n = 1
    while nodes[n]["split"] >= 0:
        n = 2 * n + (nodes[n]["split"] in idx)
    return n


def test_margins_follow_the_trees(spark):
    rows = _rows(spark, 200)
    fitted = boosting.fit(
        rows.withColumns({"y": F.col("has_active").cast("double"), "weight": F.lit(1.0)}), ["ad_id"], FEW
    )
    trees = by(fitted, "ad_id", "tree", "node")
    nested = boosting.nested(fitted, ["ad_id"], FEW.depth)
    got = rows.join(nested, "ad_id").select(
        "ad_id", "idx", boosting.leaves("trees", FEW.depth).alias("leaves"), boosting.margin("trees", FEW.depth).alias("m")
    )
    for r in got.collect():
        total = 0.0
        for t in range(FEW.trees):
            nodes = {n: v for (a, tr, n), v in trees.items() if a == r.ad_id and tr == t}
            end = _walk(nodes, r.idx)
            assert r.leaves[t] == end
            total += nodes[end]["value"]
        assert r.m == pytest.approx(total)


def test_training_finds_the_planted_rule_and_calibrates(spark):
    rows = _rows(spark)
    folded = training.prepare(rows, ["row_key"])
    widths = materialize(rows.select("ad_id").distinct().withColumn("width", F.lit(20).cast("bigint")))
    clicks = materialize(rows.groupBy("ad_id").agg(F.sum("click_active").alias("click_actives")))
    fractions = materialize(sampling.sample_fractions(rows))
    trained = training.train(folded, widths, clicks, fractions, FEW)
    meta = by(trained.meta, "ad_id")
    assert sorted(meta) == sorted(ADS)
    # Held-out scores should order the rows about as well as the planted rule itself does.
    rule = [F.when((F.col("ad_id") == a) & F.array_contains("idx", k), 1.0) for a, k in ADS.items()]
    ideal = by(metrics.auc(rows.withColumn("score", F.coalesce(*rule, F.lit(0.0)))), "ad_id")
    for ad in ADS:
        assert meta[ad]["test_auc"] > ideal[ad]["auc"] - 0.03 > 0.7
    full = materialize(folded.withColumn("variant", F.lit(models.FULL)))
    p = models.predict(trained.model, full, ["row_key", "weight"])
    sums = by(p.groupBy("ad_id").agg(F.sum(F.col("weight") * F.col("p")).alias("s")), "ad_id")
    want = by(clicks, "ad_id")
    for ad in ADS:
        assert sums[ad]["s"] * meta[ad]["discount"] == pytest.approx(want[ad]["click_actives"])
    # The prediction is the linear model over features, leaves and constant.
    full_models = trained.model.coefs.where(F.col("variant") == models.FULL).collect()
    coefs = {(r.ad_id, c): v for r in full_models for c, v in zip(r.cols, r.coefs)}
    trees = by(trained.model.trees.where(F.col("variant") == models.FULL), "ad_id", "tree", "node")
    span = 2 ** (FEW.depth + 1)
    idx = {r.row_key: r.idx for r in rows.collect()}
    for r in p.limit(60).collect():
        cols = [*idx[r.row_key], 20 + FEW.trees * span]
        for t in range(FEW.trees):
            nodes = {n: v for (a, tr, n), v in trees.items() if a == r.ad_id and tr == t}
            cols.append(20 + t * span + _walk(nodes, idx[r.row_key]))
        z = sum(coefs.get((r.ad_id, c), 0.0) for c in cols)
        assert r.p == pytest.approx(1 / (1 + math.exp(-z)))


def _linear_rows(spark, sizes):
    """Rows of ads of very unequal size, columns 0 .. 29 and a constant."""
    rnd = random.Random(11)
    out = []
    for ad, n in sizes.items():
        for r in range(n):
            cols = sorted(rnd.sample(range(30), 5)) + [30]
            y = float(rnd.random() < 1 / (1 + math.exp(2 - 1.5 * (ad % 7 in cols) - 1.0 * (12 in cols))))
            out.append((f"{ad}-{r}", ad, cols, y, 1.0 + r % 3))
    return materialize(spark.createDataFrame(out, "row_key string, ad_id bigint, cols array<int>, y double, weight double"))


def _at_optimum(rows, fitted, penalty, tolerance):
    """The conditions of an L1 minimum hold for every column."""
    grads = {}
    coefs = {(r.ad_id, c): v for r in fitted for c, v in zip(r.cols, r.coefs)}
    for r in rows:
        z = sum(coefs.get((r.ad_id, c), 0.0) for c in r.cols)
        for c in r.cols:
            grads[r.ad_id, c] = grads.get((r.ad_id, c), 0.0) + r.weight * (1 / (1 + math.exp(-z)) - r.y)
    for key, g in grads.items():
        v = coefs.get(key, 0.0)
        assert abs(g + math.copysign(penalty, v)) < tolerance if v else abs(g) < penalty + tolerance


@pytest.mark.parametrize("working", [linear.WORKING, 16])
def test_linear_fit_is_at_its_optimum(spark, working):
    """Also with 16 working columns of 31, which then have to change by round."""
    rows = _linear_rows(spark, {1: 40, 2: 700, 3: 6000})
    fitted = linear.fit(rows, ["ad_id"], working=working).collect()
    assert {r.ad_id for r in fitted} == {1, 2, 3}
    assert all(r.violation is None or r.violation <= linear.TOLERANCE * 10 for r in fitted)
    _at_optimum(rows.collect(), fitted, 10.0, 0.01)


def test_pooled_fit_equals_separate_fits(spark):
    rows = _linear_rows(spark, {1: 40, 2: 700, 3: 9000, 4: 1})
    together = {r.ad_id: r for r in linear.fit(rows, ["ad_id"]).collect()}
    for ad in (1, 2, 4):
        alone = linear.fit(materialize(rows.where(F.col("ad_id") == ad)), ["ad_id"]).first()
        assert alone.cols == together[ad].cols and alone.coefs == pytest.approx(together[ad].coefs, abs=0.001)
    assert together[4].cols == []  # too light for the penalty


def test_rows_without_a_model_get_the_average(spark):
    rows = materialize(models.variant_rows(training.prepare(_rows(spark, 100), ["row_key"]), (models.FULL,)))
    widths = materialize(rows.select("ad_id").distinct().withColumn("width", F.lit(20).cast("bigint")))
    model = models.fit_tree_linear(rows, widths, BoostParams(trees=1, depth=1))
    asked = spark.createDataFrame([(1, 1, models.FULL, [5]), (2, 99, models.FULL, [5]), (3, 2, 0, None)], "id int, ad_id bigint, variant int, idx array<int>")
    got = {r.id: r.p for r in models.predict(model, asked, ["id"]).collect()}
    assert set(got) == {1, 2, 3} and got[1] != got[2] == got[3] == pytest.approx(model.average)


def test_learned_models_are_saved_and_loaded(spark, tmp_path):
    from bidlift.plans import scoring

    rows = materialize(models.variant_rows(training.prepare(_rows(spark, 100), ["row_key"]), (models.FULL,)))
    widths = materialize(rows.select("ad_id").distinct().withColumn("width", F.lit(20).cast("bigint")))
    model = models.fit_tree_linear(rows, widths, BoostParams(trees=2, depth=2))
    scoring.save_learned(model, widths, widths, str(tmp_path / "runs"), "2001-12-01_00-00-00")
    loaded, _, _ = scoring.load_learned(spark, str(tmp_path / "runs"))
    before, after = (sorted(map(tuple, models.predict(m, rows, ["row_key"]).collect())) for m in (model, loaded))
    assert before == after and loaded.params == model.params


def test_all_ways_grow_the_same_trees(spark):
    """By one task or level by level, for many models or a single one."""
    rows = materialize(
        _rows(spark, 150).select("row_key", "ad_id", "idx", F.col("has_active").cast("double").alias("y"), F.lit(1.0).alias("weight"))
    )
    p = BoostParams(trees=boosting.FLUSH + 2, depth=3)
    want = by(boosting.fit(rows, ["ad_id"], p), "ad_id", "tree", "node")
    alone = materialize(rows.where("ad_id = 2"))
    mine = {key[1:]: r for key, r in want.items() if key[0] == 2}
    for expected, got in (
        (want, by(boosting.fit(rows, ["ad_id"], p, whole=0), "ad_id", "tree", "node")),
        (mine, by(boosting.fit_one(alone, p), "tree", "node")), (mine, by(boosting.fit_one(alone, p, whole=0), "tree", "node")),
    ):
        assert set(got) == set(expected)
        for key, r in got.items():
            assert r["split"] == expected[key]["split"] and r["value"] == pytest.approx(expected[key]["value"])


def test_trees_of_nothing(spark):
    none = materialize(_rows(spark, 1).where("ad_id < 0").select("row_key", "ad_id", "idx", F.lit(1.0).alias("y"), F.lit(1.0).alias("weight")))
    p = BoostParams(trees=2, depth=2)
    assert boosting.fit(none, ["ad_id"], p).count() == 0 and boosting.fit_one(none, p).count() == 0
    asked = spark.createDataFrame([(1, [3])], "id int, idx array<int>")
    assert models.predict_price(boosting.fit_one(none, p), asked, p).first().pred_bid == p.base


def test_price_model_learns(spark):
    rnd = random.Random(6)
    data = [(str(n), sorted(rnd.sample(range(12), 4))) for n in range(400)]
    rows = spark.createDataFrame([(k, i, 10.0 + 5.0 * (3 in i)) for k, i in data], "row_key string, idx array<int>, bidprice double")
    p = BoostParams(trees=8, depth=2, rate=0.5, base=0.5, loss="squared", column_share=1.0)
    trees = models.fit_price(materialize(rows), p)
    got = models.predict_price(trees, rows, p).select(F.avg(F.abs(F.col("pred_bid") - F.col("bidprice")))).first()[0]
    assert got < 0.5


def test_price_query_grows_every_tree(spark, monkeypatch):
    from conftest import SMALL

    from bidlift.plans.catalog import QUERIES

    asked = []

    def fit(rows, p):
        asked.append(p)
        return spark.createDataFrame([(0, 1, -1, 0.0)], "tree int, node int, split int, value double")

    monkeypatch.setattr(boosting, "fit_one", fit)
    QUERIES["bid_model"](spark, SMALL)
    assert asked == [models.PRICE_PARAMS] and models.PRICE_PARAMS.trees == 100
