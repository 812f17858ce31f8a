"""Score tables, scorers, AUC, calibration, routing, samples, leaves."""

import glob
import math
import random
from itertools import combinations

import pytest
from fixtures import by, col, encoded

from bidlift.operators import calibrate, leaf, lookup, metrics, routing, sampling, smoothing
from bidlift.session import materialize
from bidlift.sources import tables
from pyspark.sql import functions as F

ROWS = [([0, 2], 1), ([0, 3], 0), ([1, 2], 0), ([0, 2], 1)]


def _fit(spark, rows, **kw):
    enc = encoded(spark, rows)
    base = materialize(smoothing.averages(enc))
    return materialize(smoothing.score_table(smoothing.feature_stats(enc, **kw), base)), base


def _score(spark, fitted, rows, scorer, weight, **kw):
    scores, base = fitted
    got = by(smoothing.score_rows(encoded(spark, rows), scores, base, ["row_key"], scorer, weight, **kw), "row_key")
    return [got[str(n)]["score"] for n in range(len(rows))]


def test_worked_example(spark):
    fitted = _fit(spark, ROWS)
    scores = {k: v["score"] for k, v in by(smoothing.decode_scores(fitted[0]), "i", "j").items()}
    assert scores[(0, -1)] == pytest.approx(3.5 / 6) and scores[(1, -1)] == pytest.approx(0.375)
    assert scores[(0, 2)] == pytest.approx(0.7) and scores[(0, 3)] == pytest.approx(0.375)
    rows = [([0, 2], 0), ([1, 3], 0), ([1], 0), ([], 0)]
    want = {
        ("mean", 0.0): [0.7, 0.5, None, None],
        ("mean", 1.0): [0.622222, 0.416667, 0.375, None],
        ("deviation", 0.0): [0.7, 0.5, None, None],
        ("deviation", 1.0): [0.646969, 0.375, 0.375, None],
        ("logodds", 0.0): [0.336472, 0.0, 0.0, 0.0],
        ("logodds", 1.0): [0.644774, -0.575364, -0.287682, 0.0],
    }
    for (scorer, weight), expected in want.items():
        got = _score(spark, fitted, rows, scorer, weight)
        for g, e in zip(got, expected):
            assert (g is None) == (e is None)
            if e is not None:
                assert g == pytest.approx(e, abs=1e-5), (scorer, weight)


def _brute(train, test, prior=3.0):
    pos, tot = {}, {}
    for idx, y in train:
        for k in [*idx, *combinations(idx, 2)]:
            tot[k] = tot.get(k, 0) + 1
            pos[k] = pos.get(k, 0) + (y == 1)
    avg = sum(y == 1 for _, y in train) / len(train)
    s = {k: (pos[k] + prior * avg) / (tot[k] + prior) for k in tot}
    out = []
    for idx, _ in test:
        singles = [s.get(i, avg) for i in idx]
        pairs = [s.get(p, avg) for p in combinations(idx, 2)]
        terms = singles + pairs
        mean = sum(terms) / len(terms) if terms else None
        w = [abs(avg - t) + 1e-6 for t in terms]
        dev = sum(a * b for a, b in zip(w, terms)) / sum(w) if terms else None
        log = sum(math.log(t) - math.log(avg) for t in terms)
        out.append((mean, dev, log))
    return out


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
def test_scorers_against_brute_force(spark, max_rows):
    rnd = random.Random(7)

    def make(n, width):
        # Index 0 is in a third of the rows, labels may be NULL.
        return [
            (sorted({0} if i % 3 == 0 else set()) + sorted(rnd.sample(range(1, width), rnd.randrange(6))), rnd.choice([0, 1, None]))
            for i in range(n)
        ]

    train, test = make(150, 20), make(60, 25)
    fitted = _fit(spark, train)
    want = _brute(train, test)
    for n, scorer in enumerate(("mean", "deviation", "logodds")):
        got = _score(spark, fitted, test, scorer, 1.0, max_rows=max_rows)
        for g, w in zip(got, want):
            assert g == (None if w[n] is None else pytest.approx(w[n], abs=1e-9))


def test_scores_are_rates_and_removed_pairs_are_average(spark):
    enc = encoded(spark, ROWS).withColumn("pair_idx", smoothing.drop_indices("idx", [2]))
    base = materialize(smoothing.averages(enc))
    scores = materialize(smoothing.score_table(smoothing.feature_stats(enc, pair_idx="pair_idx"), base))
    keys = set(by(smoothing.decode_scores(scores), "i", "j"))
    assert (2, -1) in keys and (0, 2) not in keys and (0, 3) in keys
    assert scores.where("score < 0 or score > 1").count() == 0
    assert _score(spark, (scores, base), [([0, 2], 0)], "mean", 0.0) == [0.5]


@pytest.mark.parametrize("frequent", [0, 5, 1000])
def test_lookup_of_frequent_facts(spark, frequent):
    """Whichever keys are told to be frequent, known or unknown, rows and facts found stay the same."""
    rnd = random.Random(3)
    table = materialize(spark.createDataFrame([(k, 1 + k % 3, k * 0.5) for k in range(0, 80, 2)], "k bigint, pop bigint, v double"))
    facts = [(n, rnd.choice([1, 2, rnd.randrange(100), None])) for n in range(500)]
    df = materialize(spark.createDataFrame(facts, "n bigint, k bigint"))
    got = lookup.lookup_left(df, table, ["k"], "pop", 4, None, lambda: lookup.frequent_keys(df, ["k"], frequent) if frequent else df.select("k").where("false"))
    want = [(n, k, k * 0.5 if k is not None and k % 2 == 0 and k < 80 else None) for n, k in facts]
    assert sorted(((r.n, r.k, r.v) for r in got.collect()), key=lambda r: r[0]) == want
    few = lookup.frequent_keys(df, ["k"], frequent or 1)
    assert few.count() <= (frequent or 1)


def test_stored_scores_are_joined_without_a_shuffle_of_the_table(spark, tmp_path):
    """The table is read by its buckets, also when the catalog knows it no more; scores equal those of the plain table."""
    rnd = random.Random(11)
    train = [(sorted(rnd.sample(range(12), 4)), rnd.randrange(2)) for _ in range(300)]
    test = [(sorted(rnd.sample(range(14), 4)), 0) for _ in range(200)]
    scores, base = _fit(spark, train)
    asked = encoded(spark, test)
    buckets = tables.Buckets(("ad_id", "code"), 8)
    path = str(tmp_path / "scores")
    tables.write_bucketed(scores, path, buckets)
    assert len(glob.glob(f"{path}/*.parquet")) <= 8
    spark.sql(f"DROP TABLE {tables._table_name(path, buckets)}")  # as a new session finds it
    stored = tables.read_bucketed(spark, path, buckets)
    assert sorted(stored.collect()) == sorted(scores.select(stored.columns).collect())

    def scored(table):
        return smoothing.score_rows(asked, table, base, ["row_key"], "mean", 1.0, max_rows=10)

    by_key = {r.row_key: r.score for r in scored(scores).collect()}
    assert {r.row_key: r.score for r in scored(stored).collect()} == pytest.approx(by_key)
    assert len(by_key) == 200
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scored(stored)._jdf.queryExecution().executedPlan().toString()
        plain = scored(scores)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    shuffles = [p.count("Exchange hashpartitioning(ad_id") for p in (plan, plain)]
    assert shuffles[0] == shuffles[1] - 1  # just the table's


def test_own_scorer(spark):
    fitted = _fit(spark, ROWS)
    best = (lambda w, s, avg: (F.when(w > 0, s), F.lit(1.0)), lambda num, den: num)
    assert _score(spark, fitted, [([0, 2], 0)], best, 0.0) == [pytest.approx(0.7)]


def _pairwise_auc(rows):
    p = [s for s, y in rows if y == 1]
    n = [s for s, y in rows if y != 1]
    if not p or not n:
        return 0.5
    return sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))


@pytest.mark.parametrize("slices", [2, 256])
def test_auc_against_all_pairs(spark, slices):
    rnd = random.Random(2)
    ads = {
        1: [(rnd.random(), rnd.randrange(2)) for _ in range(200)],
        2: [(rnd.randrange(4) / 4, rnd.choice([0, 1, None])) for _ in range(200)],
        3: [(0.5, 1)] * 60 + [(0.5, 0)] * 20 + [(rnd.random(), 1) for _ in range(20)],
        4: [(rnd.random(), 1) for _ in range(9)],
        5: [(rnd.random(), 0) for _ in range(9)],
    }
    df = spark.createDataFrame([(a, s, y) for a, v in ads.items() for s, y in v], "ad_id bigint, score double, click_active int")
    got = by(metrics.auc(df, slices=slices), "ad_id")
    for a, v in ads.items():
        assert got[a]["auc"] == pytest.approx(_pairwise_auc(v), abs=1e-12)


def test_cross_auc_counts_a_missing_half_as_chance(spark):
    rows = [(1, 0, 0.9, 1), (1, 0, 0.1, 0), (1, 1, 0.3, 1), (2, 0, 0.9, 1), (2, 0, 0.1, 0)]
    df = spark.createDataFrame(rows, "ad_id bigint, fold bigint, score double, click_active int")
    got = by(metrics.cross_auc(df), "ad_id")
    assert got[1]["test_auc"] == pytest.approx(0.75) and got[2]["test_auc"] == pytest.approx(0.75)


def test_calibration(spark):
    predicted = spark.createDataFrame([(1, 6, 0.5), (1, 1, 0.2), (2, 1, 0.4)], "ad_id bigint, weight bigint, p double")
    clicks = spark.createDataFrame([(1, 2)], "ad_id bigint, click_actives bigint")
    fractions = spark.createDataFrame([(1, 0.8), (2, 1.0)], "ad_id bigint, fraction double")
    got = by(calibrate.discount(predicted, clicks, fractions), "ad_id")
    assert got[1]["discount"] * 3.2 * 0.8 == pytest.approx(2)
    assert got[2]["discount"] == 0
    bids = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0)], "ad_id bigint, pred_bid double")
    averages = calibrate.bid_average(bids)
    previous = spark.createDataFrame([(2, 7.0)], "ad_id bigint, bid_constant double")
    got = by(calibrate.bid_constant(averages, clicks), "ad_id")
    assert got[1]["bid_constant"] == pytest.approx(15 / 2 * 2) and got[2]["bid_constant"] is None
    assert by(calibrate.bid_constant(averages, clicks, previous), "ad_id")[2]["bid_constant"] == 7.0


def test_routing_and_price(spark):
    models = spark.createDataFrame([(42256, 0.5, 10.0), (43479, 2.0, 10.0)], "ad_id bigint, discount double, bid_constant double")
    id_map = spark.createDataFrame([(111111, 43479), (222222, 99999)], "axid bigint, adid bigint")
    override = spark.createDataFrame([(333333, 43479), (555555, 77777)], "axid bigint, model_id bigint")
    asked = [42256, 43479, 111111, 222222, 444444, 333333, 555555]
    requests = spark.createDataFrame([(a, 0.1) for a in asked], "axid bigint, p double")
    routes = materialize(routing.route_table(models, id_map, override))
    got = routing.route_model(requests, routes, 42256)
    assert {r.axid: r.use_model for r in got.collect()} == {
        42256: 42256, 43479: 43479, 111111: 43479, 222222: 42256, 444444: 42256, 333333: 43479, 555555: 42256,
    }
    correction = spark.createDataFrame([(111111, 1.5)], "axid bigint, factor double")
    priced = by(routing.price(got, models, correction), "axid")
    assert priced[111111]["cvr"] == pytest.approx(0.2) and priced[111111]["bid"] == pytest.approx(3.0)
    assert priced[444444]["bid"] == pytest.approx(0.5)


def test_routing_by_auc(spark):
    models = spark.createDataFrame([(1, 0.6), (2, 0.7), (3, 0.7), (4, 0.9)], "ad_id bigint, test_auc double")
    id_map = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (5, 10), (6, 20)], "axid bigint, adid bigint")
    routes = materialize(routing.route_table_by_auc(models, id_map))
    requests = spark.createDataFrame([(a,) for a in (1, 5, 6)], "axid bigint")
    got = {r.axid: r.use_model for r in routing.route_model(requests, routes, routing.best_model(models)).collect()}
    assert got == {1: 1, 5: 2, 6: 4}


def test_stratified_sample(spark):
    rows = [(f"{ad}-{n}", ad, n % 5, (1 if n % 4 == 0 else None if n % 50 == 1 else 0)) for ad, size in ((1, 4000), (2, 300)) for n in range(size)]
    df = spark.createDataFrame(rows, "row_key string, ad_id bigint, x bigint, has_active int")
    fractions = sampling.sample_fractions(df, 1000, 800)
    got = by(fractions, "ad_id")
    assert got[1]["fraction"] == pytest.approx(0.2) and got[2]["fraction"] == 1.0
    kept = materialize(sampling.stratified_sample(df, fractions, ["row_key"]))
    again = sampling.stratified_sample(df, fractions, ["row_key"])
    assert col(kept, "row_key") == col(again, "row_key")
    assert kept.where("ad_id = 2").count() == 300
    one = kept.where("ad_id = 1")
    assert one.where("has_active = 1").count() == 1000
    assert one.where("has_active is null").count() == 0
    assert 450 < one.where("has_active = 0").count() < 720


def test_folds_partition_the_rows(spark):
    df = spark.range(1000).withColumn("row_key", F.col("id").cast("string"))
    folds = [r["count"] for r in sampling.assign_folds(df, 3, ["row_key"]).groupBy("fold").count().collect()]
    assert sum(folds) == 1000 and len(folds) == 3 and min(folds) > 250


def test_unseen_leaf_has_no_column(spark):
    train = spark.createDataFrame([("a", 1, [3, 7]), ("b", 1, [4, 7])], "row_key string, ad_id bigint, leaves array<int>")
    test = spark.createDataFrame([("c", 1, [4, 9])], "row_key string, ad_id bigint, leaves array<int>")
    columns = leaf.leaf_columns(train)
    assert {(r.tree, r.leaf): r.col for r in columns.collect()} == {(0, 3): 1, (0, 4): 2, (1, 7): 3}
    assert by(leaf.leaf_onehot(train, columns, ["row_key"]), "row_key")["a"]["cols"] == [1, 3]
    assert by(leaf.leaf_onehot(test, columns, ["row_key"]), "row_key")["c"]["cols"] == [2]
