"""Flattening, derivation, flags and row assembly."""

from fixtures import by, col, log, segments, session

from bidlift.functions.derive import add_click_active, derive_fields, flatten_log
from bidlift.operators import rows, sampling, vocab
from pyspark.sql import functions as F


def test_click_active_truth_table(spark):
    cases = {(0, 1): 0, (1, 1): 1, (None, 1): 1, (0, 0): 0, (1, 0): 0, (0, None): None, (None, None): None}
    df = spark.createDataFrame(list(cases), "has_click int, has_active int")
    got = {(r.has_click, r.has_active): r.click_active for r in add_click_active(df).collect()}
    assert got == cases


def test_derived_fields(spark):
    df = log(
        spark,
        session("full"),
        session("unpadded", drt="2017-9-4+1:2:3"),
        session("empty segment", user={"data": segments(["a"], [])}),
    )
    got = by(derive_fields(flatten_log(df, ("row_key",))), "row_key")
    assert got["full"]["weekday"] == "3"
    assert (got["full"]["time_zone"], got["full"]["minute"]) == ("1", "2")
    assert (got["full"]["osv"], got["full"]["model"]) == ("10", "iPhone8")
    assert got["full"]["data"] == ["x", "y"]
    assert got["unpadded"]["weekday"] == "0"
    assert got["empty segment"]["data"] == []


def test_rows_that_cannot_be_derived(spark):
    bad = {
        "bad time": {"drt": "bad"},
        "no time": {"drt": None},
        "no osv": {"device": {"osv": None}},
        "no model": {"device": {"model": None}},
        "no data": {"user": {"data": None}},
        "empty data": {"user": {"data": []}},
        "null element": {"user": {"data": segments(["a"], None)}},
        "null segment": {"user": {"data": [([("a",)],), (None,)]}},
    }
    df = log(spark, session("good"), session("empty model", device={"model": ""}), *[session(k, **v) for k, v in bad.items()])
    flat = flatten_log(df, ("row_key",))
    assert col(derive_fields(flat), "row_key") == ["empty model", "good"]
    kept = derive_fields(flat, on_error="keep")
    assert kept.count() == 10
    tokens = vocab.tokenize(kept, ["row_key"])
    assert col(tokens.select("row_key").distinct(), "row_key") == ["empty model", "good"]


def test_null_tokens_vanish(spark):
    df = log(
        spark,
        session("a", user={"data": segments([None, "v"]), "spec_usrtag": ["t", None, "t"]}, content={"keyword": [], "cclabel": [""]}),
    )
    tokens = vocab.tokenize(derive_fields(flatten_log(df, ("row_key",))), ["row_key"])
    named = tokens.withColumn("field", vocab.field_name(F.col("field_pos")))
    got = sorted((r.field, r.value) for r in named.collect() if r.field in ("data", "spec_usrtag", "keyword", "cclabel"))
    assert got == [("cclabel", ""), ("data", "v"), ("spec_usrtag", "t"), ("spec_usrtag", "t")]


def test_ad_paytype_is_its_own_column(spark):
    df = flatten_log(log(spark, session("a", paytype="top", ad={"paytype": "nested"})))
    row = df.first()
    assert (row.paytype, row.ad_paytype) == ("top", "nested")


def test_training_rows_take_old_conversions_only(spark):
    ads = spark.createDataFrame([(100001,)], "ad_id bigint")
    new = log(spark, session("n0"), session("n1", has_active=None), session("other", ad={"axid": 100009}))
    old = log(spark, session("o0"), session("o1", has_active=1), session("o2", has_active=1, has_click=0))
    got = by(rows.training_rows(new, old, ads, keep=("row_key",)), "row_key")
    assert sorted(got) == ["n0", "n1", "o1", "o2"]
    assert (got["o1"]["click_active"], got["o2"]["click_active"]) == (1, 0)


def test_window_negatives_drop_unknown(spark):
    df = log(spark, session("0"), session("1", has_active=1), session("n", has_active=None))
    assert col(rows.window_negatives(df), "row_key") == ["0"]


def test_bid_rows_restrict_the_bid_log_only(spark):
    ads = spark.createDataFrame([(100001,)], "ad_id bigint")
    bids = log(spark, session("b1"), session("b2", ad={"axid": 100009})).drop("has_click", "has_active")
    sessions = log(spark, session("s1", ad={"axid": 100009}))
    assert col(rows.bid_training_rows(bids, sessions, ads, ("row_key",)), "row_key") == ["b1", "s1"]


def test_weights_equal_replication(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", None)], "row_key string, click_active int")
    got = by(sampling.training_weights(df), "row_key")
    assert [got[k]["weight"] for k in "abc"] == [6, 1, 1]
