"""The training job: its stages, its gates, and going on where it broke."""

import pytest
from conftest import SMALL
from fixtures import by
from pyspark.sql import functions as F

from bidlift.operators.boosting import BoostParams
from bidlift.plans import catalog, job, scoring
from bidlift.plans import testbed as B
from bidlift.session import materialize

FEW = BoostParams(trees=2, depth=2)


def _prices(spark):
    bids = materialize(catalog._bid_rows(spark, SMALL), "bids")
    return bids, BoostParams(trees=3, depth=2, rate=0.5, base=0.5, loss="squared")


def test_job_goes_on_where_it_broke(spark, tmp_path):
    root = str(tmp_path / "job")
    new, old = B.new_sessions(spark, SMALL), B.old_sessions(spark, SMALL)
    t = job.Trainer(level="adid", more_than=20, gate="growth", params=FEW)
    bids, params = _prices(spark)
    job.train_price(bids, str(tmp_path / "price"), "r1", params)
    price = job.load_price(spark, str(tmp_path / "price"), params)
    for stage in job.STAGES[:-1]:
        with pytest.raises(job.Stopped):
            job.train_ads(new, old, root, "r1", B.NOW, t, price, stop_after=stage)
        assert job.latest_state(spark, f"{root}/state").count() == 0
    assert job.train_ads(new, old, root, "r1", B.NOW, t, price) == ["state"]
    assert job.train_ads(new, old, root, "r1", B.NOW, t, price) == []

    state = by(job.latest_state(spark, f"{root}/state"), "ad_id")
    counted = by(B.eligible(spark, SMALL, "adid"), "ad_id")
    assert set(state) == set(counted)
    assert all(state[a]["sessions"] == counted[a]["sessions"] and state[a]["last_train_time"] == B.NOW for a in state)
    _, _, meta = scoring.load_learned(spark, f"{root}/models")
    record = by(meta, "ad_id")
    assert set(record) == set(counted)
    averages = by(job.predicted_bids(catalog._training(spark, SMALL, "adid"), price), "ad_id")
    for a, r in record.items():
        clicks = counted[a]["click_actives"]
        want = averages[a]["bid_average"] / clicks * averages[a]["num"] if clicks else None
        assert r["bid_constant"] == (pytest.approx(want, rel=1e-6) if clicks else None)
        assert r["level"] == "adid" and r["era"] == "new" and r["trained_at"] == B.NOW

    # A later run without growth would train nothing; one of all ads without prices keeps the constants.
    assert job.chosen_ads(new, job.latest_state(spark, f"{root}/state"), B.NOW + 1, t).count() == 0
    every = job.Trainer(level="adid", more_than=20, gate="all", params=FEW, sample_limit=50, sample_cap=40)
    assert job.train_ads(new, old, root, "r2", B.NOW + 1, every) == list(job.STAGES)
    later = by(scoring.load_learned(spark, f"{root}/models")[2], "ad_id")
    assert {a: r["bid_constant"] for a, r in later.items()} == {a: r["bid_constant"] for a, r in record.items()}
    assert {r["last_train_time"] for r in by(job.latest_state(spark, f"{root}/state"), "ad_id").values()} == {B.NOW + 1}


def test_window_trainer(spark, tmp_path):
    """Each adid is trained on its own kept band."""
    log = B.session_log(spark, SMALL).drop("_status", "producttype")
    t = job.Trainer(level="adid", gate="windows", more_than=B.WINDOW_MORE_THAN, percent=10, params=FEW)
    root = str(tmp_path / "job")
    job.train_ads(log, log, root, "r1", B.NOW, t)
    _, _, meta = scoring.load_learned(spark, f"{root}/models")
    kept = by(catalog.QUERIES["retrain_gate_windows"](spark, SMALL), "ad_id")
    record, state = by(meta, "ad_id"), by(job.latest_state(spark, f"{root}/state"), "ad_id")
    assert set(record) <= set(kept) and set(state) == set(record) and {r["era"] for r in record.values()} == {"old"}
    assert all(state[a]["sessions"] == kept[a]["sessions"] for a in state)


def test_days_of_bands(spark):
    from bidlift.functions import date_band
    from bidlift.operators.rows import band_days

    days = spark.sql("SELECT explode(sequence(date'1999-12-25', date'2001-03-02')) AS date").withColumn("band", date_band(F.col("date")))
    first, last = band_days(F.col("band"))
    bounds = days.groupBy("band").agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a > '2000-01-01' AND b < '2001-03-01'")
    assert bounds.where((first != F.col("a")) | (last != F.col("b"))).count() == 0 and bounds.count() > 30
