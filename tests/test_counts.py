"""Counters, id maps, gates and state."""

import pytest
from fixtures import by, col, log, session

from bidlift.operators import counts, gates
from bidlift.schemas import AD_STATE


def _log(spark):
    return log(
        spark,
        session("1", has_active=1),
        session("2", has_active=1, has_click=0),
        session("3", has_active=None),
        session("4", ad={"axid": 100002, "adid": 0}),
        session("5", ad={"axid": 100002, "adid": 10003}),
        session("6", ad={"axid": 100002, "adid": 10002}),
        session("7", ad={"axid": 100003, "adid": None}),
    )


def test_counts_fuse_three_queries(spark):
    got = by(counts.ad_counts(_log(spark), "axid"), "ad_id")
    assert got[100001] == {"sessions": 3, "actives": 2, "click_actives": 1}
    assert got[100003] == {"sessions": 1, "actives": 0, "click_actives": 0}
    assert by(counts.rows_per_ad(_log(spark), "axid", "click_active"), "ad_id") == {100001: {"num": 1}}


def test_id_maps(spark):
    pairs = counts.id_pairs(_log(spark))
    assert sorted(map(tuple, pairs.collect())) == [(100001, 10001), (100002, 10002), (100002, 10003)]
    assert by(counts.axid_to_adid(pairs), "axid")[100002] == {"adid": 10003}
    twice = pairs.unionByName(pairs)
    assert by(counts.adid_to_axids(twice), "adid")[10001] == {"axids": [100001]}


def test_eligible(spark):
    c = spark.createDataFrame([(1, 60, 51), (2, 60, 50), (3, 0, 0)], "ad_id bigint, sessions bigint, actives bigint")
    assert col(counts.eligible_ads(c, more_than=50), "ad_id") == [1]
    fixed = spark.createDataFrame([(2,), (3,), (4,)], "ad_id bigint")
    assert col(counts.eligible_ads(c, fixed=fixed), "ad_id") == [2]
    with pytest.raises(ValueError):
        counts.eligible_ads(c)


def test_retrain_gate(spark):
    now = 1_000_000.0
    cases = [
        # sessions, old, actives, old actives, hours since, train
        (105, 100, 9, 9, 1, False),
        (106, 100, 9, 9, 1, True),
        (100, 100, 9, 9, 13, False),
        (100, 100, 10, 9, 13, True),
        (100, 100, 10, 9, 11, False),
        (100, 95, 9, 9, 1, False),  # exactly 5 percent
        (100, None, 9, None, None, True),
    ]
    c = spark.createDataFrame([(i, x[0], x[2]) for i, x in enumerate(cases)], "ad_id bigint, sessions bigint, actives bigint")
    s = spark.createDataFrame(
        [(i, "axid", x[1], x[3], now - 3600.0 * x[4]) for i, x in enumerate(cases) if x[1] is not None], AD_STATE
    )
    got = by(gates.retrain_gate(c, s, now), "ad_id")
    assert [got[i]["train"] for i in range(len(cases))] == [x[5] for x in cases]


def _walk(windows, carried, percent=0.1, below=360000):
    trained = []
    for band, sessions in windows:
        if (sessions - carried) / sessions > percent and carried < below:
            carried = sessions
            trained.append(band)
    return trained


def test_window_gate_carries_the_count(spark):
    histories = {
        1: [200, 210, 230],
        2: [100, 90, 95, 120, 131, 150],
        3: [400_000, 900_000],
        4: [100],
    }
    start = {4: 95}
    data = [(ad, w, 90 - w, n, 60) for ad, ns in histories.items() for w, n in enumerate(ns, 1)]
    bands = spark.createDataFrame(data, "ad_id bigint, widx int, band bigint, sessions bigint, actives bigint")
    state = spark.createDataFrame([(a, "adid", n, 0, 0.0) for a, n in start.items()], AD_STATE)
    got = by(gates.window_gate(bands, state), "ad_id")
    for ad, ns in histories.items():
        want = _walk([(90 - w, n) for w, n in enumerate(ns, 1)], start.get(ad, 0))
        assert (ad in got) == bool(want)
        if want:
            assert got[ad]["trained_bands"] == ",".join(map(str, want))
            assert got[ad]["kept_band"] == want[-1]
    assert got[1]["kept_band"] == 87


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "axid", 10, 1, 5.0), (2, "axid", 20, None, 5.0)], AD_STATE)
    new = spark.createDataFrame([(2, "axid", 21, None, 6.0), (2, "adid", 7, 7, 6.0)], AD_STATE)
    once = gates.upsert(old, new, ["ad_id", "level"])
    twice = gates.upsert(once, new, ["ad_id", "level"])
    want = {
        (1, "axid"): {"sessions": 10, "actives": 1, "last_train_time": 5.0},
        (2, "axid"): {"sessions": 21, "actives": None, "last_train_time": 6.0},
        (2, "adid"): {"sessions": 7, "actives": 7, "last_train_time": 6.0},
    }
    assert by(once, "ad_id", "level") == want
    assert by(twice, "ad_id", "level") == want
