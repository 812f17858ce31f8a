"""Logs, state, text forms, snapshots, reports."""

import datetime as dt

import pytest
from fixtures import LOG, by, col, encoded, log, session
from pyspark.sql import functions as F

from bidlift.operators import models, report
from bidlift.schemas import AD_STATE, MODEL_META
from bidlift.session import fresh_path, work_dir
from bidlift.sources import logs, tables, text

DAY = dt.date(2017, 9, 15)


def _days(spark, mark):
    out = []
    for back in range(6):
        out += [session(f"{mark}-{back}-{n}", date=DAY - dt.timedelta(days=back)) for n in range(2)]
    return log(spark, *out)


def test_ingest_prunes_and_refresh_replaces(spark):
    root = fresh_path(spark, "log")
    logs.ingest_window(_days(spark, "a"), root, DAY, 4)
    whole = logs.read_log(spark, root)
    assert whole.count() == 8 and "date" in whole.columns
    some = logs.read_log(spark, root, DAY - dt.timedelta(days=2), "2017-09-14")
    assert some.count() == 4
    assert len(some.inputFiles()) < len(whole.inputFiles()) or "PartitionFilters" in some._jdf.queryExecution().toString()
    logs.refresh_partitions(_days(spark, "b"), root, DAY, days_back=1)
    logs.refresh_partitions(_days(spark, "b"), root, DAY, days_back=1)
    marks = [k[0] for k in col(logs.read_log(spark, root), "row_key")]
    assert marks.count("a") == 6 and marks.count("b") == 4


def test_product_type_partitions(spark):
    root = fresh_path(spark, "bids")
    bids = _days(spark, "a").withColumn("producttype", F.when(F.col("row_key").endswith("0"), "feed").otherwise("video"))
    logs.ingest_window(bids, root, DAY, 4)
    got = logs.read_log(spark, root, producttypes=("feed",))
    assert got.count() == 4 and {"producttype", "date"} <= set(got.columns)


def test_missing_state_is_empty_but_other_errors_surface(spark):
    path = fresh_path(spark, "state")
    assert tables.load_state(spark, path).count() == 0
    spark.createDataFrame([("no parquet",)], "value string").write.text(path)
    with pytest.raises(Exception):
        tables.load_state(spark, path).collect()


def test_state_roundtrip_is_one_file(spark):
    path = fresh_path(spark, "state")
    state = spark.createDataFrame([(i, "axid", i, i, 1.0) for i in range(50)], AD_STATE).repartition(5)
    tables.save_state(state, path)
    assert len(spark.read.parquet(path).inputFiles()) == 1
    assert tables.load_state(spark, path).count() == 50


def test_json_map_splits_when_large(spark):
    ids = spark.createDataFrame([(i, i * 10) for i in range(100)], "axid bigint, adid bigint")
    assert text.json_objects(ids, "axid", "adid").count() == 1
    assert text.json_objects(ids, "axid", "adid", objects=4).count() == 4
    assert [r.value for r in text.json_objects(ids.limit(0), "axid", "adid").collect()] == ["{}"]
    path = fresh_path(spark, "ids")
    text.json_objects(ids, "axid", "adid", objects=4).write.text(path)
    assert {r.id: r.value for r in text.read_json_map(spark, path).collect()} == {i: i * 10 for i in range(100)}


def test_text_parts_are_read_from_all_folders(spark):
    root = fresh_path(spark, "parts")
    for n in (1, 2):
        text.write_ids(spark.createDataFrame([(n,), (n + 10,)], "ad_id bigint"), f"{root}/x/{n}")
    text.write_ids(spark.createDataFrame([], "ad_id bigint"), f"{root}/empty")
    assert col(text.read_text_parts(spark, root), "line") == ["1", "11", "12", "2"]


def test_libsvm_and_vectors_agree(spark):
    enc = encoded(spark, [([0, 3], 1), ([], 0), ([4], None)])
    path = fresh_path(spark, "libsvm")
    text.write_libsvm(enc, path)
    back = sorted((r.label, str(r.features)) for r in text.read_libsvm(spark, path, 5).collect())
    vectors = sorted((float(r.has_active or 0), str(r.features)) for r in models.to_vector(enc, 5).collect())
    assert back == vectors
    assert vectors[-1][1] == "(5,[0,3],[1.0,1.0])"


def test_snapshots_do_not_overwrite(spark):
    root = fresh_path(spark, "runs")
    for n in (1, 2):
        tables.publish_snapshot({"t": spark.range(n)}, root, f"2017-09-1{n}_00-00-00")
    assert tables.read_snapshot(spark, root, "t").count() == 2
    assert tables.read_snapshot(spark, root, "t", "2017-09-11_00-00-00").count() == 1


def test_names_keep_the_last_and_reports_tolerate_gaps(spark):
    path = fresh_path(spark, "names")
    names = spark.createDataFrame(
        [("100001", "10001", 'a "quoted", name'), ("100002", "10001", "second"), ("100003", "10002", None)],
        "spotid string, adid string, remark string",
    )
    tables.write_report_csv(names, path)
    back = tables.read_ad_names(spark, path)
    assert by(report.latest_names(back, "spotid"), "ad_id")[100001]["remark"] == 'a "quoted", name'
    assert by(report.latest_names(back, "adid"), "ad_id")[10001]["remark"] == "second"
    meta = spark.createDataFrame(
        [(100001, "axid", "new", 0.0, 0.8, 5, 1.0, 0.7), (100009, "axid", "new", 0.0, 0.8, 6, 1.0, 0.6),
         (10001, "adid", "new", 0.0, 0.8, 7, 1.0, 0.9), (10001, "adid", "old", 0.0, 0.8, 8, 1.0, 0.5)],
        MODEL_META,
    )
    state = spark.createDataFrame([(100001, "axid", 10, 2, 1505347200.0), (10001, "adid", 20, 4, 0.0)], AD_STATE)
    ids = spark.createDataFrame([(100001, 10001)], "axid bigint, adid bigint")
    new = meta.where("era = 'new'")
    got = by(report.report_axid(new, state, back, ids), "axid")
    assert sorted(got) == [100001, 100009]
    assert got[100001]["update_time"] == "2017-09-14 08:00:00"
    assert (got[100001]["zadid"], got[100001]["zadid_cols"], got[100001]["zadid_session"]) == (10001, 7, 20)
    assert got[100009]["remark"] is None and got[100009]["session"] is None
    eras = report.report_adid(meta, state.withColumn("era", F.lit("new")), back).collect()
    assert [(r.adid, r.time, r.session) for r in eras] == [(10001, "new", 20), (10001, "old", None)]


def test_work_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert work_dir(spark) == named.rstrip("/")
    assert fresh_path(spark, "t") != fresh_path(spark, "t")


def test_row_keys_tell_equal_impressions_apart(spark, tmp_path):
    """Numbers by file and place: unique, the same on every read, also under a filter; equal rows stay two through encoding and pricing."""
    from conftest import SMALL

    from bidlift.functions.derive import derive_fields, flatten_log
    from bidlift.operators import vocab
    from bidlift.plans import catalog, scoring
    from bidlift.plans import testbed as B

    log = B.bid_log(spark, SMALL).drop("row_key", "row_seq")
    twice = log.unionByName(log)
    root = str(tmp_path / "log")
    twice.repartition(5).write.partitionBy("producttype", "date").parquet(root)
    first = logs.read_log(spark, root, row_key="row_key").select("row_key", "drt", "ad.axid")
    second = logs.read_log(spark, root, row_key="row_key").select("row_key", "drt", "ad.axid")
    n = twice.count()
    assert first.schema["row_key"].dataType.simpleString() == "bigint"
    assert first.select("row_key").distinct().count() == n and first.exceptAll(second).count() == 0
    part = logs.read_log(spark, root, start=dt.date(1998, 1, 1), row_key="row_key").select("row_key")
    assert 0 < part.count() == part.distinct().count() < n

    meta, routes, default = catalog._routing(spark, SMALL)
    models = catalog._smoothed_models(spark, SMALL, meta)
    requests = logs.read_log(spark, root, row_key="row_key")
    priced = scoring.score_requests(requests, models, routes, default, meta, B.bid_correction(spark, SMALL))
    assert priced.count() == n and priced.select("row_key").distinct().count() == n
    blind = scoring.score_requests(requests.withColumn("row_key", F.lit(0)), models, routes, default, meta, B.bid_correction(spark, SMALL))
    assert blind.count() == n  # even without a key no row is lost

    rows = catalog.materialize(derive_fields(flatten_log(requests, ("row_key",))).withColumn("ad_id", F.col("axid")), "rows")
    encoded = vocab.encode_rows(rows, models.dictionary, ["ad_id"])
    assert encoded.count() == rows.count()


def test_a_refresh_counts_only_its_days(spark):
    """Days outside the refresh keep their counts even if the log behind them changed; emptied days lose theirs."""
    from bidlift.sources import daily

    root, counted = fresh_path(spark, "log"), fresh_path(spark, "counts")
    logs.ingest_window(_days(spark, "a"), root, DAY, 5)
    first = DAY - dt.timedelta(days=5)
    daily.write_day_counts(spark, root, counted, first, DAY)
    assert daily.read_day_counts(spark, counted).agg(F.sum("sessions")).first()[0] == 10
    more = _days(spark, "b").unionByName(_days(spark, "c"))
    logs.refresh_partitions(more, root, DAY, 5)  # the log changes on all days, four rows each
    daily.refresh_day_counts(spark, root, counted, DAY, 1)
    by_day = by(daily.read_day_counts(spark, counted).groupBy("date").agg(F.sum("sessions").alias("n")), "date")
    assert {d: r["n"] for d, r in by_day.items()} == {
        DAY - dt.timedelta(days=n): 4 if n <= 1 else 2 for n in range(6)
    }
    log_days = logs.read_log(spark, root, DAY - dt.timedelta(days=1), DAY)
    assert "PartitionFilters: [isnotnull(date" in log_days._jdf.queryExecution().toString()
    empty = fresh_path(spark, "log")
    _days(spark, "d").where(F.col("date") < DAY).write.partitionBy("date").parquet(empty)
    daily.write_day_counts(spark, empty, counted, DAY, DAY)
    assert DAY not in by(daily.read_day_counts(spark, counted).select("date").distinct(), "date")
    levels = by(daily.by_level(daily.read_day_counts(spark, counted)), "level", "ad_id")
    assert sum(r["sessions"] for (level, _), r in levels.items() if level == "axid") == 4 + 2 * 4
