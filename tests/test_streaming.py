"""Streams give what the batch gives, and retries change nothing."""

from conftest import SMALL
from fixtures import by
from pyspark.sql import functions as F

from bidlift.plans import testbed as B
from bidlift.session import fresh_path
from bidlift.streaming import jobs


def _stream(spark, path, **kw):
    schema = B.table(spark, SMALL, "events").schema
    return jobs.event_sessions(jobs.read_stream(spark, path, schema, **kw))


def _split_events(spark):
    path = fresh_path(spark, "events")
    B.table(spark, SMALL, "events").repartition(4).write.parquet(path)
    return path


def _batch(spark):
    return jobs.event_sessions(B.table(spark, SMALL, "events"))


def test_counts_over_several_batches(spark):
    path = _split_events(spark)
    got = by(jobs.count_stream(spark, _stream(spark, path, files_per_batch=1)), "ad_id")
    want = _batch(spark).groupBy("ad_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("has_click").alias("clicks"), F.sum("has_active").alias("actives")
    )
    assert got == by(want, "ad_id")


def _sessions(spark, state):
    return jobs.latest_counts(spark, state).agg(F.sum("sessions")).first()[0]


def test_counts_go_on_and_every_file_counts_once(spark):
    """More files, a retried batch, a lost checkpoint, a version that was broken off: nothing counts twice or is lost."""
    out, events = fresh_path(spark, "state"), fresh_path(spark, "events")
    first, second, third = B.table(spark, SMALL, "events").randomSplit([0.4, 0.3, 0.3], 1)
    sink = jobs.count_sink(f"{out}/state")
    seen = []
    stream = lambda: _stream(spark, events)

    def recording(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)  # as if retried after its commit
        seen.append(batch_id)

    first.write.mode("append").parquet(events)
    jobs.run_available(stream(), recording, f"{out}/checkpoint")
    assert _sessions(spark, f"{out}/state") == first.count()
    second.write.mode("append").parquet(events)
    jobs.run_available(stream(), sink, f"{out}/checkpoint-lost")  # starts over, without the first checkpoint
    assert _sessions(spark, f"{out}/state") == first.count() + second.count()
    # Tables of a version without an entry in the log are not seen, and the next version takes their place.
    log = jobs.ad_log(spark, f"{out}/state")
    broken = f"{int(log.latest()) + 1:012d}"
    spark.createDataFrame([(1, 10**6, 0, 0)], log.schema).write.parquet(f"{out}/state/counts/run_ts={broken}")
    assert _sessions(spark, f"{out}/state") == first.count() + second.count()
    third.write.mode("append").parquet(events)
    jobs.run_available(stream(), sink, f"{out}/checkpoint")
    assert _sessions(spark, f"{out}/state") == B.table(spark, SMALL, "events").count()
    before = by(jobs.latest_counts(spark, f"{out}/state"), "ad_id")
    log.compact()
    assert log.latest("sums") == log.latest() and by(jobs.latest_counts(spark, f"{out}/state"), "ad_id") == before
    assert seen == [0]


def _counts_and_late_are_all(spark, state):
    """Counts of all days plus late rows equal the batch result; gives the late ones by day and ad."""
    rows = jobs.event_sessions(B.table(spark, SMALL, "events")).withColumn("day", F.date_trunc("day", "ts"))
    each = lambda df: by(df.groupBy("day", "ad_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("has_active").alias("actives")), "day", "ad_id")
    got = by(jobs.day_log(spark, state).current(), "day", "ad_id")
    lost, want = each(jobs.late_rows(spark, state, rows.schema)), each(rows)
    assert set(got) | set(lost) == set(want)
    for key, v in want.items():
        for name in ("sessions", "actives"):
            assert v[name] == got.get(key, {}).get(name, 0) + lost.get(key, {}).get(name, 0)
    return lost


def test_daily_counts_and_late_rows_are_all_rows(spark):
    """Old files after new ones: closed days do not change, their rows are kept aside."""
    out, events = fresh_path(spark, "daily"), fresh_path(spark, "events")
    schema = B.table(spark, SMALL, "events").schema
    table = B.table(spark, SMALL, "events")
    middle, newest = table.selectExpr("percentile_approx(cast(ts as timestamp), 0.7)", "max(ts)").first()
    late = "1 day"
    table.where(F.col("ts").cast("timestamp") > F.lit(middle)).coalesce(1).write.parquet(events)
    sink = jobs.daily_sink(f"{out}/state", late)
    jobs.run_available(_stream(spark, events), sink, f"{out}/checkpoint")
    table.where(F.col("ts").cast("timestamp") <= F.lit(middle)).coalesce(1).write.mode("append").parquet(events)
    jobs.run_available(_stream(spark, events), sink, f"{out}/checkpoint")
    lost = _counts_and_late_are_all(spark, f"{out}/state")
    assert lost
    closed = newest.date() if hasattr(newest, "date") else newest
    assert max(d for d, _ in lost).date() < closed


def test_daily_counts_over_several_batches(spark):
    path, out = _split_events(spark), fresh_path(spark, "daily")
    jobs.run_available(_stream(spark, path, files_per_batch=2), jobs.daily_sink(f"{out}/state"), f"{out}/checkpoint")
    assert _counts_and_late_are_all(spark, f"{out}/state")  # the second batch comes after the first one's newest day
    whole = fresh_path(spark, "daily")
    jobs.run_available(_stream(spark, path), jobs.daily_sink(f"{whole}/state"), f"{whole}/checkpoint")
    assert not _counts_and_late_are_all(spark, f"{whole}/state")  # one batch has no late rows


def test_a_published_run_changes_the_next_batch(spark, tmp_path):
    from bidlift.sources import tables

    root, out, events = str(tmp_path / "models"), fresh_path(spark, "scored"), fresh_path(spark, "events")
    spark.range(20).repartition(1).write.parquet(events)
    loads = []

    def load(spark, root, run):
        loads.append(run)
        return tables.read_snapshot(spark, root, "model", run).first()[0]

    handle = jobs.ModelHandle(spark, root, load)
    score = lambda batch: batch.withColumn("p", F.lit(handle.current()))
    run = lambda: jobs.run_available(jobs.read_stream(spark, events, spark.range(1).schema), jobs.score_sink(score, out), f"{out}-checkpoint")
    tables.publish_snapshot({"model": spark.createDataFrame([(0.25,)], "p double")}, root, "2001-01-01")
    run()
    tables.publish_snapshot({"model": spark.createDataFrame([(0.75,)], "p double")}, root, "2001-01-02")
    spark.range(20, 30).repartition(1).write.mode("append").parquet(events)
    run()
    got = {r.id: r.p for r in spark.read.parquet(out).collect()}
    assert got == {i: 0.25 if i < 20 else 0.75 for i in range(30)}
    handle.current()
    assert loads == ["2001-01-01", "2001-01-02"]


def test_scoring_with_saved_summaries_scans_no_table(spark, monkeypatch, tmp_path):
    from bidlift.operators import lookup
    from bidlift.plans import catalog, scoring

    meta, routes, default = catalog._routing(spark, SMALL)
    scoring.save_models(catalog._smoothed_models(spark, SMALL, meta), meta, str(tmp_path / "m"), "r1")
    models, meta = scoring.load_models(spark, str(tmp_path / "m"))
    monkeypatch.setattr(lookup, "summarize", lambda *a: 1 / 0)
    scored = scoring.score_requests(B.bid_log(spark, SMALL).limit(50), models, routes, default, meta, B.bid_correction(spark, SMALL))
    assert scored.count() > 0
