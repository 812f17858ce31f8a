"""The named queries. Each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

Arrays leave as text and ratios rounded, so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_band, token_text
from ..functions.derive import add_click_active, derive_fields, flatten_log
from ..operators import (
    calibrate,
    counts,
    gates,
    leaf,
    metrics,
    models,
    report,
    routing,
    rows,
    sampling,
    smoothing,
    vocab,
)
from ..schemas import BID_PATHS, FEATURE_FIELDS, MULTI_FIELDS
from ..session import fresh_path, materialize
from ..sources import daily, logs, tables, text
from ..streaming import jobs
from . import job, scoring, training
from . import testbed as B

Query = Callable[[SparkSession, str], DataFrame]

# The queries on the cut itself cut here, so that it shows on these tables; all
# others cut at ``vocab.VOCABULARY``.
VOCABULARY_CUT = 100
# Sampling limits at which these tables are sampled.
SAMPLE_LIMIT, SAMPLE_CAP = 300, 200
# The same for the rows behind a discount.
DISCOUNT_LIMIT, DISCOUNT_CAP = 50, 40
UNIFORM_SHARE = 0.4
# The day the ingest queries take for today.
TODAY = dt.date(2001, 6, 1)
KEEP = ("row_key", "row_seq")
ROW_COLUMNS = ["row_key", "has_active", "click_active", "bidprice", "winprice"]


def _bucket() -> Column:
    """Sample bucket from integer keys, the same in every engine."""
    return F.col("row_seq") * 7919 % sampling.BUCKETS


def _ads(spark: SparkSession, sf: str, level: str) -> DataFrame:
    return materialize(B.eligible(spark, sf, level).select("ad_id"), "ads")


def _training(spark: SparkSession, sf: str, level: str) -> DataFrame:
    """Derived training rows of the eligible ads, written."""
    flat = rows.training_rows(
        B.new_sessions(spark, sf), B.old_sessions(spark, sf), _ads(spark, sf, level), level, KEEP
    )
    return materialize(derive_fields(flat).withColumn("ad_id", F.col(level)), "rows")


def _dict(training: DataFrame, k: int = vocab.VOCABULARY) -> DataFrame:
    return materialize(vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), k)), "dict")


def _encoded(spark: SparkSession, sf: str, level: str, columns: list[str] = ROW_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Encoded training rows with the columns that the query goes on with, written, and their dictionary."""
    training = _training(spark, sf, level)
    dictionary = _dict(training)
    return materialize(vocab.encode_rows(training, dictionary, columns), "encoded"), dictionary


def _joined(column: str) -> Column:
    return F.concat_ws(",", F.col(column).cast("array<string>")).alias(column)


def _flat_text(flat: DataFrame) -> DataFrame:
    """Flat rows with arrays as text and NULL kept."""
    arrays = {f: F.array_join(f, ",", "~") for f in MULTI_FIELDS if f in flat.columns}
    if "drt" in flat.columns:
        arrays["data"] = F.to_json("data")
    prices = {c: F.round(c, 6) for c in ("bidprice", "winprice") if c in flat.columns}
    return flat.withColumns({**arrays, **prices})


# -- sources and sinks --------------------------------------------------------


def scan_sessions(spark, sf):
    log = B.session_core(spark, sf, "2000-09-01", "2000-09-23")
    return log.select(
        "row_key", F.col("date").cast("string").alias("date"), "has_click", "has_active",
        F.col("ad.axid").alias("axid"), F.col("ad.adid").alias("adid"),
    )


def scan_bids(spark, sf):
    """All product types over two days, written as a partitioned log and read back by folder."""
    root = fresh_path(spark, "bids")
    logs.ingest_window(B.bid_log(spark, sf), root, TODAY, 10)
    log = logs.read_log(spark, root, TODAY - dt.timedelta(days=5), TODAY - dt.timedelta(days=1))
    return log.select(
        "row_key", "producttype", F.col("date").cast("string").alias("date"), F.col("ad.axid").alias("axid"),
        F.round("bid.bidprice", 6).alias("bidprice"),
    )


def ingest_window(spark, sf):
    root = fresh_path(spark, "sessions")
    logs.ingest_window(B.new_sessions(spark, sf), root, TODAY, 35)
    log = logs.read_log(spark, root)
    return log.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("num"), F.count_if(F.col("has_active") == 1).alias("actives")
    )


def refresh_partitions(spark, sf):
    """A log of 35 days whose outcome flags were not known yet, refreshed over the last eleven."""
    root = fresh_path(spark, "sessions")
    full = B.session_core(spark, sf, B.SPLIT_DAY)
    early = full.withColumn("has_active", F.lit(0))
    logs.ingest_window(early, root, TODAY, 35)
    logs.refresh_partitions(full, root, TODAY)
    return logs.read_log(spark, root).groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("num"), F.count_if(F.col("has_active") == 1).alias("actives")
    )


def counts_after_refresh(spark, sf):
    """The log of ``refresh_partitions`` with counters per day: after the refresh only its eleven days are counted again."""
    root, counted = fresh_path(spark, "sessions"), fresh_path(spark, "day-counts")
    full = B.session_core(spark, sf, B.SPLIT_DAY)
    logs.ingest_window(full.withColumn("has_active", F.lit(0)), root, TODAY, 35)
    daily.write_day_counts(spark, root, counted, TODAY - dt.timedelta(days=35), TODAY)
    logs.refresh_partitions(full, root, TODAY)
    daily.refresh_day_counts(spark, root, counted, TODAY)
    return daily.by_level(daily.read_day_counts(spark, counted))


def ad_names(spark, sf):
    path = fresh_path(spark, "names")
    tables.write_report_csv(B.ad_names(spark, sf), path)
    names = tables.read_ad_names(spark, path)
    return report.latest_names(names, "spotid").withColumn("level", F.lit("axid")).unionByName(
        report.latest_names(names, "adid").withColumn("level", F.lit("adid"))
    )


def ad_state_save(spark, sf):
    path = fresh_path(spark, "state")
    tables.save_state(B.ad_state(spark, sf), path)
    return tables.load_state(spark, path)


def ad_state_load(spark, sf):
    """The first run finds no state, the second the first one's."""
    path = fresh_path(spark, "state")
    new = gates.state_rows(counts.ad_counts(B.session_core(spark, sf, B.SPLIT_DAY), "axid"), "axid", B.NOW)
    tables.save_state(gates.upsert(tables.load_state(spark, path), new, ["ad_id", "level"]), path)
    return tables.load_state(spark, path)


def ads_to_train(spark, sf):
    path = fresh_path(spark, "ads")
    text.write_ids(_gated(spark, sf).where("train"), path)
    return text.read_text_parts(spark, path).withColumnRenamed("line", "ad_id")


def id_map_json(spark, sf):
    ids = materialize(B.id_map(spark, sf), "ids")
    return text.json_objects(ids, "axid", "adid")


def id_map_from_json(spark, sf):
    path = fresh_path(spark, "ids")
    text.write_json_map(materialize(B.id_map(spark, sf), "ids"), "axid", "adid", path)
    return text.read_json_map(spark, path).select(F.col("id").alias("axid"), F.col("value").alias("adid"))


def constants_load(spark, sf):
    path = fresh_path(spark, "constants")
    text.write_json_map(materialize(B.bid_correction(spark, sf), "factors"), "axid", "factor", path)
    return text.read_json_map(spark, path, "double").select(F.col("id").alias("axid"), F.col("value").alias("factor"))


def read_text_parts(spark, sf):
    """Ids written to two nested folders, read as one list of lines."""
    root = fresh_path(spark, "parts")
    for level in ("axid", "adid"):
        text.write_ids(B.eligible(spark, sf, level), f"{root}/ids/{level}")
    return text.read_text_parts(spark, root)


def libsvm_roundtrip(spark, sf):
    path = fresh_path(spark, "libsvm")
    encoded, dictionary = _encoded(spark, sf, "axid")
    width = dictionary.agg(F.max("global_idx") + 1).first()[0]
    text.write_libsvm(encoded, path)
    return text.read_libsvm(spark, [path], width).select(
        F.col("label").cast("bigint").alias("label"), F.col("features").cast("string").alias("features")
    )


def publish_snapshot(spark, sf):
    """Two runs over the whole log are published, of actives and of all sessions; the reader gets the later one."""
    root = fresh_path(spark, "published")
    log = B.session_core(spark, sf, spread=False)
    for run, part in (("2001-11-01_00-00-00", log.where("has_active = 1")), ("2001-12-01_00-00-00", log)):
        table = counts.ad_counts(part, "axid")
        tables.publish_snapshot({"ad_counts": table}, root, run)
    return tables.read_snapshot(spark, root, "ad_counts")


# -- counts, ids, gates -------------------------------------------------------


def click_active(spark, sf):
    return add_click_active(B.session_core(spark, sf)).select("row_key", "has_click", "has_active", "click_active")


def session_counts(spark, sf):
    return counts.ranked_counts(counts.by_level(B.session_core(spark, sf, B.SPLIT_DAY, spread=False)))


def active_counts(spark, sf):
    return counts.ranked_counts(counts.by_level(B.session_core(spark, sf, B.SPLIT_DAY, spread=False)), "actives")


def click_active_counts(spark, sf):
    return counts.ranked_counts(counts.by_level(B.session_core(spark, sf, B.SPLIT_DAY, spread=False)), "click_actives")


def _both_levels(make: Callable[[str], DataFrame]) -> DataFrame:
    axid, adid = (make(level).withColumn("level", F.lit(level)) for level in ("axid", "adid"))
    return axid.unionByName(adid)


def ad_counts(spark, sf):
    return counts.by_level(B.session_core(spark, sf, spread=False))


def id_pairs(spark, sf):
    return counts.id_pairs(B.session_core(spark, sf))


def axid_to_adid(spark, sf):
    return counts.axid_to_adid(counts.id_pairs(B.session_core(spark, sf)))


def adid_to_axids(spark, sf):
    return counts.adid_to_axids(counts.id_pairs(B.session_core(spark, sf))).select("adid", _joined("axids"))


def bidprice_by_ad(spark, sf):
    return counts.bidprice_by_ad(B.session_core(spark, sf))


def eligible_ads(spark, sf):
    """By actives at both levels, and a fixed list: the ads with a price correction."""
    log = B.session_core(spark, sf, B.SPLIT_DAY)
    fixed = materialize(B.bid_correction(spark, sf).select(F.col("axid").alias("ad_id")), "fixed")
    listed = counts.eligible_ads(counts.ad_counts(log, "axid"), fixed=fixed)
    return _both_levels(lambda level: B.eligible(spark, sf, level)).unionByName(
        listed.withColumn("level", F.lit("fixed"))
    )


def filter_ads(spark, sf):
    log = B.session_core(spark, sf, B.SPLIT_DAY)
    return rows.filter_ads(log, _ads(spark, sf, "axid")).select("row_key", F.col("ad.axid").alias("axid"))


def _gated(spark, sf) -> DataFrame:
    state = materialize(B.ad_state(spark, sf), "state")
    return gates.retrain_gate(materialize(B.eligible(spark, sf, "axid"), "ads"), state, B.NOW)


def retrain_gate_axid(spark, sf):
    return _gated(spark, sf)


def state_upsert(spark, sf):
    """The saved counters after a run: trained ads get their new counters and the run's time."""
    trained = gates.state_rows(_gated(spark, sf).where("train"), "axid", B.NOW)
    return gates.upsert(B.ad_state(spark, sf), trained, ["ad_id", "level"])


def date_bands(spark, sf):
    return counts.date_bands(B.session_core(spark, sf))


def retrain_gate_windows(spark, sf):
    bands = materialize(counts.counts_by_band(B.session_core(spark, sf)), "bands")
    none = tables.load_state(spark, fresh_path(spark, "no-state"))
    return gates.window_gate(gates.newest_bands(bands), none, more_than=B.WINDOW_MORE_THAN)


# -- rows ---------------------------------------------------------------------


def flatten(spark, sf):
    return _flat_text(flatten_log(B.session_log(spark, sf).drop("_status"), ("row_key",)))


def derive(spark, sf):
    flat = flatten_log(add_click_active(B.session_log(spark, sf)), ("row_key",))
    return _flat_text(derive_fields(flat))


def _slim(log: DataFrame) -> DataFrame:
    return log.select(
        "row_key", F.col("ad.axid").alias("axid"), "has_click", "has_active", "click_active"
    )


def old_positives(spark, sf):
    return _slim(rows.old_positives(B.session_core(spark, sf, end=B.SPLIT_DAY)))


def window_negatives(spark, sf):
    return _slim(rows.window_negatives(B.session_core(spark, sf, B.SPLIT_DAY)))


def training_rows(spark, sf):
    flat = rows.training_rows(
        B.new_sessions(spark, sf), B.old_sessions(spark, sf), _ads(spark, sf, "axid"), "axid", ("row_key",)
    )
    return _flat_text(flat)


def window_training_rows(spark, sf):
    """The newest band's non-converted rows of its eligible adids with all conversions of these adids."""
    bands = materialize(gates.newest_bands(counts.counts_by_band(B.session_core(spark, sf)), 1), "bands")
    ads = materialize(counts.eligible_ads(bands, B.WINDOW_MORE_THAN).select("ad_id"), "ads")
    newest = bands.agg(F.max("band")).first()[0]
    log = B.session_log(spark, sf).drop("_status", "producttype")
    window = log.where(date_band(F.col("date")) == newest)
    return _flat_text(rows.window_training_rows(window, log, ads, ("row_key",)))


def window_kept_rows(spark, sf):
    """For every adid that the window gate trains: the rows of its own kept band, and all its conversions."""
    kept = materialize(retrain_gate_windows(spark, sf), "kept")
    days, (first, last) = rows.kept_days(kept)
    window = B.session_log(spark, sf, str(first), str(last + dt.timedelta(days=1)))
    log = B.session_log(spark, sf).drop("_status", "producttype")
    return _flat_text(rows.kept_window_rows(window.drop("_status", "producttype"), log, kept, ("row_key",)))


def bid_training_rows(spark, sf):
    """Bid rows of the ads of the fixed list, and the session rows of all ads in the new range."""
    fixed = materialize(B.bid_correction(spark, sf).select(F.col("axid").alias("ad_id")), "fixed")
    return _flat_text(
        rows.bid_training_rows(B.bid_log(spark, sf), B.new_sessions(spark, sf), fixed, ("row_key",))
    )


def training_weights(spark, sf):
    log = add_click_active(B.session_core(spark, sf))
    return sampling.training_weights(log).select("row_key", "click_active", "weight")


# -- vocabulary and encoding --------------------------------------------------


def tokenize(spark, sf):
    training = _training(spark, sf, "axid").withColumn("w", vocab.active_weight())
    return vocab.tokenize(training, ["row_key", "ad_id", "w"]).select(
        "row_key", "ad_id", F.col("field_pos").cast("bigint").alias("field_pos"), "value",
        token_text(vocab.field_name(F.col("field_pos")), F.col("value")).alias("token"), "w",
    )


def token_weights(spark, sf):
    return _named(vocab.token_weights(_training(spark, sf, "axid")))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("field", vocab.field_name(F.col("field_pos"))).drop("field_pos")


def _bid_rows(spark, sf) -> DataFrame:
    fixed = materialize(B.bid_correction(spark, sf).select(F.col("axid").alias("ad_id")), "fixed")
    flat = rows.bid_training_rows(B.bid_log(spark, sf), B.new_sessions(spark, sf), fixed, ("row_key",))
    return derive_fields(flat)


def token_distinct(spark, sf):
    return _named(vocab.token_distinct(_bid_rows(spark, sf)))


def global_dict(spark, sf):
    return vocab.global_dict(vocab.token_distinct(_bid_rows(spark, sf))).drop("field_pos")


def bid_encode(spark, sf):
    """The ads' training rows in the indices of the global bid dictionary."""
    dictionary = materialize(vocab.global_dict(vocab.token_distinct(_bid_rows(spark, sf))), "dict")
    encoded = vocab.encode_rows(_training(spark, sf, "axid"), dictionary, ["row_key", "ad_id"], model=None)
    return encoded.select("row_key", "ad_id", _joined("idx"))


def top_tokens(spark, sf):
    top = vocab.top_tokens(vocab.token_weights(_training(spark, sf, "axid")), VOCABULARY_CUT)
    return _named(top).withColumn("rank", F.col("rank").cast("bigint"))


def cutoff_weight(spark, sf):
    return vocab.cutoff_weight(vocab.top_tokens(vocab.token_weights(_training(spark, sf, "axid")), VOCABULARY_CUT))


def feature_dict(spark, sf):
    return _dict(_training(spark, sf, "axid"), VOCABULARY_CUT).drop("field_pos")


def field_sizes(spark, sf):
    return vocab.field_sizes(_dict(_training(spark, sf, "axid"))).drop("field_pos")


def field_offsets(spark, sf):
    sizes = vocab.field_sizes(_dict(_training(spark, sf, "axid")))
    return vocab.field_offsets(sizes).drop("field_pos")


def encode_rows(spark, sf):
    training = _training(spark, sf, "axid")
    encoded = vocab.encode_rows(training, _dict(training), ["row_key", "has_active", "click_active"])
    return encoded.select("row_key", "ad_id", "has_active", "click_active", _joined("idx"))


def decode_features(spark, sf):
    training = _training(spark, sf, "axid")
    dictionary = _dict(training)
    encoded = materialize(vocab.encode_rows(training, dictionary, ["row_key"]), "encoded")
    decoded = vocab.decode_features(encoded, dictionary, ["row_key"])
    return decoded.select(
        "row_key", "ad_id", F.col("global_idx").cast("bigint").alias("global_idx"),
        token_text(F.col("field"), F.col("value")).alias("feature"),
    )


def to_vector(spark, sf):
    encoded, dictionary = _encoded(spark, sf, "axid", ["row_key"])
    width = dictionary.agg(F.max("global_idx") + 1).first()[0]
    return models.to_vector(encoded, width).select("row_key", "ad_id", F.col("features").cast("string").alias("features"))


# -- samples, folds -----------------------------------------------------------


def _sample_rows(spark, sf) -> DataFrame:
    return B.session_core(spark, sf).withColumn("ad_id", F.col("ad.axid"))


def sample_fractions(spark, sf):
    return sampling.sample_fractions(_sample_rows(spark, sf), SAMPLE_LIMIT, SAMPLE_CAP).withColumn(
        "fraction", F.round("fraction", 6)
    )


def stratified_sample(spark, sf):
    log = _sample_rows(spark, sf)
    fractions = materialize(sampling.sample_fractions(log, SAMPLE_LIMIT, SAMPLE_CAP), "fractions")
    kept = sampling.stratified_sample(log, fractions, bucket=_bucket())
    return kept.select("row_key", "ad_id", "has_active")


def uniform_sample(spark, sf):
    log = B.session_core(spark, sf)
    return sampling.uniform_sample(log, UNIFORM_SHARE, bucket=_bucket()).select("row_key", "has_active")


def fold_assign(spark, sf):
    folds = sampling.assign_folds(B.session_core(spark, sf), 2, bucket=F.col("row_seq"))
    return folds.select("row_key", "fold")


# -- smoothing ----------------------------------------------------------------


def single_stats(spark, sf):
    encoded, _ = _encoded(spark, sf, "adid", ["has_active"])
    return smoothing.single_stats(encoded)


# Fields left out of pairs in the pair query: those with many values.
CROSS_EXCLUDE = ("minute", "cityc")


def pair_stats(spark, sf):
    training = _training(spark, sf, "adid")
    dictionary = _dict(training)
    encoded = vocab.encode_rows(training, dictionary, ["row_key", "has_active"], cross_exclude=CROSS_EXCLUDE)
    return smoothing.pair_stats(encoded, pair_idx="cross_idx")


def _fitted(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    encoded, _ = _encoded(spark, sf, "adid", ["row_key", "has_active", "click_active"])
    base = materialize(smoothing.averages(encoded), "base")
    scores = materialize(smoothing.score_table(smoothing.feature_stats(encoded), base), "scores")
    return encoded, scores, base


def smoothed_scores(spark, sf):
    encoded, _ = _encoded(spark, sf, "adid", ["has_active"])
    base = materialize(smoothing.averages(encoded), "base")
    scores = smoothing.score_table(smoothing.feature_stats(encoded), base)
    return smoothing.decode_scores(scores).withColumn("score", F.round("score", 6))


def _scores(spark, sf, scorer: str, weight: float) -> DataFrame:
    encoded, scores, base = _fitted(spark, sf)
    scored = smoothing.score_rows(encoded, scores, base, ["row_key"], scorer, weight)
    return scored.withColumn("score", F.round("score", 6))


def score_mean(spark, sf):
    return _scores(spark, sf, "mean", 0.0)


def score_deviation(spark, sf):
    return _scores(spark, sf, "deviation", 1.0)


def score_logodds(spark, sf):
    return _scores(spark, sf, "logodds", 1.0)


def auc(spark, sf):
    encoded, scores, base = _fitted(spark, sf)
    scored = smoothing.score_rows(encoded, scores, base, ["row_key", "click_active"])
    return metrics.auc(_or_average(scored, base)).withColumn("auc", F.round("auc", 6))


def _or_average(scored: DataFrame, base: DataFrame) -> DataFrame:
    """Rows that the tables say nothing about score their model's average, as in scoring."""
    return scored.join(base, "ad_id", "left").withColumn("score", F.coalesce("score", "average")).drop("average")


# -- calibration --------------------------------------------------------------


def _click_actives(spark, sf, level: str) -> DataFrame:
    log = B.session_core(spark, sf, B.SPLIT_DAY)
    return counts.ad_counts(log, level).where("click_actives > 0").select("ad_id", "click_actives")


def discount(spark, sf):
    """Fitted on sampled rows, so divided by the same fractions."""
    training = _training(spark, sf, "adid")
    fractions = materialize(sampling.sample_fractions(training, DISCOUNT_LIMIT, DISCOUNT_CAP), "fractions")
    kept = materialize(sampling.stratified_sample(training, fractions, bucket=_bucket()).drop("fraction"), "kept")
    encoded = materialize(vocab.encode_rows(kept, _dict(kept), ROW_COLUMNS), "encoded")
    base = materialize(smoothing.averages(encoded), "base")
    scores = materialize(smoothing.score_table(smoothing.feature_stats(encoded), base), "scores")
    scored = _or_average(smoothing.score_rows(encoded, scores, base, ["row_key", "click_active"]), base)
    predicted = sampling.training_weights(scored).withColumnRenamed("score", "p")
    out = calibrate.discount(predicted, _click_actives(spark, sf, "adid"), fractions)
    return out.withColumn("discount", F.round("discount", 6))


def bid_average(spark, sf):
    training = _training(spark, sf, "axid")
    return calibrate.bid_average(training, "bidprice").withColumn("bid_average", F.round("bid_average", 6))


def bid_constant(spark, sf):
    averages = calibrate.bid_average(_training(spark, sf, "axid"), "bidprice")
    out = calibrate.bid_constant(averages, _click_actives(spark, sf, "axid"))
    return out.withColumn("bid_constant", F.round("bid_constant", 4))


# -- routing and scoring ------------------------------------------------------


def _routing(spark, sf) -> tuple[DataFrame, DataFrame, int]:
    meta = materialize(B.model_meta(spark, sf), "meta")
    default = B.default_model(meta)
    routes = routing.route_table(meta, B.id_map(spark, sf), B.model_override(spark, sf, default))
    return meta, materialize(routes, "routes"), default


def route_model(spark, sf):
    _, routes, default = _routing(spark, sf)
    requests = B.session_core(spark, sf).select("row_key", F.col("ad.axid").alias("axid"))
    return routing.route_model(requests, routes, default)


def route_model_by_auc(spark, sf):
    meta = materialize(B.model_meta(spark, sf).where("level = 'axid'"), "meta")
    routes = materialize(routing.route_table_by_auc(meta, B.id_map(spark, sf)), "routes")
    requests = B.session_core(spark, sf).select("row_key", F.col("ad.axid").alias("axid"))
    return routing.route_model(requests, routes, routing.best_model(meta))


def bid_price(spark, sf):
    meta, routes, default = _routing(spark, sf)
    requests = B.session_core(spark, sf).select(
        "row_key", F.col("ad.axid").alias("axid"), (F.col("row_seq") % 997 / F.lit(997.0)).alias("p")
    )
    routed = routing.route_model(requests, routes, default)
    return _priced(routing.price(routed, meta, B.bid_correction(spark, sf)))


def _priced(df: DataFrame) -> DataFrame:
    return df.select(
        "row_key", "axid", "use_model", F.round("p", 6).alias("p"), F.round("cvr", 6).alias("cvr"),
        F.round("bid", 4).alias("bid"),
    )


def _smoothed_models(spark, sf, meta: DataFrame) -> scoring.SmoothedModels:
    flat = rows.training_rows(B.new_sessions(spark, sf), B.old_sessions(spark, sf), None, keep=KEEP)
    training = materialize(rows.model_rows(derive_fields(flat), meta), "rows")
    return scoring.fit_smoothed(training, vocab.VOCABULARY)


def score_saved_models(spark, sf):
    """Two runs are fitted and published; requests are priced with the latest one's tables, read back."""
    meta, routes, default = _routing(spark, sf)
    flat = rows.training_rows(B.new_sessions(spark, sf), B.old_sessions(spark, sf), None, keep=KEEP)
    training = materialize(rows.model_rows(derive_fields(flat), meta), "rows")
    root = fresh_path(spark, "models")
    for run, prior in (("2001-11-01_00-00-00", 50.0), ("2001-12-01_00-00-00", smoothing.PRIOR)):
        scoring.save_models(scoring.fit_smoothed(training, vocab.VOCABULARY, prior=prior), meta, root, run)
    models, meta = scoring.load_models(spark, root)
    return _priced(
        scoring.score_requests(B.bid_log(spark, sf), models, routes, default, meta, B.bid_correction(spark, sf))
    )


def score_stored_buckets(spark, sf):
    """Score tables published in buckets; of them only keys of a thousandth of all uses or requests are broadcast."""
    meta, routes, default = _routing(spark, sf)
    root = fresh_path(spark, "models")
    scoring.save_models(_smoothed_models(spark, sf, meta), meta, root, "2001-12-01_00-00-00", broadcast_rows=0)
    models, meta = scoring.load_models(spark, root)
    correction = B.bid_correction(spark, sf)
    return _priced(scoring.score_requests(B.bid_log(spark, sf), models, routes, default, meta, correction, max_rows=1000))


def score_requests(spark, sf):
    meta, routes, default = _routing(spark, sf)
    models = _smoothed_models(spark, sf, meta)
    scored = scoring.score_requests(
        B.bid_log(spark, sf), models, routes, default, meta, B.bid_correction(spark, sf)
    )
    return _priced(scored)


# -- learned models -----------------------------------------------------------


def _model_widths(dictionary: DataFrame) -> DataFrame:
    return materialize(dictionary.groupBy("ad_id").agg(F.count(F.lit(1)).alias("width")), "widths")


def cross_auc(spark, sf):
    """Two-fold AUC of every eligible creative."""
    encoded, dictionary = _encoded(spark, sf, "axid", ["row_key", "has_active", "click_active"])
    folded = training.prepare(encoded, ["row_key"])
    return training.cross_auc(folded, _model_widths(dictionary)).withColumn("test_auc", F.round("test_auc", 6))


def _given_scores(spark, sf) -> DataFrame:
    """Every session of a campaign with a score, a fold and a weight that follow from its number."""
    log = add_click_active(B.session_core(spark, sf)).withColumn("ad_id", F.col("ad.adid"))
    return log.select(
        "ad_id", "click_active", (F.col("row_seq") * 31 % 97 / F.lit(97.0)).alias("score"), (F.col("row_seq") % 2).alias("fold"),
        (F.col("row_seq") % 3 + 1).alias("weight"),
    )


def cross_auc_given(spark, sf):
    """Two-fold AUC of given scores."""
    return metrics.cross_auc(_given_scores(spark, sf)).withColumn("test_auc", F.round("test_auc", 6))


def calibration_holds(spark, sf):
    """Weighted predictions times the discount, against the click-actives it was made for."""
    scored = materialize(_given_scores(spark, sf).withColumnRenamed("score", "p"), "scored")
    actives = scored.groupBy("ad_id").agg(F.count_if(F.col("click_active") == 1).alias("click_actives"))
    discounts = calibrate.discount(scored, actives, sampling.no_sample(scored))
    total = scored.groupBy("ad_id").agg(F.sum(F.col("weight") * F.col("p")).alias("total"))
    return discounts.join(total, "ad_id").join(actives, "ad_id").select(
        "ad_id", F.round(F.col("total") * F.col("discount"), 6).alias("expected"), "click_actives"
    )


# Trees and coefficients given by number, for checks of prediction.
GIVEN = models.BoostParams(trees=8, depth=2, base=0.5)
GIVEN_COLUMNS = 97


def _given_trees(ads: DataFrame) -> DataFrame:
    """The given trees of every row of ``ads``: nodes 1 to 3 split, 4 to 7 are leaves."""
    every = ads.withColumn("id", F.explode(F.sequence(F.lit(0), F.lit(8 * GIVEN.trees - 1))))
    nodes = every.withColumns({"tree": (F.col("id") / 8).cast("int"), "node": (F.col("id") % 8).cast("int")}).where("node > 0")
    split = F.when(F.col("node") < 4, (F.col("tree") * 13 + F.col("node") * 5) % GIVEN_COLUMNS).otherwise(-1).cast("int")
    value = ((F.col("tree") * 31 + F.col("node") * 17) % 101 - 40) / F.lit(8.0)
    return nodes.select(*ads.columns, "tree", "node", split.alias("split"), value.alias("value"))


def tree_margin(spark, sf):
    """The margin of given trees on every training row in the global bid indices."""
    dictionary = materialize(vocab.global_dict(vocab.token_distinct(_bid_rows(spark, sf))), "dict")
    encoded = vocab.encode_rows(_training(spark, sf, "axid"), dictionary, ["row_key", "ad_id"], model=None)
    rated = models.predict_price(_given_trees(spark.range(1).select(F.lit(0).alias("model"))), encoded, GIVEN)
    return rated.select("row_key", "ad_id", F.round("pred_bid", 6).alias("margin"))


def bid_constant_predicted(spark, sf):
    """Bid constants from the predictions of given price trees."""
    dictionary = materialize(vocab.global_dict(vocab.token_distinct(_bid_rows(spark, sf))), "dict")
    bids = job.predicted_bids(_training(spark, sf, "axid"), job.PriceModel(_given_trees(spark.range(1).select(F.lit(0).alias("model"))), dictionary, GIVEN))
    out = calibrate.bid_constant(bids, _click_actives(spark, sf, "axid"))
    return out.withColumn("bid_constant", F.round("bid_constant", 4))


def linear_predict(spark, sf):
    """Probabilities of every training row under given trees and coefficients, one model an adid."""
    encoded, dictionary = _encoded(spark, sf, "adid", ["row_key"])
    widths = _model_widths(dictionary)
    ads = widths.select("ad_id", F.lit(models.FULL).alias("variant"), "width")
    trees = materialize(_given_trees(ads.select("ad_id", "variant")), "trees")
    last = F.col("width") + GIVEN.trees * 2 ** (GIVEN.depth + 1)
    active = ads.select("ad_id", "variant", F.explode(F.sequence(F.lit(0), last)).alias("col")).where((F.col("col") * 7 + F.col("ad_id")) % 5 < 2)
    coef = ((F.col("col") * 37 + F.col("ad_id")) % 41 - 20) / F.lit(40.0)
    packed = active.groupBy("ad_id", "variant").agg(F.array_sort(F.collect_list(F.struct(F.col("col").cast("int").alias("col"), coef.alias("coef")))).alias("a"))
    coefs = packed.select("ad_id", "variant", F.transform("a", lambda x: x["col"]).alias("cols"), F.transform("a", lambda x: x["coef"]).alias("coefs"))
    model = models.TreeLinear(trees, materialize(coefs, "coefs"), widths, GIVEN)
    asked = encoded.withColumn("variant", F.lit(models.FULL))
    return models.predict(model, asked, ["row_key"]).select("row_key", "ad_id", F.round("p", 6).alias("p"))


def cvr_model(spark, sf):
    """Train every eligible campaign and give its record, with the bid constant from the price model's predictions."""
    derived = _training(spark, sf, "adid")
    dictionary = _dict(derived)
    encoded = materialize(vocab.encode_rows(derived, dictionary, ROW_COLUMNS), "encoded")
    trained = training.train(
        training.prepare(encoded, ["row_key"]),
        _model_widths(dictionary),
        _click_actives(spark, sf, "adid"),
        materialize(sampling.no_sample(encoded), "fractions"),
    )
    constants = calibrate.bid_constant(job.predicted_bids(derived, _price_model(spark, sf)), _click_actives(spark, sf, "adid"))
    return trained.meta.join(constants, "ad_id", "left")


def train_job_state(spark, sf):
    """The training job of all creatives that the gate lets through, broken off after each stage and taken up again; the state it leaves."""
    root = fresh_path(spark, "job")
    tables.publish_snapshot({"state": B.ad_state(spark, sf)}, f"{root}/state", "2001-11-01_00-00-00")
    new, old = B.new_sessions(spark, sf), B.old_sessions(spark, sf)
    for stage in (*job.STAGES[:-1], None):
        try:
            job.train_ads(new, old, root, "2001-12-01_00-00-00", B.NOW, job.BY_AXID, stop_after=stage)
        except job.Stopped:
            continue
    return job.latest_state(spark, f"{root}/state")


def _price_model(spark, sf) -> job.PriceModel:
    root = fresh_path(spark, "price")
    job.train_price(materialize(_bid_rows(spark, sf), "bids"), root, "2001-12-01_00-00-00")
    return job.load_price(spark, root)


def bid_model(spark, sf):
    """Train the global price model and give the mean predicted bid of every eligible creative."""
    price = _price_model(spark, sf)
    return job.predicted_bids(_training(spark, sf, "axid"), price)


def score_requests_learned(spark, sf):
    """Train every model of the registry and price all bid requests with the routed one."""
    meta, routes, default = _routing(spark, sf)
    flat = rows.training_rows(B.new_sessions(spark, sf), B.old_sessions(spark, sf), None, keep=KEEP)
    training_rows = materialize(rows.model_rows(derive_fields(flat), meta), "rows")
    dictionary = _dict(training_rows)
    encoded = materialize(vocab.encode_rows(training_rows, dictionary, ROW_COLUMNS), "encoded")
    folded = training.prepare(encoded, ["row_key"])
    full = materialize(models.variant_rows(folded, (models.FULL,)), "train")
    model = models.fit_tree_linear(full, _model_widths(dictionary))
    return _priced(
        scoring.score_requests_learned(
            B.bid_log(spark, sf), model, dictionary, routes, default, meta, B.bid_correction(spark, sf)
        )
    )


# -- models and reports -------------------------------------------------------


def _widths(spark, sf) -> DataFrame:
    """Dictionary size of every model of both levels."""
    meta = materialize(B.model_meta(spark, sf), "meta")
    flat = rows.training_rows(B.new_sessions(spark, sf), B.old_sessions(spark, sf), None, keep=KEEP)
    training = rows.model_rows(derive_fields(flat), meta)
    dictionary = vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), vocab.VOCABULARY))
    registry = tables.model_registry(meta, vocab.field_sizes(dictionary))
    return registry.withColumn("col_num", F.col("cols")).drop("cols")


def _meta_out(meta: DataFrame) -> DataFrame:
    return meta.withColumns(
        {"bid_constant": F.round("bid_constant", 4), "test_auc": F.round("test_auc", 6)}
    )


def model_meta(spark, sf):
    """Records written per ad and upserted by a later run that retrains the new era."""
    path = fresh_path(spark, "meta")
    meta = B.model_meta(spark, sf)
    meta.write.mode("overwrite").partitionBy("era").parquet(path)
    saved = spark.read.option("basePath", path).parquet(path).select(meta.columns)
    later = saved.where("era = 'new'").withColumns(
        {"trained_at": F.lit(B.NOW), "test_auc": F.col("test_auc") - 0.25}
    )
    return _meta_out(gates.upsert(saved, later, ["ad_id", "level", "era"]))


def model_registry(spark, sf):
    return _meta_out(_widths(spark, sf))


def trained_ids(spark, sf):
    meta = B.model_meta(spark, sf)
    campaigns = report.trained_ids(meta, 5).select("ad_id", F.lit("campaign").alias("kind"))
    creatives = report.trained_ids(meta, 6, exactly=False).select("ad_id", F.lit("creative").alias("kind"))
    return campaigns.unionByName(creatives)


def _state_now(spark, sf) -> DataFrame:
    """Counters of both levels and, for campaigns, of both eras."""
    new, old = B.session_core(spark, sf, B.SPLIT_DAY), B.session_core(spark, sf, end=B.SPLIT_DAY)
    parts = []
    for log, level, era in ((new, "axid", "new"), (new, "adid", "new"), (old, "adid", "old")):
        state = gates.state_rows(counts.ad_counts(log, level), level, B.NOW)
        parts.append(state.withColumn("era", F.lit(era)))
    state = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return state.withColumn("last_train_time", F.col("last_train_time") - (F.col("ad_id") % 48) * 3600.0)


def report_axid(spark, sf):
    """Written as one parquet file and as CSV; the parquet is read back."""
    path = fresh_path(spark, "report")
    state = _state_now(spark, sf).where("era = 'new'")
    names = materialize(B.ad_names(spark, sf), "names")
    out = report.report_axid(materialize(_widths(spark, sf), "meta"), state, names, B.id_map(spark, sf))
    out = materialize(out, "report")
    tables.write_report(out, path)
    tables.write_report_csv(out, f"{path}-csv")
    return _rounded(spark.read.parquet(path), "test_cvr", "zadid_test_cvr")


def report_adid(spark, sf):
    names = materialize(B.ad_names(spark, sf), "names")
    out = report.report_adid(materialize(_widths(spark, sf), "meta"), _state_now(spark, sf), names)
    return _rounded(out, "test_cvr")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def leaf_onehot(spark, sf):
    """Three given leaf numbers per row, fitted per campaign on the new range, applied to all rows."""
    def leaves(log: DataFrame) -> DataFrame:
        quantity = F.pmod(F.col("row_seq"), F.lit(7))
        return log.select(
            "row_key", F.col("ad.adid").alias("ad_id"),
            F.array(quantity, F.col("ad.axid") % 5, F.dayofmonth("date").cast("bigint")).alias("leaves"),
        )

    columns = materialize(leaf.leaf_columns(leaves(B.session_core(spark, sf, B.SPLIT_DAY))), "leaves")
    out = leaf.leaf_onehot(leaves(B.session_core(spark, sf)), columns, ["row_key"])
    return out.select("row_key", "ad_id", _joined("cols"))


# -- streams ------------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    schema = B.table(spark, sf, "events").schema
    return jobs.event_sessions(jobs.read_stream(spark, sf, schema, "events.parquet"))


def stream_ad_counts(spark, sf):
    return jobs.count_stream(spark, _event_stream(spark, sf))


def stream_daily_counts(spark, sf):
    daily = jobs.daily_stream(spark, _event_stream(spark, sf))
    return daily.withColumn("day", F.col("day").cast("date").cast("string"))


def stream_score(spark, sf):
    """Requests as a stream, scored with whatever run is the latest when their batch begins."""
    meta, routes, default = _routing(spark, sf)
    root = fresh_path(spark, "models")
    scoring.save_models(_smoothed_models(spark, sf, meta), meta, root, "2001-12-01_00-00-00")
    correction = materialize(B.bid_correction(spark, sf), "factors")
    handle = jobs.ModelHandle(spark, root, scoring.load_models)

    def score(batch: DataFrame) -> DataFrame:
        models, records = handle.current()
        requests = B.session_log(batch.sparkSession, sf, lineitem=batch.drop("_file")).where(F.col("_status") == "O")
        return scoring.score_requests(
            requests.drop("_status", "has_click", "has_active"), models, routes, default, records, correction
        )

    stream = jobs.read_stream(spark, sf, B.table(spark, sf, "lineitem").schema, "lineitem.parquet")
    return _priced(jobs.score_stream(spark, stream, score))


QUERIES: dict[str, Query] = {
    "scan_sessions": scan_sessions,
    "scan_bids": scan_bids,
    "ingest_window": ingest_window,
    "refresh_partitions": refresh_partitions,
    "counts_after_refresh": counts_after_refresh,
    "ad_names": ad_names,
    "ad_state_save": ad_state_save,
    "ad_state_load": ad_state_load,
    "ads_to_train": ads_to_train,
    "id_map_json": id_map_json,
    "id_map_from_json": id_map_from_json,
    "constants_load": constants_load,
    "read_text_parts": read_text_parts,
    "libsvm_roundtrip": libsvm_roundtrip,
    "publish_snapshot": publish_snapshot,
    "click_active": click_active,
    "session_counts": session_counts,
    "active_counts": active_counts,
    "click_active_counts": click_active_counts,
    "ad_counts": ad_counts,
    "id_pairs": id_pairs,
    "axid_to_adid": axid_to_adid,
    "adid_to_axids": adid_to_axids,
    "bidprice_by_ad": bidprice_by_ad,
    "eligible_ads": eligible_ads,
    "filter_ads": filter_ads,
    "retrain_gate_axid": retrain_gate_axid,
    "state_upsert": state_upsert,
    "date_bands": date_bands,
    "retrain_gate_windows": retrain_gate_windows,
    "flatten_log": flatten,
    "derive_fields": derive,
    "old_positives": old_positives,
    "window_negatives": window_negatives,
    "training_rows": training_rows,
    "window_training_rows": window_training_rows,
    "window_kept_rows": window_kept_rows,
    "bid_training_rows": bid_training_rows,
    "training_weights": training_weights,
    "tokenize": tokenize,
    "token_weights": token_weights,
    "token_distinct": token_distinct,
    "global_dict": global_dict,
    "bid_encode": bid_encode,
    "top_tokens": top_tokens,
    "cutoff_weight": cutoff_weight,
    "feature_dict": feature_dict,
    "field_sizes": field_sizes,
    "field_offsets": field_offsets,
    "encode_rows": encode_rows,
    "decode_features": decode_features,
    "to_vector": to_vector,
    "sample_fractions": sample_fractions,
    "stratified_sample": stratified_sample,
    "uniform_sample": uniform_sample,
    "fold_assign": fold_assign,
    "single_stats": single_stats,
    "pair_stats": pair_stats,
    "smoothed_scores": smoothed_scores,
    "score_mean": score_mean,
    "score_deviation": score_deviation,
    "score_logodds": score_logodds,
    "auc": auc,
    "discount": discount,
    "bid_average": bid_average,
    "bid_constant": bid_constant,
    "route_model": route_model,
    "route_model_by_auc": route_model_by_auc,
    "bid_price": bid_price,
    "score_requests": score_requests,
    "score_saved_models": score_saved_models,
    "score_stored_buckets": score_stored_buckets,
    "cross_auc": cross_auc,
    "cross_auc_given": cross_auc_given,
    "calibration_holds": calibration_holds,
    "tree_margin": tree_margin,
    "linear_predict": linear_predict,
    "bid_constant_predicted": bid_constant_predicted,
    "train_job_state": train_job_state,
    "cvr_model": cvr_model,
    "bid_model": bid_model,
    "score_requests_learned": score_requests_learned,
    "model_meta": model_meta,
    "model_registry": model_registry,
    "trained_ids": trained_ids,
    "report_axid": report_axid,
    "report_adid": report_adid,
    "leaf_onehot": leaf_onehot,
    "stream_ad_counts": stream_ad_counts,
    "stream_daily_counts": stream_daily_counts,
    "stream_score": stream_score,
}
