"""The training job, from the gate to publication, in stages that can be resumed.

Every stage writes its tables under the run's timestamp and a manifest last. A
job that is started again under the same timestamp reads the stages that have
one and goes on with the first that has not. Counters of the trained ads enter
the state only in the last stage, after the models are published.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_band
from ..functions.derive import add_click_active, derive_fields
from ..operators import calibrate, counts, gates, models, rows, sampling, vocab
from ..operators.boosting import BoostParams
from ..schemas import AD_STATE
from ..session import materialize
from ..sources import tables
from . import scoring, training


@dataclass(frozen=True)
class Trainer:
    """The switches of a training job. The defaults and the three trainers below."""

    level: str = "axid"
    more_than: int = 50
    gate: str = "growth"  # growth or stale, all, windows
    percent: int = 5
    stale_hours: int = 12
    previous_below: int = 360_000
    windows: int = 10
    sample_limit: int = 250_000
    sample_cap: int = 200_000
    vocabulary: int = vocab.VOCABULARY
    repeats: int = 5
    renew_bid_constant: bool = True
    params: BoostParams = field(default_factory=BoostParams)


BY_AXID = Trainer()
BY_ADID = Trainer(level="adid", more_than=20, gate="all", sample_limit=500_000, sample_cap=400_000)
BY_WINDOW = Trainer(level="adid", gate="windows", percent=10, sample_limit=500_000, sample_cap=400_000)

STAGES = ("ads", "rows", "encoded", "model", "meta", "published", "state")


class Stopped(Exception):
    """Raised after the stage at which a run was asked to stop."""


class Stages:
    """Tables of a run by stage, made once."""

    def __init__(self, spark: SparkSession, root: str, run_ts: str, stop_after: str | None = None):
        self.spark, self.root, self.run_ts, self.stop_after = spark, root, run_ts, stop_after
        self.made: list[str] = []

    def tables(self, stage: str, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        root = f"{self.root}/{stage}"
        if not tables.is_published(self.spark, root, self.run_ts):
            tables.publish_snapshot(make(), root, self.run_ts)
            self.made.append(stage)
        found = {name: tables.read_snapshot(self.spark, root, name, self.run_ts) for name in tables.table_names(self.spark, root, self.run_ts)}
        if stage == self.stop_after:
            raise Stopped(stage)
        return found


@dataclass
class PriceModel:
    """Trees of the bid price over one global dictionary."""

    trees: DataFrame
    dictionary: DataFrame
    params: BoostParams = models.PRICE_PARAMS


def train_price(bids: DataFrame, root: str, run_ts: str, params: BoostParams = models.PRICE_PARAMS) -> None:
    """Fit the price model on derived bid rows (row_key, bidprice, fields), a written table, and publish it."""
    dictionary = materialize(vocab.global_dict(vocab.token_distinct(bids)), "dict")
    encoded = materialize(vocab.encode_rows(bids, dictionary, ["row_key", "bidprice"], model=None), "encoded")
    tables.publish_snapshot({"trees": models.fit_price(encoded, params), "dictionary": dictionary}, f"{root}/price", run_ts)


def load_price(spark: SparkSession, root: str, params: BoostParams = models.PRICE_PARAMS) -> PriceModel:
    """The latest published price model."""
    run = tables.latest_run(spark, f"{root}/price")
    return PriceModel(*(tables.read_snapshot(spark, f"{root}/price", n, run) for n in ("trees", "dictionary")), params)


def predicted_bids(derived: DataFrame, price: PriceModel) -> DataFrame:
    """Mean predicted bid and row count per ad of derived rows (row_key, ad_id, fields), a written table."""
    encoded = vocab.encode_rows(derived, price.dictionary, ["row_key", "ad_id"], model=None)
    return calibrate.bid_average(models.predict_price(price.trees, encoded, price.params))


def chosen_ads(new: DataFrame, state: DataFrame, now: float, t: Trainer) -> DataFrame:
    """(ad_id, sessions, actives, click_actives, kept_band) of the ads to train."""
    if t.gate == "windows":
        banded = counts.counts_by_band(new, t.level)
        gated = gates.window_gate(gates.newest_bands(banded, t.windows), state, t.more_than, t.percent, t.previous_below)
        clicks = add_click_active(new).where("click_active = 1").groupBy(
            F.col(f"ad.{t.level}").alias("ad_id"), date_band(F.col("date")).alias("kept_band")
        ).agg(F.count(F.lit(1)).alias("click_actives"))
        found = gated.join(clicks, ["ad_id", "kept_band"], "left")
        return found.select("ad_id", "sessions", "actives", F.coalesce("click_actives", F.lit(0)).alias("click_actives"), "kept_band")
    worth = counts.eligible_ads(counts.ad_counts(new, t.level), more_than=t.more_than)
    if t.gate == "growth":
        train = gates.retrain_gate(worth, state, now, t.percent, t.stale_hours).where("train").select("ad_id")
        worth = worth.join(train, "ad_id", "left_semi")
    return worth.select("ad_id", "sessions", "actives", "click_actives", F.lit(None).cast("bigint").alias("kept_band"))


def train_ads(
    new: DataFrame,
    old: DataFrame,
    root: str,
    run_ts: str,
    now: float,
    t: Trainer = BY_AXID,
    price: PriceModel | None = None,
    stop_after: str | None = None,
) -> list[str]:
    """Run the job over session logs and return the stages that this call made.

    ``root`` holds stages, published models and state. For windows, ``new`` and
    ``old`` are the whole old range. Without a price model, or without
    ``renew_bid_constant``, the constants of the latest earlier run stay.
    """
    spark = new.sparkSession
    stages = Stages(spark, f"{root}/stages", run_ts, stop_after)
    state_root, models_root = f"{root}/state", f"{root}/models"

    def ads():
        state = latest_state(spark, state_root).where(F.col("level") == t.level)
        return {"ads": chosen_ads(new, state, now, t), "state": latest_state(spark, state_root)}

    begun = stages.tables("ads", ads)
    chosen = begun["ads"]

    def derived():
        if t.gate == "windows":
            flat = rows.kept_window_rows(new, old, chosen, ("row_key",))
        else:
            flat = rows.training_rows(new, old, chosen, t.level, ("row_key",))
        every = materialize(derive_fields(flat).withColumn("ad_id", F.col(t.level)), "derived")
        fractions = materialize(sampling.sample_fractions(every, t.sample_limit, t.sample_cap), "fractions")
        kept = sampling.stratified_sample(every, fractions, ["row_key"]).drop("fraction")
        return {"rows": kept, "fractions": fractions}

    sampled = stages.tables("rows", derived)

    def encoded():
        top = vocab.top_tokens(vocab.token_weights(sampled["rows"]), t.vocabulary)
        dictionary = materialize(vocab.feature_dict(top), "dict")
        carried = ["row_key", "has_active", "click_active", "bidprice", "winprice"]
        found = {"dictionary": dictionary, "encoded": vocab.encode_rows(sampled["rows"], dictionary, carried)}
        if price is not None and t.renew_bid_constant:
            found["bids"] = predicted_bids(sampled["rows"], price)
        return found

    features = stages.tables("encoded", encoded)

    def model():
        widths = materialize(features["dictionary"].groupBy("ad_id").agg(F.count(F.lit(1)).alias("width")), "widths")
        folded = training.prepare(features["encoded"], ["row_key"], repeats=t.repeats)
        clicks = chosen.where("click_actives > 0").select("ad_id", "click_actives")
        fitted = training.train(folded, widths, clicks, sampled["fractions"], t.params)
        return {**scoring.learned_tables(fitted.model), "trained": fitted.meta}

    learned = stages.tables("model", model)

    def meta():
        constants = _bid_constants(spark, models_root, features.get("bids"), chosen)
        era = "old" if t.gate == "windows" else "new"
        record = learned["trained"].join(constants, "ad_id", "left").select(
            "ad_id", F.lit(t.level).alias("level"), F.lit(era).alias("era"), F.lit(float(now)).alias("trained_at"),
            "discount", F.col("col_num").cast("bigint").alias("col_num"), "bid_constant", "test_auc",
        )
        return {"meta": record}

    record = stages.tables("meta", meta)["meta"]

    def published():
        model = scoring.learned_model(learned)
        scoring.save_learned(model, features["dictionary"], record, models_root, run_ts)
        return {"ads": record.select("ad_id")}

    done = stages.tables("published", published)

    def state():
        trained = chosen.join(done["ads"], "ad_id", "left_semi")
        after = gates.upsert(begun["state"], gates.state_rows(trained, t.level, now), ["ad_id", "level"])
        tables.publish_snapshot({"state": after}, state_root, run_ts)
        return {"ads": trained.select("ad_id")}

    stages.tables("state", state)
    return stages.made


def _bid_constants(spark: SparkSession, models_root: str, bids: DataFrame | None, chosen: DataFrame) -> DataFrame:
    previous = None
    if tables.has_run(spark, models_root):
        previous = tables.read_snapshot(spark, models_root, "meta").select("ad_id", "bid_constant")
    if bids is None:
        kept = chosen.select("ad_id")
        none = F.lit(None).cast("double").alias("bid_constant")
        return kept.join(previous, "ad_id", "left") if previous is not None else kept.select("ad_id", none)
    clicks = chosen.where("click_actives > 0").select("ad_id", "click_actives")
    return calibrate.bid_constant(bids, clicks, previous)


def latest_state(spark: SparkSession, root: str) -> DataFrame:
    """Counters of the latest run that ended, or none."""
    if not tables.has_run(spark, root):
        return spark.createDataFrame([], AD_STATE)
    return tables.read_snapshot(spark, root, "state").select([f.name for f in AD_STATE.fields])
