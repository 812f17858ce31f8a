"""The given tables seen as ad logs.

One session per lineitem row; suppliers are creatives, their nations campaigns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counts as C
from ..operators import gates as G
from ..operators.lookup import direct
from ..schemas import PRODUCT_TYPES

# The new range starts here, everything before is the old range.
SPLIT_DAY = "2000-01-01"
# Fixed clock of the retrain gate: 2001-12-01 00:00 UTC.
NOW = 1_007_164_800.0
AXID_MORE_THAN = 50
ADID_MORE_THAN = 20
WINDOW_MORE_THAN = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Lineitem that is read in fewer pieces than cores is read by few tasks; spread its orders. Larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, "l_orderkey") if df.rdd.getNumPartitions() < cores else df


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _nulls(*names: str) -> dict[str, Column]:
    return {n: F.lit(None).cast("string") for n in names}


def _row_key() -> Column:
    parts = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.unix_timestamp("l_shipdate"), F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    ]
    return F.concat_ws("-", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])


def _outcomes(lineitem: DataFrame) -> DataFrame:
    return lineitem.withColumns(
        {
            "has_active": F.when(F.col("l_quantity") == 50, F.lit(None))
            .when(F.col("l_returnflag") == "R", 1)
            .otherwise(0)
            .cast("int"),
            "has_click": F.when(F.col("l_quantity") <= 2, F.lit(None))
            .when(F.col("l_linestatus") == "F", 1)
            .otherwise(0)
            .cast("int"),
        }
    )


def _flags(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """``lineitem`` with outcomes. It is not shuffled while suppliers are few."""
    nations = direct(supplier.select("s_suppkey", "s_nationkey"))
    return lineitem.join(nations, F.col("l_suppkey") == F.col("s_suppkey")).withColumns(
        {
            "row_key": _row_key(),
            "row_seq": F.col("l_orderkey") * 7 + F.col("l_linenumber"),
            "date": F.col("l_shipdate").cast("date"),
            "axid": F.lit(100000) + F.col("l_suppkey"),
            "adid": F.when(F.col("s_nationkey") == 0, F.lit(0))
            .otherwise(F.col("s_nationkey") + 10000)
            .cast("bigint"),
        }
    )


def _bid() -> Column:
    price = F.col("l_extendedprice")
    return _struct(bidprice=price, winprice=price * (1 - F.col("l_discount"))).alias("bid")


def _range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Days start <= date < end, on the stored timestamp so that the scan can skip row groups."""
    if start:
        df = df.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        df = df.where(F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
    return df


def session_core(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None, spread: bool = True
) -> DataFrame:
    """Sessions with ids, flags, date and prices only: enough for counting, with one small join."""
    lineitem = _range(table(spark, sf_dir, "lineitem"), start, end)
    lineitem = _spread(lineitem) if spread else lineitem
    return _flags(_outcomes(lineitem), table(spark, sf_dir, "supplier")).select(
        "row_key", "row_seq", "date", "has_click", "has_active",
        _struct(adid=F.col("adid"), axid=F.col("axid")).alias("ad"),
        _bid(),
    )


def session_log(
    spark: SparkSession,
    sf_dir: str,
    start: str | None = None,
    end: str | None = None,
    lineitem: DataFrame | None = None,
) -> DataFrame:
    """Sessions with the full nested log schema. ``lineitem``: a part of that table to use instead of the range.

    Lineitem goes through two shuffles, for its orders (which have met their
    customers) and its parts. Wide columns that derive from it come after these.
    """
    if lineitem is None:
        lineitem = _spread(_range(table(spark, sf_dir, "lineitem"), start, end))
    t = {n: table(spark, sf_dir, n) for n in ("supplier", "nation", "region", "part", "orders", "customer")}
    orders = (
        t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        .join(t["customer"].select("c_custkey", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .drop("o_custkey", "c_custkey")
    )
    parts = t["part"].select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    met = (
        _outcomes(lineitem)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    j = (
        _flags(met, t["supplier"])
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    moment = F.timestamp_seconds(
        F.unix_timestamp("l_shipdate") + F.col("l_linenumber") * 3600 + F.col("l_quantity").cast("bigint") * 60
    )
    drt = F.when(F.col("l_partkey") % 50 == 0, F.lit("bad")).otherwise(
        F.date_format(moment, "yyyy-MM-dd+HH:mm:ss")
    )
    osv = F.when(
        F.col("p_size") != 13,
        F.concat_ws(".", F.col("l_linenumber").cast("string"), F.col("p_size").cast("string")),
    )

    def segment(*values: Column) -> Column:
        return _struct(segment=F.array(*[_struct(value=v) for v in values]))

    data = F.array(segment(F.lit("x")), segment(F.col("p_type"), F.col("p_brand")))
    no_data = F.array().cast("array<struct<segment:array<struct<value:string>>>>")
    cclabel = (
        F.when(F.col("l_linenumber") == 7, F.array().cast("array<string>"))
        .when(F.col("l_linenumber") == 6, F.array(F.lit("")))
        .otherwise(F.array("c_mktsegment"))
    )
    return j.select(
        "row_key", "row_seq", "date", drt.alias("drt"), "has_click", "has_active",
        F.col("o_orderstatus").alias("paytype"),
        F.col("p_type").alias("product"),
        F.col("c_mktsegment").alias("serv"),
        _struct(adid=F.col("adid"), axid=F.col("axid"), **_nulls("ad_pkg", "dspchn", "paytype")).alias("ad"),
        _struct(
            **_nulls("app_pkg", "name", "adxslotid", "slotid", "adplace_width",
                     "adplace_height", "rtbchn", "app", "dsslotid")
        ).alias("app"),
        _struct(**_nulls("carrier", "nettype")).alias("network"),
        _struct(
            country=F.col("n_name"), regionc=F.col("r_name"),
            cityc=F.col("c_nationkey").cast("string"), **_nulls("lat", "lon"),
        ).alias("geo"),
        _struct(
            brand=F.col("p_brand"),
            model=F.concat_ws(",", "p_type", "p_brand"),
            osv=osv, **_nulls("screen_width", "screen_height", "dv"),
        ).alias("device"),
        _struct(
            **_nulls("yob", "gender", "edu"),
            spec_usrtag=F.array("o_orderpriority", "o_orderstatus", "o_orderstatus"),
            data=F.when(F.col("p_size") == 17, no_data).otherwise(data),
        ).alias("user"),
        _struct(
            keyword=F.split("p_name", " "), cclabel=cclabel,
            **_nulls("cat1", "cat2", "author", "cont_id", "program"),
        ).alias("content"),
        _bid(),
        F.element_at(F.array(*[F.lit(p) for p in PRODUCT_TYPES]), F.col("p_size") % 5 + 1).alias("producttype"),
        F.col("l_linestatus").alias("_status"),
    )


def new_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_log(spark, sf_dir, start=SPLIT_DAY).drop("_status", "producttype")


def old_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_log(spark, sf_dir, end=SPLIT_DAY).drop("_status", "producttype")


def bid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid requests: the open rows, without outcome columns."""
    return session_log(spark, sf_dir).where(F.col("_status") == "O").drop("_status", "has_click", "has_active")


def ad_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters remembered from an earlier run, made from the new range so that every gate case occurs."""
    counts = C.ad_counts(session_core(spark, sf_dir, SPLIT_DAY), "axid").where("ad_id % 5 != 0")
    half = F.expr("ad_id div 4")
    return counts.select(
        "ad_id",
        F.lit("axid").alias("level"),
        F.expr("sessions - (sessions * (ad_id % 4)) div 33").alias("sessions"),
        (F.col("actives") - half % 2).alias("actives"),
        (F.lit(NOW) - (half % 24) * 3600.0).alias("last_train_time"),
    )


def eligible(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    limit = AXID_MORE_THAN if level == "axid" else ADID_MORE_THAN
    return C.eligible_ads(C.ad_counts(session_core(spark, sf_dir, SPLIT_DAY), level), more_than=limit)


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.axid_to_adid(C.id_pairs(session_core(spark, sf_dir, SPLIT_DAY)))


def ad_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = C.axid_to_adid(C.id_pairs(session_core(spark, sf_dir)))
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("axid", F.lit(100000) + F.col("s_suppkey"))
        .join(pairs, "axid")
        .select(
            F.col("axid").cast("string").alias("spotid"),
            F.col("adid").cast("string").alias("adid"),
            F.col("s_name").alias("remark"),
        )
    )


def model_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model records as training would leave them: two thirds of the creatives, half of the campaigns."""
    core = session_core(spark, sf_dir, SPLIT_DAY)
    parts = []
    for level, limit, has_model in (
        ("axid", AXID_MORE_THAN, "ad_id % 3 != 0"),
        ("adid", ADID_MORE_THAN, "ad_id % 2 = 0 and ad_id != 0"),
    ):
        total = F.sum(F.col("bid.bidprice").cast("decimal(18,4)")).cast("double")
        prices = core.groupBy(F.col(f"ad.{level}").alias("ad_id")).agg(
            F.count(F.lit(1)).alias("sessions"),
            F.count_if(F.col("has_active") == 1).alias("actives"),
            F.count_if((F.col("has_active") == 1) & ~F.coalesce(F.col("has_click") == 0, F.lit(False))).alias("clicks"),
            (total / F.count("bid.bidprice")).alias("price"),
        )
        parts.append(
            prices.where(F.col("actives") > limit)
            .where(has_model)
            .select(
                "ad_id",
                F.lit(level).alias("level"),
                F.when(F.col("ad_id") % 4 == 0, "old").otherwise("new").alias("era"),
                (F.lit(NOW) - (F.col("ad_id") % 48) * 3600.0).alias("trained_at"),
                F.lit(0.8).alias("discount"),
                F.lit(None).cast("bigint").alias("col_num"),
                (F.col("price") * F.col("sessions") / F.nullif("clicks", F.lit(0))).alias("bid_constant"),
                (F.lit(0.5) + (F.col("ad_id") % 50) / F.lit(100.0)).alias("test_auc"),
            )
        )
    return parts[0].unionByName(parts[1])


def model_override(spark: SparkSession, sf_dir: str, default_model: int) -> DataFrame:
    axids = table(spark, sf_dir, "supplier").select((F.lit(100000) + F.col("s_suppkey")).alias("axid"))
    return axids.where("axid % 10 = 7").withColumn("model_id", F.lit(default_model).cast("bigint"))


def bid_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    axids = table(spark, sf_dir, "supplier").select((F.lit(100000) + F.col("s_suppkey")).alias("axid"))
    return axids.where("axid % 4 = 1").withColumn("factor", F.lit(1.1))


def default_model(meta: DataFrame) -> int:
    """The smallest campaign that has a model."""
    return meta.where(F.col("level") == "adid").agg(F.min("ad_id")).first()[0]
