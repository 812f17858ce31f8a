"""Field lists and fixed schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Leaf paths of a bid log row, in feature order.
BID_PATHS = (
    "drt", "ad.adid", "ad.axid", "paytype", "product", "serv", "ad.ad_pkg", "ad.dspchn",
    "app.app_pkg", "app.name", "app.adxslotid", "app.slotid", "app.adplace_width",
    "app.adplace_height", "app.rtbchn", "app.app", "app.dsslotid", "network.carrier",
    "network.nettype", "geo.country", "geo.regionc", "geo.cityc", "geo.lat", "geo.lon",
    "device.brand", "device.model", "device.osv", "device.screen_width",
    "device.screen_height", "device.dv", "user.yob", "user.gender", "user.edu",
    "user.spec_usrtag", "user.data", "content.keyword", "content.cclabel", "content.cat1",
    "content.cat2", "content.author", "content.cont_id", "content.program", "bid.bidprice",
)

# What a session row has on top of a bid row.
SESSION_PATHS = ("has_active", "has_click", *BID_PATHS, "bid.winprice")

# Single-valued feature fields. The order sets the index order.
SINGLE_FIELDS = (
    "weekday", "time_zone", "minute", "paytype", "product", "serv", "ad_pkg", "dspchn",
    "app_pkg", "name", "adxslotid", "slotid", "adplace_width", "adplace_height", "rtbchn",
    "app", "dsslotid", "carrier", "nettype", "country", "regionc", "cityc", "lat", "lon",
    "brand", "model", "osv", "screen_width", "screen_height", "dv", "yob", "gender", "edu",
    "cat1", "cat2", "author", "cont_id", "program",
)

# Multi-valued feature fields, placed after the single-valued ones.
MULTI_FIELDS = ("spec_usrtag", "data", "keyword", "cclabel")

FEATURE_FIELDS = SINGLE_FIELDS + MULTI_FIELDS
FIELD_POS = {name: pos for pos, name in enumerate(FEATURE_FIELDS)}
FIRST_MULTI_POS = len(SINGLE_FIELDS)

# Product types of the bid log.
PRODUCT_TYPES = ("banner", "feed", "native", "spot", "video")


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TAGS = T.ArrayType(T.StringType())
_SEGMENTS = T.ArrayType(
    T.StructType([T.StructField("segment", T.ArrayType(_strings("value")))])
)

BID_LOG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("drt", T.StringType()),
        *_strings("paytype", "product", "serv").fields,
        T.StructField(
            "ad",
            T.StructType(
                [
                    T.StructField("adid", T.LongType()),
                    T.StructField("axid", T.LongType()),
                    *_strings("ad_pkg", "dspchn", "paytype").fields,
                ]
            ),
        ),
        T.StructField(
            "app",
            _strings("app_pkg", "name", "adxslotid", "slotid", "adplace_width",
                     "adplace_height", "rtbchn", "app", "dsslotid"),
        ),
        T.StructField("network", _strings("carrier", "nettype")),
        T.StructField("geo", _strings("country", "regionc", "cityc", "lat", "lon")),
        T.StructField(
            "device", _strings("brand", "model", "osv", "screen_width", "screen_height", "dv")
        ),
        T.StructField(
            "user",
            T.StructType(
                [
                    *_strings("yob", "gender", "edu").fields,
                    T.StructField("spec_usrtag", _TAGS),
                    T.StructField("data", _SEGMENTS),
                ]
            ),
        ),
        T.StructField(
            "content",
            T.StructType(
                [
                    T.StructField("keyword", _TAGS),
                    T.StructField("cclabel", _TAGS),
                    *_strings("cat1", "cat2", "author", "cont_id", "program").fields,
                ]
            ),
        ),
        T.StructField("bid", T.StructType([T.StructField("bidprice", T.DoubleType())])),
        T.StructField("producttype", T.StringType()),
    ]
)

SESSION_LOG = T.StructType(
    [f for f in BID_LOG.fields if f.name not in ("bid", "producttype")]
    + [
        T.StructField("has_click", T.IntegerType()),
        T.StructField("has_active", T.IntegerType()),
        T.StructField(
            "bid",
            T.StructType(
                [T.StructField("bidprice", T.DoubleType()), T.StructField("winprice", T.DoubleType())]
            ),
        ),
    ]
)

AD_STATE = T.StructType(
    [
        T.StructField("ad_id", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("sessions", T.LongType()),
        T.StructField("actives", T.LongType()),
        T.StructField("last_train_time", T.DoubleType()),
    ]
)

AD_NAMES = _strings("spotid", "adid", "remark")

MODEL_META = T.StructType(
    [
        T.StructField("ad_id", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("era", T.StringType()),
        T.StructField("trained_at", T.DoubleType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("col_num", T.LongType()),
        T.StructField("bid_constant", T.DoubleType()),
        T.StructField("test_auc", T.DoubleType()),
    ]
)
