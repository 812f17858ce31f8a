"""Hand-made rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlift.schemas import SESSION_LOG


def _tree(struct: T.StructType, values: dict):
    out = []
    for f in struct.fields:
        v = values.get(f.name)
        out.append(_tree(f.dataType, v or {}) if isinstance(f.dataType, T.StructType) else v)
    return tuple(out)


LOG = T.StructType([T.StructField("row_key", T.StringType()), *SESSION_LOG.fields])


def segments(*elements):
    """Data elements from lists of values; None for a NULL element."""
    return [None if e is None else ([None if v is None else (v,) for v in e],) for e in elements]


def session(key, **kw):
    """One session with usable fields unless said otherwise."""
    values = {
        "row_key": key,
        "drt": "2017-09-14+01:02:03",
        "has_click": 1,
        "has_active": 0,
        "ad": {"adid": 10001, "axid": 100001},
        "device": {"osv": "10.3.1", "model": "iPhone8,1"},
        "user": {"data": segments(["a"], ["x", "y"])},
        "content": {},
        "bid": {"bidprice": 1.0, "winprice": 0.5},
    }
    for name, v in kw.items():
        values[name] = {**values[name], **v} if isinstance(v, dict) else v
    return _tree(LOG, values)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def encoded(spark, rows, ad_id=1):
    """(idx, label) rows as encoded rows of one ad."""
    data = [(str(n), ad_id, list(idx), y, y) for n, (idx, y) in enumerate(rows)]
    return spark.createDataFrame(
        data, "row_key string, ad_id bigint, idx array<int>, has_active int, click_active int"
    )


def by(df, *keys):
    """Rows as a dict by key columns."""
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in keys)
        rest = {c: r[c] for c in df.columns if c not in keys}
        out[k if len(k) > 1 else k[0]] = rest
    return out


def col(df, name):
    return sorted(r[0] for r in df.select(F.col(name)).collect())
