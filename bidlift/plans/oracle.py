"""The named queries once more, as plain SQL over the given tables."""

from __future__ import annotations

from ..schemas import (
    BID_PATHS,
    FEATURE_FIELDS,
    FIRST_MULTI_POS,
    MULTI_FIELDS,
    PRODUCT_TYPES,
    SESSION_PATHS,
    SINGLE_FIELDS,
)
from . import catalog as Q
from . import testbed as B

_SET = {
    "paytype": "o_orderstatus",
    "product": "p_type",
    "serv": "c_mktsegment",
    "country": "n_name",
    "regionc": "r_name",
    "cityc": "CAST(c_nationkey AS VARCHAR)",
    "brand": "p_brand",
}
_EMPTY = [f for f in SINGLE_FIELDS if f not in _SET and f not in ("weekday", "time_zone", "minute", "osv", "model")]

_FLAGS = """
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(epoch(l_shipdate) AS BIGINT),
              CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_key,
    l_orderkey * 7 + l_linenumber AS row_seq,
    CAST(l_shipdate AS DATE) AS date,
    100000 + l_suppkey AS axid,
    CAST(CASE WHEN s_nationkey = 0 THEN 0 ELSE 10000 + s_nationkey END AS BIGINT) AS adid,
    CASE WHEN l_quantity = 50 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS has_active,
    CASE WHEN l_quantity <= 2 THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS has_click,
    CASE WHEN l_quantity > 2 AND l_linestatus <> 'F' AND l_returnflag = 'R' AND l_quantity <> 50 THEN 0
         WHEN l_quantity = 50 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS click_active,
    l_extendedprice AS bidprice, l_extendedprice * (1 - l_discount) AS winprice"""

_CORE = f"core AS (SELECT {_FLAGS} FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"
_NEW = f"date >= DATE '{B.SPLIT_DAY}'"
_OLD = f"date < DATE '{B.SPLIT_DAY}'"
_BAND = (
    "CAST(year(date) * 1000 + month(date) * 10 + least(CAST(floor(day(date) / 10.0) AS BIGINT), 2) AS BIGINT)"
)

_FULL = f"""full_log AS (
  SELECT {_FLAGS},
    l_linestatus AS status,
    CASE WHEN l_partkey % 50 = 0 THEN 'bad' ELSE strftime(moment, '%Y-%m-%d+%H:%M:%S') END AS drt,
    CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE moment END AS parsed,
    CASE WHEN p_size = 13 THEN NULL ELSE l_linenumber || '.' || p_size END AS osv,
    p_type || ',' || p_brand AS model,
    p_type, p_brand, p_size, l_linenumber,
    {", ".join(f"{sql} AS {name}" for name, sql in _SET.items())},
    {", ".join(f"CAST(NULL AS VARCHAR) AS {name}" for name in [*_EMPTY, "ad_paytype"])},
    [o_orderpriority, o_orderstatus, o_orderstatus] AS spec_usrtag,
    CASE WHEN p_size = 17 THEN '[]' ELSE
      '[{{"segment":[{{"value":"x"}}]}},{{"segment":[{{"value":"' || p_type || '"}},{{"value":"' || p_brand || '"}}]}}]'
      END AS data_json,
    CASE WHEN p_size = 17 THEN NULL ELSE [p_type, p_brand] END AS data,
    string_split(p_name, ' ') AS keyword,
    CASE WHEN l_linenumber = 7 THEN CAST([] AS VARCHAR[]) WHEN l_linenumber = 6 THEN [''] ELSE [c_mktsegment] END AS cclabel,
    CASE p_size % 5 {" ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PRODUCT_TYPES))} END AS producttype
  FROM (SELECT *, l_shipdate + to_hours(CAST(l_linenumber AS INTEGER)) + to_minutes(CAST(l_quantity AS INTEGER)) AS moment FROM lineitem)
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def _derived(source: str, name: str = "derived") -> str:
    """Derived rows of a relation with full_log's columns."""
    return f"""{name} AS (
  SELECT * REPLACE (split_part(osv, '.', 1) AS osv, split_part(model, ',', 1) AS model),
    CAST(isodow(parsed) - 1 AS VARCHAR) AS weekday, CAST(hour(parsed) AS VARCHAR) AS time_zone,
    CAST(minute(parsed) AS VARCHAR) AS minute
  FROM {source} WHERE parsed IS NOT NULL AND osv IS NOT NULL AND model IS NOT NULL AND data IS NOT NULL)"""


def _eligible(level: str, name: str = "ads") -> str:
    limit = B.AXID_MORE_THAN if level == "axid" else B.ADID_MORE_THAN
    return f"""{name} AS (
  SELECT {level} AS ad_id, count(*) AS sessions, count(*) FILTER (WHERE has_active = 1) AS actives,
    count(*) FILTER (WHERE click_active = 1) AS click_actives
  FROM core WHERE {_NEW} GROUP BY 1 HAVING count(*) FILTER (WHERE has_active = 1) > {limit})"""


def _training(level: str) -> str:
    """CTEs up to ``derived``: training rows of the eligible ads with ad_id."""
    return f"""{_CORE}, {_FULL}, {_eligible(level)},
chosen AS (
  SELECT *, {level} AS ad_id FROM full_log
  WHERE {level} IN (SELECT ad_id FROM ads) AND ({_NEW} OR has_active = 1)),
{_derived("chosen")}"""


def _tokens(source: str, columns: str, name: str = "tokens", weight: bool = True) -> str:
    w = (
        ", 1 + CASE WHEN has_active = 1 THEN 3 ELSE 0 END + CASE WHEN click_active = 1 THEN 6 ELSE 0 END AS w"
        if weight
        else ""
    )
    parts = [
        f"SELECT {columns}, {pos} AS field_pos, '{f}' AS field, {f} AS value{w} FROM {source} WHERE {f} IS NOT NULL"
        for pos, f in enumerate(SINGLE_FIELDS)
    ]
    parts += [
        f"SELECT {columns}, {FIRST_MULTI_POS + pos} AS field_pos, '{f}' AS field, unnest({f}) AS value{w} FROM {source}"
        for pos, f in enumerate(MULTI_FIELDS)
    ]
    return f"{name} AS (" + "\n  UNION ALL ".join(parts) + ")"


_WEIGHTS = "weights AS (SELECT ad_id, field_pos, field, value, CAST(sum(w) AS BIGINT) AS weight FROM tokens GROUP BY ALL)"


def _top(k: int) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY weight DESC, field_pos, value) AS rank FROM weights),
top_tokens AS (SELECT * FROM ranked WHERE rank <= {k})"""


_DICT = f"""dict AS (
  SELECT ad_id, field_pos, field, value, weight,
    row_number() OVER (PARTITION BY ad_id ORDER BY field_pos, weight DESC, value) - 1 AS global_idx,
    row_number() OVER (PARTITION BY ad_id, field_pos ORDER BY weight DESC, value)
      - CASE WHEN field_pos < {FIRST_MULTI_POS} THEN 0 ELSE 1 END AS local_idx
  FROM top_tokens WHERE field_pos < {FIRST_MULTI_POS} OR value <> '')"""


def _dict(level: str, k: int = 20_000) -> str:
    row = "row_key, ad_id, has_active, click_active"
    return f"{_training(level)}, {_tokens('derived', row)}, {_WEIGHTS}, {_top(k)}, {_DICT}"


def _encoded(rows: str = "derived", model: str = "ad_id", keep: str = "has_active, click_active") -> str:
    """``enc``: one row per input row with its sorted distinct indices."""
    r_keep = ", ".join(f"r.{c.strip()}" for c in keep.split(","))
    return f"""hits AS (
  SELECT t.row_key, t.{model}, list_sort(list_distinct(list(d.global_idx))) AS idx
  FROM tokens t JOIN dict d ON t.{model} = d.ad_id AND t.field_pos = d.field_pos AND t.value = d.value
  GROUP BY 1, 2),
enc AS (
  SELECT r.row_key, r.{model} AS ad_id, {r_keep}, coalesce(h.idx, []) AS idx
  FROM {rows} r LEFT JOIN hits h ON r.row_key = h.row_key AND r.{model} = h.{model})"""


_FLAT_IDX = "flat_idx AS (SELECT row_key, ad_id, has_active, unnest(idx) AS i FROM enc)"
_PAIRS = """pairs AS (
  SELECT a.row_key, a.ad_id, a.has_active, a.i AS i, b.i AS j
  FROM flat_idx a JOIN flat_idx b ON a.row_key = b.row_key AND a.ad_id = b.ad_id AND a.i < b.i)"""
_BASE = "base AS (SELECT ad_id, count(*) FILTER (WHERE has_active = 1) / count(*) AS average FROM enc GROUP BY 1)"
_STATS = """stats AS (
  SELECT ad_id, i, -1 AS j, count(*) FILTER (WHERE has_active = 1) AS pos, count(*) AS tot FROM flat_idx GROUP BY 1, 2
  UNION ALL
  SELECT ad_id, i, j, count(*) FILTER (WHERE has_active = 1) AS pos, count(*) AS tot FROM pairs GROUP BY 1, 2, 3)"""
_SMOOTH = "smooth AS (SELECT s.*, (pos + average * 3.0) / (tot + 3.0) AS score FROM stats s JOIN base USING (ad_id))"


def _smoothing(level: str = "adid") -> str:
    return f"{_dict(level)}, {_encoded()}, {_FLAT_IDX}, {_PAIRS}, {_BASE}, {_STATS}, {_SMOOTH}"


_DISCOUNT_ROWS = f"""{_training("adid")},
drawn AS (SELECT ad_id, CASE WHEN count(*) > {Q.DISCOUNT_LIMIT} THEN {Q.DISCOUNT_CAP} / count(*) ELSE CAST(1 AS DOUBLE) END AS fraction
  FROM derived GROUP BY 1),
sampled AS (SELECT d.* FROM derived d JOIN drawn f USING (ad_id) WHERE f.fraction >= 1 OR has_active = 1
  OR (has_active = 0 AND row_seq * 7919 % 1000000 < f.fraction * 1000000)),
{_tokens("sampled", "row_key, ad_id, has_active, click_active")}, {_WEIGHTS}, {_top(20_000)}, {_DICT}, {_encoded("sampled")}"""


def _scored(num: str, den: str, weight: float, final: str) -> str:
    """``scored``: score per row of ``enc`` from the terms of its keys."""
    return f"""keyed AS (
  SELECT row_key, ad_id, i, -1 AS j, CAST({weight} AS DOUBLE) AS w FROM flat_idx
  UNION ALL SELECT row_key, ad_id, i, j, CAST(1 AS DOUBLE) AS w FROM pairs),
terms AS (
  SELECT k.row_key, k.ad_id, k.w, b.average, coalesce(s.score, b.average) AS s
  FROM keyed k JOIN base b USING (ad_id) LEFT JOIN smooth s ON k.ad_id = s.ad_id AND k.i = s.i AND k.j = s.j),
sums AS (SELECT row_key, ad_id, sum({num}) AS num, sum({den}) AS den FROM terms GROUP BY 1, 2),
scored AS (
  SELECT e.row_key, e.ad_id, e.has_active, e.click_active, {final} AS score
  FROM enc e LEFT JOIN sums USING (row_key, ad_id))"""


_RATIO = "CASE WHEN den > 0 THEN num / den END"
_MEAN = _scored("w * s", "w", 0, _RATIO)


def _flat_columns(paths: tuple[str, ...], data: str) -> str:
    names = []
    for path in paths:
        name = path.split(".")[-1]
        if name == "data":
            names.append(f"{data} AS data")
        elif name in MULTI_FIELDS:
            names.append(f"array_to_string({name}, ',') AS {name}")
        elif name in ("bidprice", "winprice"):
            names.append(f"round({name}, 6) AS {name}")
        else:
            names.append(name)
    return ", ".join(names)


_SLIM = "row_key, axid, has_click, has_active, click_active"


def _days(back: int, until: int) -> str:
    return f"date BETWEEN DATE '{B_TODAY}' - INTERVAL {back} DAY AND DATE '{B_TODAY}' - INTERVAL {until} DAY"


B_TODAY = Q.TODAY.isoformat()

_STATE = f"""state AS (
  SELECT axid AS ad_id, 'axid' AS level, count(*) - (count(*) * (axid % 4)) // 33 AS sessions,
    count(*) FILTER (WHERE has_active = 1) - (axid // 4) % 2 AS actives,
    CAST({B.NOW} - ((axid // 4) % 24) * 3600 AS DOUBLE) AS last_train_time
  FROM core WHERE {_NEW} AND axid % 5 <> 0 GROUP BY axid)"""

_GATE = f"""gate AS (
  SELECT a.ad_id, a.sessions, a.actives, a.click_actives, coalesce(s.sessions, 0) AS sessions_old,
    coalesce(s.actives, 0) AS actives_old, coalesce(s.last_train_time, 0) AS last_train_time,
    round((a.sessions - coalesce(s.sessions, 0)) / a.sessions, 6) AS growth,
    (20 * (a.sessions - coalesce(s.sessions, 0)) > a.sessions
      OR ({B.NOW} - coalesce(s.last_train_time, 0) > 43200 AND a.actives > coalesce(s.actives, 0))) AS train
  FROM ads a LEFT JOIN state s ON a.ad_id = s.ad_id)"""

_IDMAP = f"idmap AS (SELECT axid, max(adid) AS adid FROM core WHERE {_NEW} AND adid <> 0 GROUP BY axid)"


def _meta_part(level: str, limit: int, has: str) -> str:
    return f"""SELECT {level} AS ad_id, '{level}' AS level,
    CASE WHEN {level} % 4 = 0 THEN 'old' ELSE 'new' END AS era,
    CAST({B.NOW} - ({level} % 48) * 3600 AS DOUBLE) AS trained_at,
    CAST(0.8 AS DOUBLE) AS discount, CAST(NULL AS BIGINT) AS col_num,
    CAST(sum(CAST(bidprice AS DECIMAL(18,4))) AS DOUBLE) / count(bidprice) * count(*)
      / nullif(count(*) FILTER (WHERE click_active = 1), 0) AS bid_constant,
    0.5 + ({level} % 50) / 100.0::DOUBLE AS test_auc
  FROM core WHERE {_NEW} AND {has} GROUP BY {level} HAVING count(*) FILTER (WHERE has_active = 1) > {limit}"""


_META = f"""meta AS (
  {_meta_part("axid", B.AXID_MORE_THAN, "axid % 3 <> 0")}
  UNION ALL {_meta_part("adid", B.ADID_MORE_THAN, "adid % 2 = 0 AND adid <> 0")})"""

_ROUTES = """dm AS (SELECT min(ad_id) AS id FROM meta WHERE level = 'adid'),
ov AS (SELECT 100000 + s_suppkey AS axid FROM supplier WHERE (100000 + s_suppkey) % 10 = 7),
routes AS (
  SELECT 100000 + s_suppkey AS axid,
    coalesce(CASE WHEN o.axid IS NOT NULL THEN dm.id END, own.ad_id, par.ad_id, dm.id) AS use_model
  FROM supplier CROSS JOIN dm LEFT JOIN ov o ON o.axid = 100000 + s_suppkey
  LEFT JOIN meta own ON own.ad_id = 100000 + s_suppkey
  LEFT JOIN idmap m ON m.axid = 100000 + s_suppkey LEFT JOIN meta par ON par.ad_id = m.adid)"""

_PRICED = """SELECT r.row_key, r.axid, r.use_model, round(r.p, 6) AS p, round(r.p * m.discount, 6) AS cvr,
    round(r.p * m.discount * m.bid_constant * CASE WHEN r.axid % 4 = 1 THEN CAST(1.1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END, 4) AS bid
  FROM requests r LEFT JOIN meta m ON m.ad_id = r.use_model"""

_MODEL_ROWS = f"""{_CORE}, {_FULL}, {_META},
all_rows AS (SELECT *, axid AS ad_id FROM full_log UNION ALL SELECT *, adid AS ad_id FROM full_log),
chosen AS (SELECT * FROM all_rows WHERE ad_id IN (SELECT ad_id FROM meta) AND ({_NEW} OR has_active = 1)),
{_derived("chosen")}, {_tokens("derived", "row_key, ad_id, has_active, click_active")}, {_WEIGHTS}"""

_REQUESTS = f"""{_MODEL_ROWS}, {_top(20_000)}, {_DICT}, {_encoded()}, {_FLAT_IDX}, {_PAIRS}, {_BASE}, {_STATS}, {_SMOOTH},
{_IDMAP}, {_ROUTES},
asked AS (
  SELECT f.*, r.use_model FROM full_log f JOIN routes r USING (axid) WHERE status = 'O'),
{_derived("asked", "request_rows")}, {_tokens("request_rows", "row_key, use_model", "request_tokens", weight=False)},
request_idx AS (
  SELECT DISTINCT t.row_key, t.use_model, d.global_idx AS i FROM request_tokens t JOIN dict d
  ON t.use_model = d.ad_id AND t.field_pos = d.field_pos AND t.value = d.value),
request_terms AS (
  SELECT a.row_key, coalesce(s.score, b.average) AS s
  FROM request_idx a JOIN request_idx c ON a.row_key = c.row_key AND a.i < c.i
  JOIN base b ON b.ad_id = a.use_model
  LEFT JOIN smooth s ON s.ad_id = a.use_model AND s.i = a.i AND s.j = c.i),
request_scores AS (SELECT row_key, sum(s) / count(*) AS score FROM request_terms GROUP BY 1),
requests AS (
  SELECT q.row_key, q.axid, q.use_model, coalesce(s.score, b.average) AS p
  FROM asked q LEFT JOIN request_scores s USING (row_key) LEFT JOIN base b ON b.ad_id = q.use_model)"""

_WIDTHS = f"""{_MODEL_ROWS}, {_top(20_000)}, {_DICT},
widths AS (SELECT ad_id, count(*) AS cols FROM dict GROUP BY 1),
full_meta AS (SELECT m.* EXCLUDE (col_num), w.cols AS col_num FROM meta m LEFT JOIN widths w ON m.ad_id = w.ad_id)"""

_STATE_NOW = f"""state_now AS (
  SELECT ad_id, era, count(*) AS session, count(*) FILTER (WHERE has_active = 1) AS has_active,
    strftime(to_timestamp(CAST({B.NOW} AS BIGINT) - (ad_id % 48) * 3600 + 28800) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS update_time
  FROM (SELECT axid AS ad_id, 'new' AS era, has_active FROM core WHERE {_NEW}
        UNION ALL SELECT adid, 'new', has_active FROM core WHERE {_NEW}
        UNION ALL SELECT adid, 'old', has_active FROM core WHERE {_OLD}) GROUP BY 1, 2)"""

_NAMES = """names AS (SELECT m.axid AS spotid, m.adid, s_name AS remark
  FROM (SELECT axid, max(adid) AS adid FROM core WHERE adid <> 0 GROUP BY axid) m
  JOIN supplier ON m.axid = 100000 + s_suppkey)"""

_BIDS_ONLY = f"""bid_rows AS (
  SELECT * FROM full_log WHERE status = 'O' AND axid % 4 = 1
  UNION ALL SELECT * FROM full_log WHERE {_NEW}),
{_derived("bid_rows", "bid_derived")}, {_tokens("bid_derived", "0 AS z", "bid_tokens", weight=False)}"""

_BIDS = f"{_CORE}, {_FULL}, {_BIDS_ONLY}"

_GDICT = f"""gdict AS (
  SELECT field_pos, field, value,
    row_number() OVER (ORDER BY field_pos, substr(md5(value), 1, 3), value) - 1 AS global_idx
  FROM (SELECT DISTINCT field_pos, field, value FROM bid_tokens)
  WHERE field_pos < {FIRST_MULTI_POS} OR value <> '')"""

_LEVELS = """SELECT {level} AS ad_id, count(*) AS num, '{level}' AS level,
  row_number() OVER (ORDER BY count(*) DESC, {level}) AS rank FROM core WHERE {where} GROUP BY 1"""


def _by_level(where: str) -> str:
    return (
        f"WITH {_CORE} " + _LEVELS.format(level="axid", where=where)
        + " UNION ALL " + _LEVELS.format(level="adid", where=where)
    )


def _libsvm_line() -> str:
    return (
        "'(' || (SELECT max(global_idx) + 1 FROM dict) || ',[' || array_to_string(idx, ',') || '],['"
        " || array_to_string(list_transform(idx, lambda x: '1.0'), ',') || '])'"
    )


_EVENTS = """ev AS (
  SELECT ts, 100000 + user_id % 10 AS ad_id, CAST(event_type = 'click' AS INTEGER) AS c,
    CAST(event_type = 'purchase' AS INTEGER) AS a FROM events)"""

_SAMPLED = f"""frac AS (
  SELECT axid AS ad_id, count(*) AS num,
    CASE WHEN count(*) > {Q.SAMPLE_LIMIT} THEN {Q.SAMPLE_CAP} / count(*) ELSE CAST(1 AS DOUBLE) END AS fraction
  FROM core GROUP BY 1)"""

_BANDS = f"""bands AS (SELECT adid AS ad_id, {_BAND} AS band, count(*) AS sessions,
    count(*) FILTER (WHERE has_active = 1) AS actives FROM core GROUP BY 1, 2),
newest AS (SELECT band, row_number() OVER (ORDER BY band DESC) AS widx FROM (SELECT DISTINCT band FROM bands)
  QUALIFY widx <= 10)"""

_KEPT = f"""WITH RECURSIVE {_CORE}, {_BANDS},
steps AS (SELECT b.*, row_number() OVER (PARTITION BY ad_id ORDER BY widx) AS n
  FROM bands b JOIN newest USING (band) WHERE actives > {B.WINDOW_MORE_THAN}),
walk AS (
  SELECT ad_id, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS sessions, CAST(0 AS BIGINT) AS actives,
    CAST('' AS VARCHAR) AS trained_bands, CAST(NULL AS BIGINT) AS kept_band
  FROM (SELECT DISTINCT ad_id FROM steps)
  UNION ALL
  SELECT w.ad_id, s.n, CASE WHEN ok THEN s.sessions ELSE w.sessions END,
    CASE WHEN ok THEN s.actives ELSE w.actives END,
    CASE WHEN NOT ok THEN w.trained_bands WHEN w.trained_bands = '' THEN CAST(s.band AS VARCHAR)
         ELSE w.trained_bands || ',' || s.band END,
    CASE WHEN ok THEN s.band ELSE w.kept_band END
  FROM walk w JOIN steps s ON s.ad_id = w.ad_id AND s.n = w.n + 1,
  LATERAL (SELECT 10 * (s.sessions - w.sessions) > s.sessions AND w.sessions < 360000 AS ok)),
kept AS (SELECT ad_id, sessions, actives, trained_bands, kept_band FROM walk
WHERE kept_band IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY n DESC) = 1)"""

def _leaf(idx: str, tree: str) -> str:
    """The leaf of given tree ``tree`` that a row with indices ``idx`` ends in."""
    def hit(node: str) -> str:
        return f"CAST(list_contains({idx}, ({tree} * 13 + ({node}) * 5) % {Q.GIVEN_COLUMNS}) AS INTEGER)"

    second = f"2 + {hit('1')}"
    return f"(2 * ({second}) + {hit(second)})"


_MARGIN = f"""{_training("axid")}, {_tokens("derived", "row_key, ad_id")}, {_BIDS_ONLY}, {_GDICT},
hits AS (SELECT DISTINCT t.row_key, t.ad_id, d.global_idx AS i FROM tokens t JOIN gdict d ON t.field_pos = d.field_pos AND t.value = d.value),
found AS (SELECT row_key, ad_id, list(i) AS idx FROM hits GROUP BY 1, 2),
listed AS (SELECT r.row_key, r.ad_id, coalesce(f.idx, []) AS idx FROM derived r LEFT JOIN found f ON f.row_key = r.row_key AND f.ad_id = r.ad_id),
walked AS (SELECT row_key, ad_id, t, {_leaf("idx", "t")} AS leaf FROM listed, (SELECT unnest(range({Q.GIVEN.trees})) AS t)),
margins AS (SELECT row_key, ad_id, {Q.GIVEN.base} + sum(((t * 31 + leaf * 17) % 101 - 40) / 8.0::DOUBLE) AS margin FROM walked GROUP BY 1, 2)"""

_LINEAR = f"""{_dict("adid")}, {_encoded()},
width AS (SELECT ad_id, count(*) AS w FROM dict GROUP BY 1),
cols AS (
  SELECT row_key, e.ad_id, unnest(idx) AS col FROM enc e
  UNION ALL SELECT row_key, e.ad_id, w + t * 8 + {_leaf("idx", "t")} FROM enc e JOIN width USING (ad_id), (SELECT unnest(range({Q.GIVEN.trees})) AS t)
  UNION ALL SELECT row_key, e.ad_id, w + {Q.GIVEN.trees} * 8 FROM enc e JOIN width USING (ad_id)),
sums AS (SELECT row_key, ad_id, coalesce(sum(((col * 37 + ad_id) % 41 - 20) / 40.0::DOUBLE) FILTER (WHERE (col * 7 + ad_id) % 5 < 2), 0) AS z
  FROM cols GROUP BY 1, 2)"""

ORACLE: dict[str, str] = {
    "scan_sessions": f"""WITH {_CORE} SELECT row_key, CAST(date AS VARCHAR) AS date, has_click, has_active, axid, adid
FROM core WHERE date >= DATE '2000-09-01' AND date < DATE '2000-09-23'""",
    "scan_bids": f"""WITH {_FULL} SELECT row_key, producttype, CAST(date AS VARCHAR) AS date, axid, round(bidprice, 6) AS bidprice
FROM full_log WHERE status = 'O' AND {_days(5, 1)}""",
    "ingest_window": f"""WITH {_CORE} SELECT CAST(date AS VARCHAR) AS date, count(*) AS num, count(*) FILTER (WHERE has_active = 1) AS actives
FROM core WHERE {_days(35, 1)} GROUP BY 1""",
    "refresh_partitions": f"""WITH {_CORE} SELECT CAST(date AS VARCHAR) AS date, count(*) AS num,
  CASE WHEN date >= DATE '{B_TODAY}' - INTERVAL 10 DAY THEN count(*) FILTER (WHERE has_active = 1) ELSE 0 END AS actives
FROM core WHERE {_days(35, 0)} GROUP BY core.date""",
    "counts_after_refresh": f"""WITH {_CORE}, logged AS (
  SELECT axid, adid, CASE WHEN date >= DATE '{B_TODAY}' - INTERVAL 10 DAY THEN has_active ELSE 0 END AS a,
    CASE WHEN date >= DATE '{B_TODAY}' - INTERVAL 10 DAY THEN click_active ELSE 0 END AS c
  FROM core WHERE {_days(35, 0)})
SELECT axid AS ad_id, 'axid' AS level, count(*) AS sessions, count(*) FILTER (WHERE a = 1) AS actives, count(*) FILTER (WHERE c = 1) AS click_actives
FROM logged GROUP BY 1 UNION ALL
SELECT adid, 'adid', count(*), count(*) FILTER (WHERE a = 1), count(*) FILTER (WHERE c = 1) FROM logged GROUP BY 1""",
    "ad_names": f"""WITH {_CORE}, {_NAMES} SELECT spotid AS ad_id, remark, 'axid' AS level FROM names
UNION ALL SELECT adid, arg_max(remark, spotid), 'adid' FROM names GROUP BY adid""",
    "ad_state_save": f"WITH {_CORE}, {_STATE} SELECT * FROM state",
    "ad_state_load": f"""WITH {_CORE} SELECT axid AS ad_id, 'axid' AS level, count(*) AS sessions,
  count(*) FILTER (WHERE has_active = 1) AS actives, CAST({B.NOW} AS DOUBLE) AS last_train_time FROM core WHERE {_NEW} GROUP BY 1""",
    "ads_to_train": f"""WITH {_CORE}, {_eligible("axid")}, {_STATE}, {_GATE}
SELECT CAST(ad_id AS VARCHAR) AS ad_id FROM gate WHERE train""",
    "id_map_json": f"""WITH {_CORE}, {_IDMAP}
SELECT '{{' || string_agg('"' || axid || '":' || adid, ',' ORDER BY axid) || '}}' AS value FROM idmap""",
    "id_map_from_json": f"WITH {_CORE}, {_IDMAP} SELECT * FROM idmap",
    "constants_load": """SELECT 100000 + s_suppkey AS axid, CAST(1.1 AS DOUBLE) AS factor FROM supplier
WHERE (100000 + s_suppkey) % 4 = 1""",
    "read_text_parts": f"""WITH {_CORE}, {_eligible("axid")}, {_eligible("adid", "camp")}
SELECT CAST(ad_id AS VARCHAR) AS line FROM ads UNION ALL SELECT CAST(ad_id AS VARCHAR) FROM camp""",
    "libsvm_roundtrip": f"""WITH {_dict("axid")}, {_encoded()}
SELECT CAST(coalesce(has_active, 0) AS BIGINT) AS label, {_libsvm_line()} AS features FROM enc""",
    "publish_snapshot": f"""WITH {_CORE} SELECT axid AS ad_id, count(*) AS sessions, count(*) FILTER (WHERE has_active = 1) AS actives,
  count(*) FILTER (WHERE click_active = 1) AS click_actives FROM core GROUP BY 1""",
    "click_active": f"WITH {_CORE} SELECT row_key, has_click, has_active, click_active FROM core",
    "session_counts": _by_level(_NEW),
    "active_counts": _by_level(f"{_NEW} AND has_active = 1"),
    "click_active_counts": _by_level(f"{_NEW} AND click_active = 1"),
    "ad_counts": f"WITH {_CORE} " + " UNION ALL ".join(
        f"""SELECT {level} AS ad_id, count(*) AS sessions, count(*) FILTER (WHERE has_active = 1) AS actives,
  count(*) FILTER (WHERE click_active = 1) AS click_actives, '{level}' AS level FROM core GROUP BY 1"""
        for level in ("axid", "adid")
    ),
    "id_pairs": f"WITH {_CORE} SELECT DISTINCT axid, adid FROM core WHERE adid <> 0",
    "axid_to_adid": f"WITH {_CORE} SELECT axid, max(adid) AS adid FROM core WHERE adid <> 0 GROUP BY 1",
    "adid_to_axids": f"""WITH {_CORE} SELECT adid, string_agg(axid, ',' ORDER BY axid) AS axids
FROM (SELECT DISTINCT axid, adid FROM core WHERE adid <> 0) GROUP BY 1""",
    "bidprice_by_ad": f"""WITH {_CORE} SELECT adid, axid,
  round(CAST(sum(CAST(bidprice AS DECIMAL(18,4))) AS DOUBLE) / count(bidprice), 6) AS bidprice FROM core GROUP BY 1, 2""",
    "eligible_ads": f"""WITH {_CORE}, {_eligible("axid")}, {_eligible("adid", "camp")}
SELECT *, 'axid' AS level FROM ads UNION ALL SELECT *, 'adid' FROM camp
UNION ALL SELECT axid, count(*), count(*) FILTER (WHERE has_active = 1), count(*) FILTER (WHERE click_active = 1), 'fixed'
FROM core WHERE {_NEW} AND axid % 4 = 1 GROUP BY 1""",
    "filter_ads": f"""WITH {_CORE}, {_eligible("axid")} SELECT row_key, axid FROM core
WHERE {_NEW} AND axid IN (SELECT ad_id FROM ads)""",
    "retrain_gate_axid": f"""WITH {_CORE}, {_eligible("axid")}, {_STATE}, {_GATE} SELECT * FROM gate""",
    "state_upsert": f"""WITH {_CORE}, {_eligible("axid")}, {_STATE}, {_GATE}
SELECT coalesce(s.ad_id, g.ad_id) AS ad_id, 'axid' AS level, coalesce(g.sessions, s.sessions) AS sessions,
  coalesce(g.actives, s.actives) AS actives,
  CASE WHEN g.ad_id IS NULL THEN s.last_train_time ELSE CAST({B.NOW} AS DOUBLE) END AS last_train_time
FROM state s FULL JOIN (SELECT * FROM gate WHERE train) g ON s.ad_id = g.ad_id""",
    "date_bands": f"""WITH {_CORE} SELECT {_BAND} AS band, CAST(min(date) AS VARCHAR) AS first_day,
  CAST(max(date) AS VARCHAR) AS last_day, count(*) AS num FROM core GROUP BY 1""",
    "retrain_gate_windows": f"{_KEPT} SELECT ad_id, sessions, actives, trained_bands, kept_band FROM kept",
    "flatten_log": f"""WITH {_FULL} SELECT row_key, ad_paytype, {_flat_columns(SESSION_PATHS, "data_json")} FROM full_log""",
    "derive_fields": f"""WITH {_FULL}, {_derived("full_log")} SELECT row_key, ad_paytype, click_active, weekday, time_zone, minute,
  {_flat_columns(tuple(p for p in SESSION_PATHS if p != "drt"), "array_to_string(data, ',')")} FROM derived""",
    "old_positives": f"WITH {_CORE} SELECT {_SLIM} FROM core WHERE {_OLD} AND has_active = 1",
    "window_negatives": f"WITH {_CORE} SELECT {_SLIM} FROM core WHERE {_NEW} AND has_active <> 1",
    "training_rows": f"""WITH {_CORE}, {_FULL}, {_eligible("axid")}
SELECT row_key, click_active, ad_paytype, {_flat_columns(SESSION_PATHS, "data_json")} FROM full_log
WHERE axid IN (SELECT ad_id FROM ads) AND ({_NEW} OR has_active = 1)""",
    "window_training_rows": f"""WITH {_CORE}, {_FULL}, {_BANDS},
win AS (SELECT max(band) AS band FROM bands),
camp AS (SELECT ad_id FROM bands JOIN win USING (band) WHERE actives > {B.WINDOW_MORE_THAN})
SELECT row_key, click_active, ad_paytype, {_flat_columns(SESSION_PATHS, "data_json")} FROM full_log
WHERE adid IN (SELECT ad_id FROM camp)
  AND (has_active = 1 OR (has_active <> 1 AND {_BAND} = (SELECT band FROM win)))""",
    "window_kept_rows": f"""{_KEPT},
{_FULL}
SELECT row_key, click_active, ad_paytype, {_flat_columns(SESSION_PATHS, "data_json")} FROM full_log f JOIN kept k ON f.adid = k.ad_id
WHERE has_active = 1 OR (has_active <> 1 AND {_BAND} = kept_band)""",
    "bid_training_rows": f"""WITH {_CORE}, {_FULL}
SELECT row_key, ad_paytype, {_flat_columns(BID_PATHS, "data_json")} FROM full_log WHERE status = 'O' AND axid % 4 = 1
UNION ALL SELECT row_key, ad_paytype, {_flat_columns(BID_PATHS, "data_json")} FROM full_log WHERE {_NEW}""",
    "training_weights": f"""WITH {_CORE} SELECT row_key, click_active,
  CAST(CASE WHEN click_active = 1 THEN 6 ELSE 1 END AS BIGINT) AS weight FROM core""",
    "tokenize": f"""WITH {_training("axid")}, {_tokens("derived", "row_key, ad_id")}
SELECT row_key, ad_id, CAST(field_pos AS BIGINT) AS field_pos, value, field || '_:_' || value AS token,
  CAST(w AS BIGINT) AS w FROM tokens""",
    "token_weights": f"""WITH {_training("axid")}, {_tokens("derived", "row_key, ad_id")}, {_WEIGHTS}
SELECT ad_id, field, value, weight FROM weights""",
    "token_distinct": f"WITH {_BIDS} SELECT DISTINCT field, value FROM bid_tokens",
    "global_dict": f"WITH {_BIDS}, {_GDICT} SELECT field, value, global_idx FROM gdict",
    "bid_encode": f"""WITH {_training("axid")}, {_tokens("derived", "row_key, ad_id")},
{_BIDS.replace(f"{_CORE}, {_FULL},", "")}, {_GDICT},
hits AS (SELECT t.row_key, list_sort(list_distinct(list(d.global_idx))) AS idx
  FROM tokens t JOIN gdict d ON t.field_pos = d.field_pos AND t.value = d.value GROUP BY 1)
SELECT r.row_key, r.ad_id, array_to_string(coalesce(h.idx, []), ',') AS idx FROM derived r LEFT JOIN hits h USING (row_key)""",
    "top_tokens": f"""WITH {_training("axid")}, {_tokens("derived", "row_key, ad_id")}, {_WEIGHTS}, {_top(Q.VOCABULARY_CUT)}
SELECT ad_id, field, value, weight, rank FROM top_tokens""",
    "cutoff_weight": f"""WITH {_training("axid")}, {_tokens("derived", "row_key, ad_id")}, {_WEIGHTS}, {_top(Q.VOCABULARY_CUT)}
SELECT ad_id, min(weight) AS cutoff, count(*) AS kept FROM top_tokens GROUP BY 1""",
    "feature_dict": f"""WITH {_dict("axid", Q.VOCABULARY_CUT)} SELECT ad_id, field, value, weight, global_idx, local_idx FROM dict""",
    "field_sizes": f"""WITH {_dict("axid")} SELECT ad_id, field, count(*) AS size FROM dict GROUP BY 1, 2""",
    "field_offsets": f"""WITH {_dict("axid")} SELECT ad_id, field, count(*) AS size,
  min(global_idx) AS "offset" FROM dict GROUP BY 1, 2""",
    "encode_rows": f"""WITH {_dict("axid")}, {_encoded()}
SELECT row_key, ad_id, has_active, click_active, array_to_string(idx, ',') AS idx FROM enc""",
    "decode_features": f"""WITH {_dict("axid")}
SELECT DISTINCT t.row_key, t.ad_id, d.global_idx, d.field || '_:_' || d.value AS feature
FROM tokens t JOIN dict d ON t.ad_id = d.ad_id AND t.field_pos = d.field_pos AND t.value = d.value""",
    "to_vector": f"""WITH {_dict("axid")}, {_encoded()} SELECT row_key, ad_id, {_libsvm_line()} AS features FROM enc""",
    "sample_fractions": f"WITH {_CORE}, {_SAMPLED} SELECT ad_id, num, round(fraction, 6) AS fraction FROM frac",
    "stratified_sample": f"""WITH {_CORE}, {_SAMPLED} SELECT row_key, axid AS ad_id, has_active
FROM core JOIN frac ON axid = ad_id
WHERE fraction >= 1 OR has_active = 1 OR (has_active = 0 AND row_seq * 7919 % 1000000 < fraction * 1000000)""",
    "fold_assign": f"WITH {_CORE} SELECT row_key, row_seq % 2 AS fold FROM core",
    "single_stats": f"""WITH {_dict("adid")}, {_encoded()}, {_FLAT_IDX}
SELECT ad_id, i, count(*) FILTER (WHERE has_active = 1) AS pos, count(*) AS tot FROM flat_idx GROUP BY 1, 2""",
    "pair_stats": f"""WITH {_dict("adid")}, {_encoded()}, flat_all AS (SELECT row_key, ad_id, has_active, unnest(idx) AS i FROM enc),
flat_idx AS (SELECT f.* FROM flat_all f JOIN dict d ON f.ad_id = d.ad_id AND f.i = d.global_idx
  WHERE d.field NOT IN ({", ".join(f"'{f}'" for f in Q.CROSS_EXCLUDE)})), {_PAIRS}
SELECT ad_id, i, j, count(*) FILTER (WHERE has_active = 1) AS pos, count(*) AS tot FROM pairs GROUP BY 1, 2, 3""",
    "smoothed_scores": f"WITH {_smoothing()} SELECT ad_id, i, CAST(j AS BIGINT) AS j, pos, tot, round(score, 6) AS score FROM smooth",
    "score_mean": f"WITH {_smoothing()}, {_MEAN} SELECT row_key, ad_id, round(score, 6) AS score FROM scored",
    "score_deviation": f"""WITH {_smoothing()},
{_scored("w * (abs(average - s) + 0.000001) * s", "w * (abs(average - s) + 0.000001)", 1, _RATIO)}
SELECT row_key, ad_id, round(score, 6) AS score FROM scored""",
    "score_logodds": f"""WITH {_smoothing()}, {_scored("w * (ln(s) - ln(average))", "0", 1, "coalesce(num, 0)")}
SELECT row_key, ad_id, round(score, 6) AS score FROM scored""",
    "auc": f"""WITH {_smoothing()}, {_MEAN},
filled AS (SELECT ad_id, coalesce(click_active, 0) AS y, round(coalesce(score, average), 12) AS s FROM scored JOIN base USING (ad_id)),
ordered AS (SELECT ad_id, y, rank() OVER w + (count(*) OVER (PARTITION BY ad_id, s) - 1) / 2.0::DOUBLE AS r
  FROM filled WINDOW w AS (PARTITION BY ad_id ORDER BY s)),
agg AS (SELECT ad_id, sum(CASE WHEN y = 1 THEN r END) AS rs, CAST(sum(y) AS DOUBLE) AS np, CAST(count(*) - sum(y) AS DOUBLE) AS nn FROM ordered GROUP BY 1)
SELECT ad_id, round(CASE WHEN np > 0 AND nn > 0 THEN (rs - np * (np + 1) / 2) / (np * nn) ELSE 0.5 END, 6) AS auc FROM agg""",
    "discount": f"""WITH {_DISCOUNT_ROWS}, {_FLAT_IDX}, {_PAIRS}, {_BASE}, {_STATS}, {_SMOOTH}, {_MEAN},
pred AS (SELECT ad_id, sum(CASE WHEN click_active = 1 THEN 6 ELSE 1 END * coalesce(score, average)) AS s
  FROM scored JOIN base USING (ad_id) GROUP BY 1)
SELECT p.ad_id, round(coalesce(a.click_actives / nullif(p.s, 0) / f.fraction, 0), 6) AS discount
FROM pred p JOIN drawn f ON f.ad_id = p.ad_id LEFT JOIN (SELECT * FROM ads WHERE click_actives > 0) a ON a.ad_id = p.ad_id""",
    "uniform_sample": f"""WITH {_CORE} SELECT row_key, has_active FROM core WHERE row_seq * 7919 % 1000000 < {Q.UNIFORM_SHARE} * 1000000""",
    "bid_average": f"""WITH {_training("axid")} SELECT ad_id,
  round(CAST(sum(CAST(bidprice AS DECIMAL(18,6))) AS DOUBLE) / count(bidprice), 6) AS bid_average, count(*) AS num
FROM derived GROUP BY 1""",
    "bid_constant": f"""WITH {_training("axid")}, avgs AS (SELECT ad_id,
  CAST(sum(CAST(bidprice AS DECIMAL(18,6))) AS DOUBLE) / count(bidprice) AS bid_average, count(*) AS num
FROM derived GROUP BY 1)
SELECT v.ad_id, round(bid_average / nullif(click_actives, 0) * num, 4) AS bid_constant FROM avgs v LEFT JOIN ads USING (ad_id)""",
    "tree_margin": f"WITH {_MARGIN} SELECT row_key, ad_id, round(margin, 6) AS margin FROM margins",
    "bid_constant_predicted": f"""WITH {_MARGIN},
avgs AS (SELECT ad_id, CAST(sum(CAST(margin AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS bid_average, count(*) AS num FROM margins GROUP BY 1)
SELECT v.ad_id, round(bid_average / nullif(click_actives, 0) * num, 4) AS bid_constant FROM avgs v LEFT JOIN ads USING (ad_id)""",
    "linear_predict": f"WITH {_LINEAR} SELECT row_key, ad_id, round(1 / (1 + exp(-z)), 6) AS p FROM sums",
    "train_job_state": f"""WITH {_CORE}, {_eligible("axid")}, {_STATE}, {_GATE}
SELECT coalesce(s.ad_id, g.ad_id) AS ad_id, 'axid' AS level, coalesce(g.sessions, s.sessions) AS sessions,
  coalesce(g.actives, s.actives) AS actives,
  CASE WHEN g.ad_id IS NULL THEN s.last_train_time ELSE CAST({B.NOW} AS DOUBLE) END AS last_train_time
FROM state s FULL JOIN (SELECT * FROM gate WHERE train) g ON s.ad_id = g.ad_id""",
    "cross_auc_given": f"""WITH {_CORE},
given AS (SELECT adid AS ad_id, row_seq % 2 AS fold, coalesce(click_active, 0) AS y, row_seq * 31 % 97 AS s FROM core),
ordered AS (SELECT ad_id, fold, y, rank() OVER w + (count(*) OVER (PARTITION BY ad_id, fold, s) - 1) / 2.0::DOUBLE AS r
  FROM given WINDOW w AS (PARTITION BY ad_id, fold ORDER BY s)),
agg AS (SELECT ad_id, fold, sum(CASE WHEN y = 1 THEN r END) AS rs, CAST(sum(y) AS DOUBLE) AS np, CAST(count(*) - sum(y) AS DOUBLE) AS nn
  FROM ordered GROUP BY 1, 2),
halves AS (SELECT ad_id, CASE WHEN np > 0 AND nn > 0 THEN (rs - np * (np + 1) / 2) / (np * nn) ELSE 0.5 END AS auc FROM agg)
SELECT ad_id, round(sum(auc) / 2 + (2 - count(*)) * 0.25, 6) AS test_auc FROM halves GROUP BY 1""",
    "calibration_holds": f"""WITH {_CORE} SELECT adid AS ad_id,
  CAST(count(*) FILTER (WHERE click_active = 1) AS DOUBLE) AS expected, count(*) FILTER (WHERE click_active = 1) AS click_actives
FROM core GROUP BY 1""",
    "route_model": f"""WITH {_CORE}, {_META}, {_IDMAP}, {_ROUTES} SELECT row_key, axid, use_model FROM core JOIN routes USING (axid)""",
    "route_model_by_auc": f"""WITH {_CORE}, {_META}, {_IDMAP}, own AS (SELECT ad_id, test_auc FROM meta WHERE level = 'axid'),
best AS (SELECT adid, ad_id FROM own JOIN idmap ON axid = ad_id
  QUALIFY row_number() OVER (PARTITION BY adid ORDER BY test_auc DESC, ad_id) = 1),
top AS (SELECT ad_id FROM own ORDER BY test_auc DESC, ad_id LIMIT 1)
SELECT row_key, c.axid, coalesce(o.ad_id, b.ad_id, top.ad_id) AS use_model
FROM core c CROSS JOIN top LEFT JOIN own o ON o.ad_id = c.axid LEFT JOIN idmap m ON m.axid = c.axid
LEFT JOIN best b ON b.adid = m.adid""",
    "bid_price": f"""WITH {_CORE}, {_META}, {_IDMAP}, {_ROUTES},
requests AS (SELECT row_key, axid, use_model, row_seq % 997 / 997.0::DOUBLE AS p FROM core JOIN routes USING (axid)) {_PRICED}""",
    "score_requests": f"WITH {_REQUESTS} {_PRICED}",
    "score_saved_models": f"WITH {_REQUESTS} {_PRICED}",
    "score_stored_buckets": f"WITH {_REQUESTS} {_PRICED}",
    "model_meta": f"""WITH {_CORE}, {_META} SELECT * REPLACE (round(bid_constant, 4) AS bid_constant,
  round(CASE WHEN era = 'new' THEN test_auc - 0.25 ELSE test_auc END, 6) AS test_auc,
  CASE WHEN era = 'new' THEN CAST({B.NOW} AS DOUBLE) ELSE trained_at END AS trained_at) FROM meta""",
    "model_registry": f"""WITH {_WIDTHS} SELECT * REPLACE (round(bid_constant, 4) AS bid_constant,
  round(test_auc, 6) AS test_auc) FROM full_meta""",
    "trained_ids": f"""WITH {_CORE}, {_META} SELECT ad_id,
  CASE WHEN length(CAST(ad_id AS VARCHAR)) = 5 THEN 'campaign' ELSE 'creative' END AS kind FROM meta
WHERE length(CAST(ad_id AS VARCHAR)) >= 5""",
    "report_axid": f"""WITH {_WIDTHS}, {_IDMAP}, {_STATE_NOW}, {_NAMES},
fig AS (SELECT m.ad_id, m.test_auc, s.has_active, s.session, m.col_num, s.update_time
  FROM full_meta m LEFT JOIN state_now s ON s.ad_id = m.ad_id AND s.era = 'new')
SELECT f.ad_id AS axid, n.remark, round(f.test_auc, 6) AS test_cvr, f.has_active, f.session, f.col_num AS cols, f.update_time,
  m.adid AS zadid, round(p.test_auc, 6) AS zadid_test_cvr, p.has_active AS zadid_has_active, p.session AS zadid_session,
  p.col_num AS zadid_cols, p.update_time AS zaxid_update_time
FROM fig f LEFT JOIN names n ON n.spotid = f.ad_id LEFT JOIN idmap m ON m.axid = f.ad_id LEFT JOIN fig p ON p.ad_id = m.adid
WHERE f.ad_id >= 100000""",
    "report_adid": f"""WITH {_WIDTHS}, {_STATE_NOW}, {_NAMES}
SELECT m.ad_id AS adid, n.remark, round(m.test_auc, 6) AS test_cvr, s.has_active, s.session, m.col_num AS cols, s.update_time, m.era AS "time"
FROM full_meta m LEFT JOIN state_now s ON s.ad_id = m.ad_id AND s.era = m.era
LEFT JOIN (SELECT adid, arg_max(remark, spotid) AS remark FROM names GROUP BY 1) n ON n.adid = m.ad_id
WHERE m.ad_id < 100000""",
    "leaf_onehot": f"""WITH {_CORE},
lv AS (SELECT row_key, adid AS ad_id, date, 0 AS tree, row_seq % 7 AS leaf FROM core
  UNION ALL SELECT row_key, adid, date, 1, axid % 5 FROM core UNION ALL SELECT row_key, adid, date, 2, day(date) FROM core),
cols AS (SELECT ad_id, tree, leaf, row_number() OVER (PARTITION BY ad_id ORDER BY tree, leaf) AS col
  FROM (SELECT DISTINCT ad_id, tree, leaf FROM lv WHERE {_NEW}))
SELECT row_key, ad_id, coalesce(string_agg(col, ',' ORDER BY col), '') AS cols
FROM lv LEFT JOIN cols USING (ad_id, tree, leaf) GROUP BY 1, 2""",
    "stream_ad_counts": f"""WITH {_EVENTS} SELECT ad_id, count(*) AS sessions, CAST(sum(c) AS BIGINT) AS clicks,
  CAST(sum(a) AS BIGINT) AS actives FROM ev GROUP BY 1""",
    "stream_daily_counts": f"""WITH {_EVENTS} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, ad_id, count(*) AS sessions,
  CAST(sum(a) AS BIGINT) AS actives FROM ev GROUP BY 1, 2""",
    "stream_score": f"WITH {_REQUESTS} {_PRICED}",
}
