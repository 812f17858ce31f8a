"""Steps that keep rows whole beside their model's entries."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlift.operators import smoothing, vocab
from bidlift.operators.beside import beside
from bidlift.schemas import FEATURE_FIELDS, FIELD_POS, MULTI_FIELDS
from bidlift.session import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark, rows):
    """(n, model, paytype, keywords) as derived rows."""
    df = spark.createDataFrame(rows, "n bigint, ad_id bigint, paytype string, keyword array<string>")
    others = {f: F.lit(None).cast("array<string>" if f in MULTI_FIELDS else "string") for f in FEATURE_FIELDS if f not in ("paytype", "keyword")}
    return materialize(df.withColumns(others))


def _dictionary(spark):
    pay, key = FIELD_POS["paytype"], FIELD_POS["keyword"]
    entries = [(1, pay, "a", 0, 9), (1, pay, "b", 1, 5), (1, key, "x", 2, 4), (1, key, "y", 3, 2), (2, pay, "a", 0, 3), (2, key, "a", 1, 3), (None, pay, "a", 7, 1)]
    return materialize(spark.createDataFrame(entries, "ad_id bigint, field_pos int, value string, global_idx bigint, weight bigint"))


@pytest.mark.parametrize("max_rows", [100, 2])
def test_encoding_leaves_rows_whole(spark, max_rows):
    """Equal rows stay apart; rows without a model, values or arrays get no index; nothing is dealt out by row."""
    one = (5, 1, "b", ["y", "x", None, "x", "z"])
    rows = [one, one, (1, 1, None, None), (2, 2, "a", ["a"]), (3, None, "a", ["x"]), (4, 9, "a", []), (6, 2, "b", [])]
    got = vocab.encode_rows(_rows(spark, rows), _dictionary(spark), ["n"], max_rows=max_rows, cross_exclude=("paytype",))
    text = plan(got)
    assert "_row" not in text and ("Exchange" in text) == (max_rows == 2)
    found = sorted((r.n, r.idx, r.cross_idx) for r in got.collect())
    assert found == [(1, [], []), (2, [0, 1], [1]), (3, [], []), (4, [], []), (5, [1, 2, 3], [2, 3]), (5, [1, 2, 3], [2, 3]), (6, [], [])]


def test_a_model_of_many_rows_is_dealt_to_several_parts(spark):
    """Each part has all entries of the model; every row comes back once."""
    rows = _rows(spark, [(n, 1 if n % 10 else 2, "a", ["y"]) for n in range(300)])
    known = _dictionary(spark).select(F.col("ad_id").alias("_model"), "value").where("_model is not null")
    asked = rows.select("n", F.col("ad_id").alias("_model"))

    def run(batch, entries):
        models = entries["_model"].to_pylist()
        found = [models.count(m) for m in batch["_model"].to_pylist()]
        return pa.table({"n": batch["n"], "found": pa.array(found, pa.int64()), "size": pa.array([len(batch)] * len(batch), pa.int64())})

    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("n", "found", "size")])
    got = beside(asked, known, "_model", lambda t: t, run, schema, 6, max_rows=0, part_rows=50).collect()
    assert sorted(r.n for r in got) == list(range(300))
    assert all(r.found % (4 if r.n % 10 else 2) == 0 and r.found > 0 for r in got)
    assert max(r["size"] for r in got) < 300


@pytest.mark.parametrize("scorer", ["mean", "deviation", "logodds"])
@pytest.mark.parametrize("weight", [0.0, 0.5])
def test_scores_beside_equal_those_of_the_join(spark, scorer, weight):
    """Tables sent whole and dealt in parts give what the join by key gives, rows and NULL scores included."""
    rnd = random.Random(4)
    table = [(m, (i << 32) + j + 1, 3, rnd.choice([None, 0.0, rnd.random()])) for m in (1, 2, None) for i in range(9) for j in (-1, *range(i + 1, 9)) if rnd.random() < 0.6]
    scores = materialize(spark.createDataFrame(table, "ad_id bigint, code bigint, tot bigint, score double"))
    base = materialize(spark.createDataFrame([(1, 0.3), (2, 0.0)], "ad_id bigint, average double"))
    rows = [(n, rnd.choice([1, 2, 3, None]), sorted(rnd.sample(range(11), rnd.randrange(6)))) for n in range(200)]
    rows += [(200, 1, None), (201, 1, [2, 5]), (201, 1, [2, 5])]
    asked = materialize(spark.createDataFrame(rows, "n bigint, ad_id bigint, idx array<int>"))

    def scored(**how):
        return sorted(smoothing.score_rows(asked, scores, base, ["n"], scorer, weight, **how).collect(), key=lambda r: (r.n, r.ad_id or 0))

    joined, whole = scored(max_rows=5), scored()
    terms, finish = smoothing.SCORERS[scorer]
    parts = smoothing._sums_beside(asked, scores, base, ["n", "ad_id"], terms, weight, 0, len(table))
    parts = sorted(parts.select("n", "ad_id", finish(F.col("_num"), F.col("_den")).alias("score")).collect(), key=lambda r: (r.n, r.ad_id or 0))
    assert "_row" not in plan(smoothing.score_rows(asked, scores, base, ["n"], scorer, weight))
    for other in (whole, parts):
        assert [(r.n, r.ad_id, r.score is None) for r in other] == [(r.n, r.ad_id, r.score is None) for r in joined]
        assert [r.score for r in other if r.score is not None] == pytest.approx([r.score for r in joined if r.score is not None])
