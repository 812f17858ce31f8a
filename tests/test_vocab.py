"""Tokens, vocabularies, encoding and lookups."""

import random
from collections import Counter, defaultdict

from fixtures import by, log, session

from bidlift.functions.derive import derive_fields, flatten_log
from bidlift.operators import rows, vocab
from bidlift.operators.lookup import lookup_left
from bidlift.schemas import FEATURE_FIELDS, FIRST_MULTI_POS
from bidlift.session import materialize
from pyspark.sql import functions as F


def _training(spark):
    rnd = random.Random(3)
    sessions = []
    for n in range(120):
        axid = 100001 if n % 3 else 100002
        sessions.append(
            session(
                f"r{n:03}", has_active=rnd.choice([0, 1, None]), has_click=rnd.choice([0, 1, None]),
                paytype=rnd.choice(["p1", "p2", None]), product=f"prod{rnd.randrange(9)}",
                ad={"axid": axid, "adid": 10001},
                user={"spec_usrtag": rnd.choices(["t1", "t2", "", "t_:_4"], k=3)},
                content={"keyword": rnd.choices(["k1", "k2", "k3"], k=rnd.randrange(3))},
            )
        )
    new = log(spark, *sessions)
    ads = spark.createDataFrame([(100001,), (100002,)], "ad_id bigint")
    flat = rows.training_rows(new, new.limit(0), ads, keep=("row_key",))
    return materialize(derive_fields(flat).withColumn("ad_id", F.col("axid")))


def _python_tokens(training):
    out = []
    for r in training.collect():
        w = 1 + 3 * (r.has_active == 1) + 6 * (r.click_active == 1)
        for pos, f in enumerate(FEATURE_FIELDS):
            values = [r[f]] if pos < FIRST_MULTI_POS else (r[f] or [])
            out += [(r.row_key, r.ad_id, pos, v, w) for v in values if v is not None]
    return out


def _python_dict(tokens, k):
    weights = defaultdict(Counter)
    for _, ad, pos, v, w in tokens:
        weights[ad][(pos, v)] += w
    out = {}
    for ad, c in weights.items():
        top = sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]
        kept = [(t, w) for t, w in top if t[0] < FIRST_MULTI_POS or t[1] != ""]
        kept.sort(key=lambda x: (x[0][0], -x[1], x[0][1]))
        out[ad] = {t: i for i, (t, _) in enumerate(kept)}
    return out


def test_dictionary_and_encoding_against_plain_python(spark):
    training = _training(spark)
    tokens = _python_tokens(training)
    for k in (5, 14, 20_000):
        want = _python_dict(tokens, k)
        dictionary = materialize(vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), k)))
        got = {ad: {} for ad in want}
        for r in dictionary.collect():
            got[r.ad_id][(r.field_pos, r.value)] = r.global_idx
            assert r.local_idx == r.global_idx - min(
                i for (p, _), i in want[r.ad_id].items() if p == r.field_pos
            ) + (1 if r.field_pos < FIRST_MULTI_POS else 0)
        assert got == want
        rows_want = defaultdict(set)
        for key, ad, pos, v, _ in tokens:
            rows_want[key]
            if (pos, v) in want[ad]:
                rows_want[key].add(want[ad][(pos, v)])
        for max_rows in (1_000_000, 3):  # broadcast, and hot/cold split
            enc = by(vocab.encode_rows(training, dictionary, ["row_key"], max_rows=max_rows), "row_key")
            assert {key: r["idx"] for key, r in enc.items()} == {key: sorted(s) for key, s in rows_want.items()}


def test_indices_are_dense_and_offsets_add_up(spark):
    training = _training(spark)
    dictionary = materialize(vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), 14)))
    for ad in (100001, 100002):
        idx = sorted(r.global_idx for r in dictionary.where(F.col("ad_id") == ad).collect())
        assert idx == list(range(len(idx)))
    firsts = by(dictionary.groupBy("ad_id", "field_pos").agg(F.min("global_idx").alias("m")), "ad_id", "field_pos")
    offsets = by(vocab.field_offsets(vocab.field_sizes(dictionary)), "ad_id", "field_pos")
    assert {k: v["m"] for k, v in firsts.items()} == {k: v["offset"] for k, v in offsets.items()}


def test_values_with_the_separator_stay_whole(spark):
    training = _training(spark)
    dictionary = materialize(vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), vocab.VOCABULARY)))
    assert dictionary.where("value = 't_:_4'").count() == 2
    enc = materialize(vocab.encode_rows(training, dictionary, ["row_key"]))
    decoded = vocab.decode_features(enc, dictionary, ["row_key"])
    want = {(k, p, v) for k, _, p, v, _ in _python_tokens(training) if p < FIRST_MULTI_POS or v != ""}
    got = {(r.row_key, FEATURE_FIELDS.index(r.field), r.value) for r in decoded.collect()}
    assert got == want


def test_rows_without_known_features_stay(spark):
    training = _training(spark)
    dictionary = vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), vocab.VOCABULARY)).where("ad_id = 100001")
    enc = vocab.encode_rows(training, materialize(dictionary), ["row_key"])
    assert enc.count() == training.count()
    assert enc.where("ad_id = 100002 and size(idx) > 0").count() == 0


def test_global_dictionary_is_dense(spark):
    training = _training(spark)
    g = vocab.global_dict(vocab.token_distinct(training)).collect()
    assert sorted(r.global_idx for r in g) == list(range(len(g)))
    order = [r.field for r in sorted(g, key=lambda r: r.global_idx)]
    assert [FEATURE_FIELDS.index(f) for f in order] == sorted(FEATURE_FIELDS.index(f) for f in order)


def test_lookup_gives_the_same_however_the_table_is_joined(spark):
    rnd = random.Random(5)
    # One key holds a third of the facts, some keys are unknown.
    facts = [(i, 0 if i % 3 == 0 else rnd.randrange(60)) for i in range(900)]
    f = spark.createDataFrame(facts, "id bigint, k bigint")
    uses = Counter(k for _, k in facts if k < 50)
    t = spark.createDataFrame([(k, n, k * 1.5) for k, n in uses.items()], "k bigint, n bigint, v double")
    want = {i: (k * 1.5 if k < 50 else None) for i, k in facts}
    for max_rows in (1_000_000, 10, 1):
        got = lookup_left(f, t, ["k"], "n", max_rows).collect()
        assert len(got) == len(facts)
        assert {r.id: r.v for r in got} == want


def test_cross_exclude_leaves_fields_out_of_pairs_only(spark):
    training = _training(spark)
    dictionary = materialize(vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), vocab.VOCABULARY)))
    enc = vocab.encode_rows(training, dictionary, ["row_key"], cross_exclude=("product",))
    products = {
        ad: {r.global_idx for r in dictionary.where((F.col("ad_id") == ad) & (F.col("field") == "product")).collect()}
        for ad in (100001, 100002)
    }
    for r in enc.collect():
        assert r.cross_idx == [i for i in r.idx if i not in products[r.ad_id]]
        assert len(r.idx) == len(r.cross_idx) + 1


def test_encoded_tokens_carry_no_row_columns(spark):
    # Row columns join back once per row; tokens through the shuffles carry the row number and model only.
    training = materialize(_training(spark))
    dictionary = materialize(vocab.feature_dict(vocab.top_tokens(vocab.token_weights(training), vocab.VOCABULARY)))
    twice = materialize(training.unionByName(training))
    enc = vocab.encode_rows(twice, dictionary, ["row_key", "has_active"])
    plan = enc._jdf.queryExecution().optimizedPlan().toString()
    assert "first(row_key" not in plan and "first(has_active" not in plan
    assert enc.count() == 2 * training.count()
    once = by(vocab.encode_rows(training, dictionary, ["row_key"]), "row_key")
    for r in enc.collect():
        assert r.idx == once[r.row_key]["idx"]
