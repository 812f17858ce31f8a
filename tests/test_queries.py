"""Every query with an SQL form against DuckDB on the small tables."""

import importlib

import pytest
from compare import connect, difference
from conftest import SMALL

catalog = importlib.import_module("bidlift.plans.catalog")
QUERIES, ORACLE = catalog.QUERIES, importlib.import_module("bidlift.plans.oracle").ORACLE
# Learned models have no SQL form; the corpus queries are tested beside their operators.
NO_SQL = {"cross_auc", "cvr_model", "bid_model", "score_requests_learned"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_is_checked_or_listed():
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def test_uniform_sample_keeps_about_the_share(spark):
    got = QUERIES["uniform_sample"](spark, SMALL).count()
    assert 2000 < got < 2800


def test_discount_rows_are_sampled_here(spark):
    from bidlift.operators import sampling

    training = catalog._training(spark, SMALL, "adid")
    fractions = sampling.sample_fractions(training, catalog.DISCOUNT_LIMIT, catalog.DISCOUNT_CAP)
    assert fractions.where("fraction < 1").count() > 0
