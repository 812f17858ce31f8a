"""The given tables seen as logs."""

from conftest import SMALL

from bidlift.plans import testbed


def test_lineitem_meets_only_orders_and_parts_by_shuffle(spark):
    """Neither suppliers nor customers deal out lineitem again, however small broadcasts must be."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = testbed.session_log(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_suppkey" not in text
    wide = [x for x in text.splitlines() if "o_custkey" in x and "l_orderkey" in x]
    assert not wide
