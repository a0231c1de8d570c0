import pytest
from support import rows
from pyspark.sql import functions as F

from filingloom.operators.latest import latest_amendment
from filingloom.operators.skew import hot_keys, skew_join


LEFT = [("a", 1, 1), ("a", 1, 1), ("a", 1, 2), ("b", 1, 3), (None, 1, 4), ("a", None, 5), ("d", 1, 5)]
RIGHT = [("a", 1, 7), ("a", 1, 8), ("a", 1, 8), ("b", 1, 9), (None, 1, 1), ("a", None, 1), ("c", 1, 2)]


@pytest.mark.parametrize("pieces", [1, 3, 64])
def test_skew_join_equals_join(spark, pieces):
    left = spark.createDataFrame(LEFT, "k string, k2 int, v int")
    right = spark.createDataFrame(RIGHT, "k string, k2 int, w int")
    for a, b in ((left, right), (left.limit(0), right), (left, right.limit(0)), (left.filter("k IS NULL"), right)):
        joined = skew_join(a, b, ["k", "k2"], pieces)
        assert joined.columns == ["k", "k2", "v", "w"]
        assert rows(joined) == rows(a.join(b, ["k", "k2"]))


def _hot_side(spark):
    """A third of the rows have one key, a tenth another; no other key has two."""
    key = F.when(F.col("id") < 8000, "hot").when(F.col("id") < 10_400, "warm").otherwise(F.col("id").cast("string"))
    return spark.range(24_000).select(key.alias("k"), "id")


def test_only_hot_keys_are_dealt(spark):
    left = _hot_side(spark).repartition(7)
    found = {r["_key"]: r["_pieces"] for r in hot_keys(left, ["k"]).collect()}
    names = spark.createDataFrame([("hot",), ("warm",)], "k string").select("k", F.xxhash64("k").alias("h")).collect()
    assert {n.k: found[n.h] for n in names} == {"hot": 22, "warm": 7}
    assert len(found) == 2
    assert hot_keys(left.filter("id >= 10400"), ["k"]).count() == 0
    nulls = left.withColumn("k", F.when(F.col("id") >= 8000, F.col("k")))
    assert hot_keys(nulls, ["k"]).count() == 1  # a hot null is no key


def test_one_key_is_spread(spark):
    """No piece of the hot key gets much more than one in 64 of all rows, and the other side moves once but for hot keys."""
    left = _hot_side(spark)
    right = left.filter("id % 100 = 0").select("k", F.col("id").alias("w"))
    joined = skew_join(left, right, ["k"])
    assert joined.count() == left.join(right, "k").count()
    dealt = left.filter("k = 'hot'").groupBy(F.pmod(F.xxhash64("k", "id"), F.lit(22))).count().collect()
    assert len(dealt) == 22 and max(r["count"] for r in dealt) < 1.3 * 24_000 / 64


def test_the_hot_list_is_bounded(spark):
    left = spark.range(200_000).select((F.col("id") % 130).alias("k"), "id")
    assert hot_keys(left, ["k"]).count() < 64  # 130 keys of equal size: none is hot
    few = spark.range(200_000).select((F.col("id") % 50).alias("k"), "id")
    found = hot_keys(few, ["k"]).collect()
    assert len(found) == 50 and sum(r["_pieces"] for r in found) < 2 * 64


def test_latest_amendment_of_one_hot_filing(spark):
    filings = spark.range(20_000).select(F.lit("f").alias("filing"), (F.col("id") % 2).cast("string").alias("amend"), "id")
    assert latest_amendment(filings, "filing", "amend").count() == 10_000
    plan = latest_amendment(filings, "filing", "amend")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
