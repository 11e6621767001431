import pytest
from pyspark.sql import functions as F

from kpiloom.operators import joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    """A left side whose key 1 holds a third of all rows and another third has no key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 97)
    left = spark.range(6000).select(key.cast("long").alias("k"), F.col("id").alias("tx"))
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (5, "d"), (None, "n")], "k long, v string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_part", [50, 10**9])
def test_skew_join_equals_the_plain_join(sides, how, rows_per_part):
    left, right = sides
    got = joins.skew_join(left, right, "k", how, rows_per_part=rows_per_part)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_hot_key_is_split_and_others_are_not(sides, spark):
    left, _ = sides
    ((key, parts),) = rows(joins.heavy_keys(left, "k", 500))
    assert key == 1 and 2 <= parts <= 16


def test_a_key_that_holds_all_rows_is_found_and_split(spark):
    left = spark.range(300_000).select(F.lit("k").alias("k"), (F.col("id") % 60).alias("d"), "id")
    ((key, parts),) = rows(joins.heavy_keys(left, "k", 1000))
    assert key == "k" and 250 <= parts <= 350
    joined = joins.skew_join(left, spark.createDataFrame([("k", 1)], "k string, v int"), "k", "inner", rows_per_part=1000)
    assert joined.count() == 300_000


def test_unknown_join_type_is_refused(sides):
    left, right = sides
    with pytest.raises(ValueError):
        joins.skew_join(left, right, "k", "full_outer")


def test_flag_join_does_not_multiply(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    for split in (False, True):
        assert rows(joins.flag_join(left, keys, "k", "f", split).select("v", "f")) == [(10, 1), (20, 0), (30, 0)]


def test_spine_rows_without_facts_are_zero(spark):
    spine = spark.createDataFrame([("2026-10",), ("2026-11",)], "mes string")
    facts = spark.createDataFrame([("2026-10", 5), ("2026-09", 7)], "mes string, n int")
    assert rows(joins.on_spine(spine, facts, "mes", ["n"])) == [("2026-10", 5), ("2026-11", 0)]


def test_repeated_keys_are_listed(spark):
    from kpiloom.sources.tables import repeated_keys

    assert rows(repeated_keys(spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int"), "k")) == []
    assert rows(repeated_keys(spark.createDataFrame([(1,), (1,), (3,)], "k int"), "k")) == [(1, 2)]
