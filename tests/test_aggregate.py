from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.operators import aggregate
from tests.conftest import d, rows

ROW = st.tuples(
    st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 3)),
    st.booleans(), st.integers(-5, 5),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=40))
def test_entity_counts_equal_the_plain_definition(spark, data):
    df = spark.createDataFrame(data, "g string, r int, p int, f boolean, v int")
    got = aggregate.entity_counts(
        df, ["g"], {"nr": ("r", F.col("f")), "np": ("p", None), "npf": ("p", F.col("f"))},
        {"s": F.when(F.col("f"), F.col("v"))}, {"m": F.col("v")}, {"again": ("p", F.col("f"), 2)},
    )
    want = df.groupBy("g").agg(
        F.count_distinct(F.when(F.col("f"), F.col("r"))).alias("nr"), F.count_distinct("p").alias("np"),
        F.count_distinct(F.when(F.col("f"), F.col("p"))).alias("npf"), F.sum(F.when(F.col("f"), F.col("v"))).alias("s"), F.max("v").alias("m"),
    )
    assert rows(got.drop("again").select(want.columns)) == rows(want)
    groups = defaultdict(set)
    for g, r, p, f, _ in data:
        if f and r is not None:
            groups[g, p].add(r)
    again = {g: 0 for g, *_ in data}
    for (g, _), items in groups.items():
        again[g] += len(items) >= 2
    assert {r.g: r.again for r in got.collect()} == again


def test_single_entity_keeps_rows_without_it_in_the_sums(spark):
    df = spark.createDataFrame([("a", None, 5), ("a", 1, 2), ("a", 1, 3)], "g string, r int, v int")
    got = aggregate.entity_counts(df, ["g"], {"n": ("r", None)}, {"s": F.col("v")})
    assert rows(got) == [("a", 1, 10)]


def test_total_rows_exist_without_data(spark):
    empty = spark.createDataFrame([], "c string, n long, g double")
    out = aggregate.keep_total_rows(empty, "c", ["ALL"], ["n"])
    assert rows(out.select("c", "n", "g")) == [("ALL", 0, None)]


def test_total_counts_an_agency_once_across_countries(spark):
    df = spark.createDataFrame([("AR", "p1", 1), ("BR", "p1", 2)], "c string, p string, r int")
    got = aggregate.entity_counts(
        df, ["c"], {"n": ("r", None), "ag": ("p", None)}, repeats={"rep": ("p", None, 2)}, totals=("c", {"ALL": None})
    )
    assert rows(got.select("c", "ag", "rep")) == [("ALL", 1, 1), ("AR", 1, 0), ("BR", 1, 0)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=30), st.booleans(), st.booleans())
def test_totals_equal_a_grouping_of_doubled_rows(spark, data, two, again):
    df = spark.createDataFrame(data, "g string, r int, p int, f boolean, v int")
    df = df.withColumn("g", F.when(F.col("v") == 5, None).otherwise(F.col("g")))
    counts = {"nr": ("r", F.col("f"))} | ({"np": ("p", None)} if two else {})
    rest = {"sums": {"s": F.when(F.col("f"), F.col("v"))}, "maxima": {"m": F.col("v")}}
    rest |= {"repeats": {"again": ("p", F.col("f"), 2)}} if again and two else {}
    got = aggregate.entity_counts(df, ["g"], counts, **rest, totals=("g", {"ALL": None, "b": F.col("g") == "b", "NOT": F.col("g") == "a"}))
    b, a = (F.coalesce(F.col("g") == x, F.lit(False)) for x in "ba")
    groups = [df.where(~b), df.withColumn("g", F.lit("ALL")), df.where(b), df.where(a).withColumn("g", F.lit("NOT"))]
    want = None
    for group in groups:
        part = aggregate.entity_counts(group, ["g"], counts, **rest)
        want = part if want is None else want.unionByName(part)
    assert rows(got.select(want.columns)) == rows(want)


def test_a_long_group_is_packed_in_chunks(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("x").alias("k"), F.format_string("f%07d", F.col("id")).alias("f"), (F.col("id") % 7).alias("c"), F.lit(1).alias("t"))
    small = spark.createDataFrame([("y", "b", 1, 1), ("y", "a", 1, 2), ("z", None, 0, 0), (None, "q", 3, 3)], "k string, f string, c long, t int")
    chunks = aggregate.packed_chunks(df.unionByName(small), ["k"], "f", ["c", "t"], "c")
    sizes = chunks.select("k", "chunk", F.size(F.split("s", ";")).alias("n"), F.substring_index("s", ";", 1).alias("first")).collect()
    big = sorted((r.chunk, r.n, r.first) for r in sizes if r.k == "x")
    assert [r[0] for r in big] == list(range(1, len(big) + 1)) and sum(r[1] for r in big) == n and max(r[1] for r in big) <= 1000
    assert big[0][2] == "f0000006 6 1" and [(-int(r[2].split()[1]), r[2]) for r in big] == sorted((-int(r[2].split()[1]), r[2]) for r in big)
    assert rows(chunks.where("k is null or k <> 'x'")) == [("y", 1, "a 1 2;b 1 1"), ("z", 1, ""), (None, 1, "q 3 3")]


def test_places(spark):
    from kpiloom.operators.ranking import with_places

    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g")).repartition(7)
    got = with_places(df, [F.col("g").desc(), F.col("v").asc()], "place").orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 5001))
    assert [(r.g, r.v) for r in got] == [(r.g, r.v) for r in df.orderBy(F.col("g").desc(), "v").collect()]
    assert with_places(df.limit(0), [F.col("v").asc()], "place").columns == ["v", "g", "place"]
    with pytest.raises(ValueError, match="place"):
        with_places(df.withColumn("place", F.lit(1)), [F.col("v").asc()], "place")


def test_top_k_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("c", 5.0), ("a", 5.0), ("b", 9.0), ("d", 1.0)], "p string, g double")
    assert [r.p for r in aggregate.top_k(df, "g", 2, "p").collect()] == ["b", "a"]


def test_extremes_take_the_earliest_of_equals(spark):
    df = spark.createDataFrame([(1, 3.0, d("2026-05-11")), (1, 3.0, d("2026-05-04")), (1, None, d("2026-05-18")), (1, 1.0, d("2026-05-25"))], "id int, v double, w date")
    assert rows(aggregate.extreme_row(df, ["id"], "v", "w")) == [(1, 3.0, d("2026-05-04"))]
    assert rows(aggregate.extreme_row(df, ["id"], "v", "w", largest=False)) == [(1, 1.0, d("2026-05-25"))]
    assert rows(aggregate.last_row(df, ["id"], "v", "w")) == [(1, 1.0, d("2026-05-25"))]


def test_packed_list_orders_by_clicks(spark):
    df = spark.createDataFrame([("x", "price", 3, 1), ("x", "stars", 7, 0), ("x", "area", 3, 2), ("y", None, 0, 0)], "k string, f string, c int, t int")
    assert rows(aggregate.packed_list(df, ["k"], "f", ["c", "t"], "c")) == [("x", "stars 7 0;area 3 2;price 3 1"), ("y", "")]


def test_member_list_leaves_one_out(spark):
    df = spark.createDataFrame([(1, "W"), (1, "P"), (1, "C"), (1, "P"), (2, "W")], "k int, m string")
    assert rows(df.groupBy("k").agg(aggregate.member_list("m", "W").alias("l"))) == [(1, "C+P"), (2, "")]


def test_weighted_mean_uses_the_weights_of_known_values(spark):
    df = spark.createDataFrame([(100.0, 7.0), (None, 13.0), (50.0, 3.0)], "v double, w double")
    assert df.agg(aggregate.weighted_mean("v", "w")).first()[0] == pytest.approx(85.0)


def test_least_squares_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = list(range(-12, 0))
    y = [float(v) for v in rng.normal(100, 20, 12)]
    df = spark.createDataFrame([("s", i, v) for i, v in zip(x, y)] + [("s", 0, None)], "k string, x int, y double")
    got = aggregate.least_squares(df, ["k"], "x", "y").where("x = 0").first()
    slope, intercept = np.polyfit(x, y, 1)
    residual = np.array(y) - (intercept + slope * np.array(x))
    assert got.slope == pytest.approx(slope) and got.intercept == pytest.approx(intercept)
    assert got.sd == pytest.approx((residual @ residual / 10) ** 0.5) and got.n == 12


def test_a_booking_without_id_makes_no_repeater(spark):
    df = spark.createDataFrame([("g", "p1", "r1"), ("g", "p1", None), ("g", "p2", "r2"), ("g", "p2", "r3")], "g string, p string, r string")
    counted = aggregate.entity_counts(df, ["g"], {"n": ("r", None), "ag": ("p", None)}, repeats={"rep": ("p", None, 2)})
    assert rows(counted.select("n", "ag", "rep")) == [(3, 2, 1)]
    assert rows(aggregate.repeaters(df, ["g"], "p", "r", 2, "rep")) == [("g", 1)]
