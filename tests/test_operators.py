from __future__ import annotations

import math
import random
import re
from collections import Counter
from datetime import datetime, timezone
from decimal import Decimal

import numpy as np
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from ampflow.operators import bitmaps, joins, nearest, profile, quantiles, ranking, rules
from ampflow.operators.distinct import distinct_counts, distinct_counts_with_total
from ampflow.operators.quantiles import Fixed, IqrRule, decimal_measure
from ampflow.session import local_table


def decimals(spark, numbers, scale=2):
    rows = [(None if n is None else Decimal(n).scaleb(-scale),) for n in numbers]
    return spark.createDataFrame(rows, f"x decimal(10,{scale})")


SERIES = {
    "random": [random.Random(1).randrange(-(10**9), 10**9) for _ in range(999)],
    "one hot value": [500] * 600 + [random.Random(2).randrange(10**6) for _ in range(301)],
    "across cells": [999_999, 1_000_000, 1_000_001, 2_000_000, -1, 0],
    "single": [7],
    "equal": [3] * 50,
    "extremes": [10**10 - 1, -(10**10) + 1, 0, 5],
}


@pytest.mark.parametrize("name", SERIES)
@pytest.mark.parametrize("probs", [(0.25, 0.75), (0.05, 0.5, 0.95), (0.0, 1.0)])
def test_fixed_quantiles_equal_linear_interpolation(spark, name, probs):
    numbers = SERIES[name]
    row = quantiles.fixed_quantiles(
        decimals(spark, [*numbers, None]), {"x": decimal_measure("x", 10, 2)}, probs
    ).first()
    assert row["x_n"] == len(numbers)
    assert [row[f"x_p{i}"] for i in range(len(probs))] == pytest.approx(
        list(np.quantile(np.array(numbers, dtype=float), probs)), rel=1e-12
    )


def test_fixed_quantiles_of_several_measures_and_wide_values(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(-(10**17), 10**17), rng.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    row = quantiles.fixed_quantiles(df, {"a": Fixed("a", digits=18), "b": Fixed("b")}, (0.25, 0.5)).first()
    for i, p in enumerate((0.25, 0.5)):
        assert row[f"a_p{i}"] == pytest.approx(np.quantile([r[0] for r in rows], p), rel=1e-9)
        assert row[f"b_p{i}"] == np.quantile([r[1] for r in rows], p)


def test_quantiles_without_values(spark):
    row = quantiles.fixed_quantiles(decimals(spark, [None, None]), {"x": decimal_measure("x", 10, 2)}).first()
    assert (row["x_n"], row["x_p0"], row["x_p1"]) == (0, None, None)


def test_float_quantiles(spark):
    rng = random.Random(4)
    floats = [rng.uniform(-1e300, 1e300) for _ in range(300)] + [1.5] * 200 + [1e-300, 0.0, -0.5]
    df = spark.createDataFrame([(x, float(i % 7)) for i, x in enumerate(floats)], "a double, b double")
    row = quantiles.float_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, (0.1, 0.5, 0.9)).first()
    for i, p in enumerate((0.1, 0.5, 0.9)):
        assert row[f"a_p{i}"] == pytest.approx(np.quantile(floats, p), rel=1e-12)
        assert row[f"b_p{i}"] == pytest.approx(np.quantile([j % 7 for j in range(len(floats))], p))


def flagged(df, rule):
    return values(quantiles.with_iqr_bounds(df, [rule]).where(rule.outlier()).select("x"))


def test_iqr_population(spark):
    """Positive values only: quartiles 10.75 and 13.25 give 7 to 17. All values: the negatives pull them down."""
    df = decimals(spark, [1000, 1100, 1200, 1300, 1400, 9900, -500, -400, 0, None])
    positive = IqrRule("x", decimal_measure("x", 10, 2))
    everything = IqrRule("x", decimal_measure("x", 10, 2), positive_only=False)
    assert flagged(df, positive) == [(Decimal("99.00"),)]
    assert flagged(df, everything) == [(Decimal("99.00"),)]
    bounds = quantiles.iqr_bounds(df, [positive]).first()
    assert (bounds["x_q1"], bounds["x_q3"]) == (11.25, 13.75)
    assert (bounds["x_lower_bound"], bounds["x_upper_bound"]) == (7.5, 17.5)
    low = decimals(spark, [100, *[5000] * 20])
    assert flagged(low, positive) == [(Decimal("1.00"),)]
    signed = decimals(spark, [-90000, *[5000 + i for i in range(20)]])
    assert flagged(signed, positive) == []
    assert flagged(signed, everything) == [(Decimal("-900.00"),)]


def test_iqr_edge_is_inclusive_and_null_bounds_flag_nothing(spark):
    on_the_edge = decimals(spark, [1000, 1100, 1200, 1300, 1400, 1700])
    rule = IqrRule("x", decimal_measure("x", 10, 2))
    bounds = quantiles.iqr_bounds(on_the_edge, [rule]).first()
    assert bounds["x_upper_bound"] == 13.75 + 1.5 * 2.5
    assert flagged(decimals(spark, [-100, 0, None]), rule) == []
    assert quantiles.with_iqr_bounds(decimals(spark, [-100, 0, None]), [rule]).count() == 3


def test_frozen_bounds(spark):
    rule = IqrRule("x", decimal_measure("x", 10, 2))
    frozen = quantiles.iqr_bounds(decimals(spark, [1000, 1100, 1200, 1300]), [rule])
    late = decimals(spark, [5000, 5100])
    assert quantiles.with_iqr_bounds(late, [rule], frozen).where(rule.outlier()).count() == 2
    assert quantiles.with_iqr_bounds(late, [rule]).where(rule.outlier()).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 4, 5, 7, 97])
def test_tiles_equal_ntile(spark, rows):
    rng = random.Random(rows)
    data = [(f"k{i:03d}" if i else None, rng.choice([1.0, 2.0, 3.0]), rng.choice([None, 5.0, 6.0])) for i in range(rows)]
    df = spark.createDataFrame(data, "k string, a double, b double")
    got = ranking.with_tiles(df, "k", {"ta": "a", "tb": "b"})
    df.createOrReplaceTempView("tiles_input")
    expected = spark.sql(
        "SELECT *, ntile(4) OVER (ORDER BY a NULLS LAST, k NULLS LAST) AS ta, "
        "ntile(4) OVER (ORDER BY b NULLS LAST, k NULLS LAST) AS tb FROM tiles_input"
    )
    assert values(got, "k", "a", "b", "ta", "tb") == values(expected, "k", "a", "b", "ta", "tb")


def test_positions_spread_one_group_over_blocks(spark):
    df = spark.range(1000).select(F.lit("only").alias("g"), (F.col("id") * 7919 % 1000).alias("v"))
    ranked = ranking.global_positions(df, "g", [F.col("v")])
    assert ranked.where(F.col("position") != F.col("v")).count() == 0
    assert ranked.where(F.col("size") != 1000).count() == 0


def hot_inputs(spark):
    left = [("hot", i) for i in range(5)] + [("warm", 5), ("none", 6), (None, 7), ("cold", 8)]
    right = [("hot", i) for i in range(300)] + [("warm", i) for i in range(40)] + [("cold", 0), (None, 1), ("else", 2)]
    return spark.createDataFrame(left, "k string, l int"), spark.createDataFrame(right, "k string, r int")


def test_hot_left_join_equals_plain_join(spark):
    left, right = hot_inputs(spark)
    plain = left.join(right, "k", "left")
    apart = joins.left_join_many(left, right, "k", rows_per_task=20)
    assert values(apart, "k", "l", "r") == values(plain, "k", "l", "r")
    nothing_hot = joins.left_join_many(left, right, "k", rows_per_task=10_000)
    assert values(nothing_hot, "k", "l", "r") == values(plain, "k", "l", "r")
    assert values(joins.frequent_keys(right, "k", 20)) == [("hot", 15), ("warm", 2)]


def test_each_side_of_a_hot_join_is_read_once(spark, tmp_path):
    left, right = hot_inputs(spark)
    left.write.parquet(f"{tmp_path}/left")
    right.write.parquet(f"{tmp_path}/right")
    joined = joins.left_join_many(spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/right"), "k", 20)
    scans = [set(re.sub(r"#\d+L?", "", s).split(",")) for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(joined))]
    assert sum("l" in s for s in scans) == 1 and sum("r" in s for s in scans) == 1
    assert joined.where("k = 'hot'").count() == 1500


def test_every_hot_key_is_split_however_many(spark):
    right = spark.range(9000).select((F.col("id") % 900).alias("k"), F.col("id").alias("r"))
    left = spark.range(0, 1000, 7).select(F.col("id").alias("k"), F.lit(1).alias("l"))
    assert joins.frequent_keys(right, "k", 9).count() == 900
    split = joins.left_join_many(left, right, "k", rows_per_task=4)
    assert values(split, "k", "l", "r") == values(left.join(right, "k", "left"), "k", "l", "r")


def test_keys_outside_full_buckets_are_not_shuffled(spark, tmp_path):
    spark.range(50_000).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("k")).write.parquet(f"{tmp_path}/cold")
    found = joins.frequent_keys(spark.read.parquet(f"{tmp_path}/cold"), "k", 1000)
    assert found.collect() == []
    final = plan_of(found).split("Initial Plan")[0]
    assert "isFinalPlan=true" in final and "hashpartitioning(k" not in final
    right = hot_inputs(spark)[1]
    for buckets in (1, 2, 1 << 14):  # keys that share a bucket are told apart
        assert values(joins.frequent_keys(right, "k", 20, buckets)) == [("hot", 15), ("warm", 2)]


def test_local_right_side(spark):
    left, right = hot_inputs(spark)
    small = local_table(spark, {"k": ["hot", "cold"], "r": [1, 2]})
    assert values(joins.left_join_many(left, small, "k")) == values(left.join(small, "k", "left"))


def test_lookup_ignores_case_and_blanks_and_fans_out(spark):
    df = spark.createDataFrame([(" ZURICH ",), ("Chur",), (None,)], "city string")
    mapping = spark.createDataFrame([("Zurich", "Zurich"), ("zurich", "Zürich")], "raw string, std string")
    got = joins.lookup_spelling(df, "city", mapping, "raw", "std")
    assert values(got) == [(" ZURICH ", "Zurich"), (" ZURICH ", "Zürich"), ("Chur", None), (None, None)]


def test_replace_values(spark):
    df = spark.createDataFrame([("Luzern",), ("Chur",), (None,)], "c string")
    mapping = spark.createDataFrame([("Luzern", "Lucerne")], "old string, new string")
    assert values(joins.replace_values(df, "c", mapping, "old", "new")) == [("Chur",), ("Lucerne",), (None,)]


def brute_nearest(point, places):
    lat, lon = point
    if lat is None or lon is None:
        return None

    def km(p):
        a = math.sin(math.radians(p[1] - lat) / 2) ** 2
        b = math.sin(math.radians(p[2] - lon) / 2) ** 2
        h = a + math.cos(math.radians(lat)) * math.cos(math.radians(p[1])) * b
        return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))

    return min((round(km(p), 6), p[0]) for p in places)


def test_nearest_place_is_exact_anywhere(spark):
    rng = random.Random(5)
    places = [(f"p{i:02d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)]
    places += [("dateline", 10.0, 179.99), ("pole", 89.9, 20.0), ("swiss", 47.0, 8.0), ("swiss2", 47.01, 8.01)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(120)]
    points += [(10.0, -179.99), (89.99, -160.0), (47.004, 8.006), (90.0, 0.0), (-90.0, 0.0), (0.0, 180.0)]
    points += [(None, 8.0), (47.0, None), points[0]]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, latitude double, longitude double")
    got = nearest.nearest_place(df, spark.createDataFrame(places, "place string, lat double, lon double"))
    assert got.count() == len(points)
    for row in got.collect():
        expected = brute_nearest(points[row["id"]], places)
        if expected is None:
            assert (row["place"], row["distance_km"]) == (None, None)
        else:
            assert row["place"] == expected[1]
            assert row["distance_km"] == pytest.approx(expected[0], abs=1e-5)


def test_points_far_from_all_places_meet_few_of_them(spark):
    rng = random.Random(8)
    places = [(f"p{i:04d}", 46 + rng.random(), 7 + rng.random()) for i in range(3000)]
    points = [(i, rng.uniform(-60, -20), rng.uniform(-170, -100)) for i in range(40)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    got = nearest.nearest_place(df, spark.createDataFrame(places, "place string, lat double, lon double"))
    rows = got.collect()
    for row in rows:
        assert row["place"] == brute_nearest(points[row["id"]][1:], places)[1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nearest_without_places(spark):
    df = spark.createDataFrame([(47.0, 8.0)], "latitude double, longitude double")
    nowhere = spark.createDataFrame([], "place string, lat double, lon double")
    assert values(nearest.nearest_place(df, nowhere)) == [(47.0, 8.0, None, None)]


def test_distinct_counts(spark):
    rng = random.Random(6)
    rows = [
        (rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]), rng.choice([7, 8]))
        for _ in range(200)
    ] + [("c", "x", None, 7)]
    df = spark.createDataFrame(rows, "day string, city string, u int, c int")
    got = distinct_counts(df, ["day"], {"users": "u", "chargers": "c"})
    plain = df.groupBy("day").agg(F.countDistinct("u"), F.countDistinct("c"))
    assert values(got) == values(plain)
    parts = distinct_counts_with_total(df, ["day"], "city", {"users": "u", "chargers": "c"})
    per_city = df.groupBy("day", "city").agg(F.countDistinct("u"), F.countDistinct("c"))
    assert values(parts, "day", "city", "users", "chargers") == values(per_city)
    assert values(parts.groupBy("day").agg(F.sum("users_first"), F.sum("chargers_first"))) == values(plain)


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "x double")
    bins = profile.histogram(df, "x", 5).collect()
    assert [r["row_count"] for r in bins] == [2, 2, 2, 2, 3]
    assert (bins[0]["bin_start"], bins[4]["bin_end"]) == (0.0, 10.0)
    flat = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [r["row_count"] for r in profile.histogram(flat, "x", 3).collect()] == [2, 0, 0]
    assert profile.histogram(df.where("x > 99"), "x", 3).count() == 0


def test_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "b"), (None, None)], "x double, c string")
    rows = {r["column_name"]: r.asDict() for r in profile.describe(df).collect()}
    assert rows["x"]["count"] == 3 and rows["x"]["p50"] == 2.0 and rows["x"]["p25"] == 1.5 and rows["x"]["max"] == 4.0
    assert rows["x"]["std"] == pytest.approx(np.std([1, 2, 4], ddof=1))
    assert (rows["c"]["count"], rows["c"]["unique"], rows["c"]["top"], rows["c"]["freq"]) == (3, 2, "b", 2)


def test_profile_moments_match_bias_corrected_formulas(spark):
    xs = [1.0, 2.0, 2.5, 7.0, 11.0, 0.0, -3.0]
    row = profile.profile_numeric(spark.createDataFrame([(x,) for x in xs], "x double")).first()
    n, a = len(xs), np.array(xs)
    m2, m3, m4 = (np.mean((a - a.mean()) ** k) for k in (2, 3, 4))
    assert row["skewness"] == pytest.approx(math.sqrt(n * (n - 1)) / (n - 2) * m3 / m2**1.5)
    assert row["kurtosis"] == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2**2 - 3) + 6))
    assert (row["n_zeros"], row["n_negative"], row["range"]) == (1, 1, 14.0)


def test_profile_columns_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "c string, n int")
    got = {r["column_name"]: (r["n_missing"], r["n_distinct"], r["n_unique"]) for r in profile.profile_columns(df).collect()}
    assert got == {"c": (1, 2, 1), "n": (1, 2, 1)}
    assert values(profile.profile_duplicates(df)) == [(4, 1)]


def test_flag_crosstab(spark):
    df = spark.createDataFrame([(True, True), (True, None), (False, True)], "a boolean, b boolean")
    assert values(profile.flag_crosstab(df, ["a", "b"])) == [("a", "a", 2), ("b", "a", 1), ("b", "b", 2)]


def test_rules(spark):
    child = spark.createDataFrame(
        [("k1", "x", 1), ("k1", "y", 2), (None, "z", 2), ("k2", None, 9)], "id string, kind string, parent int"
    )
    parent = spark.createDataFrame([(1,), (None,)], "pid int")
    suite = [
        rules.Rule("child", rules.UNIQUE, "id"),
        rules.Rule("child", rules.NOT_NULL, "id"),
        rules.Rule("child", rules.NOT_NULL, "parent"),
        rules.Rule("child", rules.ACCEPTED, "kind", values=("x", "y"), severity="warn"),
        rules.Rule("child", rules.ACCEPTED, "parent", values=(1, 2, 9)),
        rules.Rule("child", rules.UNIQUE, "id || '|' || kind"),
        rules.Rule("child", rules.RELATED, "parent", parent="parent", parent_column="pid"),
        rules.Rule("empty", rules.UNIQUE, "id"),
        rules.Rule("empty", rules.NOT_NULL, "id"),
    ]
    tables = {"child": child, "parent": parent, "empty": child.where("false")}
    got = [(r["rule_name"], r["column_name"], r["failures"], r["status"]) for r in rules.evaluate(suite, tables).collect()]
    assert Counter(got) == Counter(
        [
            ("unique", "id", 1, "fail"),
            ("not_null", "id", 1, "fail"),
            ("not_null", "parent", 0, "pass"),
            ("accepted_values", "kind", 1, "warn"),
            ("accepted_values", "parent", 0, "pass"),
            ("unique", "id || '|' || kind", 0, "pass"),
            ("relationships", "parent", 3, "fail"),
            ("unique", "id", 0, "pass"),
            ("not_null", "id", 0, "pass"),
        ]
    )


def test_accepted_values_with_quotes(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("other",)], "v string")
    rule = rules.Rule("t", rules.ACCEPTED, "v", values=("it's", "a\\b"))
    assert [r["failures"] for r in rules.evaluate([rule], {"t": df}).collect()] == [1]


def test_rules_are_compiled_and_a_table_may_be_its_own_parent(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (2, 7), (None, 7), (None, None)], "id int, boss int")
    suite = [
        rules.Rule("t", rules.UNIQUE, "id"),
        rules.Rule("t", rules.NOT_NULL, "boss"),
        rules.Rule("t", rules.RELATED, "boss", parent="t", parent_column="id"),
    ]
    checked = rules.evaluate(suite, {"t": df})
    assert "Generate" not in plan_of(checked)
    assert {r["rule_name"]: r["failures"] for r in checked.collect()} == {"unique": 1, "not_null": 2, "relationships": 2}


def test_union_all(spark):
    frames = [spark.createDataFrame([(i,)], "x int") for i in range(5)]
    assert values(joins.union_all(frames)) == [(i,) for i in range(5)]


def test_rule_records(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert values(rules.duplicated(df, "v")) == [("a", 2)]
    assert values(rules.not_accepted(df, "v", ["a"])) == [("b", 1)]
    assert values(rules.null_rows(df, ["v"])) == [("v", 2)]


def test_doubles_keep_their_order_as_integers(spark):
    rng = random.Random(8)
    numbers = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, float("inf"), -float("inf"), 1.0, 2.0]
    numbers += [math.ldexp(1.0, e) for e in range(-1074, 1024, 13)]
    numbers += [math.nextafter(math.ldexp(1.0, e), t) for e in range(-1060, 1023, 17) for t in (0, math.inf)]
    numbers += [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-1070, 1023)) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in numbers] + [(float("nan"),), (None,)], "x double")
    keyed = quantiles.with_sortable(df.withColumn("k", F.col("x")), ["k"])
    places = df.withColumn("row", F.monotonically_increasing_id()), keyed.withColumn("row", F.monotonically_increasing_id())
    rows = places[0].join(places[1], "row").withColumn("back", F.expr(quantiles.from_sortable("k"))).collect()
    known = [r for r in rows if r.x is not None and not math.isnan(r.x)]
    assert all(r.back == r.x for r in known)
    assert [r.k for r in sorted(known, key=lambda r: r.x)] == sorted(r.k for r in known)
    assert max(rows, key=lambda r: r.k or 0).x != max(r.x for r in known)  # NaN is last
    assert [r for r in rows if r.x is None][0].k is None


def linear(ordered, p):
    position = p * (len(ordered) - 1)
    low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
    return low + (position % 1) * (high - low)


def test_quantiles_are_one_lazy_plan_with_bounded_histograms(spark, monkeypatch):
    rng = random.Random(5)
    numbers = [rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 1e-3), -rng.expovariate(1e-9), 7.25]) for _ in range(4000)] + [1e300, -1e300]
    df = spark.createDataFrame([(x, int(x) if abs(x) < 1e15 else None) for x in numbers], "x double, k bigint").repartition(5)
    probs = (0.0, 0.1, 0.5, 0.999, 1.0)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    row = quantiles.float_quantiles(df, {"x": F.col("x"), "k": F.col("k")}, probs)
    assert not list(jobs.getJobIdsForGroup("lazy"))
    found = row.first()
    spark.sparkContext.setJobGroup("", "")
    for i, p in enumerate(probs):
        assert found[f"x_p{i}"] == pytest.approx(linear(sorted(numbers), p), rel=1e-12)
        assert found[f"k_p{i}"] == pytest.approx(linear(sorted(int(x) for x in numbers if abs(x) < 1e15), p), rel=1e-12)
    monkeypatch.setattr(quantiles, "MAX_BITS", 5)
    again = quantiles.float_quantiles(df, {"x": F.col("x"), "k": F.col("k")}, probs).first()
    assert again == found


def test_quantiles_of_instants(spark):
    times = [datetime(2025, 1, 1, 0, 0, s, 250_000) for s in (0, 10, 20, 59)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    row = quantiles.fixed_quantiles(df, {"t": quantiles.instant_measure("t")}, (0.5,)).first()
    assert row["t_p0"] / 1e6 == datetime(2025, 1, 1, 0, 0, 15, 250_000, tzinfo=timezone.utc).timestamp()


def test_profile_of_frames(spark):
    odd = spark.createDataFrame([(1, "a", None, True), (2, "bb", -0.0, None), (2, None, 0.0, True), (None, "bb", 2.5, False)], "n int, `s t` string, x double, f boolean")
    empty = spark.createDataFrame([], "d date, y decimal(5,1)")
    rows = {(r.frame_name, r.column_name): r for r in profile.profile_frames({"odd": odd, "empty": empty}).collect()}
    assert [k for k, _ in sorted(rows.items(), key=lambda i: (i[1].frame_name, i[1].position))] == [
        ("empty", "d"), ("empty", "y"), ("odd", "n"), ("odd", "s t"), ("odd", "x"), ("odd", "f")
    ]
    n, s, x, f = (rows["odd", c] for c in ("n", "s t", "x", "f"))
    assert (n.n_missing, n.n_distinct, n.n_unique, n.freq, n.top, n.p50, n.max, n.kind) == (1, 2, 1, 2, None, 2.0, 2.0, "number")
    assert (s.top, s.freq, s.min_length, s.max_length, s.mean, s.p_missing) == ("bb", 2, 1, 2, None, 0.25)
    assert (x.n_distinct, x.n_zeros, x.n_negative, x.p25, x.p75) == (2, 2, 0, 0.0, 1.25)
    assert (f.kind, f.top, f.freq, f.n_distinct) == ("flag", "true", 2, 2)
    assert (rows["empty", "y"].n_rows, rows["empty", "y"].p_missing, rows["empty", "d"].p50, rows["empty", "d"].n_distinct) == (0, None, None, 0)


def test_long_quantiles_of_many_measures(spark):
    rng = random.Random(2)
    numbers = {m: [rng.gauss(m, 10.0**m) for _ in range(rng.randint(1, 90))] for m in range(7)}
    rows = spark.createDataFrame([(m, x) for m, xs in numbers.items() for x in xs] + [(9, None)], "measure int, value double")
    got = {r.measure: (r.p0, r.p1) for r in quantiles.long_quantiles(rows, (0.25, 0.9)).collect()}
    assert got == {m: tuple(pytest.approx(linear(sorted(xs), p), rel=1e-12) for p in (0.25, 0.9)) for m, xs in numbers.items()}


def test_long_quantiles_read_the_rows_once(spark):
    rows = spark.createDataFrame([(m, float(x % 7)) for m in range(2) for x in range(100)], "measure int, value double")
    met = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    got = {r.measure: (r.p0, r.p1) for r in quantiles.long_quantiles(rows.mapInArrow(seen, rows.schema), (0.25, 0.9)).collect()}
    expected = linear(sorted(float(x % 7) for x in range(100)), 0.25), linear(sorted(float(x % 7) for x in range(100)), 0.9)
    assert got == {m: tuple(map(pytest.approx, expected)) for m in range(2)}
    assert met.value == 200


def test_profile_sums_up_only_what_a_kind_has(spark):
    df = spark.createDataFrame([("a", True, 1.0)], "s string, f boolean, x double")
    assert plan_of(profile.profile_frames({"one": df})).lower().count("partial_skewness") == 1


def test_sets_of_days_give_distinct_counts_of_any_grain(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(20), rng.choice(["x", "y", None]), rng.choice([None, *(f"u{i}" for i in range(70))]), f"c{rng.randrange(9)}") for _ in range(3000)]
    rows += [(99, "z", f"many{i}", "c") for i in range(40_000)]  # more than one bitmap
    df = spark.createDataFrame(rows, "day int, city string, user string, charger string")
    counted = {"users": "user", "chargers": "charger"}
    sets = bitmaps.id_sets(df, ["day", "city"], counted, {k: bitmaps.numbered_ids(df, c) for k, c in counted.items()})
    sets = sets.withColumn("week", F.expr("day DIV 7"))
    for keys in (["day", "city"], ["week"], ["city"], []):
        got = values(bitmaps.distinct_at(sets, keys, list(counted)))
        grouped = df.withColumn("week", F.expr("day DIV 7")).groupBy(*keys)
        assert got == values(grouped.agg(F.count_distinct("user").alias("users"), F.count_distinct("charger").alias("chargers")))
