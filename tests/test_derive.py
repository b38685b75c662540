import datetime

import pytest
from pyspark.sql import functions as F
from rows import column, towers

import mastgrid as mg
from mastgrid.functions import derive
from mastgrid.functions.durable import durable
from mastgrid.functions.numeric import round_half_even, to_int_half_even, to_int_half_up
from mastgrid.plans.summary import tower_summary


def test_region_rounding(spark):
    lats = [0.5, 1.5, 2.5, -0.5, -2.5, 2.4999999999999996, -0.4, 89.9]
    df = towers(spark, *[{"lat": x, "cell": i} for i, x in enumerate(lats)]).orderBy("cell")
    up = column(mg.with_region(df, "half_up").orderBy("cell"), "lat_r")
    even = column(mg.with_region(df, "half_even").orderBy("cell"), "lat_r")
    assert up == [1, 2, 3, -1, -3, 2, 0, 90]
    assert even == [0, 2, 2, 0, -2, 2, 0, 90]
    with pytest.raises(ValueError):
        mg.with_region(df, "down")


def test_integer_rounding_agrees_with_spark(spark):
    x = F.col("id") / 8 - 300
    df = spark.range(5000).select(x.alias("x"))
    wrong = df.filter(
        (to_int_half_up(F.col("x")) != F.round("x").cast("int"))
        | (to_int_half_even(F.col("x")) != F.bround("x").cast("int"))
    )
    assert wrong.count() == 0


def test_rounding_of_unusable_numbers_is_null(spark):
    df = spark.sql("SELECT * FROM VALUES (double('NaN')), (double('Infinity')), (1e300D), (NULL) AS t(x)")
    result = df.select(to_int_half_up(F.col("x")), to_int_half_even(F.col("x"))).collect()
    assert {tuple(row) for row in result} == {(None, None)}


@pytest.mark.parametrize("digits", [1, 2])
def test_decimal_rounding_agrees_with_python(spark, digits):
    pairs = [(a, b) for b in range(1, 81) for a in range(-60, 400, 7)]
    df = spark.createDataFrame(pairs, "a long, b long").select((F.col("a") / F.col("b")).alias("x"))
    rows = df.select("x", round_half_even(F.col("x"), digits).alias("r")).collect()
    assert all(row.r == round(row.x, digits) for row in rows)
    assert any(row.r != round(row.x * 10**digits) / 10**digits for row in rows)


def test_tower_id(spark):
    df = towers(spark, {"area": 3, "cell": 4}, {"area": None, "cell": 4})
    assert column(mg.with_tower_id(df), "tower_id") == ["3_4", "4"]
    assert column(mg.with_tower_id(df, full_key=True), "tower_id")[0] == "310_260_3_4"
    assert column(mg.tower_samples(df), "tower_id") == ["3_4"]


def test_years_from_numbers_and_texts(spark):
    texts = ["1459813819", "2016-04-05", "x", None]
    rows = [{"created": t, "updated": t, "cell": i} for i, t in enumerate(texts)]
    df = towers(spark, *rows, text_dates=True)
    stamped = mg.with_timestamps(df).orderBy("cell")
    assert column(stamped, "year") == [2016, 2016, None, None]
    assert column(stamped, "created_ts") == [
        datetime.datetime(2016, 4, 4, 23, 50, 19), datetime.datetime(2016, 4, 5), None, None,
    ]


def test_years_do_not_depend_on_the_session_zone(spark):
    df = towers(spark, {"created": 1451606399}, {"created": 1451606400}, {"created": -1})
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert column(mg.with_year(df), "year") == [2015, 2016, 1969]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_operator_names(spark):
    df = towers(
        spark, {"mcc": 310, "mnc": 260}, {"mcc": 310, "mnc": 4}, {"mcc": None, "mnc": 260},
        {"mcc": 3, "mnc": 10260},
    )
    assert column(mg.with_operator(df), "operator_name") == ["T-Mobile US", "Other", "Other", "Other"]
    assert column(mg.with_operator(df, default="Unknown"), "operator_name")[1] == "Unknown"
    assert column(mg.with_operator(df, {(310, 4): "X"}), "operator_name")[:2] == ["Other", "X"]
    assert mg.with_operator(df).columns == df.columns + ["operator_name"]


def test_operator_table_with_a_repeated_code(spark):
    df = towers(spark, {"mnc": 260}, {"mnc": 1})
    table = spark.createDataFrame(
        [(310, 260, "B"), (310, 260, "A")], "mcc int, mnc int, operator_name string"
    )
    assert sorted(column(mg.with_operator(df, table), "operator_name")) == ["A", "Other"]
    assert mg.by_operator(df, "A", table).count() == 1
    assert sorted(map(tuple, mg.operator_count(df, table).collect())) == [("A", 1), ("Other", 1)]


def test_operator_code_joins_digits(spark):
    df = towers(spark, {"mcc": 310, "mnc": 4}, {"mcc": 3, "mnc": 104}, {"mcc": None})
    assert column(mg.with_operator_code(df), "operator") == [3104, 3104, None]


def test_filtering_by_operator_equals_filtering_by_name(spark):
    codes = [(310, 260), (310, 410), (311, 480), (310, 4), (None, 260), (310, None), (None, None)]
    df = towers(spark, *[{"mcc": a, "mnc": b, "cell": i} for i, (a, b) in enumerate(codes)])
    named = mg.with_operator(df)
    for name in ("T-Mobile US", "Verizon US", "Other", "Nobody"):
        expected = sorted(column(named.filter(F.col("operator_name") == name), "cell"))
        assert sorted(column(mg.by_operator(df, name), "cell")) == expected


def test_colors(spark):
    df = towers(spark, {"radio": "NR"}, {"radio": "CDMA"}, {"radio": None})
    assert column(mg.with_tech_color(df), "color") == ["red", "gray", "gray"]
    df = towers(spark, {"mnc": 120}, {"mnc": 1})
    assert column(mg.with_operator_color(df), "color") == ["orange", "gray"]


def test_region_rule_is_recorded(spark):
    even = mg.with_region(towers(spark, {"lat": 0.5}), "half_even")
    assert column(mg.region_stats(even, mode="half_even"), "lat_r") == [0]
    for table in (even, even.filter("lat_r = 0").select("*"), tower_summary(even, "half_even")):
        with pytest.raises(ValueError, match="half_even"):
            mg.region_stats(table)
    kept = durable(tower_summary(towers(spark, {"lat": 0.5}), "half_even"))
    assert column(mg.region_count(kept, mode="half_even"), "lat_r") == [0]
    with pytest.raises(ValueError, match="half_even"):
        mg.region_count(kept)


def test_moments_keep_their_digits(spark):
    rows = towers(spark, *[{"range": 10**9 + i} for i in range(3)])
    far = towers(spark, *[{"range": 9 * 10**18 + i} for i in range(3)])
    for table in (rows, tower_summary(rows)):
        assert column(mg.tech_stats(table), "stddev_radius") == [1.0]
        assert column(mg.range_stats(table), "stddev_radius") == [1.0]
    assert column(mg.tech_describe(rows), "std") == [1.0]
    assert mg.tech_radius_kde(rows).count() == 200
    assert mg.tech_stats(tower_summary(far.limit(1))).first().stddev_radius is None


def operator_names(spark):
    return spark.createDataFrame(
        [(310, 260, "b"), (310, 260, "a"), (310, 5, "c"), (1, 1, "unused")], "mcc int, mnc int, operator_name string")


@pytest.mark.parametrize("sent", [100_000, 2])
def test_operators_of_a_table(spark, sent, monkeypatch):
    monkeypatch.setattr(derive, "BROADCAST_ROWS", sent)
    codes = [260] * 50 + [5, 6, 7, None]
    rows = towers(spark, *[{"mnc": mnc, "cell": i} for i, mnc in enumerate(codes)])
    found = mg.with_operator(rows, operator_names(spark), "none")
    wanted = ["a"] * 50 + ["c", "none", "none", "none"]
    assert [name for _, name in sorted(column(found, "cell", "operator_name"))] == wanted
    many = {(310, i): f"op{i}" for i in (5, 6, 260)}
    found = mg.with_operator(rows, many, "none")
    assert sorted(column(found, "operator_name")) == ["none"] * 2 + ["op260"] * 50 + ["op5", "op6"]


def test_towers_are_not_exchanged_by_code(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        found = mg.with_operator(towers(spark, {}, {"mnc": 5}), operator_names(spark))
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(mcc" not in text and "BroadcastHashJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
