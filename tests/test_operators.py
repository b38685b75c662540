import math

import pytest
from pyspark.sql import functions as F
from rows import column, towers

import mastgrid as mg
from mastgrid.functions import select
from mastgrid.functions.durable import durable, shared_folder
from mastgrid.functions.select import first_rows
from mastgrid.plans.report import summary_tables, write_report
from mastgrid.plans.summary import tower_summary
from mastgrid.sources.lineitem import towers_from_lineitem

DATA = "/root/testdata/sf0.001/lineitem.parquet"


@pytest.fixture(scope="module")
def clean(spark):
    table = mg.clean_towers(towers_from_lineitem(spark.read.parquet(DATA))).cache()
    yield table
    table.unpersist()


def sorted_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_deviation_of_one_row_is_null(spark):
    df = towers(spark, {"range": 1000})
    assert mg.tech_stats(df).first().stddev_radius is None
    assert mg.range_stats(tower_summary(df)).first().stddev_radius is None
    assert mg.tech_describe(df).first()["std"] is None
    assert mg.tech_radius_kde(df).count() == 0


def test_equal_radii_give_no_curve(spark):
    df = towers(spark, *[{"range": 100003}] * 3)
    assert mg.tech_radius_kde(df).count() == 0
    assert mg.tech_describe(df).first()["std"] == 0.0


def test_quartiles_interpolate(spark):
    row = mg.tech_describe(towers(spark, {"range": 1}, {"range": 2}, {"range": None})).first()
    assert (row["count"], row.p25, row.p50, row.p75) == (2, 1.25, 1.5, 1.75)


def test_empty_table(spark):
    df = towers(spark, {}).limit(0)
    assert tuple(mg.range_stats(df).first()) == (None, None, None, None)
    assert mg.tower_sample(df).count() == 0
    assert mg.suggest_sites_all(df).count() == 0
    assert mg.layer_sites(df).count() == 0
    assert mg.tech_share(df).count() == 0


def test_ties_take_the_first_operator(spark):
    df = towers(spark, {"mnc": 120}, {"mnc": 410})
    assert mg.region_top_operator(df).first().operator_name == "AT&T US"


def test_ties_in_top_regions_take_the_lowest_key(spark):
    df = towers(spark, *[{"lat": x} for x in (3.0, 1.0, 2.0)])
    assert column(mg.region_densest(df, 2), "lat_r") == [1, 2]


def test_means_round_as_python_does(spark):
    df = towers(spark, *[{"range": r} for r in (1, 0, 0, 0, 0, 0, 0, 0)])
    assert mg.region_avg_radius(df).first().avg_radius == round(1 / 8, 2) == 0.12


def test_underserved_limits_are_exclusive(spark):
    few = [{"lat": 1.0, "range": 1999}] * 9
    many = [{"lat": 2.0, "range": 1999}] * 10
    wide = [{"lat": 3.0, "range": 2000}]
    assert column(mg.region_underserved(towers(spark, *few, *many, *wide)), "lat_r") == [1]


def test_null_keys_are_kept(spark):
    df = towers(spark, {"radio": None}, {"radio": "LTE"})
    assert mg.tech_count(df).count() == 2


def test_region_counts_add_up(clean):
    rows = clean.count()
    for table in (mg.region_count(clean), mg.region_count(clean, mode="half_even"),
                  mg.density_grid(clean, 0.25), mg.operator_count(clean)):
        assert table.agg(F.sum("tower_count")).first()[0] == rows


def test_shares_add_up(clean):
    assert mg.tech_share(clean).agg(F.sum("share_pct")).first()[0] == pytest.approx(100, abs=0.3)


def test_curves_integrate_to_one(clean):
    areas = mg.tech_radius_kde(clean).groupBy("radio").agg(
        (F.sum("density") * (F.max("x") - F.min("x")) / 199).alias("area")
    )
    assert all(area == pytest.approx(1, abs=0.01) for area in column(areas, "area"))


def test_summary_stands_in_for_the_towers(clean):
    from_towers, from_summary = summary_tables(clean), summary_tables(tower_summary(clean))
    for name, table in from_summary.items():
        expected = from_towers[name]
        assert table.columns == expected.columns, name
        assert table.dtypes == expected.dtypes, name
        pairs = zip(sorted_rows(table), sorted_rows(expected), strict=True)
        assert all(close(a, b) for x, y in pairs for a, b in zip(x, y)), name


@pytest.mark.parametrize("operator", [
    mg.tower_sample, mg.operator_preview, mg.region_underserved, mg.tech_describe,
    mg.layer_operator_scatter, mg.top_region_tech_share, mg.operator_radius_kde,
])
def test_results_do_not_depend_on_partitioning(clean, operator):
    pairs = zip(
        sorted_rows(operator(clean)), sorted_rows(operator(clean.repartition(23))), strict=True
    )
    assert all(close(a, b) for x, y in pairs for a, b in zip(x, y))


def test_sample_has_the_exact_size(clean):
    assert mg.tower_sample(clean, 17).count() == 17
    assert mg.tower_sample(clean, 10**6).count() == clean.count()
    by_tech = mg.tower_sample(clean, 7, by=["radio"]).groupBy("radio").count()
    assert set(column(by_tech, "count")) == {7}
    assert sorted_rows(mg.tower_sample(clean, 50, seed=1)) != sorted_rows(mg.tower_sample(clean, 50))


def test_sample_of_many_copies(spark):
    copies = towers(spark, {}).crossJoin(spark.range(500)).drop("id")
    rows = copies.unionByName(towers(spark, *[{"cell": i} for i in range(2, 100)]))
    assert mg.tower_sample(rows, 300).count() == 300
    assert mg.tower_sample(rows, 20, by=["radio"]).count() == 20


def test_first_rows_of_a_hot_group(spark):
    df = spark.range(20000).select("id", (F.col("id") % 100 == 0).alias("rare")).repartition(13)
    rows = first_rows(df, 5, ["rare"], ["id"])
    assert sorted(column(rows, "id")) == [0, 1, 2, 3, 4, 5, 100, 200, 300, 400]


@pytest.fixture
def small_cuts(monkeypatch):
    """Cut groups of a few rows, as large ones are."""
    monkeypatch.setattr(select, "CUT_ROWS", 40)
    monkeypatch.setattr(select, "ACCURACY", 200)


def test_rows_are_cut_before_the_exchange(spark, small_cuts):
    df = spark.range(30_000).select(
        (F.col("id") * 7919 % 30_000).alias("id"), (F.col("id") % 100 == 0).alias("rare"),
        F.when(F.col("id") % 2 == 0, "a").alias("kind")).repartition(13)
    rows = first_rows(df, 1500, ["kind"], ["id"])
    text = rows._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    cut = next(i for i, line in enumerate(lines) if "Filter" in line and "_cut" in line)
    assert any("Exchange hashpartitioning(kind" in line for line in lines[:cut])
    for kind in ("a", None):
        mine = F.col("kind").eqNullSafe(F.lit(kind))
        wanted = sorted(column(df.filter(mine), "id"))[:1500]
        assert sorted(column(rows.filter(mine), "id")) == wanted
    kept = select.cut_rows(df, 100, ["kind"], F.col("id"))
    assert 200 <= kept.count() < 1500
    assert select.cut_rows(df, 100, [], F.col("id")).count() < 1000


def test_cut_keeps_ties_and_missing_values(spark, small_cuts):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("v"), "id")
    rows = first_rows(df, 1200, [], ["v", "id"])
    assert rows.filter("v IS NULL").count() == 1000 and rows.count() == 1200
    assert select.cut_rows(df.limit(0), 5, [], F.col("v")).count() == 0


@pytest.mark.parametrize("n", [20, 1100])
def test_samples_are_the_same_with_and_without_cuts(spark, n, monkeypatch):
    table = mg.clean_towers(towers_from_lineitem(spark.read.parquet(DATA)))
    found = []
    for least in (10**9, 30):
        monkeypatch.setattr(select, "CUT_ROWS", least)
        monkeypatch.setattr(select, "ACCURACY", 200)
        both = (mg.tower_sample(table, n), mg.tower_sample(table, n, by=["radio"]))
        found.append([sorted(map(tuple, x.collect())) for x in both])
    assert found[0] == found[1] and len(found[0][0]) == n


def test_durable_tables_are_in_the_shared_folder(spark):
    kept = durable(towers(spark, {}))
    assert shared_folder(spark).removeprefix("file:") in kept.inputFiles()[0]


def test_report(spark, tmp_path):
    folder = str(tmp_path / "report")
    write_report(towers_from_lineitem(spark.read.parquet(DATA)), folder, layers=False)
    assert spark.read.parquet(f"{folder}/tower_row_count").first().raw_count == 6000
    assert spark.read.parquet(f"{folder}/region_densest").count() == 5
