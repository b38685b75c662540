"""The physical plans are those meant: pushed filters, pruned columns, shared exchanges."""
import os
import sys

import pytest
from rows import towers

import mastgrid as mg

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as driver  # noqa: E402

DATA = "/root/testdata/sf0.001"
EAGER = {
    "read_towers_csv", "read_towers_mixed", "read_towers_headed", "tower_lines", "save_clean_parquet",
    "write_result_parquet", "layer_sites", "map_layers",
    "suggest_sites_all", "suggest_sites_operator", "suggest_sites_tech",
    "suggest_sites_operator_tech",
}
EAGER |= {f"{name}_fit" for name in EAGER if name.startswith("suggest_sites_")}
EAGER |= {f"layer_sites_{kind}_towers" for kind in ("all", "operator", "tech", "operator_tech")}
EAGER |= {"map_layers_shown", "with_operator_table", "operator_tech_count_table"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Towers in a Parquet table, as they are kept in use."""
    path = str(tmp_path_factory.mktemp("stored") / "towers")
    driver.raw_towers(spark, DATA).write.parquet(path)
    return mg.read_towers(spark, path, "parquet")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_filter_reaches_the_scan(stored):
    text = plan(mg.clean_towers(stored))
    assert "IsNotNull(lat)" in text and "IsNotNull(lon)" in text


@pytest.mark.parametrize("operator, columns", [
    (mg.tech_count, "radio:string,lon:double,lat:double"),
    (mg.region_count, "lon:double,lat:double"),
    (mg.operator_count, "mcc:int,mnc:int,lon:double,lat:double"),
    (mg.distinct_cells, "cell:bigint,lon:double,lat:double"),
    (mg.range_stats, "lon:double,lat:double,range:bigint"),
    (mg.tower_samples, "area:bigint,cell:bigint,lon:double,lat:double,samples:bigint"),
])
def test_only_needed_columns_are_read(stored, operator, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(operator(mg.clean_towers(stored)))


def test_operator_filter_is_pushed_without_a_join(stored):
    text = plan(mg.by_operator(stored, "T-Mobile US"))
    assert "EqualTo(mcc,310)" in text and "EqualTo(mnc,260)" in text and "Join" not in text


def test_year_filter_is_pushed(stored):
    assert "GreaterThanOrEqual(created,1420070400)" in plan(mg.recent_years(stored))
    assert mg.recent_years(stored).filter("year < 2015").count() == 0
    assert mg.recent_years(stored).count() == mg.with_year(stored).filter("year >= 2015").count()


@pytest.mark.parametrize("operator", [
    lambda t: mg.region_count(t, 10), mg.region_underserved, mg.top_regions, mg.tower_sample,
    mg.layer_scatter, lambda t: mg.tower_samples(t, 10), lambda t: mg.operator_tech_count(t, 20),
])
def test_top_rows_need_no_global_sort(stored, operator):
    text = plan(operator(mg.clean_towers(stored)))
    assert "rangepartitioning" not in text


@pytest.mark.parametrize("operator", [
    mg.operator_preview, mg.region_top_operator, mg.operator_top_regions,
])
def test_ranked_groups_are_cut_before_the_shuffle(stored, operator):
    assert "WindowGroupLimit" in plan(operator(stored))


@pytest.mark.parametrize("operator", [mg.top_region_tech_share, mg.tech_radius_kde])
def test_towers_are_read_once(stored, operator):
    result = operator(stored)
    result.collect()
    text = plan(result).split("Initial Plan")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


@pytest.mark.parametrize("name", sorted(set(driver.tower_queries()) - EAGER))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(driver.tower_queries()[name](spark, DATA))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_large_operator_tables_are_joined_after_counting(spark):
    df = towers(spark, {}, {"mnc": 1})
    lines = plan(mg.operator_count(df)).splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert any("partial_count" in line for line in lines[join:])
