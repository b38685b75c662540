"""

Every query runs over whole tables. The tower table is derived from ``lineitem`` on both
sides: by DataFrame functions in ``mastgrid.sources.lineitem`` and by the SQL text below.
"""
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import mastgrid as mg  # noqa: E402
from mastgrid.functions.durable import shared_path  # noqa: E402
from mastgrid.operators.sites import OPERATOR, OPERATOR_TECH, TECH  # noqa: E402
from mastgrid.plans.summary import tower_summary  # noqa: E402
from mastgrid.sources.lineitem import towers_from_lineitem  # noqa: E402

# The training-text operators and their pipeline can be taken out; only their absence passes.
try:
    import corpus_pipeline  # noqa: E402
    from mastgrid.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "mastgrid.llm"):
        raise
    corpus_pipeline = llm = None


def raw_towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return towers_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the under-served regions."""
    return queries()["region_underserved"](spark, "/root/testdata/sf0.001")


def _through_csv(towers: DataFrame) -> DataFrame:
    """Write a headerless tower file and read it back by position."""
    path = shared_path(towers.sparkSession)
    towers.write.csv(path)
    return mg.read_towers(towers.sparkSession, path)


def _mixed_files(towers: DataFrame) -> str:
    """Headerless files of 13 columns and of 14, under one folder."""
    path, odd = shared_path(towers.sparkSession), F.col("cell") % 2 == 1
    towers.filter(~odd).write.csv(f"{path}/of13")
    signal = (-(F.col("cell") % 50)).cast("int").alias("average_signal")
    towers.filter(odd).select("*", signal).write.csv(f"{path}/of14")
    return f"{path}/*"


def _through_mixed_csv(towers: DataFrame) -> DataFrame:
    return mg.read_towers(towers.sparkSession, _mixed_files(towers))


def _lines_by_width(towers: DataFrame) -> DataFrame:
    lines = mg.tower_lines(towers.sparkSession, _mixed_files(towers))
    return lines.groupBy("width").agg(F.sum("line_count").alias("line_count"))


def _through_headed_csv(towers: DataFrame) -> DataFrame:
    """Headed files whose columns come in two orders, read by each file's own names."""
    path, odd = shared_path(towers.sparkSession), F.col("cell") % 2 == 1
    towers.filter(~odd).write.csv(f"{path}/one", header=True)
    towers.filter(odd).select(*reversed(towers.columns)).write.csv(f"{path}/other", header=True)
    return mg.read_towers(towers.sparkSession, f"{path}/*", header=True)


def _with_text_dates(towers: DataFrame) -> DataFrame:
    """Times that come as texts: epoch seconds, dates, and what is neither."""
    day = F.date_format(F.timestamp_seconds("created"), "yyyy-MM-dd")
    said = F.when(F.col("cell") % 3 == 0, F.col("created").cast("string")).when(F.col("cell") % 3 == 1, day)
    texts = towers.withColumns({"created": F.coalesce(said, F.lit("soon")), "updated": F.col("updated").cast("string")})
    return mg.with_timestamps(texts).select("area", "cell", "created_ts", "updated_ts", "year")


def _through_clean_parquet(towers: DataFrame) -> DataFrame:
    """Keep the cleaned table by technology and read all of it."""
    path = shared_path(towers.sparkSession)
    mg.save_clean(mg.clean_towers(towers), path)
    kept = mg.read_towers(towers.sparkSession, path, "parquet")
    return kept.select("radio", "area", "cell", "lon", "lat", "range", "created")


def _through_sink(towers: DataFrame) -> DataFrame:
    """Write a result partitioned by technology and read it back."""
    path = shared_path(towers.sparkSession)
    mg.write_result(mg.region_tech_count(mg.clean_towers(towers)), path, "parquet", ["radio"])
    return towers.sparkSession.read.parquet(path)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 4) for name in names})


def _operator_table(towers: DataFrame) -> DataFrame:
    """A table of operators that follows from the towers: some codes are named, one twice."""
    codes = towers.select("mcc", "mnc").distinct().filter("mnc <> 120")
    names = F.explode(F.array(F.concat(F.lit("net "), "mnc"), F.concat(F.lit("old "), "mnc")))
    return codes.select("mcc", "mnc", names.alias("operator_name"))


def _shown(layers: DataFrame) -> DataFrame:
    """The markers of layers but the suggested sites, which have no SQL."""
    return layers.filter(F.col("popup").isNull() | ~F.col("popup").startswith("Suggested"))


# On the towers as they come.
RAW_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "clean_towers": mg.clean_towers,
    "tower_row_count": mg.tower_row_count,
    "read_towers_csv": _through_csv,
    "read_towers_mixed": _through_mixed_csv,
    "read_towers_headed": _through_headed_csv,
    "tower_lines": _lines_by_width,
    "with_timestamps": _with_text_dates,
    "save_clean_parquet": _through_clean_parquet,
    "write_result_parquet": _through_sink,
    "conform_towers": lambda t: mg.conform_towers(t.toDF(*[f"_c{i}" for i in range(13)])),
}

# On the cleaned towers.
CLEAN_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "by_operator": lambda t: mg.by_operator(t, "T-Mobile US"),
    "by_operator_default": lambda t: mg.by_operator(t, "Other"),
    "by_tech": lambda t: mg.by_tech(t, "NR"),
    "by_operator_tech": lambda t: mg.by_operator_tech(t, "Verizon US", "GSM"),
    "recent_years": lambda t: mg.recent_years(t).select("area", "cell", "created", "year"),
    "with_tower_id": lambda t: mg.with_tower_id(t).select("tower_id", "area", "cell"),
    "with_year": lambda t: mg.with_year(t).select("area", "cell", "created", "year"),
    "with_operator_code": lambda t: mg.with_operator_code(t).select("mcc", "mnc", "operator"),
    "with_operator": lambda t: mg.with_operator(t).select("mcc", "mnc", "cell", "operator_name"),
    "with_tech_color": lambda t: mg.with_tech_color(t).select("radio", "cell", "color"),
    "with_operator_color": lambda t: mg.with_operator_color(t).select(
        "operator_name", "cell", "color"
    ),
    "created_parsed": mg.created_parsed,
    "distinct_tech": mg.distinct_tech,
    "distinct_tech_count": mg.distinct_tech_count,
    "distinct_operator": mg.distinct_operator,
    "distinct_cells": mg.distinct_cells,
    "tech_count": mg.tech_count,
    "tech_share": mg.tech_share,
    "tech_stats": lambda t: _rounded(mg.tech_stats(t), "stddev_radius"),
    "tech_avg_radius": mg.tech_avg_radius,
    "tech_describe": mg.tech_describe,
    "tech_radius_kde": mg.tech_radius_kde,
    "operator_radius_kde": mg.operator_radius_kde,
    "range_stats": lambda t: _rounded(mg.range_stats(t), "stddev_radius"),
    "region_key_half_up": lambda t: mg.region_count(t, mode="half_up"),
    "region_key_half_even": lambda t: mg.region_count(t, mode="half_even"),
    "region_count": mg.region_count,
    "region_densest": mg.region_densest,
    "region_top10": lambda t: mg.region_count(t, 10),
    "region_stats": mg.region_stats,
    "region_stats_half_even": lambda t: mg.region_stats(t, mode="half_even"),
    "region_stats_top10": lambda t: mg.region_stats(t, 10),
    "region_tech_count": mg.region_tech_count,
    "region_tech_top20": lambda t: mg.region_tech_count(t, 20),
    "region_avg_radius_top": mg.region_avg_radius,
    "region_avg_radius_top5": lambda t: mg.region_avg_radius(t, 5),
    "region_avg_radius_top5_half_even": lambda t: mg.region_avg_radius(t, 5, "half_even"),
    "region_largest_radius": mg.region_largest_radius,
    "region_smallest_radius": mg.region_smallest_radius,
    "region_underserved": mg.region_underserved,
    "region_underserved_top10": lambda t: mg.region_underserved(t, k=10),
    "top5_regions": mg.top_regions,
    "top_region_tech_share": mg.top_region_tech_share,
    "tower_samples": mg.tower_samples,
    "tower_samples_full_key": lambda t: mg.tower_samples(t, full_key=True),
    "tower_top_samples": lambda t: mg.tower_samples(t, 10),
    "year_tech_count": mg.year_tech_count,
    "recent_year_tech_count": mg.recent_year_tech_count,
    "operator_count": mg.operator_count,
    "operator_tech_count": mg.operator_tech_count,
    "operator_tech_top20": lambda t: mg.operator_tech_count(t, 20),
    "operator_tech_split": mg.operator_tech_split,
    "region_operator_count": mg.region_operator_count,
    "region_top_operator": mg.region_top_operator,
    "operator_top_regions": mg.operator_top_regions,
    "operator_preview": mg.operator_preview,
    "centroid": mg.centroid,
    "centroid_operator": lambda t: mg.centroid(mg.with_operator(t), OPERATOR),
    "centroid_tech": lambda t: mg.centroid(t, TECH),
    "centroid_operator_tech": lambda t: mg.centroid(mg.with_operator(t), OPERATOR_TECH),
    "tower_sample": mg.tower_sample,
    "density_grid": mg.density_grid,
    "density_grid_half_degree": lambda t: mg.density_grid(t, 0.5),
    "tower_summary": lambda t: tower_summary(t).withColumns(
        {name: F.col(name).cast("double") for name in ("range_squares", "samples_squares")}),
    "with_operator_table": lambda t: mg.with_operator(t, _operator_table(t), "Unknown").select(
        "mcc", "mnc", "cell", "operator_name"),
    "operator_tech_count_table": lambda t: mg.operator_tech_count(
        t, operators=_operator_table(t), default="Unknown"),
    "layer_scatter": mg.layer_scatter,
    "layer_density": mg.layer_density,
    "layer_region_radius": mg.layer_region_radius,
    "layer_region_samples": mg.layer_region_samples,
    "layer_underserved": mg.layer_underserved,
    "layer_top_operator": mg.layer_top_operator,
    "layer_operator_scatter": mg.layer_operator_scatter,
    "suggest_sites_all": mg.suggest_sites_all,
    "suggest_sites_operator": mg.suggest_sites_operator,
    "suggest_sites_tech": mg.suggest_sites_tech,
    "suggest_sites_operator_tech": mg.suggest_sites_operator_tech,
    "suggest_sites_all_fit": lambda t: mg.site_fit(t, mg.suggest_sites_all(t)),
    "suggest_sites_operator_fit": lambda t: mg.site_fit(t, mg.suggest_sites_operator(t), OPERATOR),
    "suggest_sites_tech_fit": lambda t: mg.site_fit(t, mg.suggest_sites_tech(t), TECH),
    "suggest_sites_operator_tech_fit": lambda t: mg.site_fit(
        t, mg.suggest_sites_operator_tech(t), OPERATOR_TECH),
    "layer_sites_all_towers": lambda t: _shown(mg.layer_sites(t, "all")),
    "layer_sites_operator_towers": lambda t: _shown(mg.layer_sites(t, "operator")),
    "layer_sites_tech_towers": lambda t: _shown(mg.layer_sites(t, "tech")),
    "layer_sites_operator_tech_towers": lambda t: _shown(mg.layer_sites(t, "operator_tech")),
    "map_layers_shown": lambda t: _shown(mg.map_layers(t)),
    "layer_sites": mg.layer_sites,
    "map_layers": mg.map_layers,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = tower_queries()
    if llm:
        found.update(llm.QUERIES, pipeline=corpus_pipeline.run)
    return found


def tower_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries on the tower table."""

    def on_raw(operator):
        return lambda spark, sf_dir: operator(raw_towers(spark, sf_dir))

    def on_clean(operator):
        return lambda spark, sf_dir: operator(mg.clean_towers(raw_towers(spark, sf_dir)))

    found = {name: on_raw(operator) for name, operator in RAW_QUERIES.items()}
    found.update({name: on_clean(operator) for name, operator in CLEAN_QUERIES.items()})
    return found


# The tower table and what most checks start from: clean rows, their region, their operator.
TOWERS_SQL = """
WITH towers AS (
  SELECT CASE WHEN l_partkey % 10 < 5 THEN 'LTE' WHEN l_partkey % 10 < 7 THEN 'UMTS'
              WHEN l_partkey % 10 < 9 THEN 'GSM' ELSE 'NR' END AS radio,
    CAST(CASE WHEN l_suppkey % 10 IN (3,4) THEN 311 ELSE 310 END AS INT) AS mcc,
    CAST(CASE l_suppkey % 10 WHEN 0 THEN 260 WHEN 1 THEN 260 WHEN 2 THEN 410 WHEN 3 THEN 480
         WHEN 4 THEN 480 WHEN 5 THEN 120 WHEN 6 THEN 410 WHEN 7 THEN 260 WHEN 8 THEN 4
         ELSE 30 END AS INT) AS mnc,
    CAST(l_suppkey AS BIGINT) AS area,
    CAST(l_partkey AS BIGINT) AS cell,
    CAST(0 AS INT) AS unit,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
         WHEN l_linenumber = 1 THEN -CAST(75 + (l_partkey % 40) AS DOUBLE) - 5e-1
         ELSE -75e0 - (CASE WHEN 4e3 / ((l_partkey * 7919 + l_orderkey * 31) % 10007 + 1) > 45e0
                       THEN 45e0
                       ELSE 4e3 / ((l_partkey * 7919 + l_orderkey * 31) % 10007 + 1) END)
         END AS lon,
    CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN CAST(0 AS DOUBLE)
         WHEN l_linenumber = 1 THEN CAST(25 + (l_suppkey % 20) AS DOUBLE) + 5e-1
         ELSE 25e0 + (CASE WHEN 4e3 / ((l_orderkey * 104729 + l_linenumber * 1299709) % 10009 + 1)
                                > 24e0
                      THEN 24e0
                      ELSE 4e3 / ((l_orderkey * 104729 + l_linenumber * 1299709) % 10009 + 1) END)
         END AS lat,
    CAST(500 + ((l_partkey * 37 + l_orderkey) % 40) * 100 AS BIGINT) AS "range",
    CAST(l_quantity AS BIGINT) AS samples,
    CAST(1 AS INT) AS changeable,
    CAST(1104537600 + ((l_orderkey * 31337 + l_linenumber) % 6500) * 86400 AS BIGINT) AS created,
    CAST(1104537600 + ((l_orderkey * 31337 + l_linenumber) % 6500 + 30) * 86400 AS BIGINT)
      AS updated
  FROM lineitem
), clean AS (
  SELECT * FROM towers WHERE lat IS NOT NULL AND lon IS NOT NULL AND lat <> 0 AND lon <> 0
), region AS (
  SELECT *, CAST(round(lat) AS INT) AS lat_r, CAST(round(lon) AS INT) AS lon_r,
    CAST(year(make_timestamp(created * 1000000)) AS INT) AS year,
    CASE WHEN mcc = 310 AND mnc = 260 THEN 'T-Mobile US' WHEN mcc = 310 AND mnc = 410 THEN 'AT&T US'
         WHEN mcc = 311 AND mnc = 480 THEN 'Verizon US' WHEN mcc = 310 AND mnc = 120 THEN 'Sprint'
         ELSE 'Other' END AS operator_name
  FROM clean
), even_region AS (
  SELECT * REPLACE (CAST(round_even(lat, 0) AS INT) AS lat_r, CAST(round_even(lon, 0) AS INT) AS lon_r)
  FROM region
), stats AS (
  SELECT lat_r, lon_r, count(*) AS tower_count, avg("range") AS avg_radius,
    avg(samples) AS avg_samples
  FROM region GROUP BY lat_r, lon_r
)
"""

COUNT = "count(*) AS tower_count"
TECH_COLOR = """CASE radio WHEN 'LTE' THEN 'blue' WHEN 'GSM' THEN 'green' WHEN 'UMTS' THEN 'orange'
  WHEN 'NR' THEN 'red' ELSE 'gray' END"""
OPERATOR_COLOR = """CASE operator_name WHEN 'T-Mobile US' THEN 'blue' WHEN 'AT&T US' THEN 'green'
  WHEN 'Verizon US' THEN 'red' WHEN 'Sprint' THEN 'orange' ELSE 'gray' END"""
SAMPLE_ORDER = """md5(concat_ws('_', area, cell, created, 42)), samples, "range", lat, lon, radio,
  mcc, mnc, updated"""
MOMENTS = """count(*) AS tower_count, count("range") AS range_n,
  CAST(sum("range") AS BIGINT) AS range_sum, CAST(sum("range" * "range") AS DOUBLE) AS range_squares,
  min("range") AS range_min, max("range") AS range_max, count(samples) AS samples_n,
  CAST(sum(samples) AS BIGINT) AS samples_sum,
  CAST(sum(samples * samples) AS DOUBLE) AS samples_squares,
  min(samples) AS samples_min, max(samples) AS samples_max"""
RADIUS_POPUP = """'Avg Radius: ' || CAST(CAST(round_even(avg_radius, 0) AS BIGINT) AS VARCHAR)
  || ' m<br>Towers: ' || tower_count"""
SCATTER = f"""lat, lon, CAST(2 AS DOUBLE) AS radius, {TECH_COLOR} AS color,
  radio || ' | Area: ' || area || ' | Cell: ' || cell AS popup"""


def _kde_sql(keys: str) -> str:
    same = " AND ".join(f"r.{k.strip()} = g.{k.strip()}" for k in keys.split(","))
    named = ", ".join(f"g.{k.strip()}" for k in keys.split(","))
    return f""", moments AS (
      SELECT {keys}, count(*) AS n, min("range") AS lo, max("range") AS hi,
        stddev_samp("range") * pow(count(*), -0.2) AS h
      FROM region GROUP BY {keys}
    ), grid AS (
      SELECT *, lo - 3 * h + i * (hi - lo + 6 * h) / 199 AS x
      FROM moments, range(200) AS steps(i) WHERE h > 0
    )
    SELECT {named}, CAST(g.i AS INT) AS grid_no, round(g.x, 4) AS x,
      round(sum(exp(-0.5 * pow((g.x - r."range") / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 10)
        AS density
    FROM grid g JOIN region r ON {same}
    GROUP BY {named}, g.i, g.x, g.n, g.h"""


def _ranked_sql(columns: str, partition: str, order: str, k: int) -> str:
    return f"""SELECT {columns} FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS INT) AS rank
      FROM region) WHERE rank <= {k}"""


REGION_OPERATOR = f"""SELECT lat_r, lon_r, operator_name, {COUNT} FROM region
  GROUP BY lat_r, lon_r, operator_name"""
DENSEST = "ORDER BY tower_count DESC, lat_r, lon_r"
UNDERSERVED = "FROM stats WHERE tower_count < 10 AND avg_radius < 2000"
AVERAGE_2 = """CAST(printf('%.2f', avg("range")) AS DOUBLE) AS avg_radius"""

ORACLES: dict[str, str] = {
    "clean_towers": "SELECT * FROM clean",
    "tower_row_count": """SELECT count(*) AS raw_count,
      (SELECT count(*) FROM clean) AS clean_count FROM towers""",
    "read_towers_csv": "SELECT * EXCLUDE (unit) FROM towers",
    "read_towers_mixed": """SELECT * EXCLUDE (unit),
      CASE WHEN cell % 2 = 1 THEN CAST(-(cell % 50) AS INT) END AS average_signal FROM towers""",
    "read_towers_headed": "SELECT * EXCLUDE (unit) FROM towers",
    "tower_lines": """SELECT CAST(13 + cell % 2 AS INT) AS width, count(*) AS line_count FROM towers
      GROUP BY 1""",
    "with_timestamps": """SELECT area, cell, CASE WHEN cell % 3 < 2 THEN make_timestamp(
        (CASE WHEN cell % 3 = 0 THEN created ELSE created // 86400 * 86400 END) * 1000000) END AS created_ts,
      make_timestamp(updated * 1000000) AS updated_ts,
      CASE WHEN cell % 3 < 2 THEN CAST(year(make_timestamp(created * 1000000)) AS INT) END AS year
      FROM towers""",
    "save_clean_parquet": 'SELECT radio, area, cell, lon, lat, "range", created FROM clean',
    "write_result_parquet": f"""SELECT lat_r, lon_r, radio, {COUNT} FROM region
      GROUP BY lat_r, lon_r, radio""",
    "conform_towers": "SELECT * EXCLUDE (unit) FROM towers",
    "by_operator": """SELECT * EXCLUDE (lat_r, lon_r, year) FROM region
      WHERE operator_name = 'T-Mobile US'""",
    "by_operator_default": """SELECT * EXCLUDE (lat_r, lon_r, year) FROM region
      WHERE operator_name = 'Other'""",
    "by_tech": "SELECT * FROM clean WHERE radio = 'NR'",
    "by_operator_tech": """SELECT * EXCLUDE (lat_r, lon_r, year) FROM region
      WHERE operator_name = 'Verizon US' AND radio = 'GSM'""",
    "recent_years": "SELECT area, cell, created, year FROM region WHERE year >= 2015",
    "with_tower_id": "SELECT area || '_' || cell AS tower_id, area, cell FROM clean",
    "with_year": "SELECT area, cell, created, year FROM region",
    "with_operator_code": """SELECT mcc, mnc, CAST(CAST(mcc AS VARCHAR) || CAST(mnc AS VARCHAR)
      AS INT) AS operator FROM clean""",
    "with_operator": "SELECT mcc, mnc, cell, operator_name FROM region",
    "with_operator_table": """SELECT mcc, mnc, cell,
      CASE WHEN mnc = 120 THEN 'Unknown' ELSE 'net ' || mnc END AS operator_name FROM region""",
    "operator_tech_count_table": f"""SELECT CASE WHEN mnc = 120 THEN 'Unknown' ELSE 'net ' || mnc END
      AS operator_name, radio, {COUNT} FROM clean GROUP BY 1, 2""",
    "with_tech_color": f"SELECT radio, cell, {TECH_COLOR} AS color FROM clean",
    "with_operator_color": f"SELECT operator_name, cell, {OPERATOR_COLOR} AS color FROM region",
    "created_parsed": """SELECT area, cell, make_timestamp(created * 1000000) AS created_ts, year
      FROM region""",
    "distinct_tech": "SELECT DISTINCT radio FROM clean",
    "distinct_tech_count": "SELECT count(DISTINCT radio) AS tech_count FROM clean",
    "distinct_operator": "SELECT DISTINCT operator_name FROM region",
    "distinct_cells": "SELECT count(DISTINCT cell) AS cell_count FROM clean",
    "tech_count": f"SELECT radio, {COUNT} FROM clean GROUP BY radio",
    "tech_share": f"""SELECT radio, tower_count, CAST(printf('%.1f', tower_count * 100
        / (SELECT count(*) FROM clean)) AS DOUBLE) AS share_pct
      FROM (SELECT radio, {COUNT} FROM clean GROUP BY radio)""",
    "tech_stats": f"""SELECT radio, {COUNT}, avg("range") AS avg_radius,
      round(stddev_samp("range"), 4) AS stddev_radius,
      CAST(sum(samples) AS BIGINT) AS total_samples FROM clean GROUP BY radio""",
    "tech_avg_radius": 'SELECT radio, avg("range") AS avg_radius FROM clean GROUP BY radio',
    "tech_describe": """SELECT radio, count("range") AS count, round(avg("range"), 2) AS mean,
      round(stddev_samp("range"), 2) AS std, CAST(min("range") AS DOUBLE) AS min,
      round(quantile_cont("range", 0.25), 2) AS p25, round(quantile_cont("range", 0.5), 2) AS p50,
      round(quantile_cont("range", 0.75), 2) AS p75, CAST(max("range") AS DOUBLE) AS max
      FROM clean GROUP BY radio""",
    "tech_radius_kde": _kde_sql("radio"),
    "operator_radius_kde": _kde_sql("operator_name, radio"),
    "range_stats": """SELECT min("range") AS min_radius, max("range") AS max_radius,
      avg("range") AS avg_radius, round(stddev_samp("range"), 4) AS stddev_radius FROM clean""",
    "region_key_half_up": f"SELECT lat_r, lon_r, {COUNT} FROM region GROUP BY lat_r, lon_r",
    "region_key_half_even": f"SELECT lat_r, lon_r, {COUNT} FROM even_region GROUP BY lat_r, lon_r",
    "region_count": "SELECT lat_r, lon_r, tower_count FROM stats",
    "region_densest": f"SELECT lat_r, lon_r, tower_count FROM stats {DENSEST} LIMIT 5",
    "region_top10": f"SELECT lat_r, lon_r, tower_count FROM stats {DENSEST} LIMIT 10",
    "region_stats": "SELECT * FROM stats",
    "region_stats_half_even": f"""SELECT lat_r, lon_r, {COUNT}, avg("range") AS avg_radius,
      avg(samples) AS avg_samples FROM even_region GROUP BY lat_r, lon_r""",
    "region_stats_top10": f"SELECT * FROM stats {DENSEST} LIMIT 10",
    "region_tech_count": f"""SELECT lat_r, lon_r, radio, {COUNT} FROM region
      GROUP BY lat_r, lon_r, radio""",
    "region_tech_top20": f"""SELECT lat_r, lon_r, radio, {COUNT} FROM region
      GROUP BY lat_r, lon_r, radio {DENSEST}, radio LIMIT 20""",
    "region_avg_radius_top": f"""SELECT lat_r, lon_r, {AVERAGE_2} FROM region
      GROUP BY lat_r, lon_r""",
    "region_avg_radius_top5": f"""SELECT lat_r, lon_r, {AVERAGE_2} FROM region
      GROUP BY lat_r, lon_r ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    "region_avg_radius_top5_half_even": f"""SELECT lat_r, lon_r, {AVERAGE_2} FROM even_region
      GROUP BY lat_r, lon_r ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    "region_largest_radius": """SELECT * FROM stats
      ORDER BY avg_radius DESC, lat_r, lon_r LIMIT 5""",
    "region_smallest_radius": "SELECT * FROM stats ORDER BY avg_radius, lat_r, lon_r LIMIT 5",
    "region_underserved": f"SELECT * {UNDERSERVED}",
    "region_underserved_top10": f"SELECT * {UNDERSERVED} ORDER BY avg_radius, lat_r, lon_r LIMIT 10",
    "top5_regions": f"SELECT lat_r, lon_r FROM stats {DENSEST} LIMIT 5",
    "top_region_tech_share": f""", densest AS (SELECT lat_r, lon_r FROM stats {DENSEST} LIMIT 5)
      SELECT lat_r, lon_r, radio, {COUNT} FROM region JOIN densest USING (lat_r, lon_r)
      GROUP BY lat_r, lon_r, radio""",
    "tower_samples": """SELECT area || '_' || cell AS tower_id,
      CAST(sum(samples) AS BIGINT) AS total_samples FROM clean GROUP BY 1""",
    "tower_samples_full_key": """SELECT concat_ws('_', mcc, mnc, area, cell) AS tower_id,
      CAST(sum(samples) AS BIGINT) AS total_samples FROM clean GROUP BY 1""",
    "tower_top_samples": """SELECT area || '_' || cell AS tower_id,
      CAST(sum(samples) AS BIGINT) AS total_samples FROM clean GROUP BY 1
      ORDER BY total_samples DESC, tower_id LIMIT 10""",
    "year_tech_count": f"SELECT year, radio, {COUNT} FROM region GROUP BY year, radio",
    "recent_year_tech_count": f"""SELECT year, radio, {COUNT} FROM region WHERE year >= 2015
      GROUP BY year, radio""",
    "operator_count": f"SELECT operator_name, {COUNT} FROM region GROUP BY operator_name",
    "operator_tech_count": f"""SELECT operator_name, radio, {COUNT} FROM region
      GROUP BY operator_name, radio""",
    "operator_tech_top20": f"""SELECT operator_name, radio, {COUNT} FROM region
      GROUP BY operator_name, radio ORDER BY tower_count DESC, operator_name, radio LIMIT 20""",
    "operator_tech_split": f"""SELECT operator_name, radio, {COUNT} FROM region
      GROUP BY operator_name, radio""",
    "region_operator_count": REGION_OPERATOR,
    "region_top_operator": f"""SELECT lat_r, lon_r, operator_name, tower_count
      FROM ({REGION_OPERATOR}) QUALIFY row_number() OVER (
        PARTITION BY lat_r, lon_r ORDER BY tower_count DESC, operator_name) = 1""",
    "operator_top_regions": f"""SELECT operator_name, lat_r, lon_r, tower_count, CAST(row_number()
        OVER (PARTITION BY operator_name ORDER BY tower_count DESC, lat_r, lon_r) AS INT) AS rank
      FROM ({REGION_OPERATOR}) QUALIFY rank <= 10""",
    "operator_preview": _ranked_sql(
        'operator_name, radio, lat, lon, "range", samples', "operator_name",
        'area, cell, created, samples, "range", lat, lon, radio', 20,
    ),
    "centroid": "SELECT round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM clean",
    "centroid_operator": """SELECT operator_name, round(avg(lat), 6) AS lat,
      round(avg(lon), 6) AS lon FROM region GROUP BY operator_name""",
    "centroid_tech": """SELECT radio, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon
      FROM region GROUP BY radio""",
    "centroid_operator_tech": """SELECT operator_name, radio, round(avg(lat), 6) AS lat,
      round(avg(lon), 6) AS lon FROM region GROUP BY operator_name, radio""",
    "tower_sample": f"SELECT * FROM clean ORDER BY {SAMPLE_ORDER} LIMIT 3000",
    "density_grid": f"""SELECT floor(lat) AS cell_lat, floor(lon) AS cell_lon, {COUNT} FROM clean
      GROUP BY 1, 2""",
    "density_grid_half_degree": f"""SELECT floor(lat / 5e-1) * 5e-1 AS cell_lat,
      floor(lon / 5e-1) * 5e-1 AS cell_lon, {COUNT} FROM clean GROUP BY 1, 2""",
    "tower_summary": f"""SELECT lat_r, lon_r, radio, mcc, mnc, year, {MOMENTS} FROM region
      GROUP BY lat_r, lon_r, radio, mcc, mnc, year""",
    "layer_scatter": f"""SELECT 'scatter' AS layer, {SCATTER}
      FROM (SELECT * FROM clean ORDER BY {SAMPLE_ORDER} LIMIT 3000)""",
    "layer_density": """SELECT 'density' AS layer, floor(lat) + 5e-1 AS lat, floor(lon) + 5e-1 AS lon,
      CAST(10 AS DOUBLE) AS radius, 'red' AS color, 'Towers: ' || count(*) AS popup
      FROM clean GROUP BY floor(lat), floor(lon)""",
    "layer_region_radius": f"""SELECT 'region_radius' AS layer, CAST(lat_r AS DOUBLE) AS lat,
      CAST(lon_r AS DOUBLE) AS lon, least(greatest(avg_radius / 1e3, 4e0), 2e1) AS radius,
      'purple' AS color, {RADIUS_POPUP} AS popup FROM stats""",
    "layer_region_samples": """SELECT 'region_samples' AS layer, CAST(lat_r AS DOUBLE) AS lat,
      CAST(lon_r AS DOUBLE) AS lon, least(greatest(avg_samples / 5, 4e0), 2e1) AS radius,
      'darkgreen' AS color,
      'Avg Samples: ' || printf('%.1f', avg_samples) || '<br>Towers: ' || tower_count AS popup
      FROM stats""",
    "layer_underserved": f"""SELECT 'underserved' AS layer, CAST(lat_r AS DOUBLE) AS lat,
      CAST(lon_r AS DOUBLE) AS lon, CAST(5 AS DOUBLE) AS radius, 'black' AS color,
      {RADIUS_POPUP} AS popup {UNDERSERVED}""",
    "layer_top_operator": f"""SELECT 'top_operator' AS layer, CAST(lat_r AS DOUBLE) AS lat,
      CAST(lon_r AS DOUBLE) AS lon, CAST(6 AS DOUBLE) AS radius, {OPERATOR_COLOR} AS color,
      operator_name || '<br>Towers: ' || tower_count AS popup
      FROM ({REGION_OPERATOR}) QUALIFY row_number() OVER (
        PARTITION BY lat_r, lon_r ORDER BY tower_count DESC, operator_name) = 1""",
    "layer_operator_scatter": _ranked_sql(
        f"'operator_scatter' AS layer, {SCATTER}", "operator_name", SAMPLE_ORDER, 1000
    ),
}


def _fit_sql(keys: str, fewest: int, per: int) -> str:
    """Sites per group of at least ``fewest`` towers: one per ``per`` towers, 2 to 5."""
    return f"""SELECT {keys}, least(greatest(2, least(5, n // {per})), places) AS k, n AS n_towers,
        true AS sizes_match, true AS settled
      FROM (SELECT {keys}, count(*) AS n, count(DISTINCT (lat, lon)) AS places FROM region GROUP BY {keys})
      WHERE n >= {fewest}"""


def _site_towers_sql(kind: str, keys: str, size: int, color: str, shown: int, fewest: int) -> str:
    """The towers under the sites of a kind: the first ``shown`` of each group in sample order."""
    partition = f"PARTITION BY {keys}" if keys else ""
    return f"""SELECT 'sites_{kind}' AS layer, lat, lon, CAST({size} AS DOUBLE) AS radius,
        '{color}' AS color, CAST(NULL AS VARCHAR) AS popup
      FROM (SELECT *, row_number() OVER ({partition} ORDER BY {SAMPLE_ORDER}) AS place,
        count(*) OVER ({partition}) AS n FROM region) WHERE place <= {shown} AND n >= {fewest}"""


ORACLES.update({
    "suggest_sites_all_fit": """SELECT CAST(10 AS BIGINT) AS k, count(*) AS n_towers,
      true AS sizes_match, true AS settled FROM clean""",
    "suggest_sites_operator_fit": _fit_sql("operator_name", 10, 5),
    "suggest_sites_tech_fit": _fit_sql("radio", 10, 5),
    "suggest_sites_operator_tech_fit": _fit_sql("operator_name, radio", 5, 3),
    "layer_sites_all_towers": _site_towers_sql("all", "", 1, "gray", 1500, 10),
    "layer_sites_operator_towers": _site_towers_sql("operator", "operator_name", 1, "blue", 1000, 10),
    "layer_sites_tech_towers": _site_towers_sql("tech", "radio", 1, "orange", 1000, 10),
    "layer_sites_operator_tech_towers": _site_towers_sql(
        "operator_tech", "operator_name, radio", 2, "blue", 1 << 40, 5),
})
LAYERS = [
    "layer_scatter", "layer_density", "layer_region_radius", "layer_region_samples", "layer_underserved",
    "layer_top_operator", "layer_operator_scatter", "layer_sites_all_towers", "layer_sites_operator_towers",
    "layer_sites_tech_towers", "layer_sites_operator_tech_towers",
]
ORACLES["map_layers_shown"] = " UNION ALL ".join(
    f"SELECT layer, lat, lon, radius, color, popup FROM ({ORACLES[name]})" for name in LAYERS)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that SQL can express."""
    found = tower_sql()
    if llm:
        found.update(llm.ORACLES)
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def tower_sql() -> dict[str, str]:
    """DuckDB SQL for the queries on towers but the K-Means ones, which SQL cannot express."""
    return {name: TOWERS_SQL + body for name, body in ORACLES.items()}
