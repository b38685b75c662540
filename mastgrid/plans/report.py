"""The whole batch report: every table of the analysis, from few passes over the towers."""
import posixpath

from mastgrid.functions.durable import durable
from mastgrid.operators import (
    clean_towers,
    distinct_cells,
    distinct_operator,
    distinct_tech,
    map_layers,
    operator_count,
    operator_preview,
    operator_radius_kde,
    operator_tech_count,
    operator_tech_split,
    operator_top_regions,
    range_stats,
    recent_year_tech_count,
    region_avg_radius,
    region_count,
    region_densest,
    region_largest_radius,
    region_operator_count,
    region_smallest_radius,
    region_stats,
    region_tech_count,
    region_top_operator,
    region_underserved,
    tech_avg_radius,
    tech_count,
    tech_describe,
    tech_radius_kde,
    tech_share,
    tech_stats,
    top_region_tech_share,
    tower_row_count,
    tower_samples,
    year_tech_count,
)
from mastgrid.plans.summary import tower_summary
from mastgrid.sources.sinks import save_clean, write_result
from mastgrid.sources.towers import read_towers


def summary_tables(summary):
    """The tables that follow from a tower summary alone."""
    return {
        "distinct_tech": distinct_tech(summary),
        "tech_count": tech_count(summary),
        "tech_share": tech_share(summary),
        "tech_stats": tech_stats(summary),
        "tech_avg_radius": tech_avg_radius(summary),
        "range_stats": range_stats(summary),
        "region_densest": region_densest(summary),
        "region_top10": region_count(summary, 10),
        "region_stats": region_stats(summary),
        "region_tech_top20": region_tech_count(summary, 20),
        "region_avg_radius_top5": region_avg_radius(summary, 5),
        "region_largest_radius": region_largest_radius(summary),
        "region_smallest_radius": region_smallest_radius(summary),
        "region_underserved_top10": region_underserved(summary, k=10),
        "top_region_tech_share": top_region_tech_share(summary),
        "year_tech_count": year_tech_count(summary),
        "recent_year_tech_count": recent_year_tech_count(summary),
        "distinct_operator": distinct_operator(summary),
        "operator_count": operator_count(summary),
        "operator_tech_top20": operator_tech_count(summary, 20),
        "operator_tech_split": operator_tech_split(summary),
        "region_operator_count": region_operator_count(summary),
        "region_top_operator": region_top_operator(summary),
        "operator_top_regions": operator_top_regions(summary),
    }


def tower_tables(towers):
    """The tables that need the towers themselves."""
    return {
        "distinct_cells": distinct_cells(towers),
        "tower_top_samples": tower_samples(towers, 10),
        "tech_describe": tech_describe(towers),
        "tech_radius_kde": tech_radius_kde(towers),
        "operator_radius_kde": operator_radius_kde(towers),
        "operator_preview": operator_preview(towers),
    }


def write_report(towers, folder, fmt="parquet", mode="errorifexists", layers=True):
    """Clean ``towers``, compute every report table and write each to its own folder.

    The input is read twice: for its row counts and to keep the cleaned table, in columns
    and by technology, under ``clean_towers``. All else reads that table, and two dozen
    tables follow from one summary of it.
    """
    spark = towers.sparkSession
    kept = posixpath.join(folder, "clean_towers")
    save_clean(clean_towers(towers), kept, mode)
    clean = read_towers(spark, kept, "parquet")
    tables = {"tower_row_count": tower_row_count(towers), **tower_tables(clean)}
    tables.update(summary_tables(durable(tower_summary(clean))))
    for name, table in tables.items():
        write_result(table, posixpath.join(folder, name), fmt, mode=mode)
    if layers:
        path = posixpath.join(folder, "map_layers")
        write_result(map_layers(clean), path, fmt, ["layer"], mode)
