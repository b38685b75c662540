from mastgrid.operators.carriers import (
    distinct_operator,
    operator_count,
    operator_preview,
    operator_tech_count,
    operator_tech_split,
    operator_top_regions,
    region_operator_count,
    region_top_operator,
)
from mastgrid.operators.clean import (
    by_operator,
    by_operator_tech,
    by_tech,
    clean_towers,
    recent_years,
    tower_row_count,
)
from mastgrid.operators.layers import (
    layer_density,
    layer_operator_scatter,
    layer_region_radius,
    layer_region_samples,
    layer_scatter,
    layer_sites,
    layer_top_operator,
    layer_underserved,
    map_layers,
)
from mastgrid.operators.region import (
    region_avg_radius,
    region_count,
    region_densest,
    region_largest_radius,
    region_smallest_radius,
    region_stats,
    region_tech_count,
    region_underserved,
    top_region_tech_share,
    top_regions,
)
from mastgrid.operators.sites import (
    site_fit,
    suggest_sites,
    suggest_sites_all,
    suggest_sites_operator,
    suggest_sites_operator_tech,
    suggest_sites_tech,
)
from mastgrid.operators.stats import (
    centroid,
    density_grid,
    operator_radius_kde,
    tech_radius_kde,
    tower_sample,
)
from mastgrid.operators.tech import (
    distinct_cells,
    distinct_tech,
    distinct_tech_count,
    range_stats,
    tech_avg_radius,
    tech_count,
    tech_describe,
    tech_share,
    tech_stats,
    tower_samples,
)
from mastgrid.operators.temporal import (
    created_parsed,
    recent_year_tech_count,
    year_tech_count,
)

__all__ = [name for name, value in globals().items() if callable(value)]
