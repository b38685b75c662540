"""Map layers as tables: one row per marker, ``layer, lat, lon, radius, color, popup``."""
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastgrid.functions.derive import operator_color, tech_color, with_operator
from mastgrid.functions.durable import durable
from mastgrid.functions.numeric import clip, round_half_even
from mastgrid.operators.carriers import region_top_operator
from mastgrid.operators.region import is_underserved, region_stats, region_underserved
from mastgrid.operators.sites import OPERATOR, OPERATOR_TECH, TECH, site_points, suggest_sites
from mastgrid.operators.stats import density_grid, tower_sample
from mastgrid.schema import DEFAULT_OPERATOR

COLUMNS = ["layer", "lat", "lon", "radius", "color", "popup"]
#: Towers usually shown, of all and of each operator.
SCATTER, OPERATOR_SCATTER = 3000, 1000


def marker(layer, lat, lon, radius, color, popup):
    """The columns of one marker."""
    values = [F.lit(layer), lat.cast("double"), lon.cast("double")]
    values.append(F.lit(None).cast("double") if radius is None else radius.cast("double"))
    values += [F.lit(color) if isinstance(color, str) else color, popup]
    return [value.alias(name) for name, value in zip(COLUMNS, values)]


def text(*parts):
    """Concatenation in which a NULL leaves a blank."""
    columns = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
               for p in parts]
    return F.concat(*columns)


def _scatter_marker(layer):
    popup = text(F.col("radio"), " | Area: ", F.col("area"), " | Cell: ", F.col("cell"))
    return marker(layer, F.col("lat"), F.col("lon"), F.lit(2), tech_color(), popup)


def _radius_popup():
    metres = F.rint("avg_radius").cast("bigint")
    return text("Avg Radius: ", metres, " m<br>Towers: ", F.col("tower_count"))


def _radius_marker():
    size = clip(F.col("avg_radius") / 1000, 4, 20)
    return marker(
        "region_radius", F.col("lat_r"), F.col("lon_r"), size, "purple", _radius_popup()
    )


def _samples_marker():
    size = clip(F.col("avg_samples") / 5, 4, 20)
    average = F.format_string("%.1f", round_half_even(F.col("avg_samples"), 1))
    popup = text("Avg Samples: ", average, "<br>Towers: ", F.col("tower_count"))
    return marker("region_samples", F.col("lat_r"), F.col("lon_r"), size, "darkgreen", popup)


def _underserved_marker():
    return marker(
        "underserved", F.col("lat_r"), F.col("lon_r"), F.lit(5), "black", _radius_popup()
    )


def layer_scatter(df, n=SCATTER, seed=42):
    """A sample of towers in the colours of their technologies."""
    return tower_sample(df, n, seed).select(*_scatter_marker("scatter"))


def layer_density(df, size=1.0):
    """Centres of the density grid's cells; all towers count, not a sample."""
    middle = [F.col(c) + size / 2 for c in ("cell_lat", "cell_lon")]
    popup = text("Towers: ", F.col("tower_count"))
    return density_grid(df, size).select(*marker("density", *middle, F.lit(10), "red", popup))


def layer_region_radius(df, mode="half_up"):
    """Regions sized by mean radius."""
    return region_stats(df, mode=mode).select(*_radius_marker())


def layer_region_samples(df, mode="half_up"):
    """Regions sized by mean samples."""
    return region_stats(df, mode=mode).select(*_samples_marker())


def layer_underserved(df, max_towers=10, max_radius=2000, mode="half_up"):
    """Regions with few towers of small radius."""
    few = region_underserved(df, max_towers, max_radius, mode=mode)
    return few.select(*_underserved_marker())


def layer_top_operator(df, mode="half_up", operators=None, default=DEFAULT_OPERATOR):
    """Regions in the colour of the operator with the most towers."""
    popup = text(F.col("operator_name"), "<br>Towers: ", F.col("tower_count"))
    point = marker(
        "top_operator", F.col("lat_r"), F.col("lon_r"), F.lit(6), operator_color(), popup
    )
    return region_top_operator(df, mode, operators, default).select(*point)


def layer_operator_scatter(df, n=OPERATOR_SCATTER, seed=42, operators=None, default=DEFAULT_OPERATOR):
    """A sample of each operator's towers in the colours of their technologies."""
    named = with_operator(df, operators, default)
    sample = tower_sample(named, n, seed, OPERATOR)
    return sample.select(*_scatter_marker("operator_scatter"))


def region_layers(df, mode="half_up"):
    """The three layers of regional means, from one pass over the towers."""
    radius, samples, few = (
        F.struct(*m) for m in (_radius_marker(), _samples_marker(), _underserved_marker())
    )
    markers = F.when(is_underserved(), F.array(radius, samples, few)).otherwise(
        F.array(radius, samples)
    )
    return region_stats(df, mode=mode).select(F.inline(markers))


USUAL = object()

# Layer name, grouping, towers usually shown (None for all), their marker size and colour.
SITE_LAYERS = {
    "all": ("sites_all", (), 1500, 1, "gray"),
    "operator": ("sites_operator", OPERATOR, 1000, 1, "blue"),
    "tech": ("sites_tech", TECH, 1000, 1, "orange"),
    "operator_tech": ("sites_operator_tech", OPERATOR_TECH, None, 2, "blue"),
}


def layer_sites(
    df, kind="all", sites=None, seed=42, operators=None, default=DEFAULT_OPERATOR, n=USUAL, **options
):
    """Suggested sites over the towers they were drawn from.

    ``kind`` is all, operator, tech or operator_tech. ``sites`` takes the result of an
    earlier ``suggest_sites`` of that kind; otherwise it is computed here. ``n`` towers of
    each group are shown, or all with None; ``SITE_LAYERS`` has the usual numbers. Groups
    named NULL are kept, as "unknown" in the popup.
    """
    layer, by, shown, size, color = SITE_LAYERS[kind]
    shown = shown if n is USUAL else n
    if "operator_name" in by:
        df = with_operator(df, operators, default)
    if sites is None:
        sites = suggest_sites(df, by, seed=seed, **options)
    towers = df if shown is None else tower_sample(df, shown, seed, by)
    if by:
        # Only groups that have sites. Their list is a local table whose size Spark knows.
        groups = sites.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        towers = towers.join(groups, same, "left_semi")
    elif sites.isEmpty():
        towers = towers.limit(0)
    base = marker(
        layer, F.col("lat"), F.col("lon"), F.lit(size), color, F.lit(None).cast("string")
    )
    group = [part for c in by for part in ("-", F.coalesce(c, F.lit("unknown")))][1:]
    popup = text("Suggested ", *group, " Tower #" if by else "Tower #", F.col("site_no"))
    point = marker(layer, F.col("lat"), F.col("lon"), None, "red", popup)
    return towers.select(*base).unionByName(sites.select(*point))


def map_layers(
    df, mode="half_up", operators=None, default=DEFAULT_OPERATOR, seed=42, shown=None, **options
):
    """Every layer in one table; write it with ``write_result(..., partition_by=["layer"])``.

    ``seed`` is that of all samples and fits. ``shown`` may name, by kind of sites, the
    towers of each group to show under them.
    """
    shown = shown or {}
    named = {"operators": operators, "default": default}

    # One pass over the towers gives the points of all four kinds of sites.
    points = site_points(df, OPERATOR_TECH, **named)

    # The first towers of all, of an operator or of a technology are among the first of each
    # operator's towers of each technology, so all samples are drawn from one of those.
    numbers = {kind: shown.get(kind, layer[2]) for kind, layer in SITE_LAYERS.items()}
    most = max(SCATTER, OPERATOR_SCATTER, *[n for n in numbers.values() if n is not None])
    sampled = durable(tower_sample(with_operator(df, **named), most, seed, OPERATOR_TECH))

    def sites(kind):
        found = suggest_sites(points, SITE_LAYERS[kind][1], seed=seed, **options)
        n = numbers[kind]
        return layer_sites(df if n is None else sampled, kind, found, seed, n=n, **named)

    # The four kinds of sites are independent jobs; they share the cluster.
    pool = ThreadPool(len(SITE_LAYERS))
    try:
        with_sites = pool.map(inheritable_thread_target(df.sparkSession)(sites), SITE_LAYERS)
    finally:
        pool.close()
    layers = [
        layer_scatter(sampled, SCATTER, seed),
        layer_density(df),
        region_layers(df, mode),
        layer_top_operator(df, mode, **named),
        layer_operator_scatter(sampled, OPERATOR_SCATTER, seed, **named),
        *with_sites,
    ]
    return reduce(DataFrame.unionByName, layers)
