"""K-Means centres of the existing towers, as candidate sites.

Centres land where towers are dense; they mark clusters, not gaps in coverage. Distance is
Euclidean in degrees. All towers together are one distributed fit of Spark's K-Means. Groups
are fitted side by side: each round is one aggregate over the places of all groups.
"""
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from mastgrid.functions.derive import with_operator
from mastgrid.functions.durable import durable
from mastgrid.schema import DEFAULT_OPERATOR

OPERATOR, TECH = ("operator_name",), ("radio",)
OPERATOR_TECH = OPERATOR + TECH

GROUP = "group_key"
PLACES_PER_PARTITION = 100_000
#: Groups that are fitted side by side; their centres are sent to every task.
GROUPS_TOGETHER = 20_000
#: Points of a group's summary, and fits of it of which the best is gone on with.
CELLS, STARTS = 4096, 4
CENTRES = pa.list_(pa.struct([("lat", pa.float64()), ("lon", pa.float64())]))


#: By grouping: the least and greatest ``k`` and the fewest towers of a group with sites.
LIMITS = {(): (3, 25, 0), OPERATOR: (2, 15, 10), TECH: (2, 15, 10), OPERATOR_TECH: (2, 8, 5)}


def site_count(by, n, k=None, k_min=None, k_max=None, min_towers=None):
    """Centres for a group of ``n`` towers; 0 if it has fewer than ``min_towers``.

    A ``k`` outside ``k_min`` to ``k_max`` (by default those of ``LIMITS``) raises. All towers
    together have ``k`` centres, or none if there are fewer towers. An operator or technology
    has at most one per five towers, a combination at most one per tower and by default one
    per three, but each ``k_min`` at least.
    """
    by = tuple(by)
    given = (k_min, k_max, min_towers)
    low, high, fewest = (d if g is None else g for g, d in zip(given, LIMITS[by]))
    if k is not None and not low <= k <= high:
        raise ValueError(f"k is {low} to {high} for {by or 'all towers together'}, not {k}")
    if not by:
        k = 10 if k is None else k
        return k if n >= max(k, fewest) else 0
    if n < fewest:
        return 0
    if by == OPERATOR_TECH:
        return max(low, min(5, n // 3) if k is None else min(k, n))
    return max(low, min(5 if k is None else k, n // 5))


def site_points(df, by=(), operators=None, default=DEFAULT_OPERATOR):
    """Distinct positions per group with their number of towers, kept by group.

    Towers at one place become one weighted point before anything is shuffled by place, so
    a place with a large part of all towers costs one row per scan task.

    The points of a finer grouping stand in for the towers: ``suggest_sites`` of points per
    operator and technology gives, for any ``by``, what it gives of the towers.
    """
    if "operator_name" in by:
        df = with_operator(df, operators, default)
    if set(df.columns) == {*by, "lat", "lon", "n_towers", GROUP}:
        return df  # they are the points of this very grouping
    towers = F.sum("n_towers") if "n_towers" in df.columns else F.count(F.lit(1)).cast("double")
    placed = df.dropna(subset=["lat", "lon"])
    points = placed.groupBy(*by, "lat", "lon").agg(towers.alias("n_towers"))
    if not by:
        return durable(points)
    # The key is a JSON text: it tells NULL from blank, and is never taken for a number.
    return durable(points.withColumn(GROUP, F.to_json(F.struct(*by))))


def suggest_sites(
    df, by=(), k=None, seed=42, max_iter=300, tol=1e-4,
    operators=None, default=DEFAULT_OPERATOR, k_min=None, k_max=None, min_towers=None,
):
    """Cluster centres of all towers, or of each group: ``by..., site_no, lat, lon, n_towers``.

    ``by`` is ``()``, ``OPERATOR``, ``TECH`` or ``OPERATOR_TECH``. Groups that are too small
    give no rows; ``site_count`` says how many centres the others have. A group with no more
    places than that has its places as centres. Groups are fitted side by side, so the number
    of jobs does not grow with theirs (up to ``GROUPS_TOGETHER`` at a time). A fit stops when
    its centres move less than ``tol`` of the variance of the positions. Centres depend on the
    towers and the seed only.
    """
    by = tuple(by)
    if by not in LIMITS:
        raise ValueError(f"by is one of {list(LIMITS)}, not {by}")

    def count(n):
        return site_count(by, n, k, k_min, k_max, min_towers)

    count(0)  # a k out of bounds raises, whatever the towers
    points = site_points(df, by, operators, default)
    groups = durable(points.groupBy(*by, *([GROUP] if by else [])).agg(*_moments())).filter("places > 0")
    if not by:
        rows = [row for g in groups.collect() if count(g.n) for row in _fit(points, g, count(g.n), seed, max_iter, tol)]
        return _site_table(df, by, rows)
    rows, held = [], {}

    def fitted():
        found = _fit_groups(points, {key: (count(g.n), g) for key, g in held.items()}, seed, max_iter, tol)
        for key, centres in found.items():
            keys = tuple(held[key][c] for c in by)
            rows.extend((*keys, i, *c) for i, c in enumerate(sorted(centres), start=1))
        held.clear()

    for g in groups.toLocalIterator():
        if count(g.n):
            held[g[GROUP]] = g
        if len(held) >= GROUPS_TOGETHER:
            fitted()
    if held:
        fitted()
    rows.sort(key=lambda row: [(x is not None, x) for x in row[:len(by) + 1]])
    return _site_table(df, by, rows)


def _moments():
    weight = F.col("n_towers")
    moments = [F.count(F.lit(1)).alias("places"), F.sum(weight).cast("bigint").alias("n")]
    for c in ("lat", "lon"):
        moments += [F.sum(weight * F.col(c)).alias(c), F.sum(weight * F.col(c) ** 2).alias(f"{c}2"),
                    F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high")]
    return moments


def _variance(g):
    """Mean variance of a group's coordinates."""
    return max(0.0, sum(g[f"{c}2"] / g.n - (g[c] / g.n) ** 2 for c in ("lat", "lon")) / 2)


def with_nearest(points, centres):
    """``points`` with their nearest centre: ``d`` squared degrees away, number ``i`` from 0.

    ``centres`` is a dict from a group's key to its ``(lat, lon)``; points of other groups are
    left out. It is sent to every task, so its size is the caller's to bound.
    """
    most = max([1, *map(len, centres.values())])

    def sent_column(axis, number):
        return pa.array([c[number][axis] if number < len(c) else None for c in centres.values()], pa.float64())

    columns = {f"_{c}{i}": sent_column(axis, i) for i in range(most) for axis, c in enumerate(("lat", "lon"))}
    sent = points.sparkSession.createDataFrame(
        pa.table({GROUP: pa.array(list(centres), pa.string()), **columns}))
    # One plain column per centre: a function over an array of centres runs outside generated
    # code, at a hundred times the cost. Centres that a group lacks are NULL and never nearest.
    north, east = ([F.col(c) - F.col(f"_{c}{i}") for i in range(most)] for c in ("lat", "lon"))
    away = F.array(*[y * y + x * x for y, x in zip(north, east)])
    near = points.join(F.broadcast(sent), GROUP).withColumn("_away", away).withColumn("d", F.array_min("_away"))
    return near.select(*points.columns, "d", (F.array_position("_away", F.col("d")) - 1).cast("int").alias("i"))


def _means(places, centres):
    """Means and towers of the places nearest to each centre: ``{(group, i): (lat, lon, n)}``.

    Centres that no place is nearest to are not in it. What comes back is a row per centre.
    """
    weight = F.col("n_towers")
    sums = with_nearest(places, centres).groupBy(GROUP, "i").agg(
        F.sum(weight).alias("n"), *[F.sum(weight * F.col(c)).alias(c) for c in ("lat", "lon")])
    return {(r[GROUP], r.i): (r.lat / r.n, r.lon / r.n, int(r.n)) for r in sums.collect()}


def _cells(places, groups):
    """The places of each group as at most CELLS weighted points: ``GROUP, k, lat, lon, n``.

    Groups with more places are summed up on a grid over their extent.
    """
    names = ("k", "places", "lat_low", "lat_high", "lon_low", "lon_high")
    values = {n: [k if n == "k" else g[n] for k, g in groups.values()] for n in names}
    table = pa.table({GROUP: pa.array(list(groups), pa.string()), **values})
    sent = places.sparkSession.createDataFrame(table)
    side = int(CELLS**0.5)

    def cell(c):
        low, high = F.col(f"{c}_low"), F.col(f"{c}_high")
        part = F.floor((F.col(c) - low) / (high - low) * side).cast("double")
        return F.when(F.col("places") <= CELLS, F.col(c)).when(low < high, F.least(part, F.lit(side - 1.0))).otherwise(0.0)

    rows = places.join(F.broadcast(sent), GROUP).groupBy(GROUP, "k", cell("lat").alias("y"), cell("lon").alias("x"))
    n = F.sum("n_towers")
    return rows.agg(n.alias("n"), *[
        (F.sum(F.col("n_towers") * F.col(c)) / n).alias(c) for c in ("lat", "lon")])


def _started(seed):
    """Centres of one group's cells: the best of a few fits of up to CELLS points."""
    def fit(cells):
        cells = cells.sort_values(["lat", "lon"])
        at, n, k = cells[["lat", "lon"]].to_numpy(), cells["n"].to_numpy(), int(cells["k"].iloc[0])
        best = (np.inf, None)
        for turn in range(STARTS):
            draw = np.random.default_rng([seed, turn])
            found, away = [], np.ones(len(at))
            while len(found) < min(k, len(at)) and (n * away).any():
                # The chance of a point grows with its towers and the square of its distance.
                upto = np.cumsum(n * away)
                found.append(at[np.searchsorted(upto, draw.random() * upto[-1], "right").clip(0, len(at) - 1)])
                away = np.min([((at - c) ** 2).sum(1) for c in found], axis=0)
            found = np.array(found)
            for _ in range(100):
                near = ((at[:, None] - found) ** 2).sum(2)
                owner = near.argmin(1)
                size = np.bincount(owner, n, len(found))
                moved = np.stack([np.bincount(owner, n * at[:, c], len(found)) for c in (0, 1)], 1)
                moved = np.where(size[:, None] > 0, moved / np.maximum(size, 1e-300)[:, None], found)
                if np.allclose(moved, found, rtol=0, atol=1e-9):
                    break
                found = moved
            best = min(best, (float((n * near.min(1)).sum()), found.tolist()), key=lambda x: x[0])
        return pd.DataFrame({GROUP: cells[GROUP].iloc[0], "lat": [c[0] for c in best[1]], "lon": [c[1] for c in best[1]]})

    return fit


def _fit_groups(points, groups, seed, max_iter, tol):
    """Centres with their towers of several groups, ``{key: [(lat, lon, n)]}``.

    Each group is first fitted roughly on a summary of bounded size, one group to a task. Where
    that leaves a group short of centres, more are drawn among all its places, with a chance
    that grows with the towers and the square of the distance; places draw by a hash of
    themselves, so nothing depends on partitions. Then all groups move their centres to the
    means of their places, until each has settled. What a round gathers is a row per centre.
    """
    places = points.select(GROUP, "lat", "lon", "n_towers").persist()
    try:
        centres = {key: [] for key in groups}
        rough = _cells(places, groups).groupBy(GROUP).applyInPandas(
            _started(seed), f"{GROUP} string, lat double, lon double")
        for row in rough.collect():  # a row per centre
            centres[row[GROUP]].append((row.lat, row.lon))
        for turn in range(max(k for k, _ in groups.values())):
            open_ = {key: centres[key] for key, (k, g) in groups.items() if len(centres[key]) < min(k, g.places)}
            if not open_:
                break
            near = with_nearest(places, open_).filter("d > 0")
            u = (F.pmod(F.xxhash64("lat", "lon", F.lit(seed), F.lit(turn)), F.lit(2**52)) + 0.5) / 2.0**52
            drawn = F.min(F.struct((-F.log(u) / (F.col("n_towers") * F.col("d"))).alias("at"), "lat", "lon"))
            for row in near.groupBy(GROUP).agg(drawn.alias("c")).collect():
                centres[row[GROUP]].append((row.c.lat, row.c.lon))
        done, moving = {}, dict(centres)
        for turn in range(max_iter):
            means = _means(places, moving)
            for key in list(moving):
                old = moving[key]
                # A centre that no place is nearest to stays where it is.
                new = [means.get((key, i), (*c, 0)) for i, c in enumerate(old)]
                moved = sum((a - c) ** 2 + (b - d) ** 2 for (a, b, _), (c, d) in zip(new, old))
                if moved <= tol * _variance(groups[key][1]) or turn == max_iter - 1:
                    done[key] = [(*c, n) for c, (_, _, n) in zip(old, new)]
                    del moving[key]
                else:
                    moving[key] = [(a, b) for a, b, _ in new]
            if not moving:
                break
        return done
    finally:
        places.unpersist()


def site_fit(df, sites, by=(), tol=1e-4, operators=None, default=DEFAULT_OPERATOR):
    """How well sites fit their towers: ``by..., k, n_towers, sizes_match, settled``.

    Every tower is assigned to its nearest site anew. ``sizes_match`` holds if each site has as
    many towers as it says; ``settled`` if moving all sites of the group to the means of their
    towers moves them by no more than ``tol`` of the variance. ``sites`` is a result of
    ``suggest_sites``: at most 25 rows a group.
    """
    by = tuple(by)
    if "operator_name" in by:
        df = with_operator(df, operators, default)
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    weight = F.col("n_towers") if "n_towers" in df.columns else F.lit(1.0)
    # Towers are summed up by site in each scan task, so they are not exchanged by place first.
    points = df.dropna(subset=["lat", "lon"]).select(key.alias(GROUP), "lat", "lon", weight.alias("n_towers"))
    keyed = sites.withColumn(GROUP, key)
    centres = {}
    for row in keyed.orderBy(GROUP, "site_no").collect():
        centres.setdefault(row[GROUP], []).append((row.lat, row.lon))
    near = with_nearest(points, centres)
    weight = F.col("n_towers")
    found = near.groupBy(GROUP, "i").agg(
        F.sum(weight).cast("bigint").alias("found"),
        *[(F.sum(weight * F.col(c)) / F.sum(weight)).alias(f"mean_{c}") for c in ("lat", "lon")],
        *[F.sum(weight * F.col(c)).alias(f"{c}1") for c in ("lat", "lon")],
        *[F.sum(weight * F.col(c) ** 2).alias(f"{c}2") for c in ("lat", "lon")])
    rows = keyed.withColumn("i", F.col("site_no") - 1).join(found, [GROUP, "i"], "left")
    moved = sum((F.col(f"mean_{c}") - F.col(c)) ** 2 for c in ("lat", "lon"))
    n = F.sum("found")
    spread = sum(F.sum(f"{c}2") / n - (F.sum(f"{c}1") / n) ** 2 for c in ("lat", "lon")) / 2
    return rows.groupBy(*by, GROUP).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n_towers").alias("n_towers"),
        F.bool_and(F.col("n_towers") == F.coalesce("found", F.lit(0))).alias("sizes_match"),
        (F.coalesce(F.sum(moved), F.lit(0.0)) <= tol * spread + 1e-12).alias("settled")).drop(GROUP)


def _fit(points, group, clusters, seed, max_iter, tol):
    """Centres of all towers, in order of latitude and longitude."""
    if group.places <= clusters:
        # No more places than centres: the places are the centres. At most k rows.
        columns = ["lat", "lon", F.col("n_towers").cast("bigint")]
        centres = [tuple(row) for row in points.select(*columns).collect()]
    else:
        centres = _cluster(points, group, clusters, seed, max_iter, tol)
    return [(i, *centre) for i, centre in enumerate(sorted(centres), start=1)]


def _cluster(members, group, clusters, seed, max_iter, tol):
    # K-Means draws its first centres by partition, so a layout that follows from the places
    # alone gives the same centres in every session. Vectors are made after the exchange.
    partitions = math.ceil(group.places / PLACES_PER_PARTITION)
    laid_out = members.select("lat", "lon", "n_towers").repartition(partitions, "lat", "lon")
    laid_out = laid_out.sortWithinPartitions("lat", "lon").select(
        array_to_vector(F.array("lat", "lon")).alias("features"), "n_towers")

    # The row solver, because the block solver fails if fewer than k first centres are drawn.
    means = KMeans(
        k=clusters, seed=seed, maxIter=max_iter, tol=math.sqrt(tol * _variance(group) / clusters),
        weightCol="n_towers", predictionCol="site", solver="row",
    )
    model = means.fit(laid_out)
    if len(model.clusterCenters()) < clusters:
        # Drawing places at random gives k different ones.
        model = means.setInitMode("random").fit(laid_out)
    if len(model.clusterCenters()) < clusters:
        raise RuntimeError(f"{len(model.clusterCenters())} of {clusters} centres: use another seed")
    centres = [(float(lat), float(lon)) for lat, lon in model.clusterCenters()]
    counted = _means(members.withColumn(GROUP, F.lit("")), {"": centres})
    sizes = {i: n for (_, i), (_, _, n) in counted.items()}
    return [(*c, sizes.get(i, 0)) for i, c in enumerate(centres)]


def _site_table(df, by, rows):
    names = [*by, "site_no", "lat", "lon", "n_towers"]
    types = [pa.string()] * len(by) + [pa.int32(), pa.float64(), pa.float64(), pa.int64()]
    columns = list(zip(*rows)) or [[] for _ in names]
    table = pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)
    return df.sparkSession.createDataFrame(table)


def suggest_sites_all(df, k=10, **options):
    """Centres of all towers together; needs at least ``k`` towers."""
    return suggest_sites(df, (), k, **options)


def suggest_sites_operator(df, k=5, **options):
    """Centres of each operator's towers; operators with fewer than 10 have none."""
    return suggest_sites(df, OPERATOR, k, **options)


def suggest_sites_tech(df, k=5, **options):
    """Centres of each technology's towers; technologies with fewer than 10 have none."""
    return suggest_sites(df, TECH, k, **options)


def suggest_sites_operator_tech(df, k=None, **options):
    """Centres of each operator's towers of each technology; groups under 5 have none."""
    return suggest_sites(df, OPERATOR_TECH, k, **options)
