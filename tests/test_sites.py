import pytest
from pyspark.sql import functions as F
from rows import column, towers

import mastgrid as mg
from mastgrid.operators.sites import (
    OPERATOR,
    OPERATOR_TECH,
    TECH,
    site_count,
    site_points,
    suggest_sites,
    with_nearest,
)
from mastgrid.sources.lineitem import towers_from_lineitem

DATA = "/root/testdata/sf0.001/lineitem.parquet"


@pytest.fixture(scope="module")
def clean(spark):
    table = mg.clean_towers(towers_from_lineitem(spark.read.parquet(DATA))).cache()
    yield table
    table.unpersist()


@pytest.mark.parametrize("by, n, k, expected", [
    ((), 9, 10, 0), ((), 10, 10, 10), ((), 10, None, 10),
    (OPERATOR, 9, 5, 0), (OPERATOR, 12, 5, 2), (TECH, 10, 5, 2), (TECH, 25, 5, 5),
    (OPERATOR, 1000, 15, 15), (OPERATOR, 1000, 2, 2),
    (OPERATOR_TECH, 4, None, 0), (OPERATOR_TECH, 5, None, 2), (OPERATOR_TECH, 9, None, 3),
    (OPERATOR_TECH, 100, None, 5), (OPERATOR_TECH, 100, 8, 8), (OPERATOR_TECH, 6, 8, 6),
])
def test_site_count(by, n, k, expected):
    assert site_count(by, n, k) == expected


def test_limits_are_parameters():
    assert site_count(OPERATOR, 1000, 40, k_max=50) == 40
    assert site_count(OPERATOR, 9, 5, min_towers=9) == 2
    assert site_count((), 1000, 100, k_max=100) == 100
    for k in (1, 16, 40):
        with pytest.raises(ValueError):
            site_count(OPERATOR, 1000, k)
    with pytest.raises(ValueError):
        site_count(OPERATOR_TECH, 100, 20)


def test_sites_do_not_depend_on_shuffle_partitions(spark, clean, monkeypatch):
    monkeypatch.setattr("mastgrid.operators.sites.PLACES_PER_PARTITION", 300)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in (4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append([tuple(r) for r in mg.suggest_sites_all(clean, 6).collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == [pytest.approx(row) for row in found[1]]


def test_null_groups_keep_their_towers(spark):
    rows = [{"radio": radio, "lat": 40.0 + i, "range": 100 * i}
            for radio in (None, "LTE") for i in range(20)]
    table = towers(spark, *rows)
    layer = mg.layer_sites(table, "tech")
    assert layer.filter("popup IS NULL").count() == 40
    assert "Suggested unknown Tower #1" in column(layer, "popup")
    assert mg.layer_sites(table, "tech", n=3).filter("popup IS NULL").count() == 6
    curves = mg.tech_radius_kde(table)
    assert curves.filter("radio IS NULL").count() == curves.filter("radio = 'LTE'").count() == 200


def test_bad_arguments(clean):
    with pytest.raises(ValueError):
        mg.suggest_sites_all(clean, 26)
    with pytest.raises(ValueError):
        suggest_sites(clean, ("area",))


def test_small_groups_have_no_sites(spark):
    nine = [{"mnc": 260, "lat": 40.0 + i} for i in range(9)]
    twelve = [{"mnc": 410, "lat": 40.0 + i} for i in range(12)]
    sites = mg.suggest_sites_operator(towers(spark, *nine, *twelve))
    assert column(sites, "operator_name", "site_no") == [("AT&T US", 1), ("AT&T US", 2)]


@pytest.mark.parametrize("places", [1, 4, 5, 6, 7])
def test_groups_with_few_places(spark, places):
    rows = [{"lat": 40.0 + i % places} for i in range(40)]
    sites = mg.suggest_sites_tech(towers(spark, *rows)).collect()
    assert len(sites) == min(places, 5)
    assert sum(s.n_towers for s in sites) == 40
    assert [s.site_no for s in sites] == list(range(1, len(sites) + 1))


def test_null_and_blank_groups_stay_apart(spark):
    rows = [{"radio": radio, "lat": 40.0 + i} for radio in (None, "", "4") for i in range(10)]
    sites = mg.suggest_sites_tech(towers(spark, *rows))
    assert sorted(column(sites, "radio"), key=str) == ["", "", "4", "4", None, None]
    assert sites.agg(F.sum("n_towers")).first()[0] == 30


@pytest.mark.parametrize("by, k", [((), 10), (TECH, 5), (OPERATOR_TECH, None)])
def test_sites_cover_their_groups(clean, by, k):
    named = mg.with_operator(clean)
    sites = suggest_sites(clean, by, k)
    sizes = named.groupBy(*by).count()
    expected = {tuple(r)[:-1]: r["count"] for r in sizes.collect()}
    found = sites.groupBy(*by).agg(F.count("site_no").alias("k"), F.sum("n_towers").alias("n"))
    for row in found.collect():
        n = expected.pop(tuple(row)[:-2])
        assert (row.k, row.n) == (site_count(by, n, k), n)
    assert not any(site_count(by, n, k) for n in expected.values())


def test_centres_are_the_means_of_their_nearest_towers(clean):
    sites = [(r.lat, r.lon, r.n_towers) for r in mg.suggest_sites_all(clean, 6, tol=1e-9).collect()]
    members = {i: [] for i in range(len(sites))}
    for lat, lon in clean.select("lat", "lon").collect():
        nearest = min(members, key=lambda i: (sites[i][0] - lat) ** 2 + (sites[i][1] - lon) ** 2)
        members[nearest].append((lat, lon))
    for i, (lat, lon, n) in enumerate(sites):
        assert len(members[i]) == n
        assert sum(m[0] for m in members[i]) / n == pytest.approx(lat, abs=1e-3)
        assert sum(m[1] for m in members[i]) / n == pytest.approx(lon, abs=1e-3)


def test_jobs_do_not_grow_with_groups(spark, clean):
    """Many groups are fitted in about as many jobs as few, and each comes out settled."""
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for groups in (4, 400):
        rows = spark.range(groups * 30).select(
            F.concat(F.lit("op"), F.col("id") % groups).alias("operator_name"), F.lit("LTE").alias("radio"),
            (40 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0).alias("lat"),
            (-75 - F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 100.0).alias("lon"))
        spark.sparkContext.setJobGroup(f"fit{groups}", "")
        sites = mg.suggest_sites_operator(rows, tol=1e-6)
        jobs.append(len(tracker.getJobIdsForGroup(f"fit{groups}")))
        spark.sparkContext.setJobGroup("checks", "")
        fit = mg.site_fit(rows, sites, OPERATOR, tol=1e-6)
        assert fit.count() == groups and fit.filter("k = 5 AND n_towers = 30 AND sizes_match AND settled").count() == groups
    assert jobs[1] < 3 * jobs[0]


def test_large_groups_start_from_a_summary(clean, monkeypatch):
    """A coarse summary changes where a fit starts, not what is true of its result."""
    for cells in (1, 16):
        monkeypatch.setattr("mastgrid.operators.sites.CELLS", cells)
        sites = mg.suggest_sites_tech(clean)
        fit = mg.site_fit(clean, sites, TECH)
        assert fit.filter("k = 5 AND sizes_match AND settled").count() == 4


def test_unfit_sites_are_told(clean):
    sites = mg.suggest_sites_tech(clean)
    moved = mg.site_fit(clean, sites.withColumn("lat", F.col("lat") + F.col("site_no")), TECH)
    assert moved.filter("settled").count() == 0


def test_sites_repeat(clean):
    again = mg.suggest_sites_tech(clean.repartition(5)).collect()
    assert [tuple(r) for r in mg.suggest_sites_tech(clean).collect()] == [
        pytest.approx(tuple(r)) for r in again
    ]


@pytest.mark.parametrize("by", [(), OPERATOR, OPERATOR_TECH])
def test_points_stand_in_for_the_towers(clean, by):
    points = site_points(clean, OPERATOR_TECH)
    from_points = [tuple(row) for row in suggest_sites(points, by).collect()]
    from_towers = [tuple(row) for row in suggest_sites(clean, by).collect()]
    assert from_points == [pytest.approx(row) for row in from_towers]


def test_site_layers(clean):
    layer = mg.layer_sites(clean, "tech")
    base = layer.filter("popup IS NULL")
    assert base.count() == sum(min(1000, n) for n in column(mg.tech_count(clean), "tower_count"))
    assert set(column(base, "color")) == {"orange"}
    sites = layer.filter("popup IS NOT NULL")
    assert "Suggested LTE Tower #1" in column(sites, "popup")
    assert set(column(sites, "color", "radius")) == {("red", None)}


def test_combined_layer_shows_every_tower(clean):
    layer = mg.layer_sites(clean, "operator_tech")
    assert layer.filter("popup IS NULL").count() == clean.count()
    assert "Suggested Sprint-GSM Tower #1" in column(layer, "popup")


def test_map_layers_round_trip(spark, clean, tmp_path):
    path = str(tmp_path / "layers")
    mg.write_result(mg.map_layers(clean), path, "parquet", ["layer"])
    written = spark.read.parquet(path)
    counts = {r.layer: r["count"] for r in written.groupBy("layer").count().collect()}
    assert set(counts) == {
        "scatter", "density", "region_radius", "region_samples", "underserved", "top_operator",
        "operator_scatter", "sites_all", "sites_operator", "sites_tech", "sites_operator_tech",
    }
    regions = mg.region_count(clean).count()
    assert counts["region_radius"] == counts["region_samples"] == regions
    assert counts["underserved"] == mg.region_underserved(clean).count()
    assert counts["sites_all"] == 1500 + 10


def test_nearest_centres_are_found_in_generated_code(spark):
    """Groups may have different numbers of centres; of equally near ones the first counts."""
    rows = [("a", 0.0, 1.0), ("a", 0.0, 9.0), ("a", 0.0, 5.0), ("b", 0.0, 9.0), ("c", 0.0, 0.0)]
    points = spark.createDataFrame(rows, "group_key string, lat double, lon double")
    near = with_nearest(points, {"a": [(0.0, 0.0), (0.0, 10.0)], "b": [(0.0, 0.0)]})
    assert sorted(near.collect()) == [
        ("a", 0.0, 1.0, 1.0, 0), ("a", 0.0, 5.0, 25.0, 0), ("a", 0.0, 9.0, 1.0, 1), ("b", 0.0, 9.0, 81.0, 0)]
    assert dict(near.dtypes)["i"] == "int"
    assert "lambdafunction" not in near._jdf.queryExecution().executedPlan().toString()
    assert with_nearest(points, {}).count() == 0


def test_site_fit_does_not_gather_places(clean, monkeypatch):
    sites = mg.suggest_sites_all(clean)
    monkeypatch.setattr("mastgrid.operators.sites.durable", None)
    assert [tuple(r) for r in mg.site_fit(clean, sites).collect()] == [(10, clean.count(), True, True)]


def test_points_of_the_same_grouping_are_used_as_they_are(clean):
    points = site_points(clean, OPERATOR_TECH)
    assert site_points(points, OPERATOR_TECH) is points
    assert site_points(points, TECH) is not points


def test_map_layers_sample_the_towers_once(spark, clean, monkeypatch):
    from mastgrid.functions import select

    sizes, cut = [], select.cut_rows
    monkeypatch.setattr(select, "cut_rows", lambda df, *rest: sizes.append(df.count()) or cut(df, *rest))
    monkeypatch.setattr("mastgrid.operators.layers.SCATTER", 30)
    monkeypatch.setattr("mastgrid.operators.layers.OPERATOR_SCATTER", 4)
    layers = mg.map_layers(clean, shown={"all": 20, "tech": 3, "operator": 2})
    assert sizes.count(clean.count()) == 1
    single = [mg.layer_scatter(clean, 30), mg.layer_operator_scatter(clean, 4)]
    for layer in single:
        name = layer.first().layer
        assert sorted(layer.collect()) == sorted(layers.filter(F.col("layer") == name).collect())
    for kind, n in (("all", 20), ("tech", 3), ("operator", 2)):
        towers = mg.layer_sites(clean, kind, n=n).filter("popup IS NULL").select("lat", "lon")
        shown = layers.filter(F.col("popup").isNull() & (F.col("layer") == f"sites_{kind}"))
        assert sorted(towers.collect()) == sorted(shown.select("lat", "lon").collect())


def test_no_pass_for_groups_already_cut(spark, monkeypatch):
    from mastgrid.functions import select

    kept, durable = [], select.durable
    monkeypatch.setattr(select, "durable", lambda df: kept.append(df) or durable(df))
    monkeypatch.setattr(select, "CUT_ROWS", 1000)
    for keys in ([], ["k"]):
        kept.clear()
        rows = spark.range(100_000).select("id", F.lit(1).alias("k"))
        left = select.cut_rows(rows, 10, keys, F.col("id"))
        assert 10 <= left.count() < 1000 and left.agg(F.min("id")).first()[0] == 0
        assert len(kept) == 2  # one set of sketches, one set of cuts
