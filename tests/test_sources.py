import math

import pytest
from pyspark.sql import functions as F
from rows import column, towers

import mastgrid as mg
from mastgrid.schema import BASE_COLUMNS

LINE = ["LTE", "310", "260", "7", "9", "0", "-75.5", "40.25", "1200", "3", "1", "1459813819", "1459813820"]


def write(tmp_path, *lines):
    path = tmp_path / "towers.csv"
    path.write_text("".join(",".join(line) + "\n" for line in lines))
    return str(path)


def test_headerless_file_loses_no_row(spark, tmp_path):
    df = mg.read_towers(spark, write(tmp_path, LINE, LINE))
    assert df.count() == 2
    assert df.columns == [c for c in BASE_COLUMNS if c != "unit"]
    row = df.first()
    assert (row.radio, row.mcc, row.lat, row.range, row.created) == ("LTE", 310, 40.25, 1200, 1459813819)


@pytest.mark.parametrize("extra, names", [
    ([], []), (["-90"], ["average_signal"]), (["-90", "x"], ["average_signal"]),
])
def test_columns_are_named_by_position(spark, tmp_path, extra, names):
    df = mg.read_towers(spark, write(tmp_path, LINE + extra))
    assert df.columns == [c for c in BASE_COLUMNS if c != "unit"] + names
    assert df.first().lat == 40.25


@pytest.mark.parametrize("line", [LINE[:12], LINE + ["a", "b", "c"]])
def test_other_widths_fail_clearly(spark, tmp_path, line):
    with pytest.raises(ValueError, match="13 to 15 columns"):
        mg.read_towers(spark, write(tmp_path, line))


def test_header_with_coordinates_keeps_its_names(spark, tmp_path):
    path = write(tmp_path, ["lon", "lat", "owner"], ["-75.5", "40.25", "me"])
    df = mg.read_towers(spark, path, header=True)
    assert dict(df.dtypes) == {"lon": "double", "lat": "double", "owner": "string"}
    assert tuple(df.first()) == (-75.5, 40.25, "me")


def test_header_without_coordinates_is_replaced(spark, tmp_path):
    path = write(tmp_path, [f"x{i}" for i in range(13)], LINE)
    df = mg.read_towers(spark, path, header=True)
    assert df.count() == 1 and df.first().cell == 9


def test_missing_and_bad_fields_are_null_not_nan(spark, tmp_path):
    bad = LINE.copy()
    bad[6], bad[7], bad[8] = "", "NaN", "wide"
    row = mg.read_towers(spark, write(tmp_path, LINE, bad)).filter("lat IS NULL").first()
    assert (row.lon, row.lat, row.range, row.radio) == (None, None, None, "LTE")


def test_text_dates(spark, tmp_path):
    dated = LINE.copy()
    dated[11] = "2016-04-05"
    df = mg.read_towers(spark, write(tmp_path, LINE, dated), text_dates=True)
    assert column(mg.with_year(df), "year") == [2016, 2016]


def test_conform_fixes_types(spark):
    df = towers(spark, {}).withColumn("range", F.lit("12x")).withColumn("mcc", F.lit(310.0))
    fixed = mg.conform_towers(df)
    assert dict(fixed.dtypes)["range"] == "bigint" and dict(fixed.dtypes)["mcc"] == "int"
    assert (fixed.first().range, fixed.first().mcc) == (None, 310)


def test_dirty_positions_are_dropped(spark):
    df = towers(
        spark, {"cell": 1}, {"lat": None}, {"lon": None}, {"lat": 0.0}, {"lon": 0.0},
        {"lat": math.nan}, {"lon": math.nan},
    )
    assert column(mg.clean_towers(df), "cell") == [1]
    assert tuple(mg.tower_row_count(df).first()) == (7, 1)


def test_save_clean_prunes_by_technology(spark, tmp_path):
    path = str(tmp_path / "clean")
    names = ["LTE", "GSM", None, "", "4", "none", "a/b=c"]
    mg.save_clean(towers(spark, *[{"radio": name} for name in names]), path)
    kept = mg.read_towers(spark, path, "parquet")
    assert sorted(column(kept, "radio"), key=str) == sorted(names, key=str)
    assert dict(kept.dtypes)["radio"] == "string"
    for name in ("GSM", "", "4", "none"):
        assert mg.by_tech(kept, name).count() == 1
    found = mg.by_tech(kept, "GSM")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "radio_key" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert found.select("cell").inputFiles() and found.count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_write_result(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    table = mg.region_tech_count(towers(spark, {}, {"radio": "GSM"}))
    mg.write_result(table, path, fmt, ["radio"])
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    assert sorted(column(reader.format(fmt).load(path), "radio")) == ["GSM", "LTE"]


def test_headed_files_go_by_their_own_names(spark, tmp_path):
    names = "radio,mcc,mnc,area,cell,unit,lon,lat,range,samples,changeable,created,updated"
    swapped = names.replace("lon,lat", "lat,lon")
    (tmp_path / "0.csv").write_text(f"{names}\nLTE,310,260,1,0,0,-75.0,40.0,1000,5,1,0,0\n")
    (tmp_path / "1.csv").write_text(f"{swapped}\nLTE,310,260,1,1,0,41.0,-76.0,1000,5,1,0,0\n")
    (tmp_path / "2.csv").write_text("lat,lon,owner\n42.0,-77.0,me\n")
    (tmp_path / "3.csv").write_text(",".join("abcdefghijklm") + "\nGSM,310,260,1,3,0,-78.0,43.0,1000,5,1,0,0\n")
    df = mg.read_towers(spark, str(tmp_path), header=True)
    found = sorted(column(df, "lat", "lon", "radio", "cell", "owner"))
    assert found == [(40.0, -75.0, "LTE", 0, None), (41.0, -76.0, "LTE", 1, None),
                     (42.0, -77.0, None, None, "me"), (43.0, -78.0, "GSM", 3, None)]


def mixed_folder(tmp_path):
    """Files of 13 and 14 columns, floats for whole numbers, quotes, blank and short lines."""
    decimal = [*LINE[:1], "310.0", "260.0", "7.0", "9007199254740993.0", *LINE[5:8], "1200.5", *LINE[9:]]
    quoted = ['"L,TE"', *LINE[1:]]
    lines = {"a.csv": [LINE, decimal, quoted], "b.csv": [LINE + ["-90"], LINE + ["-91", "x"]],
             "c.csv": [LINE[:3], [""], LINE + ["a", "b", "c"], LINE]}
    for name, rows in lines.items():
        (tmp_path / name).write_text("".join(",".join(row) + "\n" for row in rows))
    return str(tmp_path)


def test_every_line_is_accounted_for(spark, tmp_path):
    path = mixed_folder(tmp_path)
    found = mg.tower_lines(spark, path).groupBy("width").agg(F.sum("line_count")).collect()
    assert sorted(map(tuple, found)) == [(3, 1), (13, 4), (14, 1), (15, 1), (16, 1)]
    with pytest.raises(ValueError, match="2 of 8 lines .*13 to 15 columns.*{3: 1, 16: 1}"):
        mg.read_towers(spark, path)
    df = mg.read_towers(spark, path, bad_lines="drop")
    assert sorted(column(df, "average_signal"), key=str) == [-90, -91, None, None, None, None]
    decimal = df.filter("cell = 9007199254740993").first()
    assert (decimal.mcc, decimal.mnc, decimal.area, decimal.range) == (310, 260, 7, None)
    assert df.filter("radio = 'L,TE'").first().lat == 40.25
    assert df.filter("radio = 'LTE' AND cell = 9").count() == 4


def test_bad_lines_of_headed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lat,lon,owner\n42.0,-77.0,me\n43.0,-78.0\n")
    (tmp_path / "b.csv").write_text("lon,lat\n-79.0,44.0\n-79.0,45.0,you\n")
    with pytest.raises(ValueError, match="2 of 4 lines"):
        mg.read_towers(spark, str(tmp_path), header=True)
    df = mg.read_towers(spark, str(tmp_path), header=True, bad_lines="drop")
    assert sorted(column(df, "lat", "owner")) == [(42.0, "me"), (44.0, None)]
    with pytest.raises(ValueError, match="raise or drop"):
        mg.read_towers(spark, str(tmp_path), bad_lines="ignore")


def test_empty_file(spark, tmp_path):
    assert mg.read_towers(spark, write(tmp_path)).columns == [c for c in BASE_COLUMNS if c != "unit"]


def test_unused_columns_are_not_parsed(spark, tmp_path):
    plan = mg.read_towers(spark, write(tmp_path, LINE)).select("radio")._jdf.queryExecution()
    assert "ReadSchema: struct<_c0:string>" in plan.executedPlan().toString()
