from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.shapes import TINY, frame, pixels, to_degrees
from zonal import Grid, coverage_cells
from zonal.operators.coverage import coverage_pixels, explode_cell_map
from zonal.sources import catalog as cat
from zonal.sources import feature_collections
from zonal.sources import locations as loc
from zonal.sources.results import write_results

SHELL = [(100.2, 50.3), (130.4, 50.3), (130.4, 80.7), (100.2, 80.7)]
HOLE = [(110.2, 60.3), (120.4, 60.3), (120.4, 70.7), (110.2, 70.7)]
OTHER = [(200.2, 50.3), (210.4, 50.3), (205.4, 60.7)]


def feature(list_id, location_id, kind, coordinates):
    return {
        "type": "Feature",
        "properties": {"list_id": list_id, "location_id": location_id, "name": "x"},
        "geometry": {"type": kind, "coordinates": coordinates},
    }


def features():
    def ring(points):
        return [[x, y, 0.0] for x, y in to_degrees(points + points[:1])]

    return [
        feature("a", 1, "Polygon", [ring(SHELL), ring(HOLE)]),
        feature("a", 2, "MultiPolygon", [[ring(SHELL)], [ring(OTHER)]]),
    ]


@pytest.mark.parametrize("lines", [False, True])
def test_geojson(spark, tmp_path, lines):
    paths = []
    for n, one in enumerate(features()):
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(one) if lines else json.dumps({"type": "FeatureCollection", "features": [one]}, indent=1))
        paths.append(str(path))
    df = loc.read_geojson(spark, paths, one_feature_per_line=lines)
    assert df.columns == ["list_id", "location_id", "rings"] and df.count() == 3
    got: dict = {}
    for r in coverage_pixels(df, TINY).collect():
        got.setdefault(r["location_id"], set()).add((r["key_row"] * 10 + r["r"], r["key_col"] * 10 + r["c"]))
    assert got == {1: pixels([SHELL, HOLE], "center"), 2: pixels([SHELL], "center") | pixels([OTHER], "center")}
    assert {r["location_id"]: r["n"] for r in loc.vertex_counts(df).collect()} == {1: 10, 2: 9}
    assert [r["location_id"] for r in loc.crowded_locations(df, 9).collect()] == [1]


def test_geojson_rejects_other_shapes(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"features": [feature("a", 1, "Point", [1.0, 2.0])]}))
    with pytest.raises(Exception, match="unsupported geometry type Point"):
        loc.read_geojson(spark, str(path)).collect()


@pytest.mark.parametrize("lines", [False, True])
def test_geojson_loses_no_feature(spark, tmp_path, lines):
    nowhere = {"type": "Feature", "properties": {"list_id": "a", "location_id": 3}, "geometry": None}
    given = [*features(), nowhere, feature("a", 4, "MultiPolygon", []), feature("a", 5, "Polygon", [])]
    path = tmp_path / "f.json"
    path.write_text("\n".join(map(json.dumps, given)) if lines else json.dumps({"features": given}))
    df = loc.read_geojson(spark, str(path), "list_id string, location_id decimal(10,2)", one_feature_per_line=lines)
    assert sorted((int(r["location_id"]), len(r["rings"])) for r in df.collect()) == [(1, 2), (2, 1), (2, 1), (3, 0), (4, 0), (5, 0)]


@pytest.mark.parametrize(
    "geometry, message",
    [
        ({"type": "Polygon"}, "without coordinates"),
        ({"coordinates": [[[1, 2]]]}, "unsupported geometry type null"),
        ({"type": "Polygon", "coordinates": [[["east", 2.0]]]}, "unreadable coordinates|two numbers"),
        ({"type": "Polygon", "coordinates": [[[1.0], [2.0, 3.0], [4.0, 1.0]]]}, "two numbers"),
    ],
)
def test_geojson_refuses_what_it_cannot_read(spark, tmp_path, geometry, message):
    path = tmp_path / "f.json"
    path.write_text(json.dumps({"features": [{"properties": {"list_id": "a", "location_id": 1}, "geometry": geometry}]}))
    with pytest.raises(Exception, match=message):
        loc.read_geojson(spark, str(path)).collect()


def test_one_collection_feeds_many_tasks(spark, tmp_path):
    """Braces, brackets, quotes and escapes in strings, other members around the features, one line
    or many: cut anywhere, the features are those of a JSON parser."""
    rng = random.Random(12)
    strings = ["}", "{[", 'a"b', "\\", '\\"}', "é🙂", '"features":[{', "], }", ""]
    given = []
    for n in range(60):
        x, y = rng.uniform(5, 600), rng.uniform(5, 300)
        ring = to_degrees([(x, y), (x + 9, y), (x + 9, y + 7), (x, y)])
        one = feature("".join(rng.choices(strings, k=3)), n, "Polygon", [ring])
        one["properties"]["more"] = {"deep": [{"a": [1, {"b": "}"}]}, "]"]}
        given.append(one)
    around = {"crs": {"type": "name", "properties": {"name": "x"}}, "bbox": [1, [2]], "links": [{"features": [1]}, {}], "features": given}
    around |= {"name": 'last "features":[{', "other": [{"type": "Feature"}]}
    whole, pretty, none = tmp_path / "a.json", tmp_path / "b.json", tmp_path / "c.json"
    text = json.dumps(around, ensure_ascii=False)
    whole.write_text(text)
    pretty.write_text(json.dumps({"features": given[:7]}, indent=2) + "\n\n")
    none.write_text('{"features" : [ ], "type": "FeatureCollection"}')
    want = sorted((f["properties"]["list_id"], f["properties"]["location_id"]) for f in given + given[:7])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        df = loc.read_geojson(spark, [str(p) for p in (whole, pretty, none)])
        assert sorted((r["list_id"], r["location_id"]) for r in df.collect()) == want
        ranges = feature_collections._pieces(spark, str(whole)).select("range").distinct().count()
        assert ranges > 0.5 * whole.stat().st_size / 700
        for cut in (30, len(text) // 2, len(text) - 2):
            whole.write_text(text[:cut])
            with pytest.raises(Exception, match="does not end|MALFORMED"):
                loc.read_geojson(spark, str(whole)).collect()
        none.write_text('{"features": [null, {"a": 1}]}')
        with pytest.raises(Exception, match="unreadable text between the features|no features"):
            loc.read_geojson(spark, str(none)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_geojson_to_cell_maps(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features()}))
    maps = loc.read_cell_map(spark, str(path), TINY)
    cells = coverage_cells(loc.read_geojson(spark, str(path)), TINY)
    n = F.aggregate("runs", F.lit(0), lambda t, run: t + run["i1"] - run["i0"])
    names = ["list_id", "key_col", "key_row", "location_id"]
    got = explode_cell_map(maps).select(*names, n.alias("n")).collect()
    assert sorted(map(tuple, got)) == sorted((*[r[c] for c in names], r["n_pixels"]) for r in cells.collect())


def test_geojson_without_features_fails(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text(json.dumps(features()[0]))
    with pytest.raises(Exception, match="no features"):
        loc.read_geojson(spark, str(path)).collect()


def test_parquet_locations_and_bounds(spark, tmp_path):
    df = frame(spark, [(1, -1, [SHELL]), (1, 5, [OTHER])])
    df.write.parquet(str(tmp_path / "l"))
    back = loc.read_locations(spark, str(tmp_path / "l"), "bigint")
    box = loc.location_bounds(loc.areas_of_interest(back), ["list_id"]).collect()
    assert len(box) == 1 and box[0]["xmin"] == pytest.approx(100.2 / 2 - 180) and box[0]["ymax"] == pytest.approx(90 - 50.3 / 2)


@pytest.fixture()
def catalog(spark, tmp_path):
    entries = [
        {"name": "loss", "source_uri": "s3://t/loss/latest/{grid_size}/{row_count}/year/{tile_id}.tif"},
        {"name": "prodes", "source_uri": "s3://t/prodes/v1/{grid_size}/{row_count}/year/{tile_id}.tif"},
        {"name": "prodes", "source_uri": "s3://t/prodes/v1/{grid_size}/{row_count}/is/{tile_id}.tif"},
        {"name": "land", "source_uri": 's3://t/land/v1/{tile_id}.tif"'},
    ]
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps({"layers": entries}, indent=2))
    return cat.read_catalog(spark, str(path), "pro")


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_catalog_takes_the_first_entry(spark, catalog):
    got = {r["name"]: r["source_uri"] for r in cat.resolve_layers(catalog, names(spark, "prodes"), "pro").collect()}
    assert got == {"prodes": "s3://t/prodes/v1/{grid_size}/{row_count}/year/{tile_id}.tif"}
    with pytest.raises(Exception, match="no catalogue entry for layer nowhere"):
        cat.resolve_layers(catalog, names(spark, "nowhere"), "pro").collect()
    with pytest.raises(Exception, match="no catalogue entry"):
        cat.resolve_layers(catalog, names(spark, "loss"), "default").collect()


def test_catalog_latest(spark, catalog):
    versions = spark.createDataFrame([("loss", "v1.8")], "dataset string, version string")
    got = {r["pos"]: r["source_uri"] for r in cat.substitute_latest(catalog, versions).collect()}
    assert got[0] == "s3://t/loss/v1.8/{grid_size}/{row_count}/year/{tile_id}.tif" and "v1/" in got[1]
    with pytest.raises(Exception, match="no latest version for layer loss"):
        cat.substitute_latest(catalog, versions.where("false")).collect()
    assert [r["name"] for r in cat.malformed_uris(catalog).collect()] == ["land"]


def test_bad_catalog_fails(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"layers": [')
    with pytest.raises(Exception):
        cat.read_catalog(spark, str(path), "pro").collect()


def test_tile_listing_goes_by_prefix(spark):
    grid = Grid()
    files = spark.createDataFrame([(29, 9), (17, 8), (0, 0)], "file_col int, file_row int")
    asked = cat.tile_uris(files, grid, F.lit("s3://t/{tile_id}.tif"))
    objects = [("s3://t/00N_110E.tif",), ("s3://t/10N_010W.tif.aux.xml",), ("s3://t/00N_110",), ("s3://u/90N_180W.tif",)]
    inventory = spark.createDataFrame(objects, "object string")
    got = sorted(r["uri"] for r in cat.existing_tiles(asked, inventory).collect())
    assert got == ["s3://t/00N_110E.tif", "s3://t/10N_010W.tif"]


def test_tile_listing_looks_past_the_end_of_a_range(spark):
    rng = random.Random(3)
    letters = ["".join(rng.choices("abé/", k=rng.randint(0, 6))) for _ in range(400)]
    uris, objects = letters[:150] + [None, ""], letters[150:] + [None]
    asked = spark.createDataFrame([(u, 7) for u in uris], "uri string, other int")
    inventory = spark.createDataFrame([(o,) for o in objects * 2], "object string")
    got = sorted(r["uri"] for r in cat.existing_tiles(asked, inventory).collect())
    assert got == sorted(u for u in uris if u is not None and any(o is not None and o.startswith(u) for o in objects))
    assert cat.existing_tiles(asked, inventory.where("false")).collect() == []
    assert cat.existing_tiles(asked.where("false"), inventory).collect() == []


def test_area_files(spark):
    df = frame(spark, [(1, -1, [[(15.2, 12.3), (45.4, 12.3), (45.4, 18.7), (15.2, 18.7)]])])
    assert sorted(map(tuple, cat.area_files(df, TINY).collect())) == [(0, 0), (1, 0), (2, 0)]


def test_results_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, {0: 0.0, 5: 2.5})], "location_id int, loss map<int,double>")
    write_results(df, str(tmp_path / "j"), files=1)
    text = [p.read_text() for p in (tmp_path / "j").glob("part-*.json")]
    assert [json.loads(t) for t in text] == [{"location_id": 1, "loss": {"0": 0.0, "5": 2.5}}]
    write_results(df, str(tmp_path / "j"), fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "j")).first()["loss"] == {0: 0.0, 5: 2.5}
    with pytest.raises(ValueError):
        write_results(df, str(tmp_path / "j"), fmt="csv")


def test_staging_goes_to_the_named_folder(spark):
    from zonal.operators.staging import stage, staging_dir

    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging_dir(spark) == folder
    df = stage(coverage_cells(frame(spark, [(1, 1, [SHELL])]), TINY))
    assert all(f.startswith(("file:", folder)) and folder in f for f in df.inputFiles())
