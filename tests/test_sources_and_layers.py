import json

import pytest
from pyspark.sql import functions as F

from plinth.operators import enrichment, layers, models, obstacles, validation
from plinth.sources import csv, overpass, sinks

WKT = "POLYGON ((30.30 59.93, 30.31 59.93, 30.31 59.94, 30.30 59.94, 30.30 59.93))"


def test_elements_to_buildings_and_obstacles(spark, tmp_path):
    node = lambda i, lat, lon, **tags: {"type": "node", "id": i, "lat": lat, "lon": lon} | ({"tags": tags} if tags else {})
    way = lambda i, nodes, **tags: {"type": "way", "id": i, "nodes": nodes, "tags": {k.replace("__", ":"): v for k, v in tags.items()}}
    square = [node(1, 59.93, 30.30), node(2, 59.93, 30.31), node(3, 59.94, 30.31), node(4, 59.94, 30.30)]
    data = square + [
        way(10, [1, 2, 3, 4], building__levels="5", building="house"),
        way(11, [1, 2, 3, 4, 1], building__levels="5;6"),
        way(12, [1, 2, 3, 4, 1], building__levels="0"),
        way(13, [1, 2, 3, 4, 1], building__levels="101"),
        way(14, [1, 2, 99, 3, 4], building__levels=" nan "),
        way(15, [1, 2, 3], building__levels="5"),
        way(16, [1, 3, 2, 4], building__levels="5"),
        node(20, 1.0, 2.0, man_made="tower", height="30 m"),
        node(21, 1.0, 2.0, historic="column", height="12", ele="45,5"),
        node(22, 1.0, 2.0, man_made="mast", height="12", ele="2000"),
        node(23, 1.0, 2.0, power="tower", **{"building:height": "21m"}),
        way(24, [1, 2, 3, 4, 1], bridge="yes", name="B"),
        node(25, 1.0, 2.0, bridge="no"),
    ]
    (tmp_path / "m.json").write_text(json.dumps({"elements": data}))
    elements = overpass.read_elements(spark, str(tmp_path / "m.json"))
    found = {r.osm_id: r for r in enrichment.map_buildings(elements).collect()}
    assert set(found) == {10, 14} and found[10].osm_height_est == 15 and found[10].osm_building_type == "house" and found[14].osm_levels is None
    assert len(found[10].geom[0][0]) == 5
    got = {r.osm_id: r for r in obstacles.obstacles(elements).collect()}
    assert {i: (r.height, r.height_source, r.height_source_fixed) for i, r in got.items()} == {20: (30.0, "estimated", "osm_tag"), 21: (45.5, "estimated", "osm_tag"), 22: (40.0, "estimated", "estimated"), 23: (21.0, "osm_tag", "osm_tag"), 24: (15.0, "estimated", "estimated")}
    assert got[24].lat == pytest.approx((59.93 * 3 + 59.94 * 2) / 5) and got[24].name == "B" and got[20].name == "tower"
    assert [r.osm_id for r in obstacles.tallest(obstacles.obstacles(elements), 2).collect()] == [21, 22]
    measured = enrichment.measured(enrichment.map_buildings(elements).where("osm_id = 10"))
    assert measured.first().area == pytest.approx(623_000, rel=0.02)


def test_third_vote(spark):
    rows = spark.createDataFrame([(0, 12.0, "low_conflicting", 14.9), (1, 12.0, "low_conflicting", 22.0), (2, 12.0, "high", 22.0), (3, 12.0, "high", None), (4, None, "none", 5.0)], "id long, height_final double, height_confidence string, osm_height_est double").withColumn("height_source", F.lit("s"))
    got = {r.id: (r.height_final, r.height_confidence) for r in enrichment.third_vote(rows).collect()}
    assert got == {0: (12.0, "low_conflicting_osm_confirmed"), 1: (22.0, "resolved_by_osm"), 2: (12.0, "high"), 3: (12.0, "high"), 4: (None, "none")}


@pytest.mark.parametrize("encoding,sep", [("utf-8", ","), ("cp1251", ";"), ("utf-8", "\t")])
def test_load_source(spark, tmp_path, encoding, sep):
    quote = lambda v: f'"{v}"' if sep in v else v
    lines = [sep.join(("id", "адрес", "geometry", "height")), *(sep.join(map(quote, r)) for r in (("a", "ул. Ленина", WKT, "12.5"), ("b", "x", "bad", "nan"), ("c", "y", WKT.replace("30.31", "30.32"), "oops")))]
    (tmp_path / "s.csv").write_bytes("\n".join(lines).encode(encoding))
    loaded = csv.load_source(spark, str(tmp_path / "s.csv"), ("height",))
    rows = loaded.rows.orderBy("original_index").collect()
    assert loaded.degrees and loaded.failures == 1 and [r.original_index for r in rows] == [0, 1] and [r.id for r in rows] == ["a", "c"]
    assert rows[0]["адрес"] == "ул. Ленина" and [r.height for r in rows] == [12.5, None] and rows[0].geom[0][0][0].x > 300_000


def test_clean_file_round_trip(spark, tmp_path):
    rows = csv.load_clean
    made = spark.createDataFrame([(1, 'a "quoted", name', WKT), (2, "b", WKT)], "k int, n string, w string").selectExpr("k", "n", "w as geometry_wkt")
    made.write.csv(str(tmp_path / "c"), header=True, escape='"')
    again = rows(spark, str(tmp_path / "c")).orderBy("k").collect()
    assert [r.n for r in again] == ['a "quoted", name', "b"] and len(again[0].geom[0][0]) == 5
    sinks.write_csv(rows(spark, str(tmp_path / "c")).select("k", "geom"), str(tmp_path / "d"))
    assert csv.load_clean(spark, str(tmp_path / "d")).count() == 2
    assert json.loads(sinks.report(a=spark.range(2), b=spark.range(1)))["b"] == {"id": 0}
    point = sinks.features(spark.createDataFrame([(1.5, 2.5, "x")], "lon double, lat double, name string")).first().feature
    assert json.loads(point)["geometry"]["coordinates"] == [1.5, 2.5]
    spark.range(3).write.parquet(str(tmp_path / "there"))
    assert csv.first_existing(spark, str(tmp_path / "missing"), str(tmp_path / "there")).count() == 3


def test_bins_and_floors(spark):
    rows = spark.createDataFrame([(0.0,), (5.0,), (5.0001,), (500.0,), (501.0,)], "height_final double")
    names = [n for *_, n in validation.HEIGHT_CLASSES]
    assert [r.c for r in rows.select(validation.height_class(F.col("height_final")).alias("c")).collect()] == [None, names[0], names[1], names[4], None]
    floors = spark.createDataFrame([(4.5,), (7.5,), (10.5,)], "height_final double")
    assert [tuple(r) for r in validation.floor_histogram(floors).collect()] == [(2, 2), (4, 1)]


def test_hexagons_hold_their_points(spark):
    points = spark.createDataFrame([(float(i * 37 % 5000), float(i * 91 % 7000)) for i in range(300)], "x double, y double")
    cell = points.withColumn("c", layers.hexagon(F.col("x"), F.col("y"))).withColumn("m", layers.hexagon_centre(F.col("c.q"), F.col("c.r")))
    assert cell.where(F.hypot(F.col("x") - F.col("m.x"), F.col("y") - F.col("m.y")) > layers.HEX_SIZE + 1e-6).count() == 0
    assert layers.districts(spark).count() == 12 and layers.landmarks(spark).count() == 7 and layers.zones(spark).count() == 5


def test_model_learns_and_fills(spark):
    rows = spark.range(900).selectExpr("id as component_id", "cast(20 + id * 7 % 300 as double) area_m2", "cast(40 + id % 60 as double) perimeter_m", "0.5D compactness", "cast(5 + id % 3 as int) n_vertices", "cast(10 + id % 20 as double) avg_height_neighbors_100m", "cast(id % 4 as int) purpose_encoded", "1L n_polygons_a", "1L n_polygons_b", "'s' height_source", "'high' height_confidence", "id % 50 = 1 is_default_height")
    rows = rows.withColumn("height_final", F.when(F.col("component_id") % 9 > 0, F.col("avg_height_neighbors_100m") + F.col("area_m2") / 30))
    rows = rows.withColumn("avg_height_neighbors_100m", F.when(F.col("component_id") % 13 > 0, F.col("avg_height_neighbors_100m")))
    filled, fitted = models.predict_missing(rows, models.ModelSettings(trees=20))
    assert filled.where("height_final is null").count() == 0 and filled.where("height_source = 'ML_predicted' and height_confidence = 'predicted'").count() == 100
    assert fitted.metrics.first().r2 > 0.6 and models.importances(fitted)[0][0] in ("area_m2", "avg_height_neighbors_100m")
    assert models.predict_missing(rows.limit(50))[1] is None
