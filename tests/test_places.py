"""Spatial operators against a plain point-in-polygon calculation."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.fixed_values import DISTRICT_POPULATION_TOTAL, OUTSIDE_REASON, SEARCH_CENTRE, SEARCH_RADIUS_KM
from tamiz.operators.constraints import key_difference
from tamiz.operators.spatial import (
    RINGS_TYPE,
    _edges_by_cell,
    _numbered_edges,
    cover_join,
    polygon_cover,
    polygon_validity,
    split_by_polygon,
    within_join,
    within_radius,
)
from tamiz.plans import geo_index
from tamiz.runtime import work_dir
from tamiz.sources.payloads import POI_TYPE, charging_points, parse_payload, read_geojson, recent
from tamiz.sources.relational import district_seed, fallback_stations


def polygons(spark, shapes):
    rows = [(name, [[{"lon": float(x), "lat": float(y)} for x, y in r] for r in rings]) for name, rings in shapes.items()]
    return spark.createDataFrame(rows, f"name string, rings {RINGS_TYPE}")


def inside(x, y, rings):
    odd = False
    for ring in rings:
        closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
        for (x1, y1), (x2, y2) in zip(closed, closed[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


SHAPES = {
    "concave": [[(-3.1, -2.2), (4.3, -1.7), (0.4, 0.1), (3.7, 3.9), (-2.8, 2.6), (-3.1, -2.2)]],
    "holed": [
        [(-9, -9), (9, -9), (9, 9), (-9, 9), (-9, -9)],
        [(-4, -4), (-1, -4), (-1, -1), (-4, -1), (-4, -4)],
    ],
    "two parts": [[(5.2, 5.1), (7.7, 5.3), (6.1, 7.9), (5.2, 5.1)], [(-7.5, 5.5), (-5.1, 5.4), (-6.6, 8.2), (-7.5, 5.5)]],
    "far": [[(50, 50), (51, 50), (51, 51), (50, 50)]],
}


@pytest.mark.parametrize("cell", [0.3, 2.0, 100.0])
def test_within_join(spark, cell):
    rng = np.random.default_rng(1)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-12, 12, (1500, 2)))]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = within_join(df, polygons(spark, SHAPES), "name", "x", "y", cell)
    pairs = sorted(((r.id, r.name) for r in got.collect()), key=str)
    want = []
    for i, x, y in points:
        names = [n for n, rings in SHAPES.items() if inside(x, y, rings)]
        want += [(i, n) for n in names] or [(i, None)]
    assert pairs == sorted(want, key=str)


def test_boundary_points_are_not_within(spark):
    square = {"s": [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]], "t": [[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]]}
    points = [(1, 2.0, 2.0), (2, 4.0, 2.0), (3, 0.0, 0.0), (4, 2.0, 4.0), (5, 2.0, 0.0), (6, 5.0, 1.0), (7, -1.0, 0.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    for cell in (0.7, 4.0):
        joined = within_join(df, polygons(spark, square), "name", "x", "y", cell)
        assert {r.id: r.name for r in joined.collect()} == {1: "s", 2: None, 3: None, 4: None, 5: None, 6: "t", 7: None}
    valid, outside = split_by_polygon(joined, "name")
    assert valid.count() == 2 and {r.motivo_rechazo for r in outside.collect()} == {OUTSIDE_REASON}


@pytest.mark.parametrize("edges_in_row", [0, 64])
def test_polygon_validity(spark, edges_in_row):
    shapes = {
        "good": [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]],
        "open": [[(0, 0), (4, 0), (4, 4), (0, 4)]],
        "bow": [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]],
        "short": [[(0, 0), (4, 0), (0, 0)]],
        "repeated vertex": [[(0, 0), (4, 0), (4, 0), (4, 4), (0, 4), (0, 0)]],
        "touching": [[(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2), (0, 0)]],
    }
    rows = {r.name: (r.is_closed, r.self_intersects, r.is_valid) for r in polygon_validity(polygons(spark, shapes), "name", edges_in_row).collect()}
    assert rows["good"] == rows["repeated vertex"] == (True, False, True)
    assert rows["open"] == (False, False, False) and rows["bow"] == (True, True, False)
    assert rows["short"][0] is False and rows["touching"] == (True, True, False)


def test_district_pipeline(spark):
    seed = district_seed(spark)
    assert seed.count() == 11
    assert seed.agg(F.sum("poblacion_total")).first()[0] == DISTRICT_POPULATION_TOTAL
    names = [r.nombre_distrito for r in seed.collect()]
    # Vertical strips side by side stand in for the district outlines.
    features = []
    for i, name in enumerate(names):
        x = -6.05 + i * 0.009
        ring = [[x, 37.3], [x + 0.009, 37.3], [x + 0.009, 37.5], [x, 37.5], [x, 37.3]]
        shape = {"type": "MultiPolygon", "coordinates": [[ring]]} if i % 2 else {"type": "Polygon", "coordinates": [ring]}
        shown = name.title().replace("-", " - ").replace("Nervion", "Nervión")
        features.append({"type": "Feature", "properties": {"Distri_11D": shown}, "geometry": shape})
    path = work_dir(spark, "districts")
    document = json.dumps({"type": "FeatureCollection", "features": features}, indent=1)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(path)
    districts = geo_index.keyed_districts(read_geojson(spark, path, "Distri_11D"))
    assert key_difference(districts, seed, "nombre_distrito").isEmpty()
    stations = fallback_stations(spark)
    assert stations.count() == 31
    features = read_geojson(spark, path, "Distri_11D")
    index, placed, outside, origin = geo_index.run(features, None)
    assert origin == "FALLBACK" and geo_index.unmatched_districts(index).isEmpty()
    assert placed.count() + outside.count() == 31 and outside.count() > 0
    rows = index.toPandas()
    assert len(rows) == 11 and (rows.num_estaciones == 0).any()
    density = rows.potencia_total_kw / rows.poblacion_total * 10000
    income = rows.renta_media_neta_persona
    scaled = (income - income.min()) / (income.max() - income.min())
    spread = (density - density.min()) / (density.max() - density.min())
    np.testing.assert_allclose(rows.IOI, scaled * (1 - spread) * 100)
    ranking = geo_index.result_table(index).toPandas()
    assert ranking.position.tolist() == list(range(1, 12)) and ranking.IOI.is_monotonic_decreasing
    export = geo_index.station_export(placed, outside).toPandas()
    assert len(export) == 31 and set(export.estado) == {"Valido", "Cuarentena"}


def test_charging_points(spark):
    pois = [
        {"AddressInfo": {"Title": "a", "Latitude": 1.0, "Longitude": 2.0}, "Connections": [{"PowerKW": 22}, {"PowerKW": 50}], "DateCreated": "2024-01-09T00:00:00Z"},
        {"AddressInfo": {"Latitude": 1.0, "Longitude": 2.0}, "Connections": [{"PowerKW": 0}, {}], "DateCreated": "2024-01-01T00:00:00Z"},
        {"AddressInfo": {"Title": "c", "Latitude": 1.0}, "Connections": None},
        {"AddressInfo": None},
        {"AddressInfo": {"Title": "e", "Latitude": 0.0, "Longitude": 0.0}, "DateCreated": "2024-01-07T00:00:00Z"},
    ]
    text = spark.createDataFrame([(json.dumps(pois),)], "t string")
    points = charging_points(text.select(F.explode(parse_payload(F.col("t"), POI_TYPE)).alias("poi")))
    rows = [(r.nombre, r.potencia_kw) for r in points.collect()]
    assert rows == [("a", 50.0), ("Punto de recarga sin nombre", 3.7), ("e", 3.7)]
    reference = F.lit("2024-01-10 00:00:00").cast("timestamp")
    assert [r.nombre for r in recent(points, "fecha_creacion", reference, 4).collect()] == ["a", "e"]


def test_radius(spark):
    near = within_radius(fallback_stations(spark), "lat", "lon", SEARCH_CENTRE, SEARCH_RADIUS_KM)
    assert near.count() == 31 and near.agg(F.max("distance_km")).first()[0] < 7


def test_validity_of_long_rings(spark):
    angles = np.linspace(0, 2 * np.pi, 3000, endpoint=False)
    circle = [(float(np.cos(a)), float(np.sin(a))) for a in angles]
    swapped = circle[:100] + [circle[101], circle[100]] + circle[102:]
    loops = [(float(np.cos(a) * (1 + 0.4 * np.cos(5 * a))), float(np.sin(2 * a))) for a in angles]
    shapes = {"circle": [[*circle, circle[0]]], "swapped": [[*swapped, swapped[0]]], "loops": [[*loops, loops[0]]]}
    found = polygon_validity(polygons(spark, shapes), "name").collect()
    assert {r.name: r.is_valid for r in found} == {"circle": True, "swapped": False, "loops": False}


def coast(n, radius, x=0.0, y=0.0):
    """A closed ring of n edges with bays, whose vertices are no round numbers."""
    angles = np.linspace(0, 2 * np.pi, n, endpoint=False)
    far = radius * (1 + 0.2 * np.sin(7 * angles) + 0.03 * np.sin(211 * angles))
    ring = [(float(x + r * np.cos(a)), float(y + r * np.sin(a))) for r, a in zip(far, angles)]
    return [*ring, ring[0]]


def test_cover_join(spark):
    shapes = {
        **SHAPES,
        "coast": [coast(3000, 7.0, 1.3, -0.7), coast(400, 1.1, 2.0, 1.0)],
        "zigzag": [[*[(float(-9 + 0.03 * i), 8.0 if i % 2 else -8.0) for i in range(200)], (-3.0, 9.0), (-9.0, 9.0)]],
        "small": [coast(100, 0.01, 3.0, 3.0)],
        "line": [[(1, 1), (2, 2), (1, 1)]],
        "no rings": [],
        "not finite": [[(0, 0), (float("nan"), 3), (4, 4), (0, 0)]],
    }
    rng = np.random.default_rng(2)
    drawn = [*rng.uniform(-12, 12, (1200, 2)), *rng.uniform(2.98, 3.02, (200, 2)), *rng.integers(-9, 10, (200, 2))]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(drawn)]
    odd = [(-1, None, 1.0), (-2, 1.0, None), (-3, float("nan"), 0.5), (-4, float("inf"), 0.5)]
    df = spark.createDataFrame([*points, points[0], *odd], "id int, x double, y double")
    got = cover_join(df, polygons(spark, shapes), "name", "x", "y")
    assert got.columns == ["id", "x", "y", "name"]
    pairs = sorted(((r.id, r.name) for r in got.collect()), key=str)
    finite = {n: r for n, r in shapes.items() if n != "not finite"}
    want = []
    for i, x, y in [*points, points[0]]:
        names = [n for n, rings in finite.items() if strictly_inside(x, y, rings)]
        want += [(i, n) for n in names] or [(i, None)]
    want += [(i, None) for i, _, _ in odd]
    assert pairs == sorted(want, key=str)
    empty = cover_join(df, polygons(spark, {}), "name", "x", "y")
    assert empty.count() == len(points) + 5 and empty.filter("name IS NOT NULL").isEmpty()


def strictly_inside(x, y, rings):
    for ring in rings:
        closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
        for (x1, y1), (x2, y2) in zip(closed, closed[1:]):
            turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
    return inside(x, y, rings)


def test_cover_of_a_country(spark):
    cover = polygon_cover(polygons(spark, {"country": [coast(20000, 5.0)]}), "name").select(
        F.size("_edges").alias("edges"), "_odd", "_level"
    ).toPandas()
    assert 100 < len(cover) < 20000 and (cover.edges == 0).any() and cover._level.nunique() > 2
    # A grid of the finest cells in use over the same box has many more.
    assert len(cover) < (12 / 4.0 ** cover._level.min()) ** 2 / 5
    assert cover.edges.sum() < 4 * 20000 and cover[cover.edges == 0]._odd.all()


def test_long_diagonals_fill_no_boxes(spark):
    n = 400
    zigzag = [(float(i), float(n * (i % 2) + i)) for i in range(n)]
    rings = {"free": [[*zigzag, (2.0 * n, 0.5), (0.0, -5.0), zigzag[0]]], "crossed": [[*zigzag, (10.5, 0.0), zigzag[0]]]}
    df = polygons(spark, rings)
    shaped = df.select("name", F.posexplode(F.transform("rings", _numbered_edges)).alias("_ring", "_edges"))
    rows = _edges_by_cell(shaped, "name").groupBy("name").count().collect()
    # About 20 rows of cells: a diagonal passes one or two cells in each, its box can fill far more.
    assert all(r["count"] < 3 * 21 * n for r in rows)
    by_cell, in_row = (
        {r.name: r.self_intersects for r in polygon_validity(df, "name", most).collect()} for most in (0, 10 * n)
    )
    assert by_cell == in_row and in_row["crossed"]
    rng = np.random.default_rng(5)
    wild = {str(i): [[(float(x), float(y)) for x, y in rng.integers(0, 30, (rng.integers(4, 8), 2))]] for i in range(60)}
    wild |= {f"coast {i}": [coast(90, 2.0 + i / 7, i)] for i in range(5)}
    got = [sorted((r.name, r.self_intersects) for r in polygon_validity(polygons(spark, wild), "name", most).collect()) for most in (0, 10 * n)]
    assert got[0] == got[1] and {s for _, s in got[0]} == {True, False}


def test_findings_of_a_district_run(spark):
    names = [r.nombre_distrito for r in district_seed(spark).collect()]
    strips = {n: [[(-6.05 + i * 0.009, 37.3), (-6.041 + i * 0.009, 37.3), (-6.041 + i * 0.009, 37.5), (-6.05 + i * 0.009, 37.5), (-6.05 + i * 0.009, 37.3)]] for i, n in enumerate(names)}
    features = lambda shapes: polygons(spark, shapes).withColumnRenamed("name", "feature_name")
    (index, placed, outside, origin), nothing = geo_index.checked_run(features(strips), None)
    assert index.count() == 11 and placed.count() + outside.count() == 31 and origin == "FALLBACK" and nothing.isEmpty()
    first, second, third = names[:3]
    faulty = {**strips, first: [strips[first][0][:-1]], "ELSEWHERE": strips[first]}
    ring = strips[second][0]
    faulty[second] = [[ring[0], ring[2], ring[1], ring[3], ring[0]]]
    del faulty[third]
    socio = district_seed(spark).filter(F.col(geo_index.NAME) != names[-1])
    socio = socio.unionByName(socio.filter(F.col(geo_index.NAME) == names[4]))
    stations = spark.createDataFrame([("near", *SEARCH_CENTRE), ("far", 38.0, -5.9), ("lost", None, -5.9)], "nombre string, lat double, lon double")
    districts = geo_index.keyed_districts(features(faulty))
    found = {tuple(r) for r in geo_index.findings(districts.unionByName(districts.filter(F.col(geo_index.NAME) == names[5])), socio, stations).collect()}
    people = socio.agg(F.sum("poblacion_total")).first()[0]
    assert found == {
        ("polygon", first, "open ring"), ("polygon", second, "meets itself"),
        ("district", third, "no polygon"), ("district", "ELSEWHERE", "no figures"), ("district", names[-1], "no figures"),
        ("district", names[4], "repeated figures"), ("district", names[5], "repeated polygon"),
        ("figure", "population", f"expected {DISTRICT_POPULATION_TOTAL}, found {people}"),
        ("station", "far", "outside the search radius"), ("station", "lost", "no place"),
    }
    none = geo_index.findings(districts.limit(0), socio.limit(0), stations.limit(0)).collect()
    assert sorted(r.subject for r in none) == ["districts", "population"]
