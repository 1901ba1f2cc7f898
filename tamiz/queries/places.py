"""Points in polygons, radius and box filters, polygon validity, district index."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators.spatial import (
    cover_join,
    polygon_validity,
    power_by_district,
    split_by_polygon,
    within_join,
    within_radius,
)
from tamiz.plans import geo_index
from tamiz.queries.base import query, table
from tamiz.runtime import work_dir
from tamiz.sources.payloads import read_geojson
from tamiz.sources.relational import catalog_problems, flag_in_box

# One concave outline and one hole, placed and scaled per nation.
OUTLINE = [(-1.93, -0.83), (1.87, -0.91), (1.71, 0.13), (0.31, 0.27), (0.37, 0.89), (-1.61, 0.77)]
HOLE = [(-0.93, -0.53), (-0.21, -0.47), (-0.57, -0.11)]


def nation_polygons(spark, sf_dir):
    """A polygon per nation on a grid; nations of region 0 have a hole, others overlap."""
    key = F.col("n_nationkey")
    x, y = (key % 5) * 5 + F.lit(2.5), F.floor(key / 5) * 2 + F.lit(1.0)
    scale = F.lit(1.0) + F.col("n_regionkey") * F.lit(0.25)

    def ring(offsets):
        vertices = [
            F.struct((x + F.lit(dx) * scale).alias("lon"), (y + F.lit(dy) * scale).alias("lat"))
            for dx, dy in [*offsets, offsets[0]]
        ]
        return F.array(*vertices)

    rings = F.when(F.col("n_regionkey") == 0, F.array(ring(OUTLINE), ring(HOLE))).otherwise(
        F.array(ring(OUTLINE))
    )
    return table(spark, sf_dir, "nation").select("n_name", "n_nationkey", rings.alias("rings"))


def event_points(spark, sf_dir):
    lat = (F.col("event_id") * 7919 % 10007) / F.lit(1000.7)
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") / F.lit(20.0)).alias("lon"), lat.alias("lat"), "value"
    )


def _vertices(ring, offsets):
    closed = [*offsets, offsets[0]]
    return [
        f"({ring}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)"
        for a, b in zip(closed, closed[1:])
    ]


PLACED_SQL = f"""
    WITH offsets(ring, dx1, dy1, dx2, dy2) AS (VALUES {', '.join(_vertices(0, OUTLINE) + _vertices(1, HOLE))}),
    edges AS (SELECT n_name, (n_nationkey % 5) * 5 + 2.5::DOUBLE + dx1 * s AS x1, floor(n_nationkey / 5) * 2 + 1.0::DOUBLE + dy1 * s AS y1,
                (n_nationkey % 5) * 5 + 2.5::DOUBLE + dx2 * s AS x2, floor(n_nationkey / 5) * 2 + 1.0::DOUBLE + dy2 * s AS y2
              FROM (SELECT *, 1.0::DOUBLE + n_regionkey * 0.25::DOUBLE AS s FROM nation)
              JOIN offsets ON ring = 0 OR n_regionkey = 0),
    points AS (SELECT event_id, value / 20.0::DOUBLE AS lon, (event_id * 7919 % 10007) / 1000.7::DOUBLE AS lat, value FROM events),
    crossings AS (SELECT event_id, n_name FROM points JOIN edges ON (y1 > lat) <> (y2 > lat)
                    AND lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
                  GROUP BY event_id, n_name HAVING count(*) % 2 = 1),
    placed AS (SELECT p.*, n_name FROM points p LEFT JOIN crossings USING (event_id))"""


def _placed(spark, sf_dir):
    points, polygons = event_points(spark, sf_dir), nation_polygons(spark, sf_dir)
    return within_join(points, polygons.select("n_name", "rings"), "n_name", "lon", "lat", 0.5)


@query(PLACED_SQL + "SELECT event_id, lon, lat, value, n_name FROM placed")
def spatial_join(spark, sf_dir):
    return _placed(spark, sf_dir)


@query(PLACED_SQL + "SELECT event_id, lon, lat, value, n_name FROM placed")
def spatial_cover_join(spark, sf_dir):
    """The same rows by cells that fit each polygon."""
    points, polygons = event_points(spark, sf_dir), nation_polygons(spark, sf_dir)
    return cover_join(points, polygons.select("n_name", "rings"), "n_name", "lon", "lat")


@query(
    PLACED_SQL
    + """SELECT event_id, lon, lat, value, 'Punto fuera de los 11 distritos oficiales de Sevilla'
    AS motivo_rechazo FROM placed WHERE n_name IS NULL"""
)
def spatial_quarantine(spark, sf_dir):
    return split_by_polygon(_placed(spark, sf_dir), "n_name")[1]


@query(
    PLACED_SQL
    + """SELECT n_name, round(coalesce(sum(value), 0), 2) AS potencia_total_kw,
    count(value)::INTEGER AS num_estaciones FROM nation LEFT JOIN placed USING (n_name) GROUP BY n_name"""
)
def district_power(spark, sf_dir):
    valid, _ = split_by_polygon(_placed(spark, sf_dir), "n_name")
    power = power_by_district(valid, nation_polygons(spark, sf_dir), "n_name", "value")
    return power.withColumn("potencia_total_kw", F.round("potencia_total_kw", 2))


INDEX_SQL = (
    PLACED_SQL
    + """, socio AS (SELECT n_name, count(c_custkey) AS people, round(sum(c_acctbal), 2) / count(c_custkey) AS income
                FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name),
    power AS (SELECT n_name, coalesce(sum(value), 0) AS kw, count(value)::INTEGER AS n
              FROM nation LEFT JOIN placed USING (n_name) GROUP BY n_name),
    master AS (SELECT *, kw / people * 10000 AS density FROM socio JOIN power USING (n_name)),
    scaled AS (SELECT *, (income - min(income) OVER ()) / (max(income) OVER () - min(income) OVER ()) AS income_norm,
                 (density - min(density) OVER ()) / (max(density) OVER () - min(density) OVER ()) AS density_norm FROM master),
    indexed AS (SELECT *, income_norm * (1 - density_norm) * 100 AS ioi FROM scaled)"""
)


def _index(spark, sf_dir):
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    people = nation.join(customer, nation.n_nationkey == customer.c_nationkey, "left")
    socio = people.groupBy(F.col("n_name").alias("nombre_distrito")).agg(
        F.count("c_custkey").alias("poblacion_total"),
        (F.round(F.sum("c_acctbal"), 2) / F.count("c_custkey")).alias("renta_media_neta_persona"),
    )
    noisy = F.concat(F.lit("  "), F.initcap("n_name"), F.lit(" "))
    polygons = nation_polygons(spark, sf_dir).select(noisy.alias("feature_name"), "rings")
    districts = geo_index.keyed_districts(polygons)
    stations = event_points(spark, sf_dir).withColumnRenamed("value", "potencia_kw")
    placed, outside = geo_index.place_stations(stations, districts, 0.5)
    return geo_index.district_index(districts, socio, placed), placed, outside


@query(
    INDEX_SQL
    + """SELECT n_name AS nombre_distrito, people AS poblacion_total, income AS renta_media_neta_persona, n AS num_estaciones,
    round(density, 4) AS densidad_energetica, round(income_norm, 6) AS renta_norm, round(density_norm, 6) AS densidad_norm,
    round(ioi, 4) AS ioi FROM indexed"""
)
def opportunity_index(spark, sf_dir):
    index, _, _ = _index(spark, sf_dir)
    return index.select(
        "nombre_distrito",
        "poblacion_total",
        "renta_media_neta_persona",
        "num_estaciones",
        F.round("densidad_energetica", 4).alias("densidad_energetica"),
        F.round("renta_norm", 6).alias("renta_norm"),
        F.round("densidad_norm", 6).alias("densidad_norm"),
        F.round("IOI", 4).alias("ioi"),
    )


@query(
    INDEX_SQL
    + """SELECT row_number() OVER (ORDER BY ioi DESC, n_name) AS position, n_name AS nombre_distrito,
    round_even(ioi * 100, 0) / 100 AS ioi, round_even(kw * 100, 0) / 100 AS potencia_total_kw FROM indexed"""
)
def opportunity_ranking(spark, sf_dir):
    ranked = geo_index.result_table(_index(spark, sf_dir)[0])
    return ranked.select("position", "nombre_distrito", F.col("IOI").alias("ioi"), "potencia_total_kw")


@query(
    PLACED_SQL
    + """SELECT event_id::VARCHAR AS nombre, coalesce(n_name, 'Fuera de distrito') AS distrito, lat, lon, value AS potencia_kw,
    CASE WHEN n_name IS NULL THEN 'Cuarentena' ELSE 'Valido' END AS estado FROM placed ORDER BY estado, distrito, nombre"""
)
def labelled_stations(spark, sf_dir):
    """Valid and rejected points as one labelled, sorted table."""
    _, placed, outside = _index(spark, sf_dir)
    name = F.col("event_id").cast("string")
    return geo_index.station_export(
        placed.withColumn("nombre", name), outside.withColumn("nombre", name)
    )


@query(
    """WITH p AS (SELECT s_suppkey, 36.5::DOUBLE + s_acctbal / 5000 AS lat, -7.0::DOUBLE + s_nationkey / 12.5::DOUBLE AS lon FROM supplier),
    d AS (SELECT *, 12742.0::DOUBLE * asin(sqrt(power(sin(radians(lat - 37.39::DOUBLE) / 2), 2)
      + cos(radians(37.39::DOUBLE)) * cos(radians(lat)) * power(sin(radians(lon + 5.9961::DOUBLE) / 2), 2))) AS km FROM p)
    SELECT s_suppkey, round(km, 6) AS distance_km FROM d WHERE km <= 60"""
)
def radius_filter(spark, sf_dir):
    points = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.lit(36.5) + F.col("s_acctbal") / 5000).alias("lat"),
        (F.lit(-7.0) + F.col("s_nationkey") / F.lit(12.5)).alias("lon"),
    )
    near = within_radius(points, "lat", "lon", (37.39, -5.9961), 60.0)
    return near.select("s_suppkey", F.round("distance_km", 6).alias("distance_km"))


def _catalog(spark, sf_dir):
    return flag_in_box(
        table(spark, sf_dir, "customer").select(
            F.col("c_name").alias("ciudad"),
            (F.lit(34.0) + F.col("c_acctbal") / 1000).alias("lat"),
            (F.lit(-12.0) + F.col("c_nationkey")).alias("lon"),
        )
    )


CATALOG_SQL = """
    SELECT c_name AS ciudad, 34.0::DOUBLE + c_acctbal / 1000 AS lat, -12.0::DOUBLE + c_nationkey AS lon,
      lat BETWEEN 35.5 AND 44.0 AND lon BETWEEN -9.5 AND 3.5 AS en_peninsula FROM customer"""


@query(CATALOG_SQL)
def box_flags(spark, sf_dir):
    return _catalog(spark, sf_dir)


@query(
    f"""SELECT ciudad, 'outside' AS problem FROM ({CATALOG_SQL}) WHERE NOT en_peninsula
    UNION ALL SELECT DISTINCT s_name, 'missing' FROM supplier WHERE s_name NOT IN (SELECT c_name FROM customer)"""
)
def catalog_findings(spark, sf_dir):
    required = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("ciudad"))
    return catalog_problems(_catalog(spark, sf_dir), required)


def customer_rings(spark, sf_dir):
    """A ring per customer, by segment: closed, open, bow-tie, touching itself, with a hole."""
    x, y = F.col("c_nationkey").cast("double"), F.col("c_acctbal")
    corner = lambda dx, dy: F.struct((x + dx).alias("lon"), (y + dy).alias("lat"))
    square = [corner(0.0, 0.0), corner(4.0, 0.0), corner(4.0, 4.0), corner(0.0, 4.0)]
    bow = [square[0], square[2], square[1], square[3]]
    pinched = [corner(0.0, 0.0), corner(4.0, 0.0), corner(2.0, 2.0), corner(4.0, 4.0), corner(0.0, 4.0), corner(2.0, 2.0)]
    hole = [corner(1.0, 1.0), corner(2.0, 1.0), corner(2.0, 2.0)]
    segment = F.col("c_mktsegment")
    rings = (
        F.when(segment == "BUILDING", F.array(F.array(*square, square[0])))
        .when(segment == "AUTOMOBILE", F.array(F.array(*square)))
        .when(segment == "MACHINERY", F.array(F.array(*bow, bow[0])))
        .when(segment == "FURNITURE", F.array(F.array(*pinched, pinched[0])))
        .otherwise(F.array(F.array(*square, square[0]), F.array(*hole, hole[0])))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", rings.alias("rings"))


def _ring_rows(segment, ring, points, closed=True):
    listed = [*points, points[0]] if closed else points
    return [f"('{segment}', {ring}, {i}, {x}, {y})" for i, (x, y) in enumerate(listed)]


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]
RING_ROWS = (
    _ring_rows("BUILDING", 0, SQUARE)
    + _ring_rows("AUTOMOBILE", 0, SQUARE, False)
    + _ring_rows("MACHINERY", 0, [SQUARE[0], SQUARE[2], SQUARE[1], SQUARE[3]])
    + _ring_rows("FURNITURE", 0, [(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2)])
    + _ring_rows("HOUSEHOLD", 0, SQUARE)
    + _ring_rows("HOUSEHOLD", 1, [(1, 1), (2, 1), (2, 2)])
)


@query(
    f"""WITH shape(seg, ring, i, dx, dy) AS (VALUES {', '.join(RING_ROWS)}),
    sizes AS (SELECT seg, ring, count(*) AS n, arg_min((dx, dy), i) = arg_max((dx, dy), i) AS ends_meet
              FROM shape GROUP BY seg, ring),
    corners AS (SELECT seg, ring, i, dx, dy, n, ends_meet FROM shape JOIN sizes USING (seg, ring)
                UNION ALL SELECT seg, ring, n, dx, dy, n, ends_meet FROM shape JOIN sizes USING (seg, ring)
                WHERE i = 0 AND NOT ends_meet),
    edges AS (SELECT a.seg, a.ring, a.i, a.dx AS x1, a.dy AS y1, b.dx AS x2, b.dy AS y2,
                max(a.i) OVER (PARTITION BY a.seg, a.ring) AS last
              FROM corners a JOIN corners b ON a.seg = b.seg AND a.ring = b.ring AND b.i = a.i + 1),
    clash AS (SELECT DISTINCT a.seg FROM edges a JOIN edges b ON a.seg = b.seg AND a.ring = b.ring AND b.i > a.i + 1
              AND NOT (a.i = 0 AND b.i = b.last)
              AND least(a.x1, a.x2) <= greatest(b.x1, b.x2) AND least(b.x1, b.x2) <= greatest(a.x1, a.x2)
              AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) AND least(b.y1, b.y2) <= greatest(a.y1, a.y2)
              AND sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1))
                * sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) <= 0
              AND sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1))
                * sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) <= 0),
    judged AS (SELECT seg, count(*)::INTEGER AS ring_count, bool_and(ends_meet AND n >= 4) AS is_closed,
                 seg IN (SELECT seg FROM clash) AS self_intersects FROM sizes GROUP BY seg)
    SELECT c_custkey, ring_count, is_closed, self_intersects, is_closed AND NOT self_intersects AS is_valid
    FROM customer JOIN judged ON c_mktsegment = seg"""
)
def ring_validity(spark, sf_dir):
    return polygon_validity(customer_rings(spark, sf_dir), "c_custkey")


@query(
    """WITH figures AS (SELECT c_name, count(*) AS people FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name),
    p AS (SELECT s_name, 36.5::DOUBLE + s_acctbal / 5000 AS lat, -7.0::DOUBLE + s_nationkey / 12.5::DOUBLE AS lon FROM supplier),
    d AS (SELECT s_name, 12742.0::DOUBLE * asin(sqrt(power(sin(radians(lat - 37.39::DOUBLE) / 2), 2)
      + cos(radians(37.39::DOUBLE)) * cos(radians(lat)) * power(sin(radians(lon + 5.9961::DOUBLE) / 2), 2))) AS km FROM p)
    SELECT 'polygon' AS check_name, c_name AS subject, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'open ring' ELSE 'meets itself' END AS detail
    FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY', 'FURNITURE')
    UNION ALL SELECT 'district', c_name, 'no figures' FROM customer WHERE c_name NOT IN (SELECT c_name FROM figures)
    UNION ALL SELECT 'district', c_name, 'repeated polygon' FROM customer GROUP BY c_name HAVING count(*) > 1
    UNION ALL SELECT 'figure', 'districts', 'expected 11, found ' || count(*) FROM figures HAVING count(*) <> 11
    UNION ALL SELECT 'figure', 'population', 'expected 697233, found ' || sum(people) FROM figures HAVING sum(people) <> 697233
    UNION ALL SELECT 'station', s_name, 'outside the search radius' FROM d WHERE km > 20"""
)
def district_findings(spark, sf_dir):
    """Checks of a district run: customers' rings as polygons, their orders as figures, suppliers as stations."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    names = customer.select("c_custkey", F.col("c_name").alias(geo_index.NAME))
    districts = customer_rings(spark, sf_dir).join(names, "c_custkey").select(geo_index.NAME, "rings")
    bought = names.join(orders, names.c_custkey == orders.o_custkey)
    socio = bought.groupBy(geo_index.NAME).agg(F.count(F.lit(1)).alias("poblacion_total"))
    stations = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("nombre"),
        (F.lit(36.5) + F.col("s_acctbal") / 5000).alias("lat"),
        (F.lit(-7.0) + F.col("s_nationkey") / F.lit(12.5)).alias("lon"),
    )
    return geo_index.findings(districts, socio, stations)


@query(
    f"""WITH offsets AS (SELECT {len(OUTLINE) + 1} AS outer_n, {len(HOLE) + 1} AS hole_n)
    SELECT n_name AS feature_name, CASE WHEN n_regionkey = 0 THEN 2 ELSE 1 END AS ring_count,
      outer_n + CASE WHEN n_regionkey = 0 THEN hole_n ELSE 0 END AS vertices,
      round((n_nationkey % 5) * 5 + 2.5::DOUBLE + {OUTLINE[0][0]}::DOUBLE * (1.0::DOUBLE + n_regionkey * 0.25::DOUBLE), 9) AS first_lon
    FROM nation, offsets"""
)
def geojson_features(spark, sf_dir):
    """Nation polygons written as GeoJSON, multipolygons among them, and read back."""
    polygons = nation_polygons(spark, sf_dir)
    coords = F.transform(
        "rings", lambda r: F.transform(r, lambda v: F.array(v["lon"], v["lat"]))
    )
    single = F.to_json(F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")))
    multi = F.to_json(
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(coords).alias("coordinates"))
    )
    shape = F.when(F.col("n_nationkey") >= 12, multi).otherwise(single)
    document = F.format_string(
        '{"type":"FeatureCollection","features":[{"properties":{"Distri_11D":"%s"},"geometry":%s}]}',
        F.col("n_name"),
        shape,
    )
    path = work_dir(spark, "geojson")
    polygons.select(document.alias("value")).write.text(path)
    features = read_geojson(spark, path, "Distri_11D", multi_line=False)
    return features.select(
        "feature_name",
        F.size("rings").alias("ring_count"),
        F.size(F.flatten("rings")).alias("vertices"),
        F.round(F.col("rings")[0][0]["lon"], 9).alias("first_lon"),
    )
