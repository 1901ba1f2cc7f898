"""Points in polygons, polygon validity and distance filters.

A polygon is a row with `rings`: array<array<struct<lon double, lat double>>>. Holes and
parts of a multipolygon are further rings; inside is decided by the even-odd rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.fixed_values import DENSITY_FACTOR, OUTSIDE_REASON
from tamiz.functions.units import energy_density, haversine_km
from tamiz.runtime import checkpoint, join_side, small_side

RINGS_TYPE = "array<array<struct<lon:double,lat:double>>>"
# Cell rows carry edges, so the side is measured in edges (about 50 bytes each).
BROADCAST_EDGES = 1_000_000
# Cells of a cover that more edges pass are cut into 16, so many times at most.
MOST_EDGES = 32
DEEPEST = 5
# Share of a cell by which edges are widened against rounding.
EDGE_PAD = 1e-6
# Degrees; about a tenth of a millimetre.
SMALLEST_EXTENT = 1e-9
# Longer rings are checked for self-intersection by a join instead of in their row.
EDGES_IN_ROW = 64


def ring_edges(ring: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> of consecutive vertices; an open ring is closed."""
    first = F.slice(ring, 1, 1)
    closed = F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(F.concat(ring, first))
    starts = F.slice(closed, F.lit(1), F.size(closed) - 1)
    ends = F.slice(closed, F.lit(2), F.size(closed) - 1)
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
        ),
    )


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether the ray from the point to the right crosses the edge."""
    straddles = (e["y1"] > y) != (e["y2"] > y)
    at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
    return straddles & (x < at)


def _side(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def _touches(e: Column, x: Column, y: Column) -> Column:
    return (
        (_side(e, x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def is_inside(x: Column, y: Column, edges: Column) -> Column:
    """Strictly inside: odd number of edges crossed to the right, and on no edge."""
    odd = F.size(F.filter(edges, lambda e: _crosses(e, x, y))) % 2 == 1
    return odd & ~F.exists(edges, lambda e: _touches(e, x, y))


def polygon_cells(polygons: DataFrame, name: str, cell: float) -> DataFrame:
    """(name, _cx, _cy, _edges): grid cells under each polygon's box, each with the edges
    that can matter to a point of that cell: those in its band of y, not left of it."""
    edges = polygons.select(name, polygon_edges(F.col("rings")).alias("_edges"))
    xs = F.transform("_edges", lambda e: F.least(e["x1"], e["x2"]))
    xe = F.transform("_edges", lambda e: F.greatest(e["x1"], e["x2"]))
    ys = F.transform("_edges", lambda e: F.least(e["y1"], e["y2"]))
    ye = F.transform("_edges", lambda e: F.greatest(e["y1"], e["y2"]))

    def span(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell)))

    cells = edges.withColumn("_cx", span(F.array_min(xs), F.array_max(xe))).withColumn(
        "_cy", span(F.array_min(ys), F.array_max(ye))
    )
    # A hair of slack keeps the selection safe against rounding at cell borders.
    slack = cell * 1e-9
    left = F.col("_cx") * cell - slack
    bottom, top = F.col("_cy") * cell - slack, (F.col("_cy") + 1) * cell + slack
    near = F.filter(
        "_edges",
        lambda e: (F.greatest(e["x1"], e["x2"]) >= left)
        & (F.greatest(e["y1"], e["y2"]) >= bottom)
        & (F.least(e["y1"], e["y2"]) <= top),
    )
    return cells.withColumn("_edges", near).filter(F.size("_edges") > 0)


def within_join(
    points: DataFrame, polygons: DataFrame, name: str, lon: str, lat: str, cell: float
) -> DataFrame:
    """Left join: one row per point and containing polygon, `name` NULL if there is none.

    Points meet polygons through an equi-join on grid cells with the exact test as a
    further join condition, so neither candidate pairs nor leftover points need another
    shuffle. The cell table is broadcast when counted small; the points then stay where
    they are.
    """
    cells = polygon_cells(polygons, name, cell)
    side = join_side(cells, BROADCAST_EDGES, F.size("_edges"))
    x, y = F.col(lon), F.col(lat)
    placed = points.withColumns({"_px": F.floor(x / cell), "_py": F.floor(y / cell)})
    matches = (
        (F.col("_px") == F.col("_cx"))
        & (F.col("_py") == F.col("_cy"))
        & is_inside(x, y, F.col("_edges"))
    )
    return placed.join(side, matches, "left").select(*points.columns, name)


def polygon_cover(
    polygons: DataFrame, name: str, most_edges: int = MOST_EDGES, deepest: int = DEEPEST
) -> DataFrame:
    """(name, _level, _cx, _cy, _edges, _odd): cells of side 4 ** _level that cover each polygon.

    The first cells are about as large as the polygon. A cell that more than `most_edges` edges pass
    is cut into 16, up to `deepest` times. Cells outside are left out; inner ones have no edges. All
    steps are projections of one stage. Coordinates are degrees; polygons with other than finite ones are left out.

    A cell needs only the edges that pass it and one bit. Let an edge count for a point if the ray to
    the right crosses it, once more for each of its ends that is right of the cell and above the
    point. Around a ring each end is counted twice, so the parity stays that of the crossings; and an
    edge that does not pass the cell counts alike for all points of it. `_odd` holds what those add up to.
    """
    edges = polygons.select(name, polygon_edges(F.col("rings")).alias("_edges"))
    corners = {
        "_x0": F.array_min(F.transform("_edges", lambda e: F.least(e["x1"], e["x2"]))),
        "_x1": F.array_max(F.transform("_edges", lambda e: F.greatest(e["x1"], e["x2"]))),
        "_y0": F.array_min(F.transform("_edges", lambda e: F.least(e["y1"], e["y2"]))),
        "_y1": F.array_max(F.transform("_edges", lambda e: F.greatest(e["y1"], e["y2"]))),
    }
    extent = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(SMALLEST_EXTENT))
    finite = F.forall("_edges", lambda e: F.abs(e["x1"] + e["y1"] + e["x2"] + e["y2"]) < float("inf"))
    boxed = edges.filter((F.size("_edges") > 0) & finite).withColumns(corners)
    rooted = boxed.withColumn("_level", F.ceil(F.log2(extent) / 2).cast("int"))
    side = _cell_side(F.col("_level"))

    def span(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) / side), F.floor(F.col(high) / side)))

    cells = rooted.withColumn("_cx", span("_x0", "_x1")).withColumn("_cy", span("_y0", "_y1"))
    # Seen from the whole polygon, every edge counts by its crossings alone.
    cells = _narrowed(cells.withColumns({"_odd": F.lit(False), "_right": F.lit(float("inf"))}), name)
    for depth in range(deepest):
        crowded = F.size("_edges") > most_edges
        parts = F.when(crowded, F.sequence(F.lit(0), F.lit(15))).otherwise(F.array(F.lit(-1)))
        cut = cells.withColumn("_part", F.explode(parts))
        whole = F.col("_part") < 0

        def quarter(index: str, offset: Column) -> Column:
            return F.when(whole, F.col(index)).otherwise(F.col(index) * 4 + offset)

        moved = {
            "_right": _right_border(F.col("_level"), F.col("_cx")),
            "_cx": quarter("_cx", F.col("_part") % 4),
            "_cy": quarter("_cy", F.floor(F.col("_part") / 4)),
            "_level": F.when(whole, F.col("_level")).otherwise(F.col("_level") - 1),
        }
        cells = _narrowed(cut.withColumns(moved), name)
    return cells


def _cell_side(level: Column) -> Column:
    """A power of two, so dividing a coordinate by it is exact."""
    return F.pow(F.lit(2.0), level * 2)


def _slack(side: Column) -> Column:
    """Far above the rounding of the tests and far below a cell."""
    return side * F.lit(2.0**-20) + F.lit(1e-12)


def _right_border(level: Column, cx: Column) -> Column:
    side = _cell_side(level)
    return (cx + 1) * side + _slack(side)


def _counted_odd(edges: Column, x: Column, y: Column, right: Column) -> Column:
    def counts(e: Column) -> Column:
        first = (e["x1"] > right) & (e["y1"] > y)
        second = (e["x2"] > right) & (e["y2"] > y)
        return (_crosses(e, x, y) != first) != second

    return F.size(F.filter(edges, counts)) % 2 == 1


def _narrowed(cells: DataFrame, name: str) -> DataFrame:
    """Cells with the edges that pass them, out of those of the cell they were cut from."""
    side = _cell_side(F.col("_level"))
    slack = _slack(side)
    left, right = F.col("_cx") * side - slack, _right_border(F.col("_level"), F.col("_cx"))
    bottom, top = F.col("_cy") * side - slack, (F.col("_cy") + 1) * side + slack

    def passes(e: Column) -> Column:
        turns = [F.signum(_side(e, x, y)) for x in (left, right) for y in (bottom, top)]
        return (
            (F.least(e["x1"], e["x2"]) <= right)
            & (F.greatest(e["x1"], e["x2"]) >= left)
            & (F.least(e["y1"], e["y2"]) <= top)
            & (F.greatest(e["y1"], e["y2"]) >= bottom)
            & (F.abs(sum(turns[1:], turns[0])) < 4)
        )

    x, y = (F.col("_cx") + 0.5) * side, (F.col("_cy") + 0.5) * side
    near = cells.withColumn("_near", F.filter("_edges", passes))
    inside = _counted_odd(F.col("_edges"), x, y, F.col("_right")) != F.col("_odd")
    odd = inside != _counted_odd(F.col("_near"), x, y, right)
    shown = near.select(name, "_level", "_cx", "_cy", F.col("_near").alias("_edges"), odd.alias("_odd"))
    return shown.filter((F.size("_edges") > 0) | F.col("_odd"))


def cover_join(points: DataFrame, polygons: DataFrame, name: str, lon: str, lat: str) -> DataFrame:
    """The rows of `within_join`, by cells that fit each polygon instead of one grid.

    Points are looked up once for each size of cell in use. Points of an inner cell match at once; in
    others they are tested against the few edges that pass it. Points without a polygon come from one
    anti join for each size, so no row has to be recognised again and nothing is grouped. The cover is
    broadcast when counted small; the points then stay where they are. Points without finite coordinates are in no polygon.
    """
    cover = checkpoint(polygon_cover(polygons, name))
    # One row a size: a handful.
    levels = sorted(r[0] for r in cover.select("_level").distinct().collect())
    if not levels:
        return points.withColumn(name, F.lit(None).cast(polygons.schema[name].dataType))
    side = small_side(cover, BROADCAST_EDGES, F.size("_edges") + 1)
    x, y = F.col(lon), F.col(lat)
    finite = (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))

    def place(value: Column, level: Column) -> Column:
        return F.when(finite, F.floor(value / _cell_side(level)))

    right = _right_border(F.col("_level"), F.col("_cx"))
    odd = _counted_odd(F.col("_edges"), x, y, right) != F.col("_odd")
    inside = odd & ~F.exists("_edges", lambda e: _touches(e, x, y))

    def met(level: Column) -> Column:
        same = (place(x, level) == F.col("_cx")) & (place(y, level) == F.col("_cy"))
        return (F.col("_level") == level) & same & inside

    looked_up = points.withColumn("_size", F.explode(F.array(*[F.lit(v) for v in levels])))
    matched = looked_up.join(side, met(F.col("_size"))).select(*points.columns, name)
    rest = points
    for level in levels:
        rest = rest.join(side, met(F.lit(level)), "left_anti")
    return matched.unionByName(rest.withColumn(name, F.lit(None).cast(polygons.schema[name].dataType)))


def split_by_polygon(joined: DataFrame, name: str, reason: str = OUTSIDE_REASON):
    """(points with a polygon, quarantine with a reason)."""
    outside = joined.filter(F.col(name).isNull()).drop(name)
    return joined.filter(F.col(name).isNotNull()), outside.withColumn(
        "motivo_rechazo", F.lit(reason)
    )


def power_by_district(valid: DataFrame, districts: DataFrame, name: str, power: str) -> DataFrame:
    """Sum and count per district; districts without points appear with zeros."""
    totals = valid.groupBy(name).agg(
        F.sum(power).alias("potencia_total_kw"), F.count(power).alias("num_estaciones")
    )
    return (
        districts.select(name)
        .join(totals, name, "left")
        .fillna({"potencia_total_kw": 0.0, "num_estaciones": 0})
        .withColumn("num_estaciones", F.col("num_estaciones").cast("int"))
    )


def district_master(
    districts: DataFrame,
    socio: DataFrame,
    power: DataFrame,
    name: str,
    factor: int = DENSITY_FACTOR,
) -> DataFrame:
    """Districts with their population, income, power and energy density (left joins)."""
    return (
        districts.join(socio, name, "left")
        .join(power, name, "left")
        .withColumn(
            "densidad_energetica",
            energy_density(F.col("potencia_total_kw"), F.col("poblacion_total"), factor),
        )
    )


def within_radius(
    points: DataFrame, lat: str, lon: str, centre: tuple[float, float], radius_km: float
) -> DataFrame:
    distance = haversine_km(F.lit(centre[0]), F.lit(centre[1]), F.col(lat), F.col(lon))
    return points.withColumn("distance_km", distance).filter(F.col("distance_km") <= radius_km)


def polygon_validity(
    polygons: DataFrame, id: str, edges_in_row: int = EDGES_IN_ROW
) -> DataFrame:
    """Per polygon: are all rings closed, does any ring cross itself, is it valid.

    The edges of a ring are compared inside its row; for rings with more than
    `edges_in_row` edges only those that share a grid cell are compared, by a join.
    """
    closed = F.forall("rings", lambda r: (F.size(r) >= 4) & (r[0] == F.element_at(r, -1)))
    edges = F.transform("rings", lambda r: _numbered_edges(r))
    shaped = polygons.select(id, F.col("rings"), edges.alias("_rings"))
    short = F.filter("_rings", lambda r: F.size(r) <= edges_in_row)
    judged = shaped.select(
        id,
        F.size("rings").alias("ring_count"),
        closed.alias("is_closed"),
        F.exists(short, _clashes_in_row).alias("_short_clash"),
    )
    long_rings = shaped.select(id, F.posexplode("_rings").alias("_ring", "_edges")).filter(
        F.size("_edges") > edges_in_row
    )
    clashing = _clashes_by_cell(long_rings, id).withColumn("_long_clash", F.lit(True))
    clash = F.col("_short_clash") | F.coalesce("_long_clash", F.lit(False))
    return judged.join(clashing, id, "left").select(
        id,
        "ring_count",
        "is_closed",
        clash.alias("self_intersects"),
        (F.col("is_closed") & ~clash).alias("is_valid"),
    )


def _numbered_edges(ring: Column) -> Column:
    """Edges of non-zero length with their number and whether they are the last."""
    real = F.filter(ring_edges(ring), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    ends = ("x1", "y1", "x2", "y2")
    return F.transform(real, lambda e, i: F.struct(i.alias("i"), *[e[c].alias(c) for c in ends]))


def _meet(a: Column, b: Column, last: Column) -> Column:
    """Whether a and a later edge b, no neighbour of a, share a point."""

    def side(e: Column, x: Column, y: Column) -> Column:
        return F.signum((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]))

    def overlap(low: str, high: str) -> Column:
        a_low, a_high = F.least(a[low], a[high]), F.greatest(a[low], a[high])
        return (F.least(b[low], b[high]) <= a_high) & (F.greatest(b[low], b[high]) >= a_low)

    apart = (b["i"] > a["i"] + 1) & ~((a["i"] == 0) & (b["i"] == last))
    return (
        apart
        & overlap("x1", "x2")
        & overlap("y1", "y2")
        & (side(a, b["x1"], b["y1"]) * side(a, b["x2"], b["y2"]) <= 0)
        & (side(b, a["x1"], a["y1"]) * side(b, a["x2"], a["y2"]) <= 0)
    )


def _clashes_in_row(edges: Column) -> Column:
    last = F.size(edges) - 1
    return F.exists(edges, lambda a: F.exists(edges, lambda b: _meet(a, b, last)))


def _edges_by_cell(rings: DataFrame, id: str) -> DataFrame:
    """Edges in the cells that they pass. Each ring's box is divided into as many cells as the
    ring has edges, so a cell holds few of them."""
    xs = F.transform("_edges", lambda e: e["x1"])
    ys = F.transform("_edges", lambda e: e["y1"])
    sides = F.ceil(F.sqrt(F.size("_edges")))
    boxed = rings.select(
        id,
        "_ring",
        (F.size("_edges") - 1).alias("_last"),
        F.array_min(xs).alias("_x0"),
        F.array_min(ys).alias("_y0"),
        F.nullif((F.array_max(xs) - F.array_min(xs)) / sides, F.lit(0.0)).alias("_w"),
        F.nullif((F.array_max(ys) - F.array_min(ys)) / sides, F.lit(0.0)).alias("_h"),
        F.explode("_edges").alias("e"),
    )

    def ends(axis: str) -> tuple[Column, Column]:
        first, second = F.col(f"e.{axis}1"), F.col(f"e.{axis}2")
        return F.least(first, second), F.greatest(first, second)

    def cell(value: Column, origin: str, width: str) -> Column:
        return F.coalesce(F.floor((value - F.col(origin)) / F.col(width)), F.lit(0))

    # Row by row: an edge is in the cells between the places where it enters and leaves a row.
    low, high = ends("y")
    rows = boxed.withColumn(
        "_cy", F.explode(F.sequence(cell(low, "_y0", "_h"), cell(high, "_y0", "_h")))
    )
    bottom = F.col("_y0") + (F.col("_cy") - EDGE_PAD) * F.col("_h")
    top = F.col("_y0") + (F.col("_cy") + 1 + EDGE_PAD) * F.col("_h")
    slope = (F.col("e.x2") - F.col("e.x1")) / F.nullif(F.col("e.y2") - F.col("e.y1"), F.lit(0.0))
    left, right = ends("x")

    def x_at(y: Column) -> Column:
        return F.greatest(left, F.least(right, F.col("e.x1") + (y - F.col("e.y1")) * slope))

    # Outside the edge's own heights, and for level edges, its ends limit it. `greatest` and `least` skip NULL.
    enters, leaves = x_at(F.greatest(low, bottom)), x_at(F.least(high, top))
    level = slope.isNull()
    pad = EDGE_PAD * F.col("_w")
    from_x = F.when(level, left).otherwise(F.least(enters, leaves))
    to_x = F.when(level, right).otherwise(F.greatest(enters, leaves))
    spread = rows.withColumn(
        "_cx", F.explode(F.sequence(cell(from_x - pad, "_x0", "_w"), cell(to_x + pad, "_x0", "_w")))
    )
    return spread.select(id, "_ring", "_cx", "_cy", "_last", "e")


def _clashes_by_cell(rings: DataFrame, id: str) -> DataFrame:
    """Ids of polygons with a ring that meets itself."""
    spread = _edges_by_cell(rings, id)
    place = [id, "_ring", "_cx", "_cy"]
    left = spread.select(*place, "_last", F.col("e").alias("a"))
    right = spread.select(*place, F.col("e").alias("b"))
    met = left.join(right, place).filter(_meet(F.col("a"), F.col("b"), F.col("_last")))
    return met.select(id).distinct()
