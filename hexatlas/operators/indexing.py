"""Points to cells and back; outlines and measures of cells.

All jobs are one narrow pass: no shuffle, no Python.  ``cell`` arguments are SQL
expressions or column names of type BIGINT; results are added as columns and are
NULL for invalid input.
"""
from pyspark.sql import DataFrame

from ..functions import bits, frames, shapes
from ..functions.constants import EARTH_RADIUS_KM
from ..functions.steps import fresh, number, run
from ._common import check_res, tuned, valid_res


def index_points(df: DataFrame, lat="lat", lng="lng", res=9, out="cell") -> DataFrame:
    """Cell containing each point.  ``res`` is a number or a column."""
    o, res = fresh("ix"), check_res(res)
    steps = frames.index_degrees(lat, lng, res, o)
    finite = " AND ".join(f"NOT isnan(CAST({c} AS DOUBLE)) AND abs(CAST({c} AS DOUBLE)) < 1e300D" for c in (lat, lng))
    ok = f"{lat} IS NOT NULL AND {lng} IS NOT NULL AND {finite} AND {valid_res(res)}"
    return run(tuned(df), steps, {out: f"CASE WHEN {ok} THEN {o}cell END"}, first=True)


def _centers(cell, o):
    steps = frames.cell_frame(cell, o) + frames.point_of_face(f"{o}face", f"{o}fx", f"{o}fy", o)
    return [{f"{o}ok": bits.is_valid_cell(cell)}] + steps, f"{o}ok"


def cell_centroids(df: DataFrame, cell="cell", lat="lat", lng="lng") -> DataFrame:
    """Centre of each cell in degrees."""
    o = fresh("ct")
    steps, ok = _centers(cell, o)
    return run(tuned(df), steps, {lat: f"CASE WHEN {ok} THEN {frames.latitude(o)} END",
                                  lng: f"CASE WHEN {ok} THEN {frames.longitude(o)} END"})


ALL = [str(n) for n in range(6)]


def cell_outlines(df: DataFrame, cell="cell", out="outline") -> DataFrame:
    """Corners of each cell, counter-clockwise, as an array of (lng, lat); a side that
    passes onto another icosahedron face has an extra point there."""
    o = fresh("ol")
    points = shapes.outline_points(o, 6)
    return run(tuned(df), shapes.outline(cell, o, ALL),
               {out: f"CASE WHEN {bits.is_valid_cell(cell)} THEN {points} END"})


def edge_outlines(df: DataFrame, edge="edge", out="outline") -> DataFrame:
    """Points along the side a directed edge crosses."""
    o = fresh("el")
    start = shapes.side_of_direction(o + "k", f"{o}dir")
    steps = [{f"{o}dir": f"coalesce({bits.reserved(edge)}, 0)", f"{o}own": f"coalesce({bits.as_cell(edge)}, 0L)"}]
    k = o + "k"
    steps += frames.cell_frame(f"{o}own", k)
    steps += [{f"{k}pent": bits.is_pentagon(f"{o}own")}, {f"{o}n0": start}]
    steps += [{f"{o}n1": f"CASE WHEN {k}pent THEN ({o}n0 + 1) % 5 ELSE ({o}n0 + 1) % 6 END"}]
    s = o + "s"
    steps += shapes.outline(f"{o}own", s, [f"{o}n0", f"coalesce({o}n1, 0)"], closed=False)
    return run(tuned(df), steps, {out: f"CASE WHEN {bits.is_valid_edge(edge)} "
                                       f"THEN {shapes.outline_points(s, 2, closed=False)} END"})


def icosahedron_faces(df: DataFrame, cell="cell", out="faces") -> DataFrame:
    """Ascending list of the icosahedron faces (0-19) a cell touches."""
    o = fresh("if")
    steps = shapes.outline(cell, o, ALL)
    rows = shapes.tables.frame_rows()
    faces = [f"{shapes.pick([r[0] for r in rows], f'{o}row{i}')}" for i in range(6)]
    listed = ", ".join(f"CASE WHEN NOT ({o}pent AND {i} = 5) THEN {f} END" for i, f in enumerate(faces))
    pent = " ".join(f"WHEN {o}p = {i} THEN array({', '.join(map(str, sorted(shapes.tables.base_cells()[b][1])))})"
                    for i, b in enumerate(shapes.tables.pentagons()))
    out_expr = (f"CASE WHEN NOT {bits.is_valid_cell(cell)} THEN NULL "
                f"WHEN {o}pent THEN CASE {pent} END "
                f"ELSE sort_array(array_distinct(filter(array({listed}, {o}face), f -> f IS NOT NULL))) END")
    return run(tuned(df), steps, {out: out_expr})


AREA_UNITS = {"rads^2": 1.0, "km^2": EARTH_RADIUS_KM ** 2, "m^2": EARTH_RADIUS_KM ** 2 * 1e6}
LENGTH_UNITS = {"rads": 1.0, "km": EARTH_RADIUS_KM, "m": EARTH_RADIUS_KM * 1000}


def unit_factor(unit, units):
    """CASE over a unit given as a Python string or, prefixed with ``=``, a column."""
    if unit.startswith("="):
        return "CASE " + " ".join(f"WHEN {unit[1:]} = '{u}' THEN {number(f)}" for u, f in units.items()) + " END"
    return number(units[unit]) if unit in units else "CAST(NULL AS DOUBLE)"


def _triangle(a, b, c):
    """Solid angle of the triangle of three unit vectors (named by prefixes); built on
    differences so that tiny triangles keep their digits."""
    d1 = [f"({a}{k} - {c}{k})" for k in "xyz"]
    d2 = [f"({b}{k} - {c}{k})" for k in "xyz"]
    triple = (f"{c}x * ({d1[1]} * {d2[2]} - {d1[2]} * {d2[1]}) + {c}y * ({d1[2]} * {d2[0]} - {d1[0]} * {d2[2]}) "
              f"+ {c}z * ({d1[0]} * {d2[1]} - {d1[1]} * {d2[0]})")

    def dot(p, q):
        return f"({p}x * {q}x + {p}y * {q}y + {p}z * {q}z)"

    return f"2D * atan2(abs({triple}), 1D + {dot(a, b)} + {dot(b, c)} + {dot(c, a)})"


def cell_areas(df: DataFrame, cell="cell", unit="km^2", out="area") -> DataFrame:
    """Exact spherical area of each cell; ``unit`` is a name or ``=column``."""
    o = fresh("ar")
    steps = shapes.outline(cell, o, ALL)
    steps += [{f"{o}m{k}": e for k, e in zip("xyz", frames.point_of_face(
        f"{o}face", f"{o}fx", f"{o}fy", "")[0].values())}]
    vectors = {"u": [f"{o}m{k}" for k in "xyz"]}
    for i in range(6):
        vectors[f"v{i}"] = [f"{o}{k}{i}" for k in "xyz"]
        vectors[f"h{i}"] = [f"{o}e{k}{i}" for k in "xyz"]
    steps.append({f"{o}{n}{k}": f"{v[j]} / sqrt({v[0]} * {v[0]} + {v[1]} * {v[1]} + {v[2]} * {v[2]})"
                  for n, v in vectors.items() for j, k in enumerate("xyz")})
    parts = []
    for i in range(6):
        nxt = f"{o}v{(i + 1) % 6}"
        # a pentagon's last side runs from vertex 4 to vertex 0
        direct = _triangle(f"{o}v{i}", nxt, f"{o}u")
        via = f"{_triangle(f'{o}v{i}', f'{o}h{i}', f'{o}u')} + {_triangle(f'{o}h{i}', nxt, f'{o}u')}"
        if i == 4:
            pent = (f"{_triangle(f'{o}v4', f'{o}h4', f'{o}u')} + {_triangle(f'{o}h4', f'{o}v0', f'{o}u')}")
            pent_direct = _triangle(f"{o}v4", f"{o}v0", f"{o}u")
            parts.append(f"CASE WHEN {o}pent AND {o}t4 IS NOT NULL THEN {pent} WHEN {o}pent THEN {pent_direct} "
                         f"WHEN {o}t4 IS NOT NULL THEN {via} ELSE {direct} END")
        elif i == 5:
            parts.append(f"CASE WHEN {o}pent THEN 0D WHEN {o}t5 IS NOT NULL THEN {via} ELSE {direct} END")
        else:
            parts.append(f"CASE WHEN {o}t{i} IS NOT NULL THEN {via} ELSE {direct} END")
    steps.append({f"{o}part{i}": e for i, e in enumerate(parts)})
    total = " + ".join(f"{o}part{i}" for i in range(6))
    return run(tuned(df), steps, {out: f"CASE WHEN {bits.is_valid_cell(cell)} "
                                       f"THEN ({total}) * {unit_factor(unit, AREA_UNITS)} END"})


def _arc(a, b):
    d = " + ".join(f"({a[k]} - {b[k]}) * ({a[k]} - {b[k]})" for k in range(3))
    return f"2D * asin(least(1D, 0.5D * sqrt({d})))"


def edge_lengths(df: DataFrame, edge="edge", unit="km", out="length") -> DataFrame:
    """Exact length of the side a directed edge crosses."""
    o = fresh("ln")
    shaped = edge_outlines(df, edge, f"{o}pts")
    p = f"{o}pts"

    def vec(q):
        return (f"cos(radians({q}.lat)) * cos(radians({q}.lng))",
                f"cos(radians({q}.lat)) * sin(radians({q}.lng))", f"sin(radians({q}.lat))")

    steps = [{f"{o}{n}{k}": f"coalesce({e}, 0D)" for n, q in (("a", f"get({p}, 0)"), ("b", f"get({p}, 1)"),
                                                             ("d", f"get({p}, 2)")) for k, e in zip("xyz", vec(q))}]
    v = {n: [f"{o}{n}{k}" for k in "xyz"] for n in "abd"}
    steps.append({f"{o}len": f"CASE WHEN size({p}) = 3 THEN {_arc(v['a'], v['b'])} + {_arc(v['b'], v['d'])} "
                             f"WHEN size({p}) = 2 THEN {_arc(v['a'], v['b'])} END"})
    return run(shaped, steps, {out: f"{o}len * {unit_factor(unit, LENGTH_UNITS)}"}, drop=(p,))


def great_circle(lat0, lng0, lat1, lng1, unit="km"):
    """Great-circle distance of two points in degrees, as a SQL expression."""
    a = (f"pow(sin((radians({lat1}) - radians({lat0})) * 0.5D), 2) + cos(radians({lat0})) * cos(radians({lat1})) "
         f"* pow(sin((radians({lng1}) - radians({lng0})) * 0.5D), 2)")
    return f"2D * atan2(sqrt({a}), sqrt(1D - ({a}))) * {unit_factor(unit, LENGTH_UNITS)}"


def great_circle_distances(df: DataFrame, lat0, lng0, lat1, lng1, unit="km", out="distance") -> DataFrame:
    return run(df, [], {out: great_circle(lat0, lng0, lat1, lng1, unit)})
