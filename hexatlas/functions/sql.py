"""The scalar functions by name: temporary SQL functions, and Column expressions.

``register(spark, prefix)`` defines them under any prefix, so existing queries run
unchanged with the prefix they use.  Each is a plain SQL function that Spark inlines, so
a call may stand in a filter or join.  Lists also come as table functions (``..._rows``)
for LATERAL, each a narrow generator.  ``column(name, ...)`` is a scalar call for the
DataFrame API.

Geometry comes from the table jobs, run on ``Inline`` parameters.  A table job of the same
name is quicker on large tables: its steps are generated code, those of a call are not.
"""
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensions, indexing, topology, traversal
from ..operators._common import HUGE_METHOD
from ..sources.polygons import outline_binary, outline_text
from . import bits
from .constants import EARTH_RADIUS_KM, MAX_RES
from .steps import Inline, Statement, as_lambda, fresh, number, pick, run, scoped

ITERATIONS = 500

CELL_OK = bits.is_valid_cell("cell")


def _bound(steps, result):
    return as_lambda(*scoped(steps, result))


def _units(units):
    return "CASE " + " ".join(f"WHEN unit = '{u}' THEN {number(f)}" for u, f in units.items()) + " END"


def _then(table, result):
    """A further expression of a job's outputs."""
    return run(table, [], {"answer": result}).value("answer")


def _disk(policy="exact", only_ring=False):
    """Members of the disk of (cell, k) as (ring, member) in that order; NULL for a negative k or an invalid cell."""
    cells = traversal._disk_by_angle(Inline("cell", "k"), "cell", "k", fresh("dk"), policy, only_ring)
    rows = cells.values("named_struct('r', ring, 'm', member)")
    limit = pick([traversal._widest(r) for r in range(MAX_RES + 1)], bits.resolution("cell"))
    wide = "raise_error('the disk may hold two pentagons: use the table job disk_expand')"
    held = "true" if policy == "null" else f"CASE WHEN k <= {limit} THEN true ELSE {wide} END"
    o = fresh("all")
    found = as_lambda([{f"{o}d": f"sort_array({rows})"}], f"CASE WHEN size({o}d) > 0 THEN {o}d END")
    return f"CASE WHEN {bits.is_valid_cell('cell')} AND k >= 0 THEN CASE WHEN {held} THEN {found} END END"


def _disk_rows(only_ring=False):
    """The same as a table: the disk of (cell, k) unless it holds a pentagon, by projections."""
    c, n = fresh("cell"), fresh("k")
    asked = Statement(f"SELECT cell AS {c}, k AS {n}", [c, n]).where(f"{bits.is_valid_cell(c)} AND {n} >= 0")
    return traversal._disk_by_angle(asked, c, n, fresh("dk"), "null", only_ring).then(["ring", "member"], "CAST(ring AS INT) AS ring", "member")


def _members(rows):
    return f"transform({rows}, e -> e.m)"


def _by_ring(rows):
    o = fresh("by")
    grouped = f"transform(sequence(0, k), g -> transform(filter({o}d, e -> e.r = g), e -> e.m))"
    return as_lambda([{f"{o}d": rows}], f"CASE WHEN {o}d IS NOT NULL THEN {grouped} END")


def _path():
    o = fresh("line")
    rows = traversal.path_expand(Inline("a", "b")).values("named_struct('s', step, 'm', member)")
    whole = f"size({o}d) > 0 AND NOT exists({o}d, e -> e.m IS NULL)"
    return as_lambda([{f"{o}d": f"sort_array({rows})"}], f"CASE WHEN {whole} THEN {_members(f'{o}d')} END")


def _area_avg():
    area = indexing.cell_areas(Inline("cell"), "cell", "rads^2", "answer").value("answer")
    pents = f"transform(sequence(0, 11), p -> {bits.pentagon_cell('p', 'res')})"
    total = f"aggregate(transform({pents}, cell -> {area}), 0D, (sum, x) -> sum + x)"
    units = {u: f for u, f in indexing.AREA_UNITS.items() if u != "rads^2"}
    return (f"CASE WHEN res BETWEEN 0 AND {MAX_RES} THEN ({number(dimensions.SPHERE)} - {total}) / ({bits.cells_at('res')} - 12) "
            f"* {_units(units)} END")


def geometric():
    """name -> (parameters, return type, body) of the functions that need geometry."""
    c, ce, v = "cell BIGINT", "edge BIGINT", "vertex BIGINT"
    lists, rings = "ARRAY<BIGINT>", "ARRAY<ARRAY<BIGINT>>"
    indexed = indexing.index_points(Inline("lat", "lng", "res"), "lat", "lng", "res", "found")
    center = indexing.cell_centroids(Inline("cell"), "cell", "c_lat", "c_lng")
    outline = indexing.cell_outlines(Inline("cell"), "cell", "shape")
    side = indexing.edge_outlines(Inline("edge"), "edge", "shape")
    ends = topology.edge_ends(Inline("edge"), "edge", "e_from", "e_to")
    pair = topology.pair_edges(Inline("a", "b"), "a", "b", "p_edge", "p_adjacent")
    point = topology.vertex_points(Inline("vertex"), "vertex", "v_lat", "v_lng")
    local = traversal.local_coordinates(Inline("origin", "cell"), "origin", "cell", "l_i", "l_j")
    valid_vertex = topology.audit_vertices(Inline("cell"), "cell", "ok").value("ok")
    metres = f"{pick(dimensions.EDGE_LENGTH_AVG_KM, 'res')} * {_units({'km': 1.0, 'm': 1000.0})}"
    ck = "cell BIGINT, k INT"
    return {
        "latlng_to_cell": ("lat DOUBLE, lng DOUBLE, res INT", "BIGINT", indexed.value("found")),
        "latlng_to_cell_string": ("lat DOUBLE, lng DOUBLE, res INT", "STRING", _then(indexed, bits.to_hex("found"))),
        "cell_to_lat": (c, "DOUBLE", center.value("c_lat")),
        "cell_to_lng": (c, "DOUBLE", center.value("c_lng")),
        "cell_to_latlng": (c, "ARRAY<DOUBLE>", _then(center, "CASE WHEN c_lat IS NOT NULL THEN array(c_lat, c_lng) END")),
        "cell_to_boundary_wkt": (c, "STRING", _then(outline, outline_text("shape"))),
        "cell_to_boundary_wkb": (c, "BINARY", _then(outline, outline_binary("shape"))),
        "get_icosahedron_faces": (c, "ARRAY<INT>", indexing.icosahedron_faces(Inline("cell"), "cell", "found").value("found")),
        "is_valid_vertex": (c, "BOOLEAN", valid_vertex),
        "is_valid_index": (c, "BOOLEAN", f"{bits.is_valid_cell('cell')} OR {bits.is_valid_edge('cell')} OR {valid_vertex}"),
        "grid_disk": (ck, lists, _members(_disk())),
        "grid_disk_distances": (ck, rings, _by_ring(_disk())),
        "grid_disk_distances_safe": (ck, rings, _by_ring(_disk())),
        "grid_disk_unsafe": (ck, lists, _members(_disk("null"))),
        "grid_disk_distances_unsafe": (ck, rings, _by_ring(_disk("null"))),
        "grid_ring": (ck, lists, _members(_disk(only_ring=True))),
        "grid_ring_unsafe": (ck, lists, _members(_disk("null", True))),
        "grid_distance": ("a BIGINT, b BIGINT", "BIGINT", traversal.pair_distances(Inline("a", "b"), "a", "b", "found").value("found")),
        "grid_path_cells": ("a BIGINT, b BIGINT", lists, _path()),
        "cell_to_local_ij": ("origin BIGINT, cell BIGINT", "ARRAY<INT>", _then(local, "CASE WHEN l_i IS NOT NULL THEN array(l_i, l_j) END")),
        "local_ij_to_cell": ("origin BIGINT, i INT, j INT", "BIGINT",
                             traversal.local_cells(Inline("origin", "i", "j"), "origin", "i", "j", "found").value("found")),
        "origin_to_directed_edges": (c, lists, topology.adjacency_edges(Inline("cell")).values("edge")),
        "directed_edge_to_cells": (ce, lists, _then(ends, "CASE WHEN e_from IS NOT NULL THEN array(e_from, e_to) END")),
        "get_directed_edge_destination": (ce, "BIGINT", ends.value("e_to")),
        "cells_to_directed_edge": ("a BIGINT, b BIGINT", "BIGINT", pair.value("p_edge")),
        "are_neighbor_cells": ("a BIGINT, b BIGINT", "BOOLEAN", pair.value("p_adjacent")),
        "reverse_directed_edge": (ce, "BIGINT", topology.reverse_edges(Inline("edge"), "edge", "found").value("found")),
        "directed_edge_to_boundary_wkt": (ce, "STRING", _then(side, outline_text("shape", "LINESTRING"))),
        "directed_edge_to_boundary_wkb": (ce, "BINARY", _then(side, outline_binary("shape", "LINESTRING"))),
        "cell_to_vertex": ("cell BIGINT, n INT", "BIGINT", topology.nth_vertices(Inline("cell", "n"), "cell", "n", "found").value("found")),
        "cell_to_vertexes": (c, lists, topology.cell_vertices(Inline("cell")).values("vertex")),
        "vertex_to_lat": (v, "DOUBLE", point.value("v_lat")),
        "vertex_to_lng": (v, "DOUBLE", point.value("v_lng")),
        "vertex_to_latlng": (v, "ARRAY<DOUBLE>", _then(point, "CASE WHEN v_lat IS NOT NULL THEN array(v_lat, v_lng) END")),
        "cell_area": ("cell BIGINT, unit STRING", "DOUBLE", indexing.cell_areas(Inline("cell", "unit"), "cell", "=unit", "found").value("found")),
        "edge_length": ("edge BIGINT, unit STRING", "DOUBLE",
                        indexing.edge_lengths(Inline("edge", "unit"), "edge", "=unit", "found").value("found")),
        "get_hexagon_area_avg": ("res INT, unit STRING", "DOUBLE", _area_avg()),
        "get_hexagon_edge_length_avg": ("res INT, unit STRING", "DOUBLE", f"CASE WHEN res BETWEEN 0 AND {MAX_RES} THEN {metres} END"),
    }


@cache
def definitions():
    """name -> (parameters, return type, body)"""
    lengths = {"rads": 1.0, "km": EARTH_RADIUS_KM, "m": EARTH_RADIUS_KM * 1000}
    hav = ("pow(sin((radians(lat1) - radians(lat0)) / 2), 2) + cos(radians(lat0)) * cos(radians(lat1)) "
           "* pow(sin((radians(lng1) - radians(lng0)) / 2), 2)")
    c, cr = "cell BIGINT", "cell BIGINT, res INT"
    valid_edge, valid = bits.is_valid_edge("cell"), CELL_OK
    return {
        "get_resolution": (c, "INT", bits.resolution_of("cell")),
        "get_base_cell_number": (c, "INT", bits.base_cell_of("cell")),
        "get_index_digit": ("cell BIGINT, r INT", "INT", bits.digit("cell", "r")),
        "string_to_index": ("s STRING", "BIGINT", bits.parse_hex("s")),
        "index_to_string": (c, "STRING", bits.to_hex("cell")),
        "is_valid_cell": (c, "BOOLEAN", valid),
        "is_valid_directed_edge": (c, "BOOLEAN", valid_edge),
        "is_res_class_iii": (c, "BOOLEAN", bits.is_class_iii("cell")),
        "is_pentagon": (c, "BOOLEAN", bits.is_pentagon("cell")),
        "construct_cell": ("base INT, digits ARRAY<INT>", "BIGINT", _bound(*bits.assemble("base", "digits", "size(digits)"))),
        "cell_to_parent": (cr, "BIGINT", f"CASE WHEN {CELL_OK} THEN {bits.parent('cell', 'res')} END"),
        "cell_to_children_size": (cr, "BIGINT", f"CASE WHEN {CELL_OK} THEN {bits.children_count('cell', 'res')} END"),
        "cell_to_center_child": (cr, "BIGINT", f"CASE WHEN {CELL_OK} THEN {bits.center_child('cell', 'res')} END"),
        "cell_to_child_pos": (cr, "BIGINT", f"CASE WHEN {CELL_OK} THEN {_bound(*bits.child_position('cell', 'res'))} END"),
        "child_pos_to_cell": ("pos BIGINT, cell BIGINT, res INT", "BIGINT",
                              f"CASE WHEN {CELL_OK} THEN {_bound(*bits.child_at('cell', 'pos', 'res'))} END"),
        "construct_cell_string": ("base INT, digits ARRAY<INT>", "STRING",
                                  bits.to_hex(_bound(*bits.assemble("base", "digits", "size(digits)")))),
        "max_grid_disk_size": ("k INT", "BIGINT", bits.disk_size("k")),
        "get_directed_edge_origin": (c, "BIGINT", f"CASE WHEN {valid_edge} THEN {bits.as_cell('cell')} END"),
        "get_num_cells": ("res INT", "BIGINT", bits.cells_at("res")),
        "get_res0_cells": ("", "ARRAY<BIGINT>", f"transform(sequence(0, 121), b -> {bits.res0_cell('b')})"),
        "get_pentagons": ("res INT", "ARRAY<BIGINT>", f"CASE WHEN res BETWEEN 0 AND {MAX_RES} THEN "
                          f"transform(sequence(0, 11), p -> {bits.pentagon_cell('p', 'res')}) END"),
        "cell_to_children": (cr, "ARRAY<BIGINT>",
                             f"CASE WHEN {CELL_OK} AND res BETWEEN {bits.resolution('cell')} AND {MAX_RES} THEN "
                             f"transform(sequence(0L, {bits.children_count('cell', 'res')} - 1L), "
                             f"p -> {_bound(*bits.child_at('cell', 'p', 'res'))}) END"),
        "great_circle_distance": ("lat0 DOUBLE, lng0 DOUBLE, lat1 DOUBLE, lng1 DOUBLE, unit STRING", "DOUBLE",
                                  f"2 * atan2(sqrt({hav}), sqrt(1 - ({hav}))) * {_units(lengths)}"),
        "get_res0_cells_string": ("", "ARRAY<STRING>", f"transform(sequence(0, 121), b -> {bits.to_hex(bits.res0_cell('b'))})"),
        "get_pentagons_string": ("res INT", "ARRAY<STRING>", f"CASE WHEN res BETWEEN 0 AND {MAX_RES} THEN "
                                 f"transform(sequence(0, 11), p -> {bits.to_hex(bits.pentagon_cell('p', 'res'))}) END"),
        **geometric(),
    }


@cache
def tables():
    """name -> (parameters, columns, generator or statement): table functions, for LATERAL"""
    scalar, ck = definitions(), "cell BIGINT, k INT"
    edges = topology.adjacency_edges(Inline("cell")).values("named_struct('e', edge, 'd', destination)")
    vertices = topology.cell_vertices(Inline("cell")).values("named_struct('n', n, 'v', vertex)")
    return {
        "grid_disk_rows": (ck, "ring INT, member BIGINT", f"inline({_disk()})"),
        "grid_disk_unsafe_rows": (ck, "ring INT, member BIGINT", _disk_rows()),
        "grid_ring_rows": (ck, "ring INT, member BIGINT", f"inline({_disk(only_ring=True)})"),
        "grid_ring_unsafe_rows": (ck, "ring INT, member BIGINT", _disk_rows(only_ring=True)),
        "grid_path_rows": ("a BIGINT, b BIGINT", "step INT, member BIGINT", f"posexplode({scalar['grid_path_cells'][2]})"),
        "directed_edge_rows": ("cell BIGINT", "edge BIGINT, destination BIGINT", f"inline({edges})"),
        "vertex_rows": ("cell BIGINT", "n INT, vertex BIGINT", f"inline({vertices})"),
        "children_rows": ("cell BIGINT, res INT", "child BIGINT", f"explode({scalar['cell_to_children'][2]})"),
        "pentagon_rows": ("res INT", "cell BIGINT", f"explode({scalar['get_pentagons'][2]})"),
    }


def column(name: str, *args) -> Column:
    """A call as a Column: arguments are column names or SQL expressions, in the order of the parameters."""
    params, returns, body = definitions()[name]
    fields, call = [p.split(" ") for p in params.split(", ") if p], fresh("call")
    if len(fields) != len(args):
        raise TypeError(f"{name}({params})")
    bound = ", ".join(f"'{p}', CAST({a} AS {kind})" for (p, kind), a in zip(fields, args))
    if not fields:
        return F.expr(f"CAST({body} AS {returns})")
    # the body's parameters are lambda variables, so that columns of the same names don't matter
    inner = f"CAST({body} AS {returns})"
    for p, _ in fields:
        inner = f"array_max(transform(array({call}.{p}), {p} -> {inner}))"
    return F.expr(f"array_max(transform(array(named_struct({bound})), {call} -> {inner}))")


def register(spark: SparkSession, prefix="hx_", only=None):
    """Define every function, or those named in ``only``, under ``prefix``; returns their names.

    Raises the session's ``spark.sql.analyzer.maxIterations`` where it is too low for the longest ones.
    """
    names = []
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") != HUGE_METHOD:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
    deep = spark.conf.get("spark.sql.analyzer.maxIterations")
    if int(deep) < ITERATIONS:  # the analyzer resolves a level of nested values at a time
        spark.conf.set("spark.sql.analyzer.maxIterations", str(ITERATIONS))
    for name, (params, returns, body) in definitions().items():
        if only is not None and name not in only:
            continue
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {returns} RETURN {body}")
        names.append(prefix + name)
    for name, (params, columns, generator) in tables().items():
        if only is not None and name not in only:
            continue
        listed = ", ".join(c.split(" ")[0] for c in columns.split(", "))
        rows = generator.text if isinstance(generator, Statement) else f"SELECT {listed} FROM {generator} AS rows({listed})"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS TABLE({columns}) RETURN {rows}")
        names.append(prefix + name)
    return names
