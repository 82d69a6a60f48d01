"""Directed edges and vertices of a cell table."""
from pyspark.sql import DataFrame

from ..functions import bits, frames, shapes
from ..functions.steps import Inline, as_lambda, fresh, run, spread
from ._common import tuned


def edge_id(cell, digit):
    return f"(({cell} & {bits.MODE_CLEAR}L) | {bits.EDGE_MODE}L | shiftleft(CAST({digit} AS BIGINT), 56))"


def neighbors(df: DataFrame, cell="cell", direction="direction", out="neighbor", res=None) -> DataFrame:
    """Neighbour of each row's cell in each row's direction (1-6).  ``res`` may name the
    one resolution of the table, which shortens the generated code."""
    o = fresh("nb")
    steps, result = _quickly(df, shapes.step_inside(cell, direction), *shapes.neighbor(cell, direction, o, res), o)
    return run(tuned(df), steps, {out: result})


def _quickly(df, quick, steps, result, o):
    """For a call by name, whose steps Spark interprets: the steps are for what ``quick`` leaves NULL."""
    if not isinstance(df, Inline):
        return steps, result
    return [{f"{o}quick": quick}], f"CASE WHEN {o}quick IS NOT NULL THEN {o}quick ELSE {as_lambda(steps, result)} END"


def adjacency_edges(df: DataFrame, cell="cell", res=None) -> DataFrame:
    """One row per directed edge leaving each cell: edge, direction, destination."""
    o = fresh("dir")
    pent = bits.is_pentagon(cell)
    wide = spread(df, f"CASE WHEN {pent} THEN array(2, 3, 4, 5, 6) "
                      f"WHEN {bits.is_valid_cell(cell)} THEN array(1, 2, 3, 4, 5, 6) END", "direction")
    wide = neighbors(wide, cell, "direction", "destination", res)
    return run(wide, [], {"edge": edge_id(cell, "direction")})


def edge_ends(df: DataFrame, edge="edge", origin="origin", destination="destination", res=None) -> DataFrame:
    """Both cells of each directed edge; NULL for an invalid edge."""
    o = fresh("ee")
    steps = [{f"{o}e": f"CASE WHEN {bits.is_valid_edge(edge)} THEN {bits.as_cell(edge)} END",
              f"{o}d": f"coalesce({bits.reserved(edge)}, 0)"}]
    more, result = _quickly(df, shapes.step_inside(f"{o}e", f"{o}d"), *shapes.neighbor(f"{o}e", f"{o}d", o + "n", res), o)
    return run(tuned(df), steps + more, {origin: f"{o}e", destination: result})


def pair_edges(df: DataFrame, a="a", b="b", edge="edge", adjacent="adjacent") -> DataFrame:
    """Directed edge from a to b (NULL if they do not touch) and whether they touch
    (NULL unless both are cells of one resolution).

    No neighbour is generated: the lattice difference of the two cells, in the frame of
    a's base cell, is one of the six unit steps exactly when they touch.
    """
    o = fresh("pe")
    digit = "CASE " + " ".join(f"WHEN {o}da = {x} AND {o}db = {y} THEN {d}"
                               for d, (x, y) in frames.ODD_STEP.items() if d) + " END"
    same = (f"{bits.is_valid_cell(a)} AND {bits.is_valid_cell(b)} "
            f"AND {bits.resolution(a)} = {bits.resolution(b)}")
    # both lie on one lattice, so their difference does: it is rounded once
    steps = shapes.relative_position(a, b, o) + frames.lattice(f"({o}lx - {o}px)", f"({o}ly - {o}py)", f"{o}res", o + "d") + [
        {f"{o}digit": f"CASE WHEN {o}ok THEN {digit} END"},
    ]
    return run(tuned(df), steps, {edge: f"CASE WHEN {o}digit IS NOT NULL THEN {edge_id(a, o + 'digit')} END",
                                  adjacent: f"CASE WHEN {same} THEN {o}digit IS NOT NULL END"})


def reverse_edges(df: DataFrame, edge="edge", out="reverse", res=None) -> DataFrame:
    """The same side crossed the other way; NULL for an invalid edge."""
    o = fresh("rv")
    if isinstance(df, Inline):
        # cells of one plane call opposite directions by digits that make 7
        whole = _reversed(Inline(*df.columns), edge, out, res, o).value(out)
        steps = [{f"{o}e": f"CASE WHEN {bits.is_valid_edge(edge)} THEN {bits.as_cell(edge)} END", f"{o}d": f"coalesce({bits.reserved(edge)}, 0)"}]
        there = edge_id(f"{o}to", f"(7 - {o}d)")
        return run(df, steps + [{f"{o}to": shapes.step_inside(f"{o}e", f"{o}d")}], {out: f"CASE WHEN {o}to IS NOT NULL THEN {there} ELSE {whole} END"})
    return _reversed(df, edge, out, res, o)


def _reversed(df, edge, out, res, o):
    ended = edge_ends(df, edge, f"{o}a", f"{o}b", res)
    return pair_edges(ended, f"{o}b", f"{o}a", out, f"{o}adj").drop(f"{o}a", f"{o}b", f"{o}adj")


def cell_vertices(df: DataFrame, cell="cell", res=None) -> DataFrame:
    """One row per vertex of each cell: n, vertex."""
    wide = spread(df, f"CASE WHEN {bits.is_pentagon(cell)} THEN sequence(0, 4) "
                      f"WHEN {bits.is_valid_cell(cell)} THEN sequence(0, 5) END", "n")
    return nth_vertices(wide, cell, "n", "vertex", res)


def nth_vertices(df: DataFrame, cell="cell", n="n", out="vertex", res=None) -> DataFrame:
    """Vertex number n of each cell; NULL where n is out of range."""
    o = fresh("vx")
    steps = [{f"{o}in": f"coalesce(CASE WHEN {n} BETWEEN 0 AND 5 THEN CAST({n} AS INT) END, 0)"}]
    more, result = shapes.vertex(cell, f"{o}in", o + "v", res)
    return run(tuned(df), steps + more, {out: f"CASE WHEN {n} BETWEEN 0 AND 5 THEN {result} END"})


def vertex_points(df: DataFrame, vertex="vertex", lat="lat", lng="lng", res=None) -> DataFrame:
    """Position of each vertex in degrees; NULL unless it is a valid vertex."""
    o = fresh("vp")
    checked = audit_vertices(df, vertex, f"{o}ok", res)
    steps = [{f"{o}n": f"least(coalesce({bits.reserved(vertex)}, 0), 5)", f"{o}own": f"coalesce({bits.as_cell(vertex)}, 0L)"}]
    steps += shapes.outline(f"{o}own", o + "s", [f"{o}n"], closed=False)
    s = o + "s"
    la, lo = shapes.degrees_of(f"{s}x0", f"{s}y0", f"{s}z0")
    return run(checked, steps, {lat: f"CASE WHEN {o}ok THEN {la} END", lng: f"CASE WHEN {o}ok THEN {lo} END"},
               drop=(f"{o}ok",))


def audit_vertices(df: DataFrame, vertex="vertex", out="is_vertex", res=None) -> DataFrame:
    """Whether each index is a vertex under its canonical owner; NULL only for NULL."""
    o = fresh("va")
    steps = [{f"{o}n": f"least(coalesce({bits.reserved(vertex)}, 0), 5)",
              f"{o}own": f"CASE WHEN {bits.has_vertex_form(vertex)} THEN {bits.as_cell(vertex)} END"}]
    more, result = shapes.vertex(f"{o}own", f"{o}n", o + "v", res)
    return run(tuned(df), steps + more,
               {out: f"CASE WHEN {vertex} IS NOT NULL THEN coalesce({result} = {vertex}, false) END"})
