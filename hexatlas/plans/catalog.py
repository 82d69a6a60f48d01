"""Every job as a query over the driver's tables, with check SQL where SQL can say it."""
from pyspark.sql import functions as F

from ..functions import bits
from ..functions import sql as names
from ..operators import audit, dimensions, dissolve, hierarchy, indexing, lookup, polyfill, topology, traversal
from ..operators._common import DEALT_ROWS, dealt
from ..sources import polygons
from . import duck

SLOW_ROWS = 2048  # rows of one task where a row costs milliseconds

QUERIES, CHECKS = {}, {}


def query(name, check=None):
    def add(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = duck.doubles(check)
        return fn
    return add


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def points(spark, sf, name="customer", key="c_custkey", extra=(), rows=DEALT_ROWS):
    lat, lng = duck.point("k")
    keys = dealt(table(spark, sf, name).selectExpr(f"{key} AS k", *extra), rows)
    return keys.selectExpr("k", f"{lat} AS lat", f"{lng} AS lng", *keys.columns[1:])


def points_sql(name="customer", key="c_custkey", extra=""):
    lat, lng = duck.point(key)
    return f"SELECT {key} AS k, {lat} AS lat, {lng} AS lng{extra} FROM {name}"


def indexed(spark, sf, res, name="customer", key="c_custkey", extra=(), rows=DEALT_ROWS):
    return indexing.index_points(points(spark, sf, name, key, extra, rows), res=res).drop("lat", "lng")


def indexed_sql(res, name="customer", key="c_custkey", extra=(), more=""):
    return duck.index(points_sql(name, key, more), ["k", *extra], "lat", "lng", res)


# A cell straight from a key, without geometry: base k % 122, digit r = floor(k / 7^(r-1)) % 7.
def keyed_cell(k, res, engine="spark"):
    div = "DIV" if engine == "spark" else "//"
    one = "CAST({} AS BIGINT)"
    parts = [str((1 << 59) + (res << 52) + 8 ** (15 - res) - 1), f"{one.format(f'({k}) % 122')} * {1 << 45}"]
    parts += [f"{one.format(f'(({k}) {div} {7 ** (r - 1)}) % 7')} * {8 ** (15 - r)}" for r in range(1, res + 1)]
    return "(" + " + ".join(parts) + ")"


PENT = "(4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)"


def every_cell(k, res, engine="spark"):
    """A valid cell for every key: under pentagons, which have no first digit 1, each 1 counts as 2."""
    div = "DIV" if engine == "spark" else "//"
    more = [f"CASE WHEN (({k}) {div} {7 ** (r - 1)}) % 7 = 1 THEN CAST({8 ** (15 - r)} AS BIGINT) ELSE 0 END" for r in range(1, res + 1)]
    return f"({keyed_cell(k, res, engine)} + CASE WHEN ({k}) % 122 IN {PENT} THEN {' + '.join(more)} ELSE 0 END)"


def every(spark, sf, res, name="orders", key="o_orderkey"):
    return table(spark, sf, name).selectExpr(f"{key} AS k", f"{every_cell(key, res)} AS cell")


def every_sql(res, name="orders", key="o_orderkey"):
    return f"SELECT {key} AS k, {every_cell(key, res, 'duck')} AS cell FROM {name}"


def _pent_sql(c, res):
    """Whether a cell of one resolution is a pentagon."""
    return f"((({c}) >> 45) & 127 IN {PENT} AND (({c}) >> {45 - 3 * res}) & {8 ** res - 1} = 0)"


def _parent_sql(c, old, new):
    """Ancestor by arithmetic on the digits."""
    low = 8 ** (15 - new)
    return f"(({c}) - CAST({old - new} AS BIGINT) * {1 << 52} - ({c}) % {low} + {low - 1})"


def _hex(c):
    return f"lower(hex({c}))"


# ---- points, centres, outlines ---------------------------------------------------------

@query("index_points", indexed_sql(9, "events", "event_id"))
def _(spark, sf):
    return indexed(spark, sf, 9, "events", "event_id")


@query("index_points_hex", f"SELECT k, {_hex('cell')} AS hex FROM ({indexed_sql(5)})")
def _(spark, sf):
    return audit.hex_keys(indexed(spark, sf, 5)).drop("cell")


@query("index_points_row_resolution", " UNION ALL ".join(
    f"SELECT k, {r} AS res, cell FROM ({duck.index(points_sql() + f' WHERE c_custkey % 3 = {r - 6}', ['k'], 'lat', 'lng', r)})"
    for r in (6, 7, 8)))
def _(spark, sf):
    pts = points(spark, sf, extra=("CAST(6 + c_custkey % 3 AS INT) AS res",))
    return indexing.index_points(pts, res="res").select("k", "res", "cell")


FLAGSHIP = (f"SELECT cell, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT {_parent_sql('cell', 7, 3)} AS cell, value "
            f"FROM ({indexed_sql(7, 'events', 'event_id', ('value',), ', value')})) GROUP BY cell")


@query("rollup_events", FLAGSHIP)
def flagship(spark, sf):
    facts = indexed(spark, sf, 7, "events", "event_id", ("value",))
    return hierarchy.rollup_cells(facts, [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")], res=3)


@query("rollup_levels", " UNION ALL ".join(
    f"SELECT {r} AS res, {_parent_sql('cell', 5, r)} AS cell, count(*) AS n, sum(k) AS keys FROM ({indexed_sql(5, 'events', 'event_id')}) GROUP BY 2"
    for r in (4, 2, 0)))
def _(spark, sf):
    facts = indexed(spark, sf, 5, "events", "event_id")
    return hierarchy.rollup_levels(
        facts, [F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys")],
        [F.sum("n").alias("n"), F.sum("keys").alias("keys")], levels=(4, 2, 0))


@query("cell_centroids", f"SELECT k, round(lat, 7) AS lat, round(lng, 7) AS lng FROM ({duck.centers(indexed_sql(9, 'events', 'event_id'), ['k'], 9)})")
def _(spark, sf):
    return indexing.cell_centroids(indexed(spark, sf, 9, "events", "event_id")).selectExpr(
        "k", "round(lat, 7) AS lat", "round(lng, 7) AS lng")


_RING = "string_agg(printf('%.6f %.6f', lng, lat), ', ' ORDER BY n)"
_OUTLINE = duck.outline(indexed_sql(8), ["k"], 8)


@query("cell_boundary_wkt", f"SELECT k, 'POLYGON ((' || {_RING} || ', ' || string_agg(printf('%.6f %.6f', lng, lat), ', ') FILTER (n = 0) || '))' AS wkt FROM ({_OUTLINE}) GROUP BY k")
def _(spark, sf):
    return indexing.cell_outlines(indexed(spark, sf, 8)).selectExpr("k", f"{polygons.outline_text('outline')} AS wkt")


@query("cell_boundary_wkb", f"SELECT k, n, round(lat, 7) AS lat, round(lng, 7) AS lng FROM ({_OUTLINE}) UNION ALL SELECT k, 6, round(lat, 7), round(lng, 7) FROM ({_OUTLINE}) WHERE n = 0")
def _(spark, sf):
    """Binary outlines, read back as rows of points."""
    wkb = indexing.cell_outlines(indexed(spark, sf, 8)).selectExpr("k", f"{polygons.outline_binary('outline')} AS wkb")
    return polygons.read_wkb(wkb).selectExpr("k", "posexplode(rings[0]) AS (n, p)").selectExpr(
        "k", "n", "round(p.y, 7) AS lat", "round(p.x, 7) AS lng")


_HAV = ("2 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) "
        "* pow(sin(radians({b}.lng - {a}.lng) / 2), 2))))")


def _arc(a, b):
    return _HAV.replace("{a}", a).replace("{b}", b)


_AREA = (f"SELECT k, round(sum(4 * atan(sqrt(greatest(0.0, tan((d1 + d2 + d3) / 4) * tan((d2 + d3 - d1) / 4) * tan((d1 + d3 - d2) / 4) "
         f"* tan((d1 + d2 - d3) / 4))))) * pow(6371.007180918475, 2), 1) AS area FROM ("
         f"SELECT o.k, {_arc('o', 'p')} AS d1, {_arc('p', 'm')} AS d2, {_arc('m', 'o')} AS d3 FROM "
         f"({duck.outline(indexed_sql(4), ['k'], 4)}) o JOIN ({duck.outline(indexed_sql(4), ['k'], 4)}) p ON o.k = p.k AND p.n = (o.n + 1) % 6 "
         f"JOIN ({duck.centers(indexed_sql(4), ['k'], 4)}) m ON m.k = o.k) GROUP BY k")


@query("cell_areas", _AREA)
def _(spark, sf):
    return indexing.cell_areas(indexed(spark, sf, 4)).selectExpr("k", "round(area, 1) AS area")


@query("icosahedron_faces")
def _(spark, sf):
    return indexing.icosahedron_faces(indexed(spark, sf, 2)).selectExpr("k", "array_join(faces, ',') AS faces")


@query("great_circle_distances", "SELECT a.k, round(" + _arc("a", "b") + " * 6371.007180918475, 5) AS km FROM "
       f"({points_sql()}) a JOIN ({points_sql('supplier', 's_suppkey')}) b ON a.k % (SELECT count(*) FROM supplier) = b.k")
def _(spark, sf):
    n = table(spark, sf, "supplier").count()
    a = points(spark, sf).selectExpr("k", "lat", "lng", f"k % {n} AS s")
    b = points(spark, sf, "supplier", "s_suppkey").selectExpr("k AS s", "lat AS lat1", "lng AS lng1")
    return indexing.great_circle_distances(a.join(b, "s"), "lat", "lng", "lat1", "lng1").selectExpr(
        "k", "round(distance, 5) AS km")


# ---- inspection ----------------------------------------------------------------------------

_RAW = "SELECT l_orderkey AS k, l_linenumber AS line, {cell} AS cell FROM lineitem"
_D = [f"((cell >> {3 * (15 - r)}) & 7)" for r in range(1, 16)]
# keys reach base cells past 121 and digit 7, so some are not cells
_MESSY = ("CAST({base} AS BIGINT) * 35184372088832 + CAST(l_linenumber AS BIGINT) * 4398046511104 + 585467951558164480 "
          "+ (l_orderkey % 8) * 549755813888 + 549755813887")


@query("audit_index", f"""SELECT k, line, cell, (cell >> 52) & 15 AS resolution, base AS base_cell,
  base < 122 AND d1 < 7 AND d2 < 7 AND NOT (base IN {PENT} AND (d1 = 1 OR (d1 = 0 AND d2 = 1))) AS is_valid_cell,
  base IN {PENT} AND d1 = 0 AND d2 = 0 AS is_pentagon
FROM (SELECT *, (cell >> 45) & 127 AS base, {_D[0]} AS d1, {_D[1]} AS d2 FROM ({_RAW.format(cell=_MESSY.format(base='(l_orderkey % 128)'))}))""")
def _(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS line",
                                                  _MESSY.format(base="(l_orderkey % 128)") + " AS cell")
    return audit.audit_index(raw).select("k", "line", "cell", "resolution", "base_cell", "is_valid_cell", "is_pentagon")


@query("index_digits", f"SELECT k, (cell >> 33) & 7 AS digit, k % 2 = 1 AS odd_key FROM ({every_sql(6)})")
def _(spark, sf):
    return audit.index_digits(every(spark, sf, 6), r="4").selectExpr("k", "digit", "k % 2 = 1 AS odd_key")


@query("normalise_keys", f"SELECT k, CASE WHEN k % 5 = 0 THEN NULL ELSE cell END AS cell FROM ({every_sql(6)})")
def _(spark, sf):
    text = every(spark, sf, 6).selectExpr("k", f"CASE WHEN k % 5 = 0 THEN 'zzz' ELSE {bits.to_hex('cell')} END AS key")
    return audit.normalise_keys(text).select("k", "cell")


@query("assemble_cells", f"SELECT o_orderkey AS k, CASE WHEN o_orderkey % 122 IN {PENT} AND (o_orderkey % 7 = 1 OR (o_orderkey % 7 = 0 "
       f"AND (o_orderkey // 7) % 7 = 1)) THEN NULL ELSE {keyed_cell('o_orderkey', 2, 'duck')} END AS cell FROM orders")
def _(spark, sf):
    parts = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k", "CAST(o_orderkey % 122 AS INT) AS base",
        "array(CAST(o_orderkey % 7 AS INT), CAST((o_orderkey DIV 7) % 7 AS INT)) AS digits")
    return audit.assemble_cells(parts).select("k", "cell")


# ---- hierarchy -----------------------------------------------------------------------------

@query("cell_to_parent", f"SELECT k, {_parent_sql('cell', 6, 4)} AS parent FROM ({every_sql(6)})")
def _(spark, sf):
    return hierarchy.with_parent(every(spark, sf, 6), res=4).select("k", "parent")


@query("descendant_range_filter", f"SELECT count(*) AS n, sum(k) AS keys FROM ({every_sql(6)}) WHERE {_parent_sql('cell', 6, 0)} = {(1 << 59) + (20 << 45) + 8 ** 15 - 1}")
def _(spark, sf):
    cells = every(spark, sf, 6)
    return cells.filter(hierarchy.descendant_filter("cell", (1 << 59) + (20 << 45) + 8 ** 15 - 1, 6)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))


@query("drilldown_cells", f"SELECT k, CAST(cell + {1 << 53} - {8 ** 13 - 8 ** 11} + a * {8 ** 12} + b * {8 ** 11} AS BIGINT) AS child "
       f"FROM ({every_sql(2)}), range(7) ra(a), range(7) rb(b) WHERE NOT ({_pent_sql('cell', 2)} AND (a = 1 OR (a = 0 AND b = 1)))")
def _(spark, sf):
    return hierarchy.drilldown_cells(every(spark, sf, 2), res=4).select("k", "child")


@query("children_counts", f"SELECT o_orderkey AS k, CASE WHEN o_orderkey % 122 IN {PENT} THEN 16807 // 6 * 5 + 1 ELSE 16807 END AS n_children FROM orders")
def _(spark, sf):
    cells = table(spark, sf, "orders").selectExpr("o_orderkey AS k", f"{keyed_cell('o_orderkey', 0)} AS cell")
    return hierarchy.children_counts(cells, res=5).select("k", "n_children")


@query("center_children", f"SELECT k, CAST(cell + {2 << 52} - {8 ** 11 - 8 ** 9} AS BIGINT) AS child FROM ({every_sql(4)})")
def _(spark, sf):
    return hierarchy.center_children(every(spark, sf, 4), res=6).select("k", "child")


def _position_sql(res):
    """Position of a res-6 cell below its ancestor; under a pentagon the first digit above 0 passes over the missing 1."""
    digit = {r: f"((cell >> {45 - 3 * r}) & 7)" for r in range(1, 7)}
    plain = lambda first: " + ".join(["0", *(f"{digit[r]} * {7 ** (6 - r)}" for r in range(first, 7))])
    cases = " ".join(f"WHEN {digit[r]} > 0 THEN {1 + 5 * (7 ** (6 - r) - 1) // 6} + ({digit[r]} - 2) * {7 ** (6 - r)} + {plain(r + 1)}"
                     for r in range(res + 1, 7))
    return f"CAST(CASE WHEN NOT {_pent_sql('cell', res)} THEN {plain(res + 1)} {cases} ELSE 0 END AS BIGINT)"


@query("child_positions", f"SELECT k, {_position_sql(2)} AS position FROM ({every_sql(6)})")
def _(spark, sf):
    return hierarchy.child_positions(every(spark, sf, 6), res=2).select("k", "position")


@query("positions_in_bases", f"SELECT k, {_position_sql(0)} AS position FROM ({every_sql(6)})")
def _(spark, sf):
    return hierarchy.child_positions(every(spark, sf, 6), res=0).select("k", "position")


@query("cells_from_bases", f"SELECT k, cell AS child FROM ({every_sql(6)})")
def _(spark, sf):
    """Positions, pentagons' too, back to cells."""
    rows = hierarchy.child_positions(every(spark, sf, 6), res=0).selectExpr("k", f"{keyed_cell('k', 0)} AS parent", "position")
    return hierarchy.cells_at_positions(rows, res=6, out="child").select("k", "child")


# below a pentagon come six cells of its centre child, then five times seven, then nothing
_AT = (f"SELECT k, cell, CASE WHEN NOT pent OR p = 0 THEN p WHEN p < 6 THEN p + 1 WHEN p < 41 THEN p + 8 END AS p FROM "
       f"(SELECT k, cell, (k // 49) % 49 AS p, {_pent_sql('cell', 2)} AS pent FROM ({every_sql(2)}))")


@query("cells_at_positions", f"SELECT k, CAST(cell + {2 << 52} - {8 ** 13 - 8 ** 11} + (p // 7) * {8 ** 12} + (p % 7) * {8 ** 11} AS BIGINT) AS child FROM ({_AT})")
def _(spark, sf):
    rows = every(spark, sf, 2).selectExpr("k", "cell AS parent", "(k DIV 49) % 49 AS position")
    return hierarchy.cells_at_positions(rows, res=4, out="child").select("k", "child")


# sets per customer: all descendants two steps below a cell, pentagons too; for odd keys all but the last one
_SET = (f"SELECT k, top, a, CAST(top + {1 << 52} - {8 ** 14 - 8 ** 13} + a * {8 ** 13} AS BIGINT) AS mid, "
        f"CAST(top + {2 << 52} - {8 ** 14 - 8 ** 12} + a * {8 ** 13} + b * {8 ** 12} AS BIGINT) AS cell FROM "
        f"(SELECT k, cell AS top FROM ({every_sql(1, 'customer', 'c_custkey')})), range(7) ra(a), range(7) rb(b) "
        f"WHERE (k % 2 = 0 OR a * 7 + b < 48) AND NOT ({_pent_sql('top', 1)} AND (a = 1 OR (a = 0 AND b = 1)))")


def _sets(spark, sf):
    wide = dealt(every(spark, sf, 1, "customer", "c_custkey")).selectExpr("k", "cell AS top")
    return hierarchy.drilldown_cells(wide, "top", 3, "cell").filter("k % 2 = 0 OR (shiftright(cell, 36) & 63) < 54").select("k", "cell")


@query("compact_cells", f"SELECT DISTINCT k, CASE WHEN k % 2 = 0 THEN top WHEN a < 6 THEN mid ELSE cell END AS cell FROM ({_SET})")
def _(spark, sf):
    return hierarchy.compact_table(_sets(spark, sf), by=["k"])


@query("uncompact_cells", f"SELECT k, cell FROM ({_SET})")
def _(spark, sf):
    return hierarchy.uncompact_table(hierarchy.compact_table(_sets(spark, sf), by=["k"]), res=3, by=["k"])


# ---- neighbourhoods ------------------------------------------------------------------------

def _ring_sql(k, res):
    """Rings by repeated stepping, as a check on the closed-form disk."""
    q = f"SELECT k, 0 AS ring, cell, cell AS member FROM ({indexed_sql(res)})"
    rounds = [q]
    for n in range(1, k + 1):
        hop = duck.neighbors(f"SELECT k, cell, member FROM ({rounds[-1]})", ["k", "origin"], res, "member").replace(
            f"FROM (SELECT k, cell, member FROM", "FROM (SELECT k, cell AS origin, member FROM")
        before = " UNION ALL ".join(f"SELECT k, member FROM ({r})" for r in rounds)
        rounds.append(f"SELECT DISTINCT h.k, {n} AS ring, h.origin AS cell, h.destination AS member FROM ({hop}) h "
                      f"LEFT JOIN ({before}) b ON b.k = h.k AND b.member = h.destination WHERE b.k IS NULL")
    return rounds


_RINGS = _ring_sql(2, 6)
_DISK = " UNION ALL ".join(f"SELECT k, ring, member FROM ({r})" for r in _RINGS)


@query("grid_disk", _DISK)
def _(spark, sf):
    return traversal.disk_expand(indexed(spark, sf, 6), k=2, min_res=6).select("k", "ring", "member")


@query("grid_ring", f"SELECT k, member FROM ({_RINGS[2]})")
def _(spark, sf):
    return traversal.disk_expand(indexed(spark, sf, 6), k=2, only_ring=True, min_res=6).select("k", "member")


@query("grid_disk_without_pentagons", f"SELECT k, ring, member FROM ({_DISK}) WHERE k NOT IN (SELECT k FROM ({_DISK}) "
       f"WHERE (member >> 45) & 127 IN {PENT} AND (member >> 27) & 262143 = 0)")
def _(spark, sf):
    return traversal.disk_expand(indexed(spark, sf, 6), k=2, policy="null", min_res=6).select("k", "ring", "member")


@query("grid_disk_arrays", f"SELECT k, ring, string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) AS members FROM ({_DISK}) GROUP BY k, ring")
def _(spark, sf):
    return (traversal.disk_expand(indexed(spark, sf, 6), k=2, min_res=6).groupBy("k", "ring")
            .agg(F.array_join(F.sort_array(F.collect_list("member")), ",").alias("members")))


@query("disk_sizes", "SELECT k, 1 + 3 * (k % 50) * (k % 50 + 1) AS size FROM (SELECT c_custkey AS k FROM customer)")
def _(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_custkey % 50 AS n").selectExpr(
        "k", f"{bits.disk_size('n')} AS size")


@query("grid_distance", f"SELECT k, member, ring AS distance FROM ({_DISK})")
def _(spark, sf):
    pairs = traversal.disk_expand(indexed(spark, sf, 6), k=2, min_res=6)
    return traversal.pair_distances(pairs, "cell", "member").select("k", "member", "distance")


@query("grid_path", f"SELECT k, member, 3 AS n, true AS ends, true AS steps FROM ({_RINGS[2]})")
def _(spark, sf):
    pairs = traversal.disk_expand(indexed(spark, sf, 6), k=2, only_ring=True, min_res=6).selectExpr(
        "k", "cell AS a", "member AS b")
    path = traversal.path_expand(pairs)
    near = traversal.pair_distances(path, "a", "member", "_d")
    return near.groupBy("k", F.col("b").alias("member")).agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.expr("min_by(member, step) = min(a) AND max_by(member, step) = min(b)").alias("ends"),
        F.expr("bool_and(_d = step)").alias("steps"))


def _local_sql(res):
    q = f"SELECT k, cell, 0 AS a0, 0 AS b0 FROM ({every_sql(res)})"
    for r in range(1, res + 1):
        p, t, g = f"a{r - 1}", f"b{r - 1}", f"((cell >> {3 * (15 - r)}) & 7)"
        down = (f"2 * {p} + {t}", f"3 * {t} - {p}") if r % 2 else (f"3 * {p} - {t}", f"{p} + 2 * {t}")
        q = (f"SELECT *, {down[0]} + [0, -1, 0, -1, 1, 0, 1][{g} + 1] AS a{r}, {down[1]} + [0, -1, 1, 0, 0, -1, 1][{g} + 1] AS b{r} FROM ({q})")
    return f"SELECT k, cell, a{res} AS i, b{res} AS j FROM ({q})"


def _with_origin(cells, res):
    return hierarchy.center_children(hierarchy.with_parent(cells, res=0), "parent", res, "origin").drop("parent")


@query("cell_to_local_ij", f"SELECT k, i, j FROM ({_local_sql(5)})")
def _(spark, sf):
    return traversal.local_coordinates(_with_origin(every(spark, sf, 5), 5)).select("k", "i", "j")


@query("local_ij_to_cell", f"SELECT k, cell FROM ({_local_sql(5)})")
def _(spark, sf):
    ij = traversal.local_coordinates(_with_origin(every(spark, sf, 5), 5)).drop("cell")
    return traversal.local_cells(ij).select("k", "cell")


# ---- edges and vertices ---------------------------------------------------------------------

_NEXT = duck.neighbors(f"SELECT k, cell AS origin, cell AS c0 FROM ({indexed_sql(6)})", ["k", "origin"], 6, "c0")


def _edge_sql(c, d):
    return f"({c} + {1 << 59} + CAST({d} AS BIGINT) * {1 << 56})"


@query("directed_edges", f"SELECT k, {_edge_sql('origin', 'd')} AS edge, destination FROM ({_NEXT})")
def _(spark, sf):
    return topology.adjacency_edges(indexed(spark, sf, 6), res=6).select("k", "edge", "destination")


def _edges(spark, sf):
    return topology.adjacency_edges(indexed(spark, sf, 6), res=6).select("k", "edge", "cell", "destination")


@query("edge_ends", f"SELECT k, {_edge_sql('origin', 'd')} AS edge, origin, destination FROM ({_NEXT})")
def _(spark, sf):
    only = indexed(spark, sf, 6).selectExpr("k", "cell", "explode(sequence(1, 6)) AS d").selectExpr(
        "k", f"{topology.edge_id('cell', 'd')} AS edge")
    return topology.edge_ends(only, res=6).select("k", "edge", "origin", "destination")


@query("cells_to_directed_edge", f"SELECT k, {_edge_sql('origin', 'd')} AS edge, true AS adjacent FROM ({_NEXT})")
def _(spark, sf):
    pairs = _edges(spark, sf).selectExpr("k", "cell AS a", "destination AS b")
    return topology.pair_edges(pairs).select("k", "edge", "adjacent")


@query("are_neighbor_cells", f"SELECT k, member, ring = 1 AS adjacent FROM ({_DISK})")
def _(spark, sf):
    pairs = traversal.disk_expand(indexed(spark, sf, 6), k=2, min_res=6)
    return topology.pair_edges(pairs, "cell", "member").select("k", "member", "adjacent")


_BACK = duck.neighbors(f"SELECT k, origin AS home, destination AS c0, d AS d0 FROM ({_NEXT})", ["k", "home", "c0", "d0"], 6, "c0")


@query("reverse_directed_edge", f"SELECT k, {_edge_sql('home', 'd0')} AS edge, {_edge_sql('c0', 'd')} AS reverse FROM ({_BACK}) WHERE destination = home")
def _(spark, sf):
    return topology.reverse_edges(_edges(spark, sf).select("k", "edge"), res=6).select("k", "edge", "reverse")


_SIDE = duck.outline(indexed_sql(6), ["k"], 6)
_EDGE_LEN = (f"SELECT o.k, round({_arc('o', 'p')} * 6371.007180918475, 6) AS length FROM ({_SIDE}) o "
             f"JOIN ({_SIDE}) p ON o.k = p.k AND p.n = (o.n + 1) % 6")


@query("edge_lengths", _EDGE_LEN)
def _(spark, sf):
    return indexing.edge_lengths(_edges(spark, sf)).selectExpr("k", "round(length, 6) AS length")


def _pt(a):
    return f"printf('%.6f %.6f', {a}.lng, {a}.lat)"


@query("edge_boundary_wkt", f"SELECT o.k, 'LINESTRING (' || {_pt('o')} || ', ' || {_pt('p')} || ', ' || {_pt('o')} || ')' AS wkt "
       f"FROM ({_SIDE}) o JOIN ({_SIDE}) p ON o.k = p.k AND p.n = (o.n + 1) % 6")
def _(spark, sf):
    return indexing.edge_outlines(_edges(spark, sf)).selectExpr(
        "k", f"{polygons.outline_text('outline', 'LINESTRING')} AS wkt")


@query("edge_boundary_wkb", f"SELECT o.k, 57 AS n_bytes, count(*) AS n FROM ({_SIDE}) o GROUP BY o.k")
def _(spark, sf):
    return indexing.edge_outlines(_edges(spark, sf)).selectExpr(
        "k", f"length({polygons.outline_binary('outline', 'LINESTRING')}) AS n_bytes").groupBy("k", "n_bytes").agg(
        F.count(F.lit(1)).alias("n"))


@query("vertex_points", f"SELECT k, n, round(lat, 7) AS lat, round(lng, 7) AS lng FROM ({_SIDE})")
def _(spark, sf):
    return topology.vertex_points(topology.cell_vertices(indexed(spark, sf, 6), res=6), res=6).selectExpr(
        "k", "n", "round(lat, 7) AS lat", "round(lng, 7) AS lng")


_OWNER = (f"SELECT k, n, least(origin, a, b) AS owner FROM (SELECT x.k, x.origin, x.destination AS a, y.destination AS b, x.d, y.d AS e, "
          f"(CASE x.d WHEN 4 THEN 0 WHEN 6 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 1 THEN 4 ELSE 5 END + t.turn) % 6 AS n FROM ({_NEXT}) x "
          f"JOIN ({_NEXT}) y ON x.k = y.k AND CASE x.d WHEN 4 THEN 6 WHEN 6 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 1 THEN 5 ELSE 4 END = y.d "
          f"JOIN ({duck.frame(indexed_sql(6), ['k'], 6)}) t ON t.k = x.k)")


@query("cell_vertices", _OWNER)
def _(spark, sf):
    """Owner of each vertex, and so the vertex index up to its number there."""
    return topology.cell_vertices(indexed(spark, sf, 6), res=6).selectExpr("k", "n", f"{bits.as_cell('vertex')} AS owner")


@query("audit_vertices", f"SELECT o.k, o.n, o.owner = c.cell AS is_vertex FROM ({_OWNER}) o JOIN ({indexed_sql(6)}) c ON c.k = o.k")
def _(spark, sf):
    """Each corner numbered under the cell itself names a vertex only where that cell is the corner's owner."""
    v = indexed(spark, sf, 6).selectExpr("k", "explode(sequence(0, 5)) AS n", "cell").selectExpr(
        "k", "n", f"(cell & {bits.MODE_CLEAR}L) | {bits.VERTEX_MODE}L | shiftleft(CAST(n AS BIGINT), 56) AS vertex")
    return topology.audit_vertices(v, res=6).select("k", "n", "is_vertex")


# ---- the grid against the tables -------------------------------------------------------------

@query("pentagon_orders", f"SELECT cell, count(*) AS n FROM (SELECT {keyed_cell('o_orderkey', 0, 'duck')} AS cell, o_orderkey % 122 AS b FROM orders) WHERE b IN {PENT} GROUP BY cell")
def _(spark, sf):
    cells = table(spark, sf, "orders").selectExpr(f"{keyed_cell('o_orderkey', 0)} AS cell")
    return (cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
            .join(F.broadcast(dimensions.pentagon_cells(spark, 0).select("cell")), "cell", "left_semi"))


@query("base_cell_orders", f"SELECT {_hex('cell')} AS hex, n FROM (SELECT {keyed_cell('o_orderkey', 0, 'duck')} AS cell, count(*) AS n FROM orders GROUP BY 1)")
def _(spark, sf):
    facts = hierarchy.rollup_cells(every(spark, sf, 3), [F.count(F.lit(1)).alias("n")], res=0)
    full = F.broadcast(dimensions.base_cells(spark)).join(facts, "cell", "left").na.fill({"n": 0}).filter("n > 0")
    return full.selectExpr(f"{bits.to_hex('cell')} AS hex", "n")


@query("grid_coverage", "SELECT res, count(DISTINCT cell) AS used, CAST(2 + 120 * pow(7, res) AS BIGINT) AS num_cells FROM (" + " UNION ALL ".join(
    f"SELECT {r} AS res, {every_cell('o_orderkey', r, 'duck')} AS cell FROM orders" for r in (1, 2, 3)) + ") GROUP BY res")
def _(spark, sf):
    cells = every(spark, sf, 3)
    levels = hierarchy.rollup_levels(cells, [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("n")], levels=(3, 2, 1))
    return (levels.groupBy("res").agg(F.count(F.lit(1)).alias("used"))
            .selectExpr("res", "used", f"{bits.cells_at('res')} AS num_cells"))


@query("resolution_averages")
def _(spark, sf):
    """Average cell size next to each resolution's use."""
    used = table(spark, sf, "customer").groupBy(F.expr("CAST(c_custkey % 16 AS INT)").alias("res")).agg(F.count(F.lit(1)).alias("n"))
    return dimensions.with_averages(used)


# ---- regions -----------------------------------------------------------------------------------

def _rect(k, lat, lng, engine="spark"):
    half = f"(1 + {k} % 3)"
    return {"x0": f"greatest(-179.5, {lng} - {half})", "x1": f"least(179.5, {lng} + {half})",
            "y0": f"greatest(-84.5, {lat} - {half})", "y1": f"least(84.5, {lat} + {half})"}


def rectangles(spark, sf):
    """Rectangles of 1-3 degrees round customers, as polygon text."""
    box = _rect("k", "lat", "lng")
    wkt = ("concat('POLYGON ((', array_join(array(concat(x0, ' ', y0), concat(x1, ' ', y0), concat(x1, ' ', y1), "
           "concat(x0, ' ', y1), concat(x0, ' ', y0)), ', '), '))') AS wkt")
    return points(spark, sf, rows=SLOW_ROWS).selectExpr("k", *[f"CAST({e} AS DOUBLE) AS {n}" for n, e in box.items()]).selectExpr("k", wkt)


_BOXES = f"SELECT k, {', '.join(f'{e} AS {n}' for n, e in _rect('k', 'lat', 'lng').items())} FROM ({points_sql()})"


def _grid_sql(res):
    digits = "".join(f" + CAST((q // {7 ** (r - 1)}) % 7 AS BIGINT) * {8 ** (15 - r)}" for r in range(1, res + 1))
    lead = "CASE " + " ".join(f"WHEN (q // {7 ** (r - 1)}) % 7 > 0 THEN (q // {7 ** (r - 1)}) % 7" for r in range(1, res + 1)) + " ELSE 0 END"
    return (f"SELECT CAST({(1 << 59) + (res << 52) + 8 ** (15 - res) - 1} + b * {1 << 45}{digits} AS BIGINT) AS cell "
            f"FROM range(122) rb(b), range({7 ** res}) rq(q) WHERE NOT (b IN {PENT} AND {lead} = 1)")


_INSIDE = (f"SELECT k, cell FROM ({_BOXES}) JOIN ({duck.centers(_grid_sql(3), ['cell'], 3)}) ON lng BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1")


@query("polyfill_center", _INSIDE)
def _(spark, sf):
    return polyfill.polyfill(rectangles(spark, sf), "wkt", 3).select("k", "cell")


@query("polyfill_center_hex", f"SELECT k, {_hex('cell')} AS hex FROM ({_INSIDE})")
def _(spark, sf):
    return audit.hex_keys(polyfill.polyfill(rectangles(spark, sf), "wkt", 3)).select("k", "hex")


def _boxed_wkb(spark, sf):
    rings = polygons.read_wkt(rectangles(spark, sf), "wkt")
    ring = "transform(slice(rings[0], 1, 4), p -> named_struct('lng', p.x, 'lat', p.y))"
    return rings.selectExpr("k", f"{polygons.outline_binary(ring)} AS wkb")


@query("polyfill_center_wkb", _INSIDE)
def _(spark, sf):
    return polyfill.polyfill(_boxed_wkb(spark, sf), "wkb", 3).select("k", "cell")


@query("points_in_covers", f"SELECT i.k, count(*) AS n, sum(e.k) AS keys FROM ({_INSIDE}) i JOIN (SELECT k, {_parent_sql('cell', 7, 3)} AS cell "
       f"FROM ({indexed_sql(7, 'events', 'event_id')})) e ON e.cell = i.cell GROUP BY i.k")
def _(spark, sf):
    """Events in each customer's rectangle: the rectangles' cells compacted, never unfolded again."""
    covers = hierarchy.compact_table(polyfill.polyfill(rectangles(spark, sf), "wkt", 3).select("k", "cell"), by=["k"])
    # planning reads the covers' resolutions and ranges, the join reads them again
    covers = traversal.cut_lineage(covers.withColumnsRenamed({"k": "area", "cell": "cover"}))
    facts = indexed(spark, sf, 7, "events", "event_id")
    found = lookup.rollup_in_covers(facts, covers, [F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys")],
                                    [F.sum("n").alias("n"), F.sum("keys").alias("keys")], by=["area"], res=7)
    return found.withColumnRenamed("area", "k")


@query("polyfill_center_hex_wkb", f"SELECT k, {_hex('cell')} AS hex FROM ({_INSIDE})")
def _(spark, sf):
    return audit.hex_keys(polyfill.polyfill(_boxed_wkb(spark, sf), "wkb", 3)).select("k", "hex")


@query("polyfill_full")
def _(spark, sf):
    return polyfill.polyfill(rectangles(spark, sf), "wkt", 3, "full").select("k", "cell")


@query("polyfill_overlap")
def _(spark, sf):
    return polyfill.polyfill(rectangles(spark, sf), "wkt", 3, "overlap").select("k", "cell")


@query("polyfill_overlap_bbox")
def _(spark, sf):
    return polyfill.polyfill(rectangles(spark, sf), "wkt", 3, "overlap_bbox").select("k", "cell")


def _disks(spark, sf):
    cells = indexed(spark, sf, 6, "supplier", "s_suppkey")
    return traversal.disk_expand(cells, k=1, min_res=6).selectExpr("k", "member AS cell")


@query("cells_to_multi_polygon", f"SELECT k, 1 AS polygons, 1 AS rings, 18 AS points FROM ({points_sql('supplier', 's_suppkey')})")
def _(spark, sf):
    """Each disk of one step dissolves to one polygon of eighteen sides."""
    shapes = dissolve.dissolve_cells(_disks(spark, sf), by=["k"], res=6)
    return shapes.selectExpr("k", "size(polygons) AS polygons", "size(polygons[0]) AS rings", "size(polygons[0][0]) AS points")


@query("cells_to_multi_polygon_text")
def _(spark, sf):
    shapes = dissolve.polygons_as(dissolve.dissolve_cells(_disks(spark, sf), by=["k"], res=6), text="wkt", binary="wkb")
    return shapes.selectExpr("k", "wkt", "length(wkb) AS n_bytes")


# ---- functions by name -------------------------------------------------------------------

def named(spark, statement, *functions, **tables):
    """A statement that calls functions by name, over tables given by keyword."""
    names.register(spark, "hx_", set(functions))
    return spark.sql(statement, **tables)


_NORTH = f"SELECT k FROM ({duck.centers(indexed_sql(6), ['k'], 6)}) WHERE lat > 0"


@query("sql_index_and_disk", f"SELECT d.k, {_hex('cell')} AS hex, member FROM ({_DISK}) d JOIN ({indexed_sql(6)}) c ON c.k = d.k "
       f"WHERE d.k IN ({_NORTH})")
def _(spark, sf):
    """A call in SELECT, one in WHERE, and a disk under LATERAL."""
    return named(spark, "SELECT k, hx_index_to_string(cell) AS hex, member FROM "
                 "(SELECT k, hx_latlng_to_cell(lat, lng, 6) AS cell FROM {points}), LATERAL hx_grid_disk_rows(cell, 2) "
                 "WHERE hx_cell_to_lat(cell) > 0", "index_to_string", "latlng_to_cell", "grid_disk_rows", "cell_to_lat", points=points(spark, sf, rows=SLOW_ROWS))


@query("sql_edges", f"SELECT k, {_edge_sql('origin', 'd')} AS edge, destination, true AS back, 1 AS steps FROM ({_NEXT})")
def _(spark, sf):
    return named(spark, "SELECT k, edge, hx_get_directed_edge_destination(edge) AS destination, "
                 "hx_directed_edge_to_cells(hx_reverse_directed_edge(edge))[1] = cell AS back, "
                 "CAST(hx_grid_distance(cell, destination) AS INT) AS steps FROM {cells}, LATERAL hx_directed_edge_rows(cell)",
                 "get_directed_edge_destination", "directed_edge_to_cells", "reverse_directed_edge", "grid_distance",
                 "directed_edge_rows", cells=indexed(spark, sf, 6, rows=SLOW_ROWS))




@query("sql_validity", f"SELECT k, k % 3 = 0 AND k % 8 = 0 AS is_cell, k % 3 = 1 AND k % 8 BETWEEN 1 AND 6 AND NOT (k % 8 = 1 AND pent) AS is_edge, "
       f"k % 2 = 1 AS odd FROM (SELECT k, {_pent_sql('cell', 2)} AS pent FROM ({every_sql(2)}) WHERE k % 2 = 0 "
       f"UNION ALL SELECT k, {_pent_sql('cell', 3)} FROM ({every_sql(3)}) WHERE k % 2 = 1)")
def _(spark, sf):
    cells = every(spark, sf, 2).filter("k % 2 = 0").unionByName(every(spark, sf, 3).filter("k % 2 = 1"))
    rows = cells.selectExpr("k", f"cell + get(array(0L, 1L, 3L), CAST(k % 3 AS INT)) * {1 << 59}L + (k % 8) * {1 << 56}L AS idx")
    return named(spark, "SELECT k, hx_is_valid_cell(idx) AS is_cell, hx_is_valid_directed_edge(idx) AS is_edge, "
                 "hx_is_res_class_iii(idx) AS odd FROM {rows}", "is_valid_cell", "is_valid_directed_edge", "is_res_class_iii", rows=rows)


@query("sql_assembled", f"SELECT k, CASE WHEN NOT (k % 122 IN {PENT} AND (k % 7 = 1 OR (k % 7 = 0 AND (k // 7) % 7 = 1))) "
       f"THEN {_hex(keyed_cell('k', 2, 'duck'))} END AS hex FROM (SELECT o_orderkey AS k FROM orders)")
def _(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey AS k")
    return named(spark, "SELECT k, hx_construct_cell_string(CAST(k % 122 AS INT), array(CAST(k % 7 AS INT), CAST((k DIV 7) % 7 AS INT))) AS hex "
                 "FROM {rows}", "construct_cell_string", rows=rows)


@query("sql_pentagons", f"SELECT k, {_hex('cell')} AS hex FROM (SELECT n_nationkey AS k, CAST({1 << 59} + CAST(n_nationkey % 16 AS BIGINT) "
       f"* {1 << 52} + CAST(b AS BIGINT) * {1 << 45} + CAST(pow(8, 15 - n_nationkey % 16) AS BIGINT) - 1 AS BIGINT) AS cell "
       f"FROM nation, (SELECT unnest([{PENT[1:-1]}]) AS b))")
def _(spark, sf):
    return named(spark, "SELECT k, explode(hexes) AS hex FROM (SELECT n_nationkey AS k, "
                 "hx_get_pentagons_string(CAST(n_nationkey % 16 AS INT)) AS hexes FROM {nation})", "get_pentagons_string",
                 nation=table(spark, sf, "nation"))


@query("sql_ring_unsafe", f"SELECT k, member FROM ({_RINGS[2]}) WHERE k NOT IN (SELECT k FROM ({_DISK}) "
       f"WHERE (member >> 45) & 127 IN {PENT} AND (member >> 27) & 262143 = 0)")
def _(spark, sf):
    return named(spark, "SELECT k, member FROM {cells}, LATERAL hx_grid_ring_unsafe_rows(cell, 2)", "grid_ring_unsafe_rows", cells=indexed(spark, sf, 6, rows=SLOW_ROWS))
