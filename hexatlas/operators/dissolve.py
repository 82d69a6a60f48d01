"""Cell sets to polygons: cancel inner sides, stitch the rest into rings."""
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits, frames, shapes
from ..functions.steps import fresh, run
from ..sources.polygons import multipolygon_binary, multipolygon_text
from .hierarchy import _keyed, _without
from .indexing import edge_outlines
from .topology import adjacency_edges, nth_vertices
from .traversal import cut_lineage


def boundary_sides(df: DataFrame, cell="cell", by=(), res=None) -> DataFrame:
    """Sides of each set's cells that no other cell of the set shares:
    keys, cell, edge, start and end vertex, points along the side."""
    keys = list(by)
    sides = adjacency_edges(df.select(*keys, F.expr(cell).alias("cell")), "cell", res)
    held = df.selectExpr(*[f"{k} AS _h{n}" for n, k in enumerate(keys)], f"{cell} AS _held")
    same = " AND ".join([f"{k} <=> _h{n}" for n, k in enumerate(keys)] + ["destination = _held"])
    # few sides are left from here on; a fresh plan also keeps the next steps quick to plan
    outer = cut_lineage(sides.join(held, F.expr(same), "left_anti"))
    outer = edge_outlines(outer, "edge", "_pts")
    o = fresh("bs")
    steps = frames.cell_frame("cell", o) + [{f"{o}pent": bits.is_pentagon("cell")}]
    outer = run(outer, steps, {"_n": shapes.side_of_direction(o, "direction"),
                               "_corners": f"CASE WHEN {o}pent THEN 5 ELSE 6 END"})
    outer = outer.selectExpr("*", "(_n + 1) % _corners AS _m")
    outer = cut_lineage(nth_vertices(outer, "cell", "_n", "start", res))
    outer = nth_vertices(outer, "cell", "_m", "end", res)
    return outer.selectExpr(*keys, "cell", "edge", "start", "end", "slice(_pts, 1, size(_pts) - 1) AS points")


def rings(df: DataFrame, cell="cell", by=(), res=None) -> DataFrame:
    """Outline rings of each set: keys, ring (a vertex that names it), seq, points, cell (the side's).

    Each boundary side has one successor, so a ring is a cycle.  Pointer doubling finds
    every side's smallest vertex on its ring and the distance to it in log2(sides)
    rounds of one equi-join each, however long one ring is.
    """
    keys = list(by)
    sides = cut_lineage(boundary_sides(df, cell, by, res))
    longest = sides.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    jump = sides.selectExpr(*keys, "start AS v", "end AS nxt", "start AS low", "0L AS off")
    reach = 1
    for n in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        other = jump.selectExpr(*[f"{k} AS _k{i}" for i, k in enumerate(keys)], "v AS _v", "nxt AS _nxt",
                                "low AS _low", "off AS _off")
        same = " AND ".join([f"{k} <=> _k{i}" for i, k in enumerate(keys)] + ["nxt = _v"])
        jump = jump.join(other, F.expr(same)).selectExpr(
            *keys, "v", "_nxt AS nxt", "least(low, _low) AS low",
            f"CASE WHEN low <= _low THEN off ELSE _off + {reach}L END AS off")
        jump = cut_lineage(jump)
        reach *= 2
    label = jump.selectExpr(*[f"{k} AS _k{i}" for i, k in enumerate(keys)], "v AS _v", "low AS ring", "-off AS seq")
    same = " AND ".join([f"{k} <=> _k{i}" for i, k in enumerate(keys)] + ["start = _v"])
    return sides.join(label, F.expr(same)).selectExpr(*keys, "ring", "CASE WHEN ring = start THEN NULL ELSE seq END AS seq",
                                                      "points", "cell")


def cell_components(df: DataFrame, by, res=None) -> DataFrame:
    """keys, cell, component (its smallest cell) of the cells that have a neighbour in their set (keys ``by``, column ``cell``).

    Alternating star contraction over pairs of neighbours: every round is two aggregations and two equi-joins, whatever a
    component's diameter, and a round adds no pairs beyond one per pair read.
    """
    keys = list(by)
    named = df.selectExpr(*keys, "cell", f"sha2(to_json(struct({', '.join(keys)})), 256) AS _g")
    held = named.selectExpr("_g", "cell AS destination")
    cur = cut_lineage(adjacency_edges(named.select("_g", "cell"), "cell", res).filter("destination < cell")
                      .join(held, ["_g", "destination"]).selectExpr("_g", "cell AS u", "destination AS v"))
    before = None
    while True:
        both = cur.unionByName(cur.selectExpr("_g", "v AS u", "u AS v"))
        least = both.groupBy("_g", "u").agg(F.expr("least(min(v), u) AS m"))
        large = both.filter("v > u").join(least, ["_g", "u"]).selectExpr("_g", "v AS u", "m AS v").distinct()
        small = large.join(large.groupBy("_g", "u").agg(F.min("v").alias("m")), ["_g", "u"])
        cur = cut_lineage(small.selectExpr("_g", "explode(array(struct(u, m AS v), struct(v AS u, m AS v))) AS e")
                          .selectExpr("_g", "e.u", "e.v").filter("u <> v").distinct())
        state = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("_g", "u", "v"))).first()
        if state == before:
            break
        before = state
    rooted = cur.selectExpr("_g", "u AS cell", "v AS component").unionByName(
        cur.selectExpr("_g", "v AS cell", "v AS component").distinct())
    return named.join(rooted, ["_g", "cell"]).select(*keys, "cell", "component")


def dissolve_cells(df: DataFrame, cell="cell", by=(), res=None, out="polygons") -> DataFrame:
    """One row per set: ``polygons``, an array of polygons (arrays of rings; the first ring
    is the outline, counter-clockwise, the others are holes) of (lng, lat) points.

    Cells that share a vertex share a side too, so an outline and its holes are the rings of
    one connected component: holes meet outlines by an equi-join, never each with each.
    A set with an invalid or repeated cell or with mixed resolutions gives no row.
    """
    rows, keys = _keyed(df, cell, by)
    flagged = rows.selectExpr("*", f"CASE WHEN {bits.is_valid_cell('cell')} THEN {bits.resolution('cell')} ELSE -1 END AS _r")
    counted = flagged.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_r"))
    bad = (counted.groupBy(*keys).agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"), F.max("_n").alias("_dup"))
           .filter("_lo < 0 OR _lo < _hi OR _dup > 1").select(*keys))
    good = _without(counted.select(*keys, "cell"), bad, keys)
    parts = rings(good, "cell", keys, res)
    ring = (parts.groupBy(*keys, "ring")
            .agg(F.expr("flatten(transform(sort_array(collect_list(named_struct('seq', seq, 'points', points))), "
                        "s -> s.points))").alias("pts"), F.min("cell").alias("at")))
    # longitudes relative to the first point, so that a ring over the antimeridian is whole
    near = ("transform(pts, p -> named_struct('x', CASE WHEN p.lng - pts[0].lng > 180D THEN p.lng - 360D "
            "WHEN p.lng - pts[0].lng < -180D THEN p.lng + 360D ELSE p.lng END, 'y', p.lat))")
    ring = ring.selectExpr("*", f"{near} AS flat")
    area = ("aggregate(sequence(0, size(flat) - 1), 0D, (a, i) -> a + flat[i].x * flat[(i + 1) % size(flat)].y "
            "- flat[(i + 1) % size(flat)].x * flat[i].y)")
    ring = cut_lineage(ring.selectExpr(*keys, "ring", "pts", "at", f"{area} AS area"))
    mine = [f"{k} AS _k{i}" for i, k in enumerate(keys)]
    same = " AND ".join(f"{k} <=> _k{i}" for i, k in enumerate(keys))
    # only where a set has holes and more than one outline must its components be told apart
    several = cut_lineage(ring.groupBy(*keys).agg(F.expr("count_if(area > 0) AS _s"), F.expr("count_if(area <= 0) AS _h"))
                          .filter("_s > 1 AND _h > 0").selectExpr(*mine))
    if several.isEmpty():
        ring = ring.withColumn("component", F.lit(0).cast("long"))
    else:
        label = (cell_components(good.join(several, F.expr(same), "left_semi"), keys, res)
                 .selectExpr(*mine, "cell AS _at", "component AS _c"))
        told = ring.join(several.withColumn("_told", F.lit(True)), F.expr(same), "left").select(ring["*"], "_told")
        ring = told.join(label, F.expr(f"{same} AND at = _at"), "left").selectExpr(
            *keys, "ring", "pts", "area", "CASE WHEN _told THEN coalesce(_c, at) ELSE 0L END AS component")
    shells = ring.filter("area > 0")
    holes = ring.filter("area <= 0")
    shell = shells.selectExpr(*mine, "ring AS shell", "area AS _a", "component AS _c")
    owned = (holes.join(shell, F.expr(f"{same} AND component = _c"))
             .groupBy(*keys, "ring").agg(F.expr("min_by(shell, _a)").alias("shell"), F.expr("first(pts)").alias("pts")))
    members = shells.selectExpr(*keys, "ring AS shell", "0 AS _o", "ring", "pts").unionByName(
        owned.selectExpr(*keys, "shell", "1 AS _o", "ring", "pts"))
    polygons = members.groupBy(*keys, "shell").agg(F.expr(
        "transform(sort_array(collect_list(named_struct('o', _o, 'ring', ring, 'pts', pts))), s -> s.pts)").alias("_rings"))
    done = polygons.groupBy(*keys).agg(F.expr(
        "transform(sort_array(collect_list(named_struct('shell', shell, 'rings', _rings))), s -> s.rings)").alias(out))
    return done.select(*by, out)


def dissolve_arrays(df: DataFrame, column, out="polygons", res=None) -> DataFrame:
    """df with the polygons of an array column's cells: no polygons for an empty array, NULL for one that is no
    set of distinct valid cells of one resolution.  Equal arrays are worked on once."""
    tagged = df.withColumn("_row", F.expr(f"sha2(CAST({column} AS STRING), 256)"))
    sets = tagged.selectExpr("_row", f"{column} AS _set_of").dropDuplicates(["_row"]).selectExpr("_row", "explode(_set_of) AS cell")
    done = dissolve_cells(sets, by=["_row"], res=res, out="_shapes")
    none = done.schema["_shapes"].dataType.simpleString()
    return (tagged.join(done, "_row", "left")
            .withColumn(out, F.expr(f"CASE WHEN size({column}) = 0 THEN CAST(array() AS {none}) ELSE _shapes END"))
            .drop("_row", "_shapes"))


def polygons_as(df: DataFrame, polygons="polygons", text=None, binary=None) -> DataFrame:
    """Add the WKT and/or WKB of dissolved polygons."""
    outputs = {}
    if text:
        outputs[text] = multipolygon_text(polygons)
    if binary:
        outputs[binary] = multipolygon_binary(polygons)
    return run(df, [], outputs)
