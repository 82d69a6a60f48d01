"""Neighbourhoods, distances, paths and local coordinates."""
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits, frames, shapes, tables
from ..functions.constants import MAX_RES
from ..functions.steps import Inline, as_lambda, fence, fresh, keep_if, number, pick, project, run, spread, whole
from ._common import tuned

# A disk reaching less than this far (in units of the resolution-0 step) can hold one
# pentagon at most: two are 2*sqrt(3) apart.
ONE_PENTAGON_REACH = 1.7
CORNER_X = [c.real for c in tables.CORNERS]
CORNER_Y = [c.imag for c in tables.CORNERS]


def _widest(res):
    """Largest k that stays below ONE_PENTAGON_REACH at a resolution."""
    return int(ONE_PENTAGON_REACH * 7 ** (res / 2))


def _framed(cell, o):
    """Frame of a cell with o_res, o_pent, and o_near/o_cx/o_cy: the nearest pentagon
    centre on its face, in lattice steps and as a position."""
    steps = frames.cell_frame(cell, o)
    steps.append({f"{o}res": bits.resolution(f"{o}c"), f"{o}pent": bits.is_pentagon(f"{o}c")})
    for m in range(3):
        steps += frames.lattice(f"({number(CORNER_X[m])} - {o}fx)", f"({number(CORNER_Y[m])} - {o}fy)", f"{o}res", f"{o}k{m}")
    steps.append({f"{o}far{m}": shapes.hex_distance(f"{o}k{m}a", f"{o}k{m}b") for m in range(3)})
    steps.append({f"{o}near": f"least({o}far0, {o}far1, {o}far2)"})
    for axis, c in (("cx", CORNER_X), ("cy", CORNER_Y)):
        steps[-1][f"{o}{axis}"] = (f"CASE WHEN {o}far0 <= {o}far1 AND {o}far0 <= {o}far2 THEN {number(c[0])} "
                                   f"WHEN {o}far1 <= {o}far2 THEN {number(c[1])} ELSE {number(c[2])} END")
    return steps


def disk_expand(df: DataFrame, cell="cell", k=1, policy="exact", only_ring=False, min_res=0) -> DataFrame:
    """One row per cell within k steps of each row's cell: ``ring``, ``member``.

    Every member is computed from the origin's position by unfolding the straight way
    to it, so the job is one narrow pass: no rounds, no joins, no shuffle, whatever
    the skew of the origins.  Round a pentagon, members reached on both sides are
    told apart by angle and get the smaller distance.  Only disks that could hold two
    pentagons (more than a tenth of the globe, so coarse resolutions) go through
    rounds of neighbour steps instead.

    ``policy='null'`` drops origins whose disk holds a pentagon, as the unsafe
    functions do (left join back to see them as NULL).  ``k`` is a number or a
    column; NULL or negative gives no rows.  ``min_res`` is the coarsest resolution in
    the table if known: with it, a fixed k that needs no rounds plans none, and a
    coarser cell for which k is too wide raises an error.
    """
    o = fresh("dk")
    literal = isinstance(k, int)
    ok = f"{bits.is_valid_cell(cell)} AND {k} >= 0"
    limit = pick([_widest(r) for r in range(MAX_RES + 1)], bits.resolution(cell))
    if policy == "null":
        # whether a disk holds a pentagon is told by the distance to the nearest one, at any k
        return _disk_by_angle(df.filter(ok), cell, k, o, policy, only_ring)
    if literal and k <= _widest(min_res):
        coarser = f"raise_error(concat('a cell is coarser than min_res = {min_res}: ', {cell}))"
        held = f"CASE WHEN coalesce({ok}, false) THEN CASE WHEN {k} <= {limit} THEN true ELSE {coarser} END ELSE false END"
        return _disk_by_angle(df.filter(held), cell, k, o, policy, only_ring)
    narrow = _disk_by_angle(df.filter(f"{ok} AND {k} <= {limit}"), cell, k, o, policy, only_ring)
    wide_in = df.filter(f"{ok} AND {k} > {limit}")
    return narrow.unionByName(_disk_by_rounds(wide_in, cell, k, only_ring))


def _disk_by_angle(df, cell, k, o, policy, only_ring):
    kept = df.columns
    steps = _framed(cell, o)
    df = project(tuned(df), steps + [{f"{o}hit": f"{o}near <= {k}", f"{o}kk": f"CAST({k} AS INT)"}])
    need = [f"{o}{n}" for n in ("face", "fx", "fy", "res", "pent", "p", "hit", "cx", "cy", "kk")]
    if policy == "null":
        df = keep_if(df, f"NOT {o}hit")
    rings = f"array({o}kk)" if only_ring else f"sequence(0, {o}kk)"
    df = fence(df, kept, {n: n for n in need})
    df = spread(df, rings, f"{o}ring")
    df = spread(df, f"sequence(0, greatest(6 * {o}ring - 1, 0))", f"{o}i")
    unit = [frames.SCALES[r] * tables.turn(n) for r in range(MAX_RES + 1) for n in range(6)]
    re, im = [z.real for z in unit], [z.imag for z in unit]
    inv = [1 / z for z in frames.SCALES]
    ire, iim = pick([z.real for z in inv], f"{o}res"), pick([z.imag for z in inv], f"{o}res")
    s1, s2 = f"6 * {o}res + {o}side", f"6 * {o}res + {o}side2"
    walk = [
        {f"{o}side": whole(f"{o}i DIV greatest({o}ring, 1)")},
        {f"{o}at": f"{o}i - {o}side * {o}ring", f"{o}side2": whole(f"({o}side + 2) % 6")},
        {f"{o}dx": f"{o}ring * {pick(re, s1)} + {o}at * {pick(re, s2)}",
         f"{o}dy": f"{o}ring * {pick(im, s1)} + {o}at * {pick(im, s2)}"},
        {f"{o}qx": f"{o}fx + {o}dx", f"{o}qy": f"{o}fy + {o}dy"},
    ]
    if policy == "null":
        # no pentagon in reach: the straight way is the only one, from the face that the origin is on
        cross = frames.cross_lazily if isinstance(df, Inline) else frames.cross_many
        more, (f, x, y) = cross(f"{o}face", f"{o}qx", f"{o}qy", f"{o}fx", f"{o}fy", o + "c", 3)
        return fence(project(df, walk + more + frames.cell_at(f, x, y, f"{o}res", o + "z")), kept, {"ring": f"{o}ring", "member": f"{o}zcell"})
    walk += [
        # angle of the member round the pentagon, against the origin's, in twelfths
        {f"{o}ex": f"{o}fx - {o}cx", f"{o}ey": f"{o}fy - {o}cy", f"{o}gx": f"{o}qx - {o}cx", f"{o}gy": f"{o}qy - {o}cy"},
        {f"{o}ang": f"CASE WHEN {o}pent THEN atan2({o}dy, {o}dx) WHEN {o}hit THEN "
                    f"atan2({o}ex * {o}gy - {o}ey * {o}gx, {o}ex * {o}gx + {o}ey * {o}gy) ELSE 0D END "
                    f"* {number(6 / math.pi)}"},
        # the same member on the other side, a sixth of a turn further on
        {f"{o}way": f"CASE WHEN {o}ang >= 0D THEN {number(tables.H60)} ELSE {number(-tables.H60)} END"},
        {f"{o}ox": f"{o}cx + 0.5D * {o}gx - {o}way * {o}gy - {o}fx", f"{o}oy": f"{o}cy + {o}way * {o}gx + 0.5D * {o}gy - {o}fy"},
    ]
    walk += frames.lattice(f"{o}ox", f"{o}oy", f"{o}res", f"{o}m")
    walk += [
        {f"{o}alt": shapes.hex_distance(f"{o}ma", f"{o}mb")},
        # pentagon origin: skip the missing wedge (7 to 9 twelfths); else skip what the
        # other side shows within reach
        {f"{o}keep": f"CASE WHEN {o}pent THEN {o}ring = 0 OR NOT ({o}ang < -3D + 1e-9D AND {o}ang > -5D + 1e-9D) "
                     f"WHEN {o}hit AND ({o}ang > 5D + 1e-9D OR {o}ang <= -5D + 1e-9D) THEN {o}alt > {o}kk ELSE true END",
         f"{o}steps": f"CASE WHEN {o}hit AND NOT {o}pent AND abs({o}ang) > 3.9D THEN least({o}ring, CAST({o}alt AS INT)) "
                      f"ELSE {o}ring END"},
    ]
    df = keep_if(project(df, walk), f"{o}keep AND {o}steps = {o}kk" if only_ring else f"{o}keep")
    # way from the origin to the member; a pentagon's members start in their own wedge
    rows = tables.frame_rows()
    faces = [r[0] for r in rows]
    turns = [r[1] for r in rows]
    row = f"{o}row"
    start = [
        {f"{o}w": f"CASE WHEN {o}pent THEN {whole(f'floor(({o}ang + CASE WHEN {o}ang >= 0D THEN 1e-9D ELSE 12D - 1e-9D END + 1D) / 2D) % 6')} "
                  f"ELSE 0 END"},
        {row: f"CASE WHEN {o}pent THEN 80 + 8 * {o}p + CASE WHEN {o}ring = 0 THEN 7 ELSE {o}w END ELSE 4 * {o}face END"},
        {f"{o}sf": pick(faces, row), f"{o}st": pick(turns, row)},
        {**dict(zip((f"{o}ax", f"{o}ay"), frames._move(f"{o}qx", f"{o}qy", f"{o}st", row))),
         **dict(zip((f"{o}bx", f"{o}by"), frames._move(f"{o}fx", f"{o}fy", f"{o}st", row)))},
    ]
    more, (f, x, y) = frames.cross_many(f"{o}sf", f"{o}ax", f"{o}ay", f"{o}bx", f"{o}by", o + "c", 3)
    steps = start + more + frames.cell_at(f, x, y, f"{o}res", o + "z")
    return fence(project(df, steps), kept, {"ring": f"{o}steps", "member": f"{o}zcell"})


def _disk_by_rounds(df, cell, k, only_ring):
    """Rounds of neighbour joins over the distinct origins.

    Used where k exceeds 1.7 * 7^(res/2), so only where the whole grid is small (k = 84
    for resolution 4, k = 588 for resolution 6): the neighbour table of that grid is
    worked out once and each round is one equi-join and one aggregation.
    """
    from .dimensions import grid_cells
    from .topology import adjacency_edges
    origin = df.selectExpr(f"{cell} AS _origin", f"CAST({k} AS INT) AS _k").distinct()
    depth = k if isinstance(k, int) else origin.agg(F.max("_k")).first()[0] or 0
    grids = [r for r in range(MAX_RES + 1) if depth > _widest(r)]
    keyed = df.withColumn("_jc", F.expr(cell)).withColumn("_jk", F.expr(f"CAST({k} AS INT)"))
    steps = None
    for r in grids:
        edges = adjacency_edges(grid_cells(df.sparkSession, r), "cell", res=r).select("cell", "destination")
        steps = edges if steps is None else steps.unionByName(edges)
    if steps is not None:
        steps = cut_lineage(steps)
    reached = origin.selectExpr("_origin", "_k", "_origin AS member", "0 AS ring")
    for n in range(depth if grids else 0):
        frontier = reached.filter(f"ring = {n} AND _k > {n}")
        hop = (frontier.join(steps, F.col("member") == F.col("cell"))
               .selectExpr("_origin", "_k", "destination AS member", f"{n + 1} AS ring"))
        reached = reached.unionByName(hop).groupBy("_origin", "_k", "member").agg(F.min("ring").alias("ring"))
        if n % 3 == 2:  # a round reads the last one twice
            reached = cut_lineage(reached)
    if only_ring:
        reached = reached.filter("ring = _k")
    joined = keyed.join(reached, (F.col("_jc") == F.col("_origin")) & (F.col("_jk") == F.col("_k")))
    return joined.select(*[F.col(c) for c in df.columns], "ring", "member")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if folder is None:
            # tests and single-machine runs only: a cluster names a shared folder
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            import tempfile
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def pair_distances(df: DataFrame, a="a", b="b", out="distance") -> DataFrame:
    """Grid steps between two cells; NULL where they cannot be laid on one plane."""
    o = fresh("ds")
    steps = shapes.local_position(a, b, o)
    d = shapes.hex_distance(f"{o}a - {o}oa", f"{o}b - {o}ob")
    found = f"CASE WHEN {o}ok THEN {d} END"
    if isinstance(df, Inline):
        # interpreted: the whole way is for cells of different base cells or planes
        near, few, inside = shapes.distance_inside(a, b, o + "i")
        return run(df, [], {out: f"CASE WHEN {near} THEN {as_lambda(few, inside)} ELSE {as_lambda(steps, found)} END"})
    return run(tuned(df), steps, {out: found})


def local_coordinates(df: DataFrame, origin="origin", cell="cell", i="i", j="j") -> DataFrame:
    """Coordinates of a cell in the frame of the origin's base cell."""
    o = fresh("lc")
    return run(tuned(df), shapes.local_position(origin, cell, o),
               {i: f"CASE WHEN {o}ok THEN CAST({o}a AS INT) END", j: f"CASE WHEN {o}ok THEN CAST({o}b AS INT) END"})


def local_cells(df: DataFrame, origin="origin", i="i", j="j", out="cell") -> DataFrame:
    """Cell at local coordinates; NULL outside the frame."""
    o = fresh("lj")
    steps = [{f"{o}c": f"coalesce({origin}, 0L)", f"{o}a": f"coalesce(CAST({i} AS BIGINT), 0L)",
              f"{o}b": f"coalesce(CAST({j} AS BIGINT), 0L)"},
             {f"{o}base": bits.base_cell(f"{o}c"), f"{o}res": bits.resolution(f"{o}c"),
              f"{o}lead": bits.leading_digit(bits.used_digits(f"{o}c"))}]
    more, result = shapes.local_cell(f"{o}base", f"{o}lead", f"{o}a", f"{o}b", f"{o}res", o + "z")
    return run(tuned(df), steps + more,
               {out: f"CASE WHEN {bits.is_valid_cell(origin)} AND {i} IS NOT NULL AND {j} IS NOT NULL THEN {result} END"})


def path_expand(df: DataFrame, a="a", b="b") -> DataFrame:
    """Cells on the line from a to b, both included: one row per ``step``, ``member``.

    A pair that cannot be laid on one plane, or whose line meets a missing wedge,
    gives no rows.  Each path is independent, so the job is one narrow pass.
    """
    kept = df.columns
    o = fresh("pa")
    steps = shapes.local_position(a, b, o)
    steps.append({f"{o}da": f"{o}a - {o}oa", f"{o}db": f"{o}b - {o}ob", f"{o}c": f"coalesce({a}, 0L)"})
    steps.append({f"{o}n": shapes.hex_distance(f"{o}da", f"{o}db"), f"{o}base": bits.base_cell(f"{o}c"),
                  f"{o}lead": bits.leading_digit(bits.used_digits(f"{o}c"))})
    need = [f"{o}{n}" for n in ("oa", "ob", "da", "db", "n", "res", "base", "lead")]
    df = keep_if(project(tuned(df), steps), f"{o}ok")
    df = spread(fence(df, kept, {n: n for n in need}), f"sequence(0L, {o}n)", f"{o}s")

    def nearest(x):  # half away from zero
        return f"(CASE WHEN {x} < 0D THEN ceil({x} - 0.5D) ELSE floor({x} + 0.5D) END)"

    walk = [
        {f"{o}t": f"CAST({o}s AS DOUBLE)", f"{o}len": f"greatest(CAST({o}n AS DOUBLE), 1D)"},
        {f"{o}u": f"-{o}oa + (-{o}da / {o}len) * {o}t", f"{o}v": f"{o}ob + ({o}db / {o}len) * {o}t",
         f"{o}w": f"({o}oa - {o}ob) + (({o}da - {o}db) / {o}len) * {o}t"},
        {f"{o}ru": nearest(f"{o}u"), f"{o}rv": nearest(f"{o}v"), f"{o}rw": nearest(f"{o}w")},
        {f"{o}du": f"abs({o}ru - {o}u)", f"{o}dv": f"abs({o}rv - {o}v)", f"{o}dw": f"abs({o}rw - {o}w)"},
        {f"{o}pa": f"CASE WHEN {o}du > {o}dv AND {o}du > {o}dw THEN {o}rv + {o}rw ELSE -{o}ru END",
         f"{o}pb": f"CASE WHEN {o}du > {o}dv AND {o}du > {o}dw THEN {o}rv "
                   f"WHEN {o}dv > {o}dw THEN -{o}ru - {o}rw ELSE {o}rv END"},
        {f"{o}pa": f"coalesce({o}pa, 0L)", f"{o}pb": f"coalesce({o}pb, 0L)"},
    ]
    walk[-1] = {f"{o}ga": f"coalesce({o}pa, 0L)", f"{o}gb": f"coalesce({o}pb, 0L)"}
    more, result = shapes.local_cell(f"{o}base", f"{o}lead", f"{o}ga", f"{o}gb", f"{o}res", o + "z")
    return fence(project(df, walk + more), kept,
                 {"step": f"CAST({o}s AS INT)", "steps": f"CAST({o}n AS INT)", "member": result})
