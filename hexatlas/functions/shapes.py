"""Cell outlines, neighbours and vertices as steps of SQL expressions."""
import cmath
import math

from . import bits, tables
from .constants import MAX_RES
from .frames import (
    EDGE_SLACK, SCALES, _move, _row_columns, _sides, cell_at, cell_frame, cross_many, lattice, digits_of,
    turned_cell,
)
from .steps import number, pick, whole

# Round a pentagon one of six directions is missing.  Vertex n of a pentagon lies
# (sixths of a turn, plus a twelfth) at PENT_TURN[n], on the sector PENT_SECTOR[n]
# of its unfolding; the face edge passed after it lies at PENT_RAY[n] twelfths.
PENT_TURN = [0, 1, 2, 3, 5, 5]
PENT_SECTOR = [1, 2, 3, 4, 0, 0]
PENT_RAY = [3, 5, 7, 11, 1, 1]
PENT_RAY_SECTOR = [1, 2, 3, 0, 0, 0]
VERTEX_RADIUS = 1 / math.sqrt(3)
# start vertex of the side crossed in a direction (digit 0-6), round a pentagon
PENT_SIDE = [0, 0, 1, 2, 4, 3, 0]
DIGIT_TURN = [0] + [tables.DIGIT_TURNS[d] for d in range(1, 7)]


def _project_rows():
    """Row of the unfolding table -> centre and axes of the face it leads to,
    expressed in the plane coordinates before unfolding."""
    out = []
    for face, n, off in tables.frame_rows():
        c, u, v = tables.face_axes()[face]
        t = tables.turn(n)
        center = [c[k] + off.real * u[k] + off.imag * v[k] for k in range(3)]
        ux = [t.real * u[k] + t.imag * v[k] for k in range(3)]
        uy = [-t.imag * u[k] + t.real * v[k] for k in range(3)]
        out.append((center, ux, uy))
    return out


def project_row(row, x, y, names):
    rows = _project_rows()
    return {name: f"{pick([r[0][k] for r in rows], row)} + {x} * {pick([r[1][k] for r in rows], row)} "
                  f"+ {y} * {pick([r[2][k] for r in rows], row)}" for k, name in enumerate(names)}


def _pent_ray_radius(res):
    tilt = tables.CLASS3_ANGLE if res % 2 else 0.0
    return abs(SCALES[res]) * VERTEX_RADIUS * math.cos(math.pi / 6) / math.cos(math.pi / 6 - tilt)


def outline(c, o, slots, closed=True):
    """Frame of the cell plus the vertices numbered ``slots`` (SQL, 0-5).

    For slot i: o_x{i}/o_y{i}/o_z{i} vector of the vertex and o_ex{i}.. vector of
    the point where the side after it passes onto another face (NULL if it does
    not; odd resolutions only).  o_pent tells a pentagon, which has no vertex 5.
    """
    faces_col, _, _, _ = _row_columns()
    k = len(slots)
    px, py = [], []
    corner = [[SCALES[r] * VERTEX_RADIUS * cmath.exp(1j * math.pi * (1 + 2 * n) / 6) for n in range(6)]
              for r in range(MAX_RES + 1)]
    flat = [z for row in corner for z in row]
    steps = cell_frame(c, o)
    steps.append({f"{o}res": bits.resolution(f"{o}c"), f"{o}pent": bits.is_pentagon(f"{o}c")})
    step = {}
    for i, n in enumerate(slots):
        at = f"6 * {o}res + CASE WHEN {o}pent THEN {pick(PENT_TURN, n)} ELSE {n} END"
        step[f"{o}px{i}"] = f"{o}fx + {pick([z.real for z in flat], at)}"
        step[f"{o}py{i}"] = f"{o}fy + {pick([z.imag for z in flat], at)}"
    steps.append(step)
    steps.append({f"{o}s{m}_{i}": e for i in range(k) for m, e in enumerate(_sides(f"{o}px{i}", f"{o}py{i}"))})
    step = {}
    for i, n in enumerate(slots):
        low = f"least({o}s0_{i}, {o}s1_{i}, {o}s2_{i})"
        step[f"{o}row{i}"] = (f"CASE WHEN {o}pent THEN 80 + 8 * {o}p + {pick(PENT_SECTOR, n)} ELSE 4 * {o}face + "
                              f"CASE WHEN {low} >= {number(-EDGE_SLACK)} THEN 0 WHEN {o}s0_{i} = {low} THEN 1 "
                              f"WHEN {o}s1_{i} = {low} THEN 2 ELSE 3 END END")
        j = (i + 1) % k
        if closed or i + 1 < k:
            def hit(m):
                a, b = f"{o}s{m}_{i}", f"{o}s{m}_{j}"
                return f"WHEN {a} * {b} < 0D AND least(abs({a}), abs({b})) > 1e-12D THEN {a} / ({a} - {b})"
            step[f"{o}t{i}"] = (f"CASE WHEN {o}res % 2 = 0 THEN NULL WHEN {o}pent THEN 0D "
                                f"{hit(0)} {hit(1)} {hit(2)} END")
    steps.append(step)
    step, extra = {}, {}
    rays = [cmath.rect(_pent_ray_radius(r), math.pi * PENT_RAY[n] / 6) for r in range(MAX_RES + 1) for n in range(6)]
    for i, n in enumerate(slots):
        step.update(project_row(f"{o}row{i}", f"{o}px{i}", f"{o}py{i}", [f"{o}{a}{i}" for a in "xyz"]))
        j = (i + 1) % k
        if not closed and i + 1 == k:
            continue
        step[f"{o}er{i}"] = f"CASE WHEN {o}pent THEN 80 + 8 * {o}p + {pick(PENT_RAY_SECTOR, n)} ELSE 4 * {o}face END"
        for axis, f, part in (("x", "fx", [z.real for z in rays]), ("y", "fy", [z.imag for z in rays])):
            step[f"{o}ep{axis}{i}"] = (
                f"CASE WHEN {o}t{i} IS NULL THEN NULL WHEN {o}pent THEN {o}{f} + {pick(part, f'6 * {o}res + {n}')} "
                f"ELSE {o}p{axis}{i} + {o}t{i} * ({o}p{axis}{j} - {o}p{axis}{i}) END")
        extra.update(project_row(f"{o}er{i}", f"{o}epx{i}", f"{o}epy{i}", [f"{o}e{a}{i}" for a in "xyz"]))
    return steps + [step] + ([extra] if extra else [])


def degrees_of(x, y, z):
    return f"degrees(atan2({z}, sqrt({x} * {x} + {y} * {y})))", f"degrees(atan2({y}, {x}))"


def point_struct(x, y, z, present="true"):
    lat, lng = degrees_of(x, y, z)
    return f"CASE WHEN {present} THEN named_struct('lng', {lng}, 'lat', {lat}) END"


def outline_points(o, k, closed=True):
    """Array of the outline's points in order, as (lng, lat) structs."""
    items = []
    for i in range(k):
        here = f"NOT ({o}pent AND {i} = 5)" if closed else "true"
        items.append(point_struct(*[f"{o}{a}{i}" for a in "xyz"], present=here))
        if closed or i + 1 < k:
            items.append(point_struct(*[f"{o}e{a}{i}" for a in "xyz"], present=f"{here} AND {o}t{i} IS NOT NULL"))
    return f"filter(array({', '.join(items)}), p -> p IS NOT NULL)"


def side_of_direction(o, digit):
    """Number of the vertex that starts the side crossed in a direction."""
    return (f"CASE WHEN {o}pent THEN {pick(PENT_SIDE, digit)} "
            f"ELSE {whole(f'({pick(DIGIT_TURN, digit)} + {o}turn + 5) % 6')} END")


def step_from(o, turn, res, p, crossings=2):
    """p_cell: neighbour of the framed cell (prefix o, with o_pent and o_p set) one
    step along ``turn``, counted in the orientation of the face it is on."""
    faces, turns, _, _ = _row_columns()
    flat = [SCALES[r] * tables.turn(n) for r in range(MAX_RES + 1) for n in range(6)]
    at = f"6 * {res} + {turn}"
    row = f"{p}row"
    steps = [
        {f"{p}qx": f"{o}fx + {pick([z.real for z in flat], at)}",
         f"{p}qy": f"{o}fy + {pick([z.imag for z in flat], at)}",
         row: f"CASE WHEN {o}pent THEN 80 + 8 * {o}p + {turn} ELSE 4 * {o}face END"},
        {f"{p}sf": pick(faces, row), f"{p}st": pick(turns, row)},
        {**dict(zip((f"{p}ax", f"{p}ay"), _move(f"{p}qx", f"{p}qy", f"{p}st", row))),
         **dict(zip((f"{p}bx", f"{p}by"), _move(f"{o}fx", f"{o}fy", f"{p}st", row)))},
    ]
    more, (f, x, y) = cross_many(f"{p}sf", f"{p}ax", f"{p}ay", f"{p}bx", f"{p}by", p + "c", crossings)
    return steps + more + cell_at(f, x, y, res, p)


def neighbor(c, digit, o, res=None):
    """o_ncell: the neighbour in direction ``digit`` (1-6); NULL where there is none."""
    steps = cell_frame(c, o)
    steps.append({f"{o}res": bits.resolution(f"{o}c"), f"{o}pent": bits.is_pentagon(f"{o}c")})
    steps.append({f"{o}nt": whole(f"({pick(DIGIT_TURN, digit)} + {o}turn) % 6")})
    steps += step_from(o, f"{o}nt", f"{o}res" if res is None else res, o + "n")
    ok = f"{bits.is_valid_cell(c)} AND {digit} BETWEEN 1 AND 6 AND NOT ({o}pent AND {digit} = 1)"
    return steps, f"CASE WHEN {ok} THEN {o}ncell END"


def _carries():
    """By parity of the level, digit and step (packed 64 p + 8 d + t): the change of the digit
    by exclusive or, times 8, and the step to take one level up."""
    out = [0] * 128
    for p in (0, 1):
        up = SCALES[1 - p] / SCALES[2 - p]
        for d in range(7):
            for t in range(7):
                z = tables.DIGIT_STEP[d] + tables.DIGIT_STEP[t]
                to, carry = next((e, u) for e in range(7) for u in range(7)
                                 if abs(tables.DIGIT_STEP[e] + up * tables.DIGIT_STEP[u] - z) < 1e-9)
                out[64 * p + 8 * d + t] = (d ^ to) * 8 + carry
    return out


def _one_frame(a, b):
    """Whether two cells of one base cell lie on one plane with one orientation: round a pentagon, if
    a digit other than 0 stands above all that they differ in."""
    return f"(NOT {bits.is_pentagon_base(bits.base_cell(a))} OR {a} & {bits.ALL_DIGITS}L >= 8L * ({a} ^ {b}))"


def step_inside(c, digit):
    """The neighbour in direction ``digit``, if it lies in the same base cell and on one plane; else
    NULL.  Digits are added with a carry from the finest up, which ends soon.  For expressions: a
    lambda's work is interpreted, so its few operations count where ``neighbor`` has hundreds."""
    res = bits.resolution(c)
    shift = f"3 * ({MAX_RES} - {res} + i)"
    code = pick(_carries(), f"64 * (({res} - i) % 2) + 8 * CAST(shiftright(s.h, {shift}) & 7 AS INT) + s.t")
    walk = (f"aggregate(sequence(0, {res} - 1), named_struct('h', {c}, 't', CAST({digit} AS INT)), (s, i) -> CASE WHEN s.t = 0 THEN s "
            f"ELSE array_max(transform(array({code}), m -> named_struct('h', s.h ^ shiftleft(CAST(shiftright(m, 3) AS BIGINT), {shift}), "
            f"'t', m & 7))) END, s -> CASE WHEN s.t = 0 AND {_one_frame(c, 's.h')} THEN s.h END)")
    return f"CASE WHEN {bits.is_valid_cell(c)} AND {res} > 0 AND {digit} BETWEEN 1 AND 6 THEN {walk} END"


def distance_inside(a, b, o):
    """Condition, steps and grid distance of two cells of one base cell and plane, from the digits
    they differ in."""
    res = bits.resolution(a)
    ok = (f"{bits.is_valid_cell(a)} AND {bits.is_valid_cell(b)} AND {res} = {bits.resolution(b)} "
          f"AND {bits.base_cell(a)} = {bits.base_cell(b)} AND {_one_frame(a, b)}")
    xs, ys = [], []
    for r in range(1, MAX_RES + 1):
        low = 3 * (MAX_RES - r)
        moved = [SCALES[r] * z for z in tables.DIGIT_STEP]
        for out, turned in ((xs, [z.real for z in moved]), (ys, [z.imag for z in moved])):
            at = [pick(turned, whole(f"shiftright({c}, {low}) & 7")) for c in (a, b)]
            out.append(f"CASE WHEN {o}x & {7 << low}L = 0 THEN 0D ELSE {at[1]} - {at[0]} END")
    steps = [{f"{o}x": f"{a} ^ {b}"}, {f"{o}dx": " + ".join(xs), f"{o}dy": " + ".join(ys), f"{o}r": res}]
    return ok, steps + lattice(f"{o}dx", f"{o}dy", f"{o}r", o), hex_distance(f"{o}a", f"{o}b")


PENT_LEFT = [1, 2, 3, 5, 0, 0]


def vertex(c, n, o, res=None):
    """Steps and result: vertex index n of a cell.

    A vertex is named after the lowest-numbered of the three cells that share it,
    and the number it has there.
    """
    steps = cell_frame(c, o)
    steps.append({f"{o}res": bits.resolution(f"{o}c"), f"{o}pent": bits.is_pentagon(f"{o}c")})
    r = f"{o}res" if res is None else res
    steps.append({f"{o}rt": f"CASE WHEN {o}pent THEN {pick(PENT_TURN, n)} ELSE {n} END",
                  f"{o}lt": f"CASE WHEN {o}pent THEN {pick(PENT_LEFT, n)} ELSE {whole(f'({n} + 1) % 6')} END"})
    steps += step_from(o, f"{o}rt", r, o + "r") + step_from(o, f"{o}lt", r, o + "l")
    flat = [SCALES[q] * VERTEX_RADIUS * cmath.exp(1j * math.pi * (1 + 2 * t) / 6)
            for q in range(MAX_RES + 1) for t in range(6)]
    at = f"6 * {o}res + {o}rt"
    steps += [
        {f"{o}own": f"least({o}c, {o}rcell, {o}lcell)",
         f"{o}vx": f"{o}fx + {pick([z.real for z in flat], at)}",
         f"{o}vy": f"{o}fy + {pick([z.imag for z in flat], at)}"},
        dict(zip((f"{o}v0", f"{o}v1", f"{o}v2"), _sides(f"{o}vx", f"{o}vy"))),
        {f"{o}low": f"least({o}v0, {o}v1, {o}v2)"},
        {f"{o}vrow": f"CASE WHEN {o}pent THEN 80 + 8 * {o}p + {pick(PENT_SECTOR, n)} ELSE 4 * {o}face + CASE "
                     f"WHEN {o}low >= {number(-EDGE_SLACK)} THEN 0 WHEN {o}v0 = {o}low THEN 1 "
                     f"WHEN {o}v1 = {o}low THEN 2 ELSE 3 END END"},
        project_row(f"{o}vrow", f"{o}vx", f"{o}vy", [f"{o}gx", f"{o}gy", f"{o}gz"]),
    ]
    # the vertex as seen from its owner: direction on the owner's face plane
    w = o + "w"
    steps += cell_frame(f"{o}own", w)
    axes = tables.face_axes()
    g = number(tables.RES0_UNIT ** 2)

    def along(part):
        return " + ".join(f"{pick([a[part][q] for a in axes], w + 'face')} * {o}{name}"
                          for q, name in enumerate(("gx", "gy", "gz")))

    inv = [1 / z for z in SCALES]
    steps += [
        {f"{w}h": f"({along(0)}) * {g}"},
        {f"{w}dx": f"({along(1)}) / {w}h - {w}fx", f"{w}dy": f"({along(2)}) / {w}h - {w}fy"},
        {f"{w}ux": f"{w}dx * {pick([z.real for z in inv], o + 'res')} - {w}dy * {pick([z.imag for z in inv], o + 'res')}",
         f"{w}uy": f"{w}dx * {pick([z.imag for z in inv], o + 'res')} + {w}dy * {pick([z.real for z in inv], o + 'res')}"},
        {f"{w}twelfth": f"coalesce(atan2({w}uy, {w}ux), 0D) * {number(6 / math.pi)} + 12D",
         f"{w}pc": bits.is_pentagon(f"{o}own")},
    ]
    hexno = whole(f"rint(({w}twelfth - 1D) / 2D) % 6D")
    # on a pentagon only the home face is framed: find the side of the whole turn
    # through the sphere, as its outline has five corners at known places
    steps.append({f"{o}num": f"CASE WHEN {w}pc THEN -1 ELSE {hexno} END"})
    ps, pno = _pentagon_vertex_number(f"{o}own", f"{o}gx", f"{o}gy", f"{o}gz", f"{o}res", o + "q")
    steps += ps
    ok = (f"{bits.is_valid_cell(c)} AND {n} BETWEEN 0 AND CASE WHEN {o}pent THEN 4 ELSE 5 END")
    result = (f"CASE WHEN {ok} THEN ({o}own & {bits.MODE_CLEAR}L) | {bits.VERTEX_MODE}L "
              f"| shiftleft(CAST(CASE WHEN {w}pc THEN {pno} ELSE {o}num END AS BIGINT), 56) END")
    return steps, result


def _pentagon_vertex_number(cell, gx, gy, gz, res, o):
    """Number of the pentagon corner nearest to a direction.

    Corner n keeps its direction from the pentagon's centre over all resolutions
    of one parity, so a table of 12 pentagons, 2 parities and 5 corners decides.
    """
    rows = _project_rows()
    table = []
    for i, base in enumerate(tables.pentagons()):
        center = tables.base_cells()[base][0]
        for r in (2, 3):
            for n in range(5):
                z = 2 + SCALES[r] * VERTEX_RADIUS * cmath.exp(1j * math.pi * (1 + 2 * PENT_TURN[n]) / 6)
                c, u, v = rows[80 + 8 * i + PENT_SECTOR[n]]
                p = tables.unit([c[k] + z.real * u[k] + z.imag * v[k] for k in range(3)])
                d = tables.unit([p[k] - center[k] * tables.dot(p, center) for k in range(3)])
                table.append(d)
    index = [tables.pentagons().index(b) if b in tables.pentagons() else 0 for b in range(128)]
    at = f"10 * {pick(index, bits.base_cell(cell))} + 5 * ({res} % 2)"
    dots = {f"{o}d{n}": " + ".join(f"{pick([t[k] for t in table], f'{o}at + {n}')} * {g}"
                                   for k, g in enumerate((gx, gy, gz))) for n in range(5)}
    best = "greatest(" + ", ".join(dots) + ")"
    number_ = "CASE " + " ".join(f"WHEN {o}d{n} = {o}best THEN {n}" for n in range(4)) + " ELSE 4 END"
    return [{f"{o}at": whole(at)}, dots, {f"{o}best": best}], number_


# ---- positions relative to a base cell ------------------------------------------------

NEAR = {d: [tables.base_neighbors().get((b, d), (-1, 0))[0] for b in range(122)] for d in range(1, 7)}


def _reverse(b, d):
    other = NEAR[d][b]
    return next((e for e in range(1, 7) if other >= 0 and NEAR[e][other] == b), 0)


BACK = [_reverse(b, d) if d else 0 for b in range(122) for d in range(7)]
PENT_FLAG = [int(b in tables.pentagons()) for b in range(122)]
WEDGE_ORDER = [0, 0, 1, 0, 3, 4, 2]  # order of digits 2-6 round a pentagon


def _apart(d, e):
    """Leading digits whose wedges round a pentagon do not touch."""
    return (f"({d} > 0 AND {e} > 0 AND abs({pick(WEDGE_ORDER, d)} - {pick(WEDGE_ORDER, e)}) IN (2, 3))")


def _bend(d, e):
    """Extra turn that brings wedge e next to wedge d across the missing wedge."""
    return f"CASE WHEN {d} = 3 AND {e} = 5 THEN 5 WHEN {d} = 5 AND {e} = 3 THEN 1 ELSE 0 END"


def _rel(c, o):
    """o_base, o_lead, o_x, o_y with the position taken relative to the base cell."""
    from .frames import cell_plane
    steps = cell_plane(c, o + "h")
    h = o + "h"
    homes = [b[3] for b in tables.base_cells()]
    lead = (f"CASE WHEN {pick(PENT_FLAG, h + 'base')} = 1 THEN {bits.leading_digit(bits.used_digits(h + 'c'))} "
            f"ELSE 0 END")
    return steps + [{f"{o}base": f"{h}base", f"{o}lead": lead,
                     f"{o}x": f"{h}x - {pick([z.real for z in homes], h + 'base')}",
                     f"{o}y": f"{h}y - {pick([z.imag for z in homes], h + 'base')}"}]


def relative_position(origin, cell, o):
    """o_lx, o_ly: position of ``cell`` in the frame of the origin's base cell; o_px, o_py
    that of the origin; o_res; o_ok whether the two can be compared."""
    p, q = o + "p", o + "q"
    steps = _rel(origin, p) + _rel(cell, q)
    to = "CASE " + " ".join(f"WHEN {pick(NEAR[d], p + 'base')} = {q}base THEN {d}" for d in range(1, 7)) + " ELSE 0 END"
    steps += [
        {f"{o}res": bits.resolution(f"{p}hc"), f"{o}dir": f"CASE WHEN {p}base = {q}base THEN 0 ELSE {to} END",
         f"{o}op": f"{pick(PENT_FLAG, p + 'base')} = 1", f"{o}ip": f"{pick(PENT_FLAG, q + 'base')} = 1"},
        {f"{o}rev": pick(BACK, f"7 * {p}base + {o}dir")},
        {f"{o}ok": f"{bits.is_valid_cell(origin)} AND {bits.is_valid_cell(cell)} "
                   f"AND {bits.resolution(origin)} = {bits.resolution(cell)} "
                   f"AND ({p}base = {q}base OR {o}dir > 0) "
                   f"AND NOT ({o}op AND {o}dir > 0 AND {_apart(p + 'lead', o + 'dir')}) "
                   f"AND NOT ({o}op AND {o}dir = 0 AND {_apart(p + 'lead', q + 'lead')}) "
                   f"AND NOT (NOT {o}op AND {o}ip AND {o}dir > 0 AND {_apart(o + 'rev', q + 'lead')})",
         # turn of the cell's own position, then of the whole (base cell offset included)
         f"{o}t1": whole(f"(CASE WHEN {o}dir > 0 THEN {pick(DIGIT_TURN, o + 'dir')} + 3 + 6 "
                         f"- {pick(DIGIT_TURN, o + 'rev')} ELSE 0 END + CASE WHEN NOT {o}op AND {o}ip "
                         f"AND {o}dir > 0 THEN {_bend(o + 'rev', q + 'lead')} ELSE 0 END) % 6"),
         f"{o}t2": f"CASE WHEN {o}op AND {o}dir > 0 THEN {_bend(p + 'lead', o + 'dir')} "
                   f"WHEN {o}op THEN {_bend(p + 'lead', q + 'lead')} ELSE 0 END"},
    ]
    re, im = [tables.turn(n).real for n in range(6)], [tables.turn(n).imag for n in range(6)]
    dx, dy = [z.real for z in tables.DIGIT_STEP], [z.imag for z in tables.DIGIT_STEP]
    steps += [
        {f"{o}c1": pick(re, o + "t1"), f"{o}s1": pick(im, o + "t1"),
         f"{o}c2": pick(re, o + "t2"), f"{o}s2": pick(im, o + "t2")},
        {f"{o}mx": f"{q}x * {o}c1 - {q}y * {o}s1 + {pick(dx, o + 'dir')}",
         f"{o}my": f"{q}x * {o}s1 + {q}y * {o}c1 + {pick(dy, o + 'dir')}"},
        {f"{o}lx": f"{o}mx * {o}c2 - {o}my * {o}s2", f"{o}ly": f"{o}mx * {o}s2 + {o}my * {o}c2"},
    ]
    return steps


def local_position(origin, cell, o):
    """o_a, o_b: lattice coordinates of ``cell`` in the frame of the origin's base cell;
    o_oa, o_ob those of the origin; o_ok whether the two can be compared."""
    steps = relative_position(origin, cell, o)
    steps += lattice(f"{o}lx", f"{o}ly", f"{o}res", o + "i")
    steps += lattice(f"{o}px", f"{o}py", f"{o}res", o + "j")
    return steps + [{f"{o}a": f"{o}ia", f"{o}b": f"{o}ib", f"{o}oa": f"{o}ja", f"{o}ob": f"{o}jb"}]


def hex_distance(a, b):
    return f"greatest(abs({a}), abs({b}), abs(({a}) - ({b})))"


def local_cell(base, lead, a, b, res, o):
    """Steps and result: the cell at lattice coordinates (a, b) in the frame of a base
    cell, as seen from an origin whose leading digit there is ``lead``; NULL past the
    neighbouring base cells or in a missing wedge."""
    steps = digits_of(a, b, res, o)
    dirs = [-1] * 9
    for d, z in enumerate(tables.DIGIT_STEP[:7]):
        q = round(z.imag * 2 / math.sqrt(3))
        dirs[(round(z.real + q / 2) + 1) * 3 + q + 1] = d
    raw = (f"CASE WHEN abs({o}a0) <= 1 AND abs({o}b0) <= 1 "
           f"THEN {pick(dirs, whole(f'3 * {o}a0 + {o}b0 + 4'))} ELSE -1 END")
    steps += [
        {f"{o}raw": raw, f"{o}op": f"{pick(PENT_FLAG, base)} = 1"},
        {f"{o}bent": f"CASE WHEN {o}op AND {lead} = 3 THEN 1 WHEN {o}op AND {lead} = 5 THEN 5 ELSE 0 END"},
        {f"{o}dir": f"CASE WHEN {o}op AND {o}raw = 1 THEN CASE WHEN {o}bent = 1 THEN 5 WHEN {o}bent = 5 THEN 3 "
                    f"ELSE -1 END ELSE {o}raw END"},
        {f"{o}to": "CASE " + " ".join(f"WHEN {o}dir = {d} THEN {pick(NEAR[d], base)}" for d in range(1, 7))
                   + f" WHEN {o}dir = 0 THEN {base} ELSE -1 END",
         f"{o}rev": f"CASE WHEN {o}dir > 0 THEN {pick(BACK, f'7 * {base} + {o}dir')} ELSE 0 END"},
        {f"{o}tt": whole(f"(CASE WHEN {o}dir > 0 THEN {pick(DIGIT_TURN, o + 'rev')} + 9 "
                         f"- {pick(DIGIT_TURN, o + 'dir')} + CASE WHEN {o}raw <> {o}dir THEN {o}bent ELSE 0 END "
                         f"ELSE 0 END) % 6"),
         f"{o}fix": f"CASE WHEN {o}to < 0 OR {pick(PENT_FLAG, o + 'to')} = 0 THEN 0 WHEN {o}dir = 0 THEN {o}bent "
                    f"WHEN {o}rev = 3 THEN 1 WHEN {o}rev = 5 THEN 5 ELSE 0 END"},
    ]
    steps += turned_cell(f"{o}h", f"greatest({o}to, 0)", f"{o}tt", f"{o}fix", res, o)
    return steps, f"CASE WHEN {o}to >= 0 AND {bits.is_valid_cell(o + 'cell')} THEN {o}cell END"
