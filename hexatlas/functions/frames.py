"""Grid geometry as steps of SQL expressions.

Three moves cover everything:

* ``cell_frame``      cell -> position of its centre on a face plane
* ``cross``           a plane position that left its face -> the face it is on
* ``cell_at``         position on a face plane -> cell

plus ``face_of_point`` / ``point_of_face`` between a plane and the sphere.
Each builder takes SQL text for its inputs, a prefix ``o`` for the columns it
makes, and returns steps.
"""
import math

from . import bits, tables
from .constants import MAX_RES
from .steps import as_lambda, floor, number, pick, whole

HALF_ROOT3 = math.sqrt(3) / 2
EDGE_SLACK = 1e-9
TURN_RE = [tables.turn(n).real for n in range(6)]
TURN_IM = [tables.turn(n).imag for n in range(6)]
POWER5 = [1, 5, 4, 6, 2, 3]  # 5^n mod 7: a sixth of a turn multiplies digits by 5 mod 7
SCALES = [tables.step_scale(r) for r in range(MAX_RES + 1)]


def of_res(values, res):
    """Constant for a literal resolution, a lookup for a column."""
    return number(values[res]) if isinstance(res, int) else pick(values, res)


def cell_plane(c, o, max_res=MAX_RES):
    """o_base, o_x, o_y: centre on the plane of the base cell's home face (unfolded).

    The position is a sum of one constant vector per digit, so it needs no loop
    and no branch on the resolution; digits are looked up in pairs.
    """
    homes = [b[3] for b in tables.base_cells()]
    src, c = c, f"{o}c"
    base = whole(f"shiftrightunsigned({c}, 45) & 127")
    xs, ys = [pick([h.real for h in homes], base)], [pick([h.imag for h in homes], base)]
    for r in range(1, max_res + 1, 2):
        a = SCALES[r]
        if r == MAX_RES:
            vec = [a * tables.DIGIT_STEP[d] for d in range(8)]
            code = whole(f"{c} & 7")
        else:
            b = SCALES[r + 1]
            vec = [a * tables.DIGIT_STEP[n >> 3] + b * tables.DIGIT_STEP[n & 7] for n in range(64)]
            code = whole(f"shiftrightunsigned({c}, {3 * (MAX_RES - r - 1)}) & 63")
        xs.append(pick([v.real for v in vec], code))
        ys.append(pick([v.imag for v in vec], code))
    return [{c: f"coalesce({src}, 0L)"},
            {f"{o}base": base, f"{o}x": " + ".join(xs), f"{o}y": " + ".join(ys)}]


def _sides(x, y):
    """Distance inside each edge of the face triangle, scaled so a corner is 3 away."""
    return (f"(1D + {x})", f"(1D - 0.5D * {x} + {number(HALF_ROOT3)} * {y})", f"(1D - 0.5D * {x} - {number(HALF_ROOT3)} * {y})")


def _row_columns():
    rows = tables.frame_rows()
    return ([r[0] for r in rows], [r[1] for r in rows], [r[2].real for r in rows], [r[2].imag for r in rows])


def _move(x, y, turn, row):
    """turn and shift (x, y) by a row of the unfolding table"""
    _, _, ox, oy = _row_columns()
    re, im = pick(TURN_RE, turn), pick(TURN_IM, turn)
    return f"{x} * {re} - {y} * {im} + {pick(ox, row)}", f"{x} * {im} + {y} * {re} + {pick(oy, row)}"


def unfold(base, x, y, lead, o):
    """o_face, o_turn, o_x, o_y: from a home-plane position to the face it lies on.

    ``lead`` is the first non-zero digit, which tells the two sides of a
    pentagon's missing wedge apart; it is read for pentagon base cells only.
    """
    faces, turns, _, _ = _row_columns()
    pent = [tables.pentagons().index(b) if b in tables.pentagons() else -1 for b in range(128)]
    home = [b[2] for b in tables.base_cells()]
    corner = {b: tables.base_cells()[b][3] for b in tables.pentagons()}
    assert all(abs(z - 2) < 1e-9 for z in corner.values())
    s = _sides(x, y)
    dx = f"({x} - 2D)"
    return [
        {f"{o}p": pick(pent, base), f"{o}s0": s[0], f"{o}s1": s[1], f"{o}s2": s[2]},
        {f"{o}min": f"least({o}s0, {o}s1, {o}s2)",
         # direction from the pentagon in sixths of a turn, ties going to the side
         # nearer the home face
         f"{o}w": f"CASE WHEN {o}p >= 0 THEN coalesce(CAST(floor((CASE WHEN {y} > -1e-14D "
                  f"THEN atan2(abs({y}), {dx}) + 1e-9D ELSE atan2({y}, {dx}) + {number(2 * math.pi - 1e-9)} END) "
                  f"* {number(3 / math.pi)} + 0.5D) AS INT) % 6, 0) ELSE 0 END"},
        {f"{o}row": f"CASE WHEN {o}p >= 0 THEN 80 + 8 * {o}p + CASE WHEN {lead} = 0 THEN 7 "
                    f"WHEN {o}w = 4 AND {lead} = 5 THEN 6 ELSE {o}w END "
                    f"ELSE 4 * {pick(home, base)} + CASE WHEN {o}min >= {number(-EDGE_SLACK)} THEN 0 "
                    f"WHEN {o}min = {o}s0 THEN 1 WHEN {o}min = {o}s1 THEN 2 ELSE 3 END END"},
        {f"{o}face": pick(faces, f"{o}row"), f"{o}turn": pick(turns, f"{o}row")},
        dict(zip((f"{o}fx", f"{o}fy"), _move(x, y, f"{o}turn", f"{o}row"))),
    ]


def cell_frame(c, o, max_res=MAX_RES):
    """o_face, o_fx, o_fy: the face the cell's centre is on and its position there;
    o_turn: turns from the base cell's home orientation to that face's;
    o_base, o_x, o_y: the same on the home plane; o_lead: leading digit of a cell
    in a pentagon base cell."""
    q = bits.used_digits(f"{o}c")
    lead = f"CASE WHEN {bits.is_pentagon_base(bits.base_cell(f'{o}c'))} THEN {bits.leading_digit(q)} ELSE 0 END"
    first = cell_plane(c, o, max_res)
    first[-1][f"{o}lead"] = lead
    return first + unfold(f"{o}base", f"{o}x", f"{o}y", f"{o}lead", o)


def cross(face, x, y, px, py, o, keep_turn=None):
    """One edge crossing on the straight way from (px, py) to (x, y).

    Makes o_face, o_x, o_y, o_px, o_py (and o_turn, added to ``keep_turn``); nothing
    moves if (x, y) is on the face.  Where two edges are overstepped the way
    decides which one is crossed first.
    """
    v, u = _sides(x, y), _sides(px, py)
    faces, turns, _, _ = _row_columns()
    steps = [{f"{o}v0": v[0], f"{o}v1": v[1], f"{o}v2": v[2]}]

    def score(m):
        ahead = f"greatest({u[m]}, 0D)"
        return (f"CASE WHEN {o}v{m} < {number(-EDGE_SLACK)} "
                f"THEN {ahead} / ({ahead} - {o}v{m}) + {o}v{m} * 1e-9D ELSE 9D END")

    steps.append({f"{o}t{m}": f"CASE WHEN least({o}v0, {o}v1, {o}v2) < {number(-EDGE_SLACK)} THEN {score(m)} END"
                  for m in range(3)})
    steps.append({f"{o}row": f"4 * {face} + CASE WHEN {o}t0 IS NULL THEN 0 WHEN {o}t0 < 9D AND {o}t0 <= {o}t1 "
                             f"AND {o}t0 <= {o}t2 THEN 1 WHEN {o}t1 < 9D AND {o}t1 <= {o}t2 THEN 2 ELSE 3 END"})
    steps.append({f"{o}face": pick(faces[:80], f"{o}row"), f"{o}n": pick(turns[:80], f"{o}row")})
    mx, my = _move(x, y, f"{o}n", f"{o}row")
    qx, qy = _move(px, py, f"{o}n", f"{o}row")
    last = {f"{o}x": mx, f"{o}y": my, f"{o}px": qx, f"{o}py": qy}
    if keep_turn:
        last[f"{o}turn"] = f"coalesce(({keep_turn} + {o}n) % 6, 0)"
    return steps + [last]


def cross_many(face, x, y, px, py, o, times):
    steps = []
    for n in range(times):
        p = f"{o}{n}_"
        steps += cross(face, x, y, px, py, p)
        face, x, y, px, py = f"{p}face", f"{p}x", f"{p}y", f"{p}px", f"{p}py"
    return steps, (face, x, y)


def cross_lazily(face, x, y, px, py, o, times):
    """As ``cross_many``, for steps that become one expression: crossings are worked out
    for a position off its face only."""
    steps, (f, qx, qy) = cross_many(face, x, y, px, py, o + "l", times)
    s, at = [f"{o}i{m}" for m in range(3)], f"{o}at"
    moved = as_lambda(steps, f"named_struct('f', {f}, 'x', {qx}, 'y', {qy})")
    return [dict(zip(s, _sides(x, y))),
            {at: f"CASE WHEN least({', '.join(s)}) >= {number(-EDGE_SLACK)} "
                 f"THEN named_struct('f', {face}, 'x', {x}, 'y', {y}) ELSE {moved} END"}], (f"{at}.f", f"{at}.x", f"{at}.y")


def point_of_face(face, x, y, o):
    """o_vx, o_vy, o_vz: (unnormalised) vector of a plane position."""
    axes = tables.face_axes()
    steps = {}
    for n, name in enumerate(("vx", "vy", "vz")):
        c, u, v = ([a[k][n] for a in axes] for k in range(3))
        steps[f"{o}{name}"] = f"{pick(c, face)} + {x} * {pick(u, face)} + {y} * {pick(v, face)}"
    return [steps]


def latitude(o):
    return f"degrees(atan2({o}vz, sqrt({o}vx * {o}vx + {o}vy * {o}vy)))"


def longitude(o):
    return f"degrees(atan2({o}vy, {o}vx))"


def vector_of_degrees(lat, lng, o):
    return [
        {f"{o}la": f"coalesce(radians(CAST({lat} AS DOUBLE)), 0D)",
         f"{o}lo": f"coalesce(radians(CAST({lng} AS DOUBLE)), 0D)"},
        {f"{o}{n}": f"coalesce({e}, 0D)" for n, e in (
            ("vx", f"cos({o}la) * cos({o}lo)"), ("vy", f"cos({o}la) * sin({o}lo)"), ("vz", f"sin({o}la)"))},
    ]


def face_of_vector(o):
    """o_face, o_x, o_y from the unit vector (o_vx, o_vy, o_vz)."""
    axes = tables.face_axes()
    names = ("vx", "vy", "vz")
    # faces come in antipodal pairs, so ten products tell all twenty apart
    pairs = [(f, g) for f in range(20) for g in range(f + 1, 20)
             if tables.near(axes[f][0], [-x for x in axes[g][0]])]
    dots = {f"{o}d{f}": " + ".join(f"{number(c)} * {o}{n}" for c, n in zip(axes[f][0], names)) for f, _ in pairs}
    best = f"greatest({', '.join(f'abs({d})' for d in dots)})"
    which = ("CASE " + " ".join(f"WHEN {o}d{f} = {o}best THEN {f} WHEN -{o}d{f} = {o}best THEN {g}"
                                for f, g in pairs[:-1])
             + f" WHEN {o}d{pairs[-1][0]} > 0D THEN {pairs[-1][0]} ELSE {pairs[-1][1]} END")

    def along(k):
        return " + ".join(f"{pick([a[k][n] for a in axes], o + 'face')} * {o}{name}" for n, name in enumerate(names))

    g2 = number(tables.RES0_UNIT ** 2)
    return [dots, {f"{o}best": best}, {f"{o}face": which},
            {f"{o}x": f"({along(1)}) / ({o}best * {g2})", f"{o}y": f"({along(2)}) / ({o}best * {g2})"}]


def lattice(x, y, res, o):
    """o_a, o_b: nearest lattice point at a resolution to a plane position."""
    inv = [1 / z for z in SCALES]
    re, im = of_res([z.real for z in inv], res), of_res([z.imag for z in inv], res)
    return [
        {f"{o}lx": f"{x} * {re} - {y} * {im}", f"{o}ly": f"{x} * {im} + {y} * {re}"},
        {f"{o}cw": f"-{o}ly * {number(1 / HALF_ROOT3)}"},
        {f"{o}cu": f"{o}lx - 0.5D * {o}cw"},
        {f"{o}cv": f"-{o}cw - {o}cu"},
        {f"{o}ru": floor(f"{o}cu + 0.5D"), f"{o}rv": floor(f"{o}cv + 0.5D"), f"{o}rw": floor(f"{o}cw + 0.5D")},
        {f"{o}du": f"abs({o}ru - {o}cu)", f"{o}dv": f"abs({o}rv - {o}cv)", f"{o}dw": f"abs({o}rw - {o}cw)"},
        {f"{o}a": f"CASE WHEN {o}du >= {o}dv AND {o}du >= {o}dw THEN -{o}rv - {o}rw ELSE {o}ru END",
         f"{o}b": f"CASE WHEN {o}dw > {o}dv AND {o}dw > {o}du THEN {o}ru + {o}rv ELSE -{o}rw END"},
    ]


ODD_STEP = {0: (0, 0), 1: (-1, -1), 2: (0, 1), 3: (-1, 0), 4: (1, 0), 5: (0, -1), 6: (1, 1)}
ODD_DIGIT = sorted(ODD_STEP, key=lambda d: (ODD_STEP[d][0] + 2 * ODD_STEP[d][1]) % 7)  # by (a + 2b) mod 7


def _sevenths(x):
    """floor(x / 7) of a whole number, in double arithmetic: integer DIV and pmod
    carry overflow and zero checks that bloat the generated code."""
    return floor(f"({x} + 0.5D) * {number(1 / 7)}")


def digits_of(a, b, res, o):
    """Climb from a lattice point to resolution 0.

    Makes o_h (digits in place, finer ones 0), o_a0, o_b0 (lattice point at
    resolution 0).  Two resolutions are climbed per step: together they divide by
    exactly 7, and the remainders name both digits.
    """
    literal = isinstance(res, int)
    steps = []
    even = f"{res} - {res} % 2"
    if not literal or res % 2:
        steps.append({f"{o}q0": _sevenths(f"({a} + 2D * {b})")})
        steps.append({f"{o}k0": whole(f"{a} + 2D * {b} - 7D * {o}q0")})
        carry = [(f - ODD_STEP[d][0] - 2 * ODD_STEP[d][1]) // 7 for f, d in enumerate(ODD_DIGIT)]
        steps.append({f"{o}u": f"{o}q0 + {pick(carry, o + 'k0')}",
                      f"{o}v": f"{b} - {pick([ODD_STEP[d][1] for d in ODD_DIGIT], o + 'k0')}",
                      f"{o}h0": f"shiftleft(CAST({pick(ODD_DIGIT, o + 'k0')} AS BIGINT), 3 * ({MAX_RES} - {res}))"})
        up = {f"{o}a1": f"3 * {o}u - {o}v", f"{o}b1": f"{o}u", f"{o}h1": f"{o}h0"}
        if not literal:
            up = {f"{o}a1": f"CASE WHEN {res} % 2 = 1 THEN {up[o + 'a1']} ELSE {a} END",
                  f"{o}b1": f"CASE WHEN {res} % 2 = 1 THEN {up[o + 'b1']} ELSE {b} END",
                  f"{o}h1": f"CASE WHEN {res} % 2 = 1 THEN {o}h0 ELSE 0L END"}
        steps.append(up)
    else:
        steps.append({f"{o}a1": f"CAST({a} AS BIGINT)", f"{o}b1": f"CAST({b} AS BIGINT)", f"{o}h1": "0L"})
    packed = [code * 256 + ((n // 7 - x) // 7 + 8) * 16 + (n % 7 - y) // 7 + 8
              for n, (code, x, y) in enumerate(tables.digit_pairs())]
    last = 1
    for t in range(1, 8):
        r = (res - res % 2 if literal else MAX_RES - 1) - 2 * (t - 1)
        if r < 2:
            break
        r = r if literal else f"({even} - {2 * (t - 1)})"
        p, n, k = last, t + 1, f"{o}k{t}"
        qa, qb = f"{o}qa{t}", f"{o}qb{t}"
        steps.append({qa: _sevenths(f"{o}a{p}"), qb: _sevenths(f"{o}b{p}")})
        steps.append({k: pick(packed, whole(f"7D * {o}a{p} + {o}b{p} - 49D * {qa} - 7D * {qb}"))})
        new = {f"{o}a{n}": f"{qa} + (shiftright({k}, 4) & 15) - 8", f"{o}b{n}": f"{qb} + ({k} & 15) - 8",
               f"{o}h{n}": f"{o}h{p} | shiftleft(CAST(shiftright({k}, 8) AS BIGINT), 3 * ({MAX_RES} - {r}))"}
        if not literal:
            new = {c: f"CASE WHEN {r} >= 2 THEN {e} ELSE {o}{c[len(o)]}{p} END" for c, e in new.items()}
        steps.append(new)
        last = n
    steps.append({f"{o}h": f"{o}h{last}", f"{o}a0": f"{o}a{last}", f"{o}b0": f"{o}b{last}"})
    return steps


DIGIT_LOW = sum(1 << (3 * n) for n in range(15))  # lowest bit of each digit


def turned_cell(h, base, turn, fix, res, o):
    """o_cell: digits turned into the base cell's home orientation.

    Turning by a sixth multiplies every digit by 5 modulo 7.  Modulo 7, doubling
    rotates a digit's three bits and negating flips them (with 7 read as 0), so
    all digits turn at once.  ``fix`` is the extra turn for positions round a
    pentagon that lead with the missing digit 1.
    """
    q = f"shiftright({h}, 3 * ({MAX_RES} - {res}))"
    twice = f"((shiftleft({h}, 1) & {6 * DIGIT_LOW}L) | (shiftright({h}, 2) & {DIGIT_LOW}L))"
    fourfold = f"((shiftleft({h}, 2) & {4 * DIGIT_LOW}L) | (shiftright({h}, 1) & {3 * DIGIT_LOW}L))"
    return [
        {f"{o}m": pick(POWER5, turn)},
        {f"{o}mul": f"CASE WHEN {fix} <> 0 AND {bits.leading_digit(q)} * {o}m % 7 = 1 "
                    f"THEN coalesce({o}m * {pick(POWER5, fix)} % 7, 0) ELSE {o}m END"},
        {f"{o}g": f"CASE WHEN {o}mul = 1 OR {o}mul = 6 THEN {h} "
                  f"WHEN {o}mul = 2 OR {o}mul = 5 THEN {twice} ELSE {fourfold} END"},
        {f"{o}n": f"CASE WHEN {o}mul = 3 OR {o}mul >= 5 THEN {o}g ^ {bits.ALL_DIGITS}L ELSE {o}g END"},
        {f"{o}z": f"{o}n & shiftright({o}n, 1) & shiftright({o}n, 2) & {DIGIT_LOW}L"},
        {f"{o}cell": f"{bits.CELL_MODE}L | shiftleft(CAST({res} AS BIGINT), 52) | shiftleft(CAST({base} AS BIGINT), 45) "
                     f"| {bits.unused_mask(res)} | ({o}n ^ ({o}z | shiftleft({o}z, 1) | shiftleft({o}z, 2)))"},
    ]


def cell_at(face, x, y, res, o):
    """o_cell: the cell whose centre is nearest on the face plane."""
    packed = [0] * 980
    for (f, a, b), (base, turn, fix) in tables.base_lookup().items():
        packed[f * 49 + (a + 3) * 7 + b + 3] = base * 64 + turn * 8 + fix
    return (lattice(x, y, res, o) + digits_of(f"{o}a", f"{o}b", res, o) + [
        {f"{o}at": pick(packed, whole(f"49D * {face} + 7D * {o}a0 + {o}b0 + 24D"))},
        {f"{o}b_": f"shiftright({o}at, 6)", f"{o}t_": f"shiftright({o}at, 3) & 7", f"{o}f_": f"{o}at & 7"},
    ] + turned_cell(f"{o}h", f"{o}b_", f"{o}t_", f"{o}f_", res, o))


def index_degrees(lat, lng, res, o):
    """o_cell from latitude and longitude in degrees; NULL for a bad resolution."""
    return (vector_of_degrees(lat, lng, o) + face_of_vector(o)
            + cell_at(f"{o}face", f"{o}x", f"{o}y", res, o))


def offset_cell(face, fx, fy, dx, dy, res, o, crossings=2):
    """Steps and cell column for the position (fx, fy) + (dx, dy)."""
    start = [{f"{o}sx": f"{fx} + {dx}", f"{o}sy": f"{fy} + {dy}"}]
    steps, (f, x, y) = cross_many(face, f"{o}sx", f"{o}sy", fx, fy, o + "c", crossings)
    return start + steps + cell_at(f, x, y, res, o), f"{o}cell"


def step_vector(turns, res, length=1.0, half=False):
    """x and y of ``length`` lattice steps at ``turns`` sixths (plus a twelfth if half)."""
    tilt = [z * (tables.cmath.exp(1j * math.pi / 6) if half else 1) * length for z in SCALES]
    re, im = of_res([z.real for z in tilt], res), of_res([z.imag for z in tilt], res)
    c, s = pick(TURN_RE, turns), pick(TURN_IM, turns)
    return f"({re} * {c} - {im} * {s})", f"({re} * {s} + {im} * {c})"
