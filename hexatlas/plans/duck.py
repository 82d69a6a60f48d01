"""Check SQL for another engine: the grid written a second way.

Indexing and centres here use azimuths, arc lengths and level-by-level rounding
(trigonometry on the sphere), where the Spark jobs use vectors, summed digit tables
and two-level division; neighbours are found by stepping and indexing again.  Only
the derived dimension tables are shared.
"""
import math
import re

from ..functions import tables
from ..functions.constants import FACE_AXIS_AZIMUTH, FACE_CENTERS, RES0_UNIT

ODD_TILT = tables.CLASS3_ANGLE
EDGES = tables.face_edges()


def point(k):
    """Point of an integer key (the same text works in both engines)."""
    return (f"((({k} * 7919) % 170001) / CAST(1000 AS DOUBLE) - 85)",
            f"((({k} * 104729) % 360000) / CAST(1000 AS DOUBLE) - 180)")


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(repr(v) if isinstance(v, int) else f"CAST({v!r} AS DOUBLE)" for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({cols}))"


def _edge_rows():
    rows = []
    for f in range(20):
        rows.append((f, 0, f, 0, 0.0, 0.0))
        for m in range(3):
            g, n, off = EDGES[f, m]
            rows.append((f, m + 1, g, n, float(off.real), float(off.imag)))
    return _values(rows, "uf, um, ug, un, ux, uy")


def faces():
    return _values([(f, la, lo, az) for f, ((la, lo), az) in enumerate(zip(FACE_CENTERS, FACE_AXIS_AZIMUTH))],
                   "f, fla, flo, faz")


def index(src, keep, lat, lng, res):
    """SELECT keep, cell: cell of each point of a subquery."""
    cols = ", ".join(keep)
    tilt = ODD_TILT if res % 2 else 0.0
    q = f"SELECT {cols}, radians({lat}) AS la, radians({lng}) AS lo, row_number() OVER () AS rid FROM ({src}) s"
    q = (f"SELECT p.*, f, fla, flo, faz, sin(la) * sin(fla) + cos(la) * cos(fla) * cos(lo - flo) AS dt FROM ({q}) p, {faces()} fc "
         f"QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dt DESC) = 1")
    q = (f"SELECT *, faz - atan2(cos(la) * sin(lo - flo), cos(fla) * sin(la) - sin(fla) * cos(la) * cos(lo - flo)) - {tilt!r} AS th, "
         f"tan(acos(least(1.0, dt))) / {RES0_UNIT!r} * pow(7.0, {res} / 2.0) AS rho FROM ({q})")
    q = f"SELECT *, rho * sin(th) * {2 / math.sqrt(3)!r} AS yb, rho * cos(th) AS xx FROM ({q})"
    q = f"SELECT *, xx + yb / 2 AS cu, yb / 2 - xx AS cv, -yb AS cw FROM ({q})"
    q = f"SELECT *, round(cu) AS ru, round(cv) AS rv, round(cw) AS rw FROM ({q})"
    q = f"SELECT *, abs(ru - cu) AS du, abs(rv - cv) AS dv, abs(rw - cw) AS dw FROM ({q})"
    q = (f"SELECT *, CAST(CASE WHEN du >= dv AND du >= dw THEN -rv - rw ELSE ru END AS BIGINT) AS a{res}, "
         f"CAST(CASE WHEN dw > dv AND dw > du THEN ru + rv ELSE -rw END AS BIGINT) AS b{res} FROM ({q})")
    for r in range(res, 0, -1):
        a, b, p, t = f"a{r}", f"b{r}", f"a{r - 1}", f"b{r - 1}"
        up = (f"(3 * {a} - {b}) / 7.0", f"({a} + 2 * {b}) / 7.0") if r % 2 else (f"(2 * {a} + {b}) / 7.0", f"(3 * {b} - {a}) / 7.0")
        q = f"SELECT *, CAST(round({up[0]}) AS BIGINT) AS {p}, CAST(round({up[1]}) AS BIGINT) AS {t} FROM ({q})"
        down = (f"2 * {p} + {t}", f"3 * {t} - {p}") if r % 2 else (f"3 * {p} - {t}", f"{p} + 2 * {t}")
        q = (f"SELECT *, CASE ({a} - ({down[0]})) * 3 + ({b} - ({down[1]})) WHEN -4 THEN 1 WHEN 1 THEN 2 WHEN -3 THEN 3 "
             f"WHEN 3 THEN 4 WHEN -1 THEN 5 WHEN 4 THEN 6 ELSE 0 END AS g{r} FROM ({q})")
    look = _values([(f, a, b, *v) for (f, a, b), v in tables.base_lookup().items()], "lf, la0, lb0, base, tn, fx")
    q = f"SELECT q.*, base, tn, fx, [1, 5, 4, 6, 2, 3][tn + 1] AS mul FROM ({q}) q JOIN {look} l ON f = lf AND a0 = la0 AND b0 = lb0"
    lead = "CASE " + " ".join(f"WHEN g{r} > 0 THEN g{r}" for r in range(1, res + 1)) + " ELSE 0 END" if res else "0"
    q = f"SELECT *, CASE WHEN fx <> 0 AND ({lead}) * mul % 7 = 1 THEN mul * [1, 5, 4, 6, 2, 3][fx + 1] % 7 ELSE mul END AS mm FROM ({q})"
    digits = " + ".join([f"CAST(g{r} * mm % 7 AS BIGINT) * {8 ** (15 - r)}" for r in range(1, res + 1)] or ["0"])
    return (f"SELECT {cols}, CAST({(1 << 59) + (res << 52) + 8 ** (15 - res) - 1} + CAST(base AS BIGINT) * {1 << 45} + {digits} AS BIGINT) AS cell FROM ({q})")


def frame(src, keep, res, cell="cell"):
    """SELECT keep, face, x, y, turn (position on the face reached) and hx, hy (on the
    home plane, with base, lead) of cells of one resolution."""
    cols = ", ".join(keep)
    homes = [b[3] for b in tables.base_cells()]
    base = _values([(n, b[2], round(b[3].real + round(b[3].imag * 2 / math.sqrt(3)) / 2), round(b[3].imag * 2 / math.sqrt(3)),
                     tables.pentagons().index(n) if b[4] else -1) for n, b in enumerate(tables.base_cells())], "hb, hf, ha, hbb, hp")
    q = f"SELECT {cols}, ({cell} >> 45) & 127 AS base" + "".join(
        f", ({cell} >> {3 * (15 - r)}) & 7 AS g{r}" for r in range(1, res + 1)) + f" FROM ({src}) s"
    q = f"SELECT q.*, hf, hp, ha AS a0, hbb AS b0 FROM ({q}) q JOIN {base} h ON base = hb"
    for r in range(1, res + 1):
        p, t = f"a{r - 1}", f"b{r - 1}"
        down = (f"2 * {p} + {t}", f"3 * {t} - {p}") if r % 2 else (f"3 * {p} - {t}", f"{p} + 2 * {t}")
        q = (f"SELECT *, {down[0]} + [0, -1, 0, -1, 1, 0, 1][g{r} + 1] AS a{r}, {down[1]} + [0, -1, 1, 0, 0, -1, 1][g{r} + 1] AS b{r} FROM ({q})")
    z = 1 / tables.step_scale(res)
    s = tables.step_scale(res)
    q = f"SELECT *, a{res} - b{res} / 2.0 AS lx, b{res} * {math.sqrt(3) / 2!r} AS ly FROM ({q})"
    lead = "CASE " + " ".join(f"WHEN g{r} > 0 THEN g{r}" for r in range(1, res + 1)) + " ELSE 0 END" if res else "0"
    q = f"SELECT *, lx * {s.real!r} - ly * {s.imag!r} AS hx, lx * {s.imag!r} + ly * {s.real!r} AS hy, {lead} AS lead FROM ({q})"
    return unfold(q, keep + ["base", "hx", "hy", "lead", "hf", "hp"], "hx", "hy")


def unfold(src, keep, x, y, face="hf"):
    """SELECT keep, face, x, y, turn for home-plane positions."""
    rows = _values([(n, f, t, float(o.real), float(o.imag)) for n, (f, t, o) in enumerate(tables.frame_rows())], "rw, rf, rt, rx, ry")
    cols = ", ".join(f"q.{c}" for c in keep)
    q = (f"SELECT *, 1 + {x} AS u0, 1 - {x} / 2 + {y} * {math.sqrt(3) / 2!r} AS u1, 1 - {x} / 2 - {y} * {math.sqrt(3) / 2!r} AS u2, "
         f"CAST(floor((atan2(CASE WHEN {y} > -1e-14 THEN abs({y}) ELSE {y} END, {x} - 2) + CASE WHEN {y} > -1e-14 THEN 1e-9 ELSE {2 * math.pi - 1e-9!r} END) "
         f"* {3 / math.pi!r} + 0.5) AS INTEGER) % 6 AS wd FROM ({src})")
    q = (f"SELECT *, CASE WHEN hp >= 0 THEN 80 + 8 * hp + CASE WHEN lead = 0 THEN 7 WHEN wd = 4 AND lead = 5 THEN 6 ELSE wd END "
         f"ELSE 4 * {face} + CASE WHEN least(u0, u1, u2) >= -1e-9 THEN 0 WHEN u0 = least(u0, u1, u2) THEN 1 WHEN u1 = least(u0, u1, u2) THEN 2 ELSE 3 END END AS rn FROM ({q})")
    return (f"SELECT {cols}, rf AS face, rt AS turn, {x} * cos(rt * pi() / 3) - {y} * sin(rt * pi() / 3) + rx AS x, "
            f"{x} * sin(rt * pi() / 3) + {y} * cos(rt * pi() / 3) + ry AS y FROM ({q}) q JOIN {rows} r ON rn = rw")


def across(src, keep, x, y, face="face"):
    """As ``unfold`` for positions near a face, over one edge at most."""
    return unfold(f"SELECT *, -1 AS hp, 0 AS lead FROM ({src})", keep, x, y, face)


def degrees_of(src, keep):
    """SELECT keep, lat, lng of positions (face, x, y)."""
    cols = ", ".join(keep)
    q = (f"SELECT q.*, fla, flo, atan(sqrt(x * x + y * y) * {RES0_UNIT!r}) AS ar, faz - atan2(y, x) AS az FROM ({src}) q JOIN {faces()} fc ON face = f")
    q = f"SELECT *, asin(greatest(-1.0, least(1.0, sin(fla) * cos(ar) + cos(fla) * sin(ar) * cos(az)))) AS pla FROM ({q})"
    q = f"SELECT *, flo + atan2(sin(az) * sin(ar) * cos(fla), cos(ar) - sin(fla) * sin(pla)) AS plo FROM ({q})"
    return (f"SELECT {cols}, degrees(pla) AS lat, degrees(CASE WHEN plo > pi() THEN plo - 2 * pi() WHEN plo < -pi() THEN plo + 2 * pi() ELSE plo END) AS lng FROM ({q})")


def centers(src, keep, res, cell="cell"):
    return degrees_of(frame(src, keep, res, cell), keep)


def neighbors(src, keep, res, cell="cell"):
    """SELECT keep, d, destination for the six directions of hexagons."""
    s = tables.step_scale(res)
    steps = _values([(d, float((s * tables.DIGIT_STEP[d]).real), float((s * tables.DIGIT_STEP[d]).imag)) for d in range(1, 7)], "d, sx, sy")
    q = frame(src, keep, res, cell)
    q = f"SELECT q.*, d, hx + sx AS nx, hy + sy AS ny FROM ({q}) q, {steps} st"
    q = unfold(f"SELECT {', '.join(keep)}, d, base, lead, hf, hp, nx, ny FROM ({q})", keep + ["d"], "nx", "ny")
    q = degrees_of(q, keep + ["d"])
    inner = index(q, keep + ["d"], "lat", "lng", res)
    return f"SELECT {', '.join(keep)}, d, cell AS destination FROM ({inner})" if "cell" not in keep else \
        f"SELECT {', '.join(k for k in keep if k != 'cell')}, origin AS cell, d, cell AS destination FROM (" + index(
            f"SELECT * EXCLUDE (cell), cell AS origin FROM ({q})", [k for k in keep if k != "cell"] + ["origin", "d"], "lat", "lng", res) + ")"


def outline(src, keep, res, cell="cell"):
    """SELECT keep, n, lat, lng: the six corners (even resolutions, hexagons)."""
    s = tables.step_scale(res) / math.sqrt(3)
    zs = [s * complex(math.cos(math.pi * (1 + 2 * n) / 6), math.sin(math.pi * (1 + 2 * n) / 6)) for n in range(6)]
    corners = _values([(n, float(z.real), float(z.imag)) for n, z in enumerate(zs)], "n, sx, sy")
    q = f"SELECT q.*, n, x + sx AS vx, y + sy AS vy FROM ({frame(src, keep, res, cell)}) q, {corners} c"
    q = across(f"SELECT {', '.join(keep)}, n, face, vx, vy FROM ({q})", keep + ["n"], "vx", "vy")
    return degrees_of(q, keep + ["n"])


_decimal = re.compile(r"(?<![\w.])(\d+\.\d+)(?![\w.])")


def doubles(sql):
    """Write decimal literals as doubles."""
    return _decimal.sub(r"\1e0", sql)
