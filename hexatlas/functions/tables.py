"""Small dimension tables derived from the fixed values.

All tables are at most a thousand numbers and do not depend on the data; they
enter a query as literal arrays which Catalyst folds into constants, so a
lookup is an array access inside generated code, not a join.

Plane convention: each face carries a complex plane, the i axis at angle 0, j at
120 degrees, k at 240, seen from outside; unit length is one resolution-0 step.
The face triangle has its corners at 2, 2w and 2w^2.
"""
import cmath
import math
from functools import lru_cache

from .constants import (
    FACE_AXIS_AZIMUTH, FACE_CENTERS, HOME_FACE, NUM_BASE_CELLS, RES0_UNIT,
)

W = cmath.exp(2j * math.pi / 3)
CORNERS = [2 * W ** m for m in range(3)]
H60 = math.sqrt(3) / 2  # sine of a sixth of a turn
# rotation between lattices of consecutive resolutions
CLASS3_ANGLE = math.asin(math.sqrt(3.0 / 28.0))
# angle of the unit step for digits 0-7; 0 is the centre and 7 means "unused"
DIGIT_TURNS = {1: 4, 2: 2, 3: 3, 4: 0, 5: 5, 6: 1}


def turn(n):
    """Exact-as-possible unit complex number at n * 60 degrees."""
    n %= 6
    re = [1.0, 0.5, -0.5, -1.0, -0.5, 0.5][n]
    im = [0.0, 1.0, 1.0, 0.0, -1.0, -1.0][n] * (math.sqrt(3) / 2)
    return complex(re, im)


def turns_of(z):
    """Angle of z in sixths of a turn, rounded."""
    return round(math.degrees(cmath.phase(z)) / 60) % 6


DIGIT_STEP = [0j] + [turn(DIGIT_TURNS[d]) for d in range(1, 7)] + [0j]


def lattice_to_plane(a, b):
    return complex(a - b / 2, b * math.sqrt(3) / 2)


def step_scale(res):
    """Plane vector of one lattice unit at a resolution."""
    z = complex(7.0 ** (-res / 2), 0)
    return z * cmath.exp(1j * CLASS3_ANGLE) if res % 2 else z


def dot(p, q):
    return sum(x * y for x, y in zip(p, q))


def unit(p):
    n = math.sqrt(dot(p, p))
    return tuple(x / n for x in p)


@lru_cache(None)
def face_axes():
    """Per face: centre, and the tangents of one plane unit along x and y."""
    out = []
    for (lat, lng), az in zip(FACE_CENTERS, FACE_AXIS_AZIMUTH):
        center = (math.cos(lat) * math.cos(lng), math.cos(lat) * math.sin(lng), math.sin(lat))
        north = (-math.sin(lat) * math.cos(lng), -math.sin(lat) * math.sin(lng), math.cos(lat))
        east = (-math.sin(lng), math.cos(lng), 0.0)

        def tangent(azimuth):
            return tuple(RES0_UNIT * (math.cos(azimuth) * n + math.sin(azimuth) * e)
                         for n, e in zip(north, east))

        out.append((center, tangent(az), tangent(az - math.pi / 2)))
    return out


def plane_to_sphere(face, z):
    c, u, v = face_axes()[face]
    return unit(tuple(ci + z.real * ui + z.imag * vi for ci, ui, vi in zip(c, u, v)))


def sphere_to_plane(face, p):
    c, u, v = face_axes()[face]
    h = dot(c, p) * RES0_UNIT ** 2
    return complex(dot(u, p) / h, dot(v, p) / h)


def near(p, q, tol=1e-6):
    return max(abs(x - y) for x, y in zip(p, q)) < tol


@lru_cache(None)
def face_edges():
    """(face, m) -> (face across the edge opposite corner m, turns, offset):
    a point z of the first face's plane is turn(turns) * z + offset on the other."""
    pts = [[plane_to_sphere(f, c) for c in CORNERS] for f in range(20)]
    out = {}
    for f in range(20):
        for m in range(3):
            s, t = (m + 1) % 3, (m + 2) % 3
            for g in range(20):
                if g == f:
                    continue
                s2 = [n for n in range(3) if near(pts[g][n], pts[f][s])]
                t2 = [n for n in range(3) if near(pts[g][n], pts[f][t])]
                if s2 and t2:
                    n = turns_of((CORNERS[s2[0]] - CORNERS[t2[0]]) / (CORNERS[s] - CORNERS[t]))
                    out[f, m] = (g, n, CORNERS[s2[0]] - turn(n) * CORNERS[s])
    assert len(out) == 60
    return out


@lru_cache(None)
def base_cells():
    """Per base cell: unit vector, {face: plane position} over every face on which
    it lies, home face, home position, pentagon?  Numbered by falling latitude."""
    found = []
    for f in range(20):
        for a in range(-2, 3):
            for b in range(-2, 3):
                z = lattice_to_plane(a, b)
                if min(1 + (z * c.conjugate()).real / 2 for c in CORNERS) < -1e-9:
                    continue
                p = plane_to_sphere(f, z)
                for q, where in found:
                    if near(p, q):
                        where[f] = z
                        break
                else:
                    found.append((p, {f: z}))
    found.sort(key=lambda e: -e[0][2])
    assert len(found) == NUM_BASE_CELLS
    return [(p, where, HOME_FACE[n], where[HOME_FACE[n]], len(where) == 5)
            for n, (p, where) in enumerate(found)]


@lru_cache(None)
def pentagons():
    return [n for n, b in enumerate(base_cells()) if b[4]]


# wedge (in sixths of a turn, home orientation) of the faces round a pentagon,
# met clockwise from the home face; wedge 4 is the removed one
PENTAGON_WEDGES = [3, 2, 1, 0, 5]


@lru_cache(None)
def pentagon_faces(base):
    """wedge -> (face, turns from home orientation to that face, corner)."""
    p, where, home, _, _ = base_cells()[base]
    up = (0.0, 0.0, 1.0)
    east = unit((up[1] * p[2] - up[2] * p[1], up[2] * p[0] - up[0] * p[2], up[0] * p[1] - up[1] * p[0]))
    north = (p[1] * east[2] - p[2] * east[1], p[2] * east[0] - p[0] * east[2], p[0] * east[1] - p[1] * east[0])

    def azimuth(f):
        c = face_axes()[f][0]
        return math.atan2(dot(c, east), dot(c, north))

    order = sorted(where, key=lambda f: (azimuth(f) - azimuth(home)) % (2 * math.pi))
    assert order[0] == home
    return {w: (f, (turns_of(-where[f]) - w) % 6, where[f])
            for w, f in zip(PENTAGON_WEDGES, order)}


@lru_cache(None)
def frame_rows():
    """Rows of the unfolding table: home-plane position -> plane of the face hit.

    Row 4*f + 0 keeps the home face f, 4*f + 1 + m crosses its edge m (ordinary
    base cells).  Row 80 + 8*i + s is sector s around pentagon number i; sectors
    0-5 are wedges, with 4 (the removed wedge) reached from digit 3, and 6 the
    same wedge reached from digit 5.  A row is (face, turns, offset).
    """
    rows = []
    for f in range(20):
        rows.append((f, 0, 0j))
        rows.extend(face_edges()[f, m] for m in range(3))
    for base in pentagons():
        faces, home = pentagon_faces(base), base_cells()[base][3]

        def wedge(w, extra=0):
            face, n, corner = faces[w]
            n = (n + extra) % 6
            return face, n, corner - turn(n) * home

        rows.extend([wedge(0), wedge(1), wedge(2), wedge(3), wedge(5, 1), wedge(5), wedge(3, 5), wedge(3)])
    return rows


def _axis_angle(face, z, at, reference):
    """Angle at sphere point ``at`` of the face's i axis, against a reference frame."""
    p, q = plane_to_sphere(face, z), plane_to_sphere(face, z + 0.01)
    d = tuple(y - x for x, y in zip(p, q))
    e1, e2 = reference
    return math.atan2(dot(d, e2), dot(d, e1))


@lru_cache(None)
def base_lookup():
    """(face, a, b) -> (base cell, turns to home orientation, pentagon fix).

    Covers each lattice point on a face or just past one of its edges.  The fix
    is the extra turn (+1 or -1) for positions that lead with the removed digit.
    """
    out = {}
    for f in range(20):
        for a in range(-3, 4):
            for b in range(-3, 4):
                z = lattice_to_plane(a, b)
                sides = [1 + (z * c.conjugate()).real / 2 for c in CORNERS]
                over = sum(s < -1e-9 for s in sides)
                if min(sides) < -0.6 or over > 1:
                    continue
                face, n, pos = f, 0, z
                if over:
                    face, n, off = face_edges()[f, sides.index(min(sides))]
                    pos = turn(n) * z + off
                p = plane_to_sphere(face, pos)
                base = next(i for i, c in enumerate(base_cells()) if near(c[0], p))
                _, where, home, home_pos, pent = base_cells()[base]
                if pent:
                    if over:
                        continue
                    w, (_, m, _) = next((w, v) for w, v in pentagon_faces(base).items() if v[0] == face)
                    out[f, a, b] = (base, -m % 6, {3: 1, 5: 5}.get(w, 0))
                else:
                    e1 = unit(tuple(y - x for x, y in zip(p, plane_to_sphere(home, home_pos + 0.01))))
                    e2 = (p[1] * e1[2] - p[2] * e1[1], p[2] * e1[0] - p[0] * e1[2], p[0] * e1[1] - p[1] * e1[0])
                    m = round(math.degrees(_axis_angle(face, pos, p, (e1, e2))) / 60) % 6
                    out[f, a, b] = (base, (m + n) % 6, 0)
    return out


@lru_cache(None)
def base_neighbors():
    """(base cell, digit) -> (neighbouring base cell, turns from the first one's
    home orientation to the neighbour's)."""
    out = {}
    for base in range(NUM_BASE_CELLS):
        _, _, home, home_pos, pent = base_cells()[base]
        for d in range(1, 7):
            if pent and d == 1:
                continue
            z = home_pos + DIGIT_STEP[d]
            if pent:
                i = pentagons().index(base)
                face, n, off = frame_rows()[80 + 8 * i + DIGIT_TURNS[d]]
                z = turn(n) * z + off
            else:
                face, n, z = home, 0, z
                sides = [1 + (z * c.conjugate()).real / 2 for c in CORNERS]
                if min(sides) < -1e-9:
                    face, n, off = face_edges()[face, sides.index(min(sides))]
                    z = turn(n) * z + off
            b = round(z.imag * 2 / math.sqrt(3))
            a = round(z.real + b / 2)
            other, m, _ = base_lookup()[face, a, b]
            out[base, d] = (other, (n + m) % 6)
    return out


@lru_cache(None)
def digit_pairs():
    """(a mod 7) * 7 + (b mod 7) -> (two-digit code, a offset, b offset) for one
    even resolution and the odd one above it: (a - offset) / 7 is the position two
    resolutions up."""
    steps = {0: (0, 0), 1: (-1, -1), 2: (0, 1), 3: (-1, 0), 4: (1, 0), 5: (0, -1), 6: (1, 1)}
    out = {}
    for odd, (p, q) in steps.items():
        for even, (a, b) in steps.items():
            x, y = 3 * p - q + a, p + 2 * q + b
            out[(x % 7) * 7 + y % 7] = (odd * 8 + even, x, y)
    return [out[n] for n in range(49)]


@lru_cache(None)
def coarse_centers(res):
    """Unit vectors of the cells of resolution 0 or 1, numbered base * 7^res + digit
    (a missing pentagon digit repeats the pentagon)."""
    out = []
    for base in range(NUM_BASE_CELLS):
        _, _, home, home_pos, pent = base_cells()[base]
        for d in range(7 ** res):
            z = home_pos + (step_scale(1) * DIGIT_STEP[d] if d else 0)
            if pent:
                rel = z - home_pos
                w = int((math.degrees(cmath.phase(rel)) % 360 + 30) // 60) % 6 if d > 1 else 7
                face, n, off = frame_rows()[80 + 8 * pentagons().index(base) + (6 if w == 4 and d == 5 else w)]
                z = home_pos if d == 1 else z
            else:
                sides = [1 + (z * c.conjugate()).real / 2 for c in CORNERS]
                face, n, off = frame_rows()[4 * home + (0 if min(sides) > -1e-9 else 1 + sides.index(min(sides)))]
            out.append(plane_to_sphere(face, turn(n) * z + off))
    return out
