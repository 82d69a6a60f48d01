"""Polygon columns in and out, as text (WKT) and little-endian binary (WKB).

Reading gives ``rings``: array of rings, each an array of (x, y) = (lng, lat); empty
for an empty or foreign geometry.  Everything is built-in expressions.
"""
from pyspark.sql import DataFrame

from ..functions.steps import fresh, run

NUMBER = r"[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?"
RINGS = "array<array<struct<x:double,y:double>>>"
EMPTY = f"CAST(array() AS {RINGS})"


def read_wkt(df: DataFrame, text="wkt", out="rings", on_error="raise") -> DataFrame:
    """Polygon text to rings.  Text that does not start with POLYGON, or is EMPTY, gives
    no rings.  Malformed text raises, or with ``on_error='null'`` gives NULL."""
    o = fresh("wk")
    point = f"^ *{NUMBER} +{NUMBER} *$"
    steps = [
        {f"{o}t": f"CASE WHEN startswith({text}, 'POLYGON') THEN ltrim(substring({text}, 8)) ELSE '' END"},
        # the reference grammar ends at the first two closing brackets in a row
        {f"{o}in": f"regexp_extract({o}t, '(?s)^\\\\( *\\\\((.*?)\\\\) *\\\\)', 1)",
         f"{o}shape": f"{o}t RLIKE '(?s)^\\\\( *\\\\(.*?\\\\) *\\\\)'",
         f"{o}poly": f"startswith({o}t, '(')"},
        {f"{o}texts": f"transform(split({o}in, '\\\\) *, *\\\\('), r -> "
                      f"CASE WHEN trim(r) = '' THEN CAST(array() AS array<string>) ELSE split(r, ',') END)"},
        {f"{o}ok": f"{o}shape AND forall({o}texts, r -> forall(r, p -> p RLIKE '{point}'))"},
        {f"{o}rings": f"CASE WHEN {o}ok THEN transform({o}texts, r -> transform(r, p -> named_struct("
                      f"'x', CAST(split_part(trim(p), ' ', 1) AS DOUBLE), "
                      f"'y', CAST(split_part(trim(p), ' ', -1) AS DOUBLE)))) END"},
    ]
    bad = f"raise_error(concat('Invalid polygon text: ', left({text}, 80)))" if on_error == "raise" else f"CAST(NULL AS {RINGS})"
    return run(df, steps, {out: f"CASE WHEN {text} IS NULL THEN NULL WHEN NOT {o}poly THEN {EMPTY} "
                                f"WHEN {o}ok THEN {o}rings ELSE {bad} END"})


def _uint(at, b):
    return (f"CAST(conv(concat(hex(substring({b}, {at} + 3, 1)), hex(substring({b}, {at} + 2, 1)), "
            f"hex(substring({b}, {at} + 1, 1)), hex(substring({b}, {at}, 1))), 16, 10) AS BIGINT)")


def _double(at, b):
    """IEEE-754 double stored little-endian at a byte position, by arithmetic."""
    text = "concat(" + ", ".join(f"hex(substring({b}, {at} + {k}, 1))" for k in range(7, -1, -1)) + ")"
    bits = f"CAST(conv({text}, 16, -10) AS BIGINT)"
    return (f"get(transform(array({bits}), v -> CASE WHEN v < 0 THEN -1D ELSE 1D END * "
            f"CASE WHEN (shiftrightunsigned(v, 52) & 2047) = 0 THEN CAST(v & 4503599627370495L AS DOUBLE) * pow(2D, -1074D) "
            f"ELSE (1D + CAST(v & 4503599627370495L AS DOUBLE) * {2.0 ** -52!r}D) "
            f"* pow(2D, CAST((shiftrightunsigned(v, 52) & 2047) - 1023 AS DOUBLE)) END), 0)")


def read_wkb(df: DataFrame, binary="wkb", out="rings", on_error="raise") -> DataFrame:
    """Little-endian polygon binary to rings; anything but a polygon raises (or NULL)."""
    o = fresh("wb")
    count = _uint("s.at", binary)
    # the ring's count and all its points lie within the binary; compared as BIGINT, so that a corrupt count can't overflow
    fits = f"coalesce(s.at + 3 <= {o}len AND CAST(s.at AS BIGINT) + 3 + 16 * {count} <= {o}len, false)"
    ring = (f"CASE WHEN s.bad OR NOT {fits} THEN named_struct('at', s.at, 'starts', s.starts, 'bad', true) "
            f"ELSE named_struct('at', CAST(s.at + 4 + 16 * {count} AS INT), 'starts', "
            f"concat(s.starts, array(named_struct('a', s.at + 4, 'n', CAST({count} AS INT)))), 'bad', false) END")
    none = "CAST(array() AS array<struct<a:int,n:int>>)"
    steps = [
        {f"{o}len": f"length({binary})", f"{o}kind": f"CASE WHEN length({binary}) >= 5 THEN {_uint(2, binary)} END",
         f"{o}order": f"hex(substring({binary}, 1, 1))"},
        {f"{o}n": f"CASE WHEN {o}kind = 3 AND {o}len >= 9 THEN {_uint(6, binary)} ELSE 0 END"},
        # each announced ring takes four bytes at least
        {f"{o}head": f"coalesce({o}order = '01' AND ({o}kind = 0 OR {o}kind = 3 AND {o}len >= 9 AND 9 + 4 * {o}n <= {o}len), false)"},
        {f"{o}walk": f"aggregate(CASE WHEN {o}head AND {o}n > 0 THEN sequence(1, CAST({o}n AS INT)) ELSE CAST(array() AS array<int>) END, "
                     f"named_struct('at', CASE WHEN {o}head THEN 10 ELSE 1 END, 'starts', {none}, 'bad', false), (s, i) -> {ring})"},
        {f"{o}ok": f"{o}head AND NOT {o}walk.bad", f"{o}starts": f"{o}walk.starts", f"{o}at": f"{o}walk.at"},
        {f"{o}rings": f"transform({o}starts, r -> CASE WHEN r.n = 0 THEN CAST(array() AS array<struct<x:double,y:double>>) "
                      f"ELSE transform(sequence(0, r.n - 1), i -> named_struct('x', {_double('r.a + 16 * i', binary)}, "
                      f"'y', {_double('r.a + 16 * i + 8', binary)})) END)"},
    ]
    bad = f"raise_error(concat('Invalid polygon binary at byte ', {o}at))" if on_error == "raise" else f"CAST(NULL AS {RINGS})"
    return run(df, steps, {out: f"CASE WHEN {binary} IS NULL THEN NULL WHEN {o}ok THEN {o}rings ELSE {bad} END"})


def _ring_text(points):
    return (f"concat('(', array_join(transform(concat({points}, slice({points}, 1, 1)), "
            f"p -> format_string('%f %f', p.lng, p.lat)), ', '), ')')")


def _bytes(x):
    """Little-endian bytes (hex) of a double expression without side effects."""
    return (f"get(transform(array({x}), v -> get(transform(array(CASE WHEN v = 0D THEN 0D ELSE floor(log2(abs(v))) END), "
            f"e0 -> get(transform(array(CASE WHEN v = 0D THEN 0D WHEN pow(2D, e0) > abs(v) THEN e0 - 1D "
            f"WHEN pow(2D, e0 + 1D) <= abs(v) THEN e0 + 1D ELSE CAST(e0 AS DOUBLE) END), e -> "
            f"get(transform(array(lpad(hex(CASE WHEN v = 0D THEN 0L ELSE (CASE WHEN v < 0D THEN shiftleft(1L, 63) ELSE 0L END) "
            f"| shiftleft(CAST(e AS BIGINT) + 1023L, 52) "
            f"| CAST((abs(v) / pow(2D, e) - 1D) * 4503599627370496D AS BIGINT) END), 16, '0')), h -> "
            f"concat(substring(h, 15, 2), substring(h, 13, 2), substring(h, 11, 2), substring(h, 9, 2), "
            f"substring(h, 7, 2), substring(h, 5, 2), substring(h, 3, 2), substring(h, 1, 2))), 0)), 0)), 0)), 0)")


def _uint_hex(n):
    h = f"lpad(hex(CAST({n} AS BIGINT)), 8, '0')"
    return f"concat(substring({h}, 7, 2), substring({h}, 5, 2), substring({h}, 3, 2), substring({h}, 1, 2))"


def _ring_hex(points):
    closed = f"concat({points}, slice({points}, 1, 1))"
    return (f"concat({_uint_hex(f'size({closed})')}, array_join(transform({closed}, "
            f"p -> concat({_bytes('p.lng')}, {_bytes('p.lat')})), ''))")


def outline_text(points, kind="POLYGON"):
    """SQL for the text of one outline; a line repeats its first point as well."""
    ring = _ring_text(points)
    return f"concat('POLYGON (', {ring}, ')')" if kind == "POLYGON" else f"concat('LINESTRING ', {ring})"


def outline_binary(points, kind="POLYGON"):
    head = "concat('0103000000', '01000000', " if kind == "POLYGON" else "concat('0102000000', "
    return f"unhex({head}{_ring_hex(points)}))"


def multipolygon_text(polygons):
    """SQL for the text of an array of polygons (arrays of rings)."""
    one = f"concat('(', array_join(transform(g, r -> {_ring_text('r')}), ', '), ')')"
    return (f"CASE WHEN size({polygons}) = 0 THEN 'MULTIPOLYGON EMPTY' "
            f"ELSE concat('MULTIPOLYGON (', array_join(transform({polygons}, g -> {one}), ', '), ')') END")


def multipolygon_binary(polygons):
    one = f"concat('0103000000', {_uint_hex('size(g)')}, array_join(transform(g, r -> {_ring_hex('r')}), ''))"
    return (f"unhex(concat('0106000000', {_uint_hex(f'size({polygons})')}, "
            f"array_join(transform({polygons}, g -> {one}), '')))")
