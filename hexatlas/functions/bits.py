"""Index bit algebra as SQL expressions over a ``BIGINT`` column.

Layout: bits 59-62 mode (1 cell, 2 directed edge, 4 vertex), 56-58 edge direction
or vertex number, 52-55 resolution, 45-51 base cell, then fifteen 3-bit digits;
digit 7 marks a level finer than the resolution.  Every function takes and
returns SQL text; wrap it in ``F.expr`` for a Column.
"""
from . import tables
from .constants import MAX_RES, NUM_BASE_CELLS
from .steps import pick, whole

RES_MASK = 15 << 52
MODE_CLEAR = ~((15 << 59) | (7 << 56)) & (2 ** 63 - 1)
CELL_MODE, EDGE_MODE, VERTEX_MODE = 1 << 59, 2 << 59, 4 << 59
ALL_DIGITS = (1 << 45) - 1
LOW_BITS = sum(1 << (3 * n) for n in range(15))


def resolution(c):
    return whole(f"shiftrightunsigned({c}, 52) & 15")


def base_cell(c):
    return whole(f"shiftrightunsigned({c}, 45) & 127")


def reserved(c):
    return whole(f"shiftrightunsigned({c}, 56) & 7")


def mode(c):
    return whole(f"shiftrightunsigned({c}, 59) & 15")


def digit(c, r):
    """Digit at resolution r; NULL when r is not 1-15."""
    return (f"CASE WHEN ({r}) BETWEEN 1 AND {MAX_RES} "
            f"THEN CAST(shiftrightunsigned({c}, 3 * ({MAX_RES} - ({r}))) & 7 AS INT) END")


def unused_mask(r):
    """Ones in all digits finer than r."""
    if isinstance(r, int):
        return f"{(1 << (3 * (MAX_RES - r))) - 1}L"
    return f"(shiftleft(1L, 3 * ({MAX_RES} - ({r}))) - 1L)"


def is_pentagon_base(b):
    return f"({b} IN ({', '.join(map(str, tables.pentagons()))}))"


def used_digits(c):
    """The digits 1..res as one base-8 number."""
    return f"shiftright({c} & {ALL_DIGITS}L, 3 * ({MAX_RES} - {resolution(c)}))"


def leading_digit(q):
    """First non-zero digit of a base-8 number (0 if none)."""
    return whole(f"CASE WHEN {q} = 0 THEN 0 ELSE shiftright({q}, 3 * ((length(bin({q})) - 1) DIV 3)) & 7 END")


def is_pentagon(c):
    return f"({is_pentagon_base(base_cell(c))} AND {used_digits(c)} = 0)"


def is_class_iii(c):
    return f"({resolution(c)} % 2 = 1)"


def _is_cell_body(c):
    """Base cell and digits are those of a cell (mode not looked at)."""
    used = f"({c} & {ALL_DIGITS}L & ~{unused_mask(resolution(c))})"
    # a used digit is 7 exactly when its three bits are all ones
    sevens = f"({used} & shiftright({used}, 1) & shiftright({used}, 2) & {LOW_BITS}L)"
    return (f"(({c} & {unused_mask(resolution(c))}) = {unused_mask(resolution(c))} AND {sevens} = 0 "
            f"AND {base_cell(c)} < {NUM_BASE_CELLS} "
            f"AND NOT ({is_pentagon_base(base_cell(c))} AND {leading_digit(used_digits(c))} = 1))")


def is_valid_cell(c):
    """Never NULL for a non-NULL index."""
    return f"({c} >= 0 AND {mode(c)} = 1 AND {reserved(c)} = 0 AND {_is_cell_body(c)})"


def as_cell(c):
    """The cell an edge or vertex belongs to."""
    return f"(({c} & {MODE_CLEAR}L) | {CELL_MODE}L)"


def is_valid_edge(c):
    return (f"({c} >= 0 AND {mode(c)} = 2 AND {reserved(c)} BETWEEN 1 AND 6 AND {_is_cell_body(c)} "
            f"AND NOT ({reserved(c)} = 1 AND {is_pentagon(c)}))")


def has_vertex_form(c):
    """All of vertex validity but the choice of owner."""
    return (f"({c} >= 0 AND {mode(c)} = 4 AND {_is_cell_body(c)} "
            f"AND {reserved(c)} < CASE WHEN {is_pentagon(c)} THEN 5 ELSE 6 END)")


def parent(c, r):
    r_ = f"({r})"
    return (f"CASE WHEN {r_} BETWEEN 0 AND {resolution(c)} "
            f"THEN ({c} & ~{RES_MASK}L) | shiftleft(CAST({r_} AS BIGINT), 52) | {unused_mask(r)} END")


def center_child(c, r):
    r_ = f"({r})"
    return (f"CASE WHEN {r_} BETWEEN {resolution(c)} AND {MAX_RES} THEN "
            f"({c} & ~{RES_MASK}L & ~{unused_mask(resolution(c))}) "
            f"| shiftleft(CAST({r_} AS BIGINT), 52) | {unused_mask(r)} END")


def _power7(n):
    return pick([7 ** k for k in range(MAX_RES + 1)], n)


def children_count(c, r):
    depth = f"(({r}) - {resolution(c)})"
    return (f"CASE WHEN ({r}) BETWEEN {resolution(c)} AND {MAX_RES} THEN CAST(CASE WHEN {is_pentagon(c)} "
            f"THEN 1 + 5 * (({_power7(depth)} - 1) DIV 6) ELSE {_power7(depth)} END AS BIGINT) END")


def cells_at(r):
    return f"CASE WHEN {r} BETWEEN 0 AND {MAX_RES} THEN 2 + 120 * {_power7(r)} END"


def first_child(c, r):
    """Lowest index among the descendants at r (also the centre child)."""
    return center_child(c, r)


def last_child(c, r):
    """Highest index among the descendants at r."""
    fill = sum(6 << (3 * n) for n in range(15))
    return (f"CASE WHEN ({r}) BETWEEN {resolution(c)} AND {MAX_RES} THEN ({center_child(c, r)}) "
            f"| ({fill}L & {unused_mask(resolution(c))} & ~{unused_mask(r)}) | {unused_mask(r)} END")


def _octal_of_base7(n, depth=MAX_RES):
    """Base-7 digits of n (a BIGINT if more than ten), packed three bits each."""
    return "(" + " | ".join(
        f"shiftleft(({n} DIV {7 ** k}) % 7, {3 * k})" if k else f"({n} % 7)" for k in range(depth)) + ")"


def _base7_of_octal(q, depth=MAX_RES):
    return "(" + " + ".join(
        f"(shiftright({q}, {3 * k}) & 7) * {7 ** k}L" if k else f"({q} & 7)" for k in range(depth)) + ")"


def child_at(p, position, r):
    """Steps and result: descendant of p at resolution r with the given position.

    Among a pentagon's descendants the centre subtree comes first, at each level,
    and the sub-tree of digit 1 is missing, so the position is first moved past
    the missing sub-trees.
    """
    depth = f"({r} - {resolution(p)})"
    # Position n below a pentagon of depth d: centre subtree holds 1+5(7^(d-1)-1)/6,
    # the others 7^(d-1).  The smallest level whose centre subtree covers n decides.
    pent_of = [1 + 5 * (7 ** k - 1) // 6 for k in range(MAX_RES + 1)]
    level = "CASE " + " ".join(f"WHEN _n < {pent_of[k]}L THEN {k}" for k in range(MAX_RES + 1)) + " END"
    steps = [
        {"_ok": f"({position} >= 0 AND {position} < {children_count(p, r)})",
         "_n": f"CAST({position} AS BIGINT)", "_pent": is_pentagon(p)},
        {"_lv": f"CASE WHEN _pent THEN {level} END"},
        {"_m": f"CASE WHEN _pent AND _lv > 0 THEN _n - {pick(pent_of, '_lv - 1')} "
               f"+ 2 * {_power7('_lv - 1')} ELSE _n END"},
        {"_q": _octal_of_base7("_m")},
    ]
    result = (f"CASE WHEN _ok THEN ({center_child(p, r)}) | shiftleft(_q, 3 * ({MAX_RES} - ({r}))) END")
    return steps, result


def child_position(c, r):
    """Steps and result: ordinal of c among the descendants of its ancestor at r."""
    pent_of = [1 + 5 * (7 ** k - 1) // 6 for k in range(MAX_RES + 1)]
    steps = [
        {"_p": parent(c, r)},
        {"_d": f"{resolution(c)} - ({r})", "_pent": is_pentagon("_p")},
        {"_q": f"CASE WHEN _p IS NOT NULL THEN {used_digits(c)} & (shiftleft(1L, 3 * _d) - 1L) END"},
        {"_m": _base7_of_octal("_q"),
         "_lv": "CASE WHEN _q = 0 THEN 0 ELSE (length(bin(_q)) - 1) DIV 3 + 1 END"},
    ]
    result = (f"CASE WHEN _pent AND _lv > 0 THEN _m + {pick(pent_of, '_lv - 1')} - 2 * {_power7('_lv - 1')} "
              f"ELSE _m END")
    return steps, result


def parse_hex(s):
    """Hex text to index; NULL if it is not hex or has a set top bit."""
    digits = f"trim(LEADING '0' FROM lower({s}))"
    return (f"CASE WHEN {s} RLIKE '^[0-9a-fA-F]+$' THEN CASE WHEN length({digits}) = 0 THEN 0L "
            f"WHEN length({digits}) < 16 OR (length({digits}) = 16 AND {digits} < '8') "
            f"THEN CAST(conv({digits}, 16, 10) AS BIGINT) END END")


def to_hex(c):
    return f"lower(hex({c}))"


def res0_cell(b):
    return f"({CELL_MODE | ALL_DIGITS}L | shiftleft(CAST({b} AS BIGINT), 45))"


def pentagon_cell(n, r):
    return (f"CASE WHEN {r} BETWEEN 0 AND {MAX_RES} THEN {CELL_MODE}L "
            f"| shiftleft(CAST({r} AS BIGINT), 52) | shiftleft(CAST({pick(tables.pentagons(), n)} AS BIGINT), 45) "
            f"| {unused_mask(r)} END")


def assemble(base, digits, res):
    """Cell of a base cell number and an array of digits; NULL if not a cell."""
    packed = (f"aggregate({digits}, 0L, (acc, d) -> acc * 8 + "
              f"CASE WHEN d BETWEEN 0 AND 6 THEN d END)")
    steps = [
        {"_q": f"CASE WHEN {res} BETWEEN 0 AND {MAX_RES} AND size({digits}) = {res} "
               f"AND {base} BETWEEN 0 AND {NUM_BASE_CELLS - 1} THEN {packed} END"},
        {"_bad": f"{is_pentagon_base(base)} AND {leading_digit('_q')} = 1"},
    ]
    result = (f"CASE WHEN NOT _bad THEN {CELL_MODE}L | shiftleft(CAST({res} AS BIGINT), 52) "
              f"| shiftleft(CAST({base} AS BIGINT), 45) | shiftleft(_q, 3 * ({MAX_RES} - {res})) "
              f"| {unused_mask(res)} END")
    return steps, result


def resolution_of(c):
    """As ``resolution``, but NULL for NULL."""
    return f"CAST(shiftrightunsigned({c}, 52) & 15 AS INT)"


def base_cell_of(c):
    return f"CAST(shiftrightunsigned({c}, 45) & 127 AS INT)"


def disk_size(k):
    """Most cells within k steps."""
    return f"CASE WHEN {k} >= 0 THEN 1L + 3L * {k} * ({k} + 1) END"
