"""Roll up, drill down, compact and uncompact tables of cells."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits
from ..functions.constants import MAX_RES
from ..functions.steps import fresh, run, scoped
from ._common import tuned


def with_parent(df: DataFrame, cell="cell", res=0, out="parent") -> DataFrame:
    """Ancestor at a resolution (number or column); NULL if finer than the cell."""
    return run(df, [], {out: f"CASE WHEN {bits.is_valid_cell(cell)} THEN {bits.parent(cell, res)} END"})


def rollup_cells(df: DataFrame, aggregates, cell="cell", res=0, by=()) -> DataFrame:
    """Aggregate facts by cell into facts by ancestor.

    The key is a bit mask, so it is evaluated inside the partial aggregation: what is
    shuffled is one row per task and ancestor, however hot one ancestor is.  Keys that
    are not cells, and cells coarser than ``res``, are aggregated under a NULL cell.
    """
    keyed = df.withColumn("cell", F.expr(f"CASE WHEN {bits.is_valid_cell(cell)} THEN {bits.parent(cell, res)} END"))
    return keyed.groupBy(*by, "cell").agg(*aggregates)


def rollup_levels(df: DataFrame, aggregates, merges, cell="cell", levels=(0,), by=()) -> DataFrame:
    """Roll up to several resolutions: res, cell, aggregates.

    The finest level is aggregated from the facts, each coarser one from the level
    before (``merges`` combine partial aggregates, column by column), so the facts
    are read and shuffled once, not once per level.
    """
    levels = sorted(levels, reverse=True)
    current = rollup_cells(df, aggregates, cell, levels[0], by)
    out = current.selectExpr(f"{levels[0]} AS res", "*")
    for r in levels[1:]:
        current = rollup_cells(current, merges, "cell", r, by)
        out = out.unionByName(current.selectExpr(f"{r} AS res", "*"))
    return out


def descendant_filter(cell, parent, res):
    """Range predicate that holds exactly for the descendants of ``parent`` (an index
    value) at ``res``.  Unlike ``parent(cell) = p`` it is pushed into a Parquet scan and
    prunes row groups of data sorted by cell."""
    old = (parent >> 52) & 15
    if not old <= res <= MAX_RES:
        return "false"
    mask_old, mask_new = (1 << (3 * (15 - old))) - 1, (1 << (3 * (15 - res))) - 1
    base = (parent & ~(15 << 52) & ~mask_old) | (res << 52) | mask_new
    fill = sum(6 << (3 * n) for n in range(15)) & mask_old & ~mask_new
    return f"{cell} BETWEEN {base}L AND {base | fill}L"


BLOCK_DEPTH = 7  # levels below a work item: at most 7^7 rows of one task


def drilldown_cells(df: DataFrame, cell="cell", res=None, out="child") -> DataFrame:
    """One row per descendant at ``res`` (number or column).

    Numbers in base 7 are the digits of the children, so the expansion is one narrow
    generator.  Cells with more than 7^7 descendants are first expanded to their
    descendants seven levels above ``res``, as work items that are dealt over all tasks:
    one base cell drilled down to a fine resolution is no task of its own.  A pentagon's
    numbers that lead with the missing digit are skipped.  Cells finer than ``res`` give
    no rows.
    """
    depth = f"({res}) - {bits.resolution(cell)}"
    ok = f"{bits.is_valid_cell(cell)} AND {res} BETWEEN {bits.resolution(cell)} AND {MAX_RES}"
    near = _descendants(df.filter(f"{ok} AND {depth} <= {BLOCK_DEPTH}"), cell, res, out)
    if isinstance(res, int) and res <= BLOCK_DEPTH:
        return near
    o = fresh("dd")
    kept = [c for c in df.columns if c != out]
    items = _descendants(df.filter(f"{ok} AND {depth} > {BLOCK_DEPTH}"), cell, f"(({res}) - {BLOCK_DEPTH})", f"{o}item")
    # a number of partitions of its own: items are few bytes, and would be coalesced
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = items.repartition(tasks, F.expr(cell), F.col(f"{o}item"))
    far = _descendants(dealt, f"{o}item", res, f"{o}child").select(*[F.col(f"`{c}`") for c in kept], F.col(f"{o}child").alias(out))
    return near.unionByName(far)


def _descendants(df, cell, res, out):
    """Descendants of valid cells not finer than ``res``."""
    o = fresh("ds")
    kept = [f"`{c}`" for c in df.columns if c != out]
    wide = df.selectExpr("*", f"CAST({bits._power7(f'({res}) - {bits.resolution(cell)}')} AS INT) AS {o}n",
                         f"{bits.is_pentagon(cell)} AS {o}pent", f"{bits.center_child(cell, res)} AS {o}first")
    numbers = f"sequence(0, {o}n - 1)"
    octal = bits._octal_of_base7(f"{o}i", 8)
    present = f"filter({numbers}, {o}i -> {bits.leading_digit(f'CAST({octal} AS BIGINT)')} <> 1)"
    wide = wide.selectExpr("*", f"explode(CASE WHEN {o}pent THEN {present} ELSE {numbers} END) AS {o}i")
    return wide.selectExpr(*kept, f"{o}first | shiftleft(CAST({octal} AS BIGINT), 3 * ({MAX_RES} - ({res}))) AS `{out}`")


def center_children(df: DataFrame, cell="cell", res=None, out="child") -> DataFrame:
    return run(df, [], {out: f"CASE WHEN {bits.is_valid_cell(cell)} THEN {bits.center_child(cell, res)} END"})


def children_counts(df: DataFrame, cell="cell", res=None, out="n_children") -> DataFrame:
    return run(df, [], {out: f"CASE WHEN {bits.is_valid_cell(cell)} THEN {bits.children_count(cell, res)} END"})


def child_positions(df: DataFrame, cell="cell", res=0, out="position") -> DataFrame:
    """Ordinal of each cell among its ancestor's descendants."""
    steps, result = scoped(*bits.child_position(cell, res))
    ok = f"{bits.is_valid_cell(cell)} AND {res} BETWEEN 0 AND {bits.resolution(cell)}"
    return run(df, steps, {out: f"CASE WHEN {ok} THEN {result} END"})


def cells_at_positions(df: DataFrame, position="position", parent="parent", res=None, out="cell") -> DataFrame:
    steps, result = scoped(*bits.child_at(parent, position, res))
    ok = f"{bits.is_valid_cell(parent)} AND {res} BETWEEN {bits.resolution(parent)} AND {MAX_RES}"
    return run(df, steps, {out: f"CASE WHEN {ok} THEN {result} END"})


def _keyed(df, cell, by):
    """The sets as (keys..., cell); without keys the whole table is one set."""
    rows = df.select(*by, F.expr(cell).alias("cell"))
    return (rows, list(by)) if by else (rows.withColumn("_set", F.lit(0)), ["_set"])


def compact_table(df: DataFrame, cell="cell", by=()) -> DataFrame:
    """Smallest mixed-resolution cover of each set of cells (keys ``by``).

    A set must hold distinct valid cells of one resolution; a set that does not gives
    no rows (a NULL result in the function form).  Work does not depend on how the
    rows spread over sets:

    1. siblings meet in one aggregation on (set, parent), as a bit mask; incomplete
       families are given back from the mask, complete ones go on as the parent;
    2. an ancestor is covered when it has as many covered descendants as it can have,
       so one aggregation of the (at most N/7) full parents over their ancestors finds
       every covered cell, and an anti join on the parent keeps the largest ones.
    """
    rows, keys = _keyed(tuned(df), cell, by)
    res = bits.resolution("cell")
    rows = rows.selectExpr("*", f"CASE WHEN {bits.is_valid_cell('cell')} THEN {res} ELSE -1 END AS _r")
    family = rows.selectExpr(
        *keys, "_r", f"CASE WHEN _r > 0 THEN {bits.parent('cell', f'({res} - 1)')} ELSE cell END AS _p",
        f"CASE WHEN _r > 0 THEN shiftleft(1, CAST(shiftrightunsigned(cell, 3 * ({MAX_RES} - _r)) & 7 AS INT)) "
        f"ELSE 1 END AS _bit")
    family = family.groupBy(*keys, "_p", "_r").agg(F.bit_or("_bit").alias("_m"), F.count(F.lit(1)).alias("_n"))
    flawed = (family.groupBy(*keys)
              .agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"),
                   F.max(F.expr("_n > bit_count(_m)")).alias("_dup"))
              .filter("_lo < 0 OR _lo < _hi OR _dup").select(*keys))
    family = _without(family, flawed, keys)
    full = f"_r > 0 AND _m = CASE WHEN {bits.is_pentagon('_p')} THEN 125 ELSE 127 END"
    single = family.filter(f"NOT ({full})").selectExpr(
        *keys, "_p", "_r", "explode(filter(sequence(0, 6), d -> shiftright(_m, d) & 1 = 1)) AS _d").selectExpr(
        *keys, f"CASE WHEN _r = 0 THEN _p ELSE (_p & ~{bits.RES_MASK}L & ~shiftleft(7L, 3 * ({MAX_RES} - _r))) "
               f"| shiftleft(CAST(_r AS BIGINT), 52) | shiftleft(CAST(_d AS BIGINT), 3 * ({MAX_RES} - _r)) END AS cell")
    parents = family.filter(full).selectExpr(*keys, "_p", "_r - 1 AS _r")
    up = parents.selectExpr(*keys, "_p", "_r", "explode(sequence(0, _r)) AS _a").selectExpr(
        *keys, "_r", f"{bits.parent('_p', '_a')} AS _q")
    covered = (up.groupBy(*keys, "_q", "_r").agg(F.count(F.lit(1)).alias("_n"))
               .filter(f"_n = {bits.children_count('_q', '_r')}").select(*keys, "_q"))
    above = covered.selectExpr(*[f"{k} AS _k{n}" for n, k in enumerate(keys)], "_q AS _above")
    same = F.expr(" AND ".join(f"{k} <=> _k{n}" for n, k in enumerate(keys))
                  + f" AND {bits.parent('_q', bits.resolution('_q') + ' - 1')} = _above")
    largest = covered.join(above, same, "left_anti").selectExpr(*keys, "_q AS cell")
    return single.unionByName(largest).select(*by, "cell")


SALTS = 64


def _without(df, bad, keys):
    """The rows of sets not named in ``bad`` (one row a set).  Each bad set stands in every
    salt and a row looks in its own, so a set of half of all rows meets in many tasks."""
    salted = df.withColumn("_salt", F.expr(f"pmod(xxhash64({', '.join(f'`{c}`' for c in df.columns)}), {SALTS})"))
    bad = bad.select(*[F.col(k).alias(f"_b{n}") for n, k in enumerate(keys)],
                     F.expr(f"explode(sequence(0L, {SALTS - 1}L))").alias("_bsalt"))
    same = [f"{k} <=> _b{n}" for n, k in enumerate(keys)] + ["_salt = _bsalt"]
    return salted.join(bad, F.expr(" AND ".join(same)), "left_anti").drop("_salt")


def uncompact_table(df: DataFrame, cell="cell", res=None, by=()) -> DataFrame:
    """Single-resolution cells of each mixed-resolution set.  A set with an invalid
    cell or one finer than ``res`` gives no rows (NULL in the function form)."""
    rows, keys = _keyed(df, cell, by)
    wrong = f"NOT coalesce({bits.is_valid_cell('cell')}, false) OR {bits.resolution('cell')} > {res} OR {res} > {MAX_RES}"
    bad = rows.filter(wrong).select(*keys).distinct()
    return drilldown_cells(_without(rows, bad, keys), "cell", res, "cell").select(*by, "cell")


def on_arrays(df: DataFrame, column, job, out) -> DataFrame:
    """Run a set job on an array column: the elements of each row are one set.

    ``job(table)`` gets (_row, cell) and returns rows of (_row, cell).  The result is
    NULL where the job drops a non-empty set, and empty for an empty array.  Sets are
    known by a digest of their elements, which a retried or reordered task computes
    alike; equal arrays are worked on once.
    """
    tagged = df.withColumn("_row", F.expr(f"sha2(CAST({column} AS STRING), 256)"))
    sets = tagged.selectExpr("_row", f"{column} AS _set_of").dropDuplicates(["_row"]).selectExpr("_row", "explode(_set_of) AS cell")
    done = job(sets).groupBy("_row").agg(F.sort_array(F.collect_list("cell")).alias("_cells"))
    return (tagged.join(done, "_row", "left")
            .withColumn(out, F.expr(f"CASE WHEN size({column}) = 0 THEN CAST(array() AS array<bigint>) ELSE _cells END"))
            .drop("_row", "_cells"))
