"""Cells against covers of mixed resolution."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits
from ..functions.steps import fresh


def lookup_cells(df: DataFrame, covers: DataFrame, cell="cell", cover="cover", res=None) -> DataFrame:
    """One row per row of ``df`` and row of ``covers`` whose cell is the row's own or an ancestor of it:
    columns of ``df``, then of ``covers``.

    A cell has one ancestor per resolution, so containment is an equi-join on the ancestors at the
    resolutions that the covers hold (at most 16, found when the join is planned): a compact cover is never
    unfolded.  ``res``, the one resolution of ``df``'s cells, lets the scan of ``df`` be pruned: covers
    are summed up as one range of descendants per base cell, at most 122, and the ranges are a filter that
    reaches the files.  Invalid cells match nothing; columns of both tables must differ in name.
    """
    both = {c.lower() for c in df.columns} & {c.lower() for c in covers.columns}
    if both:
        raise ValueError(f"columns of both tables: {sorted(both)}")
    held = covers.filter(bits.is_valid_cell(cover))
    level = bits.resolution(cover)
    if res is None:
        levels = [r[0] for r in held.selectExpr(f"CAST({level} AS INT) AS r").distinct().collect()]
        rows = df.filter(bits.is_valid_cell(cell))
    else:
        held = held.filter(f"{level} <= {res}")
        known = (held.selectExpr(f"{bits.base_cell(cover)} AS b", f"CAST({level} AS INT) AS r",
                                 f"{bits.first_child(cover, res)} AS lo", f"{bits.last_child(cover, res)} AS hi")
                 .groupBy("b").agg(F.collect_set("r"), F.min("lo"), F.max("hi")).collect())
        levels = {r for row in known for r in row[1]}
        ranges = " OR ".join(f"{cell} BETWEEN {row[2]}L AND {row[3]}L" for row in known)
        rows = df.filter(ranges or "false").filter(bits.is_valid_cell(cell))
    o = fresh("lk")
    if not levels:
        rows, levels = rows.filter("false"), [0]
    choices = ", ".join(f"CASE WHEN {bits.resolution(cell)} >= {r} THEN {bits.parent(cell, r)} END" for r in sorted(levels))
    rows = rows.selectExpr("*", f"explode(array_compact(array({choices}))) AS {o}up")
    return rows.join(held, F.expr(f"{o}up = {cover}")).drop(f"{o}up")


def rollup_in_covers(df: DataFrame, covers: DataFrame, aggregates, merges, by=(), cell="cell", cover="cover", res=None) -> DataFrame:
    """Aggregate the rows of ``df`` in each set of covers (keys ``by``, columns of ``covers``).

    Many sets may hold one cell: each different cell of the covers meets the rows once, by
    ``lookup_cells``, and is aggregated; the sets then meet those aggregates, which ``merges`` combine
    column by column.  Work grows with rows plus covers, not with rows times the sets over them.
    """
    held = lookup_cells(df, covers.select(cover).distinct(), cell, cover, res).groupBy(cover).agg(*aggregates)
    return covers.select(*by, cover).join(held, cover).groupBy(*by).agg(*merges)
