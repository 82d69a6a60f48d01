"""Cell sets to polygons: holes and their outlines, empty and flawed sets."""
from pyspark.sql import functions as F

from hexatlas.operators import dissolve, indexing, traversal


def test_nested_rings_find_their_outlines(spark):
    """A ring of cells round a ring of cells, twice in one set; a lone cell; a set without holes; a flawed set."""
    spots = spark.createDataFrame([(1, 40.0, -100.0), (1, 10.0, 20.0), (None, 41.0, -101.0), (2, 41.0, -101.0), (3, 41.0, -101.0)],
                                  "s int, lat double, lng double")
    tops = indexing.index_points(spots, res=6).select("s", "cell")
    wide = traversal.disk_expand(tops, k=6, min_res=6).selectExpr("s", "cell AS centre", "member AS cell", "ring")
    held = wide.filter("CASE WHEN s = 1 OR s IS NULL THEN ring IN (1, 2, 4, 6) OR ring = 0 AND s IS NULL ELSE ring < 2 END").select("s", "cell")
    rows = held.unionByName(spark.createDataFrame([(3, 7)], "s int, cell long"))
    got = {r.s: sorted(tuple(len(g) for g in p) for p in r.polygons) for r in dissolve.dissolve_cells(rows, by=["s"], res=6).collect()}
    rings = [(30, 6), (54, 42), (78, 66)]
    assert got == {1: sorted(rings * 2), None: [(30,), (54, 42), (78, 66)], 2: [(18,)]}


def test_components_of_a_long_chain_and_of_lone_cells(spark):
    top = indexing.index_points(spark.createDataFrame([(40.0, -100.0)], "lat double, lng double"), res=6).select("cell")
    cells = traversal.disk_expand(top, k=9, min_res=6).filter("ring IN (0, 3, 5, 6, 9)").selectExpr("1 AS s", "member AS cell", "ring")
    found = {r.cell: r.component for r in dissolve.cell_components(cells, ["s"], 6).collect()}
    want = {}
    for r in cells.collect():
        want.setdefault({0: 0, 3: 3, 5: 5, 6: 5, 9: 9}[r.ring], []).append(r.cell)
    del want[0]  # has no neighbour
    assert found == {c: min(part) for part in want.values() for c in part}


def test_empty_and_flawed_arrays(spark):
    top = indexing.index_points(spark.createDataFrame([(40.0, -100.0)], "lat double, lng double"), res=6).first().cell
    rows = spark.createDataFrame([(0, [top]), (1, []), (2, [0]), (3, [None]), (4, None), (5, [top, top]), (6, [top])], "k int, cells array<long>")
    text = dissolve.polygons_as(dissolve.dissolve_arrays(rows, "cells", res=6), text="wkt").select("k", F.col("wkt"))
    got = {r.k: r.wkt for r in text.collect()}
    assert got[0] == got[6] and got[0].startswith("MULTIPOLYGON (((") and got[1] == "MULTIPOLYGON EMPTY"
    assert [got[k] for k in (2, 3, 4, 5)] == [None] * 4
