"""Whole-grid properties and brute force."""
import pytest
from pyspark.sql import functions as F

from hexatlas.operators import dimensions, hierarchy, indexing, topology, traversal


def test_centres_index_back(spark):
    cells = indexing.cell_centroids(dimensions.grid_cells(spark, 3))
    back = indexing.index_points(cells, res=3, out="again")
    assert back.filter("cell = again").count() == 2 + 120 * 7 ** 3


def test_neighbours_are_mutual_and_pairs_find_them(spark):
    edges = topology.adjacency_edges(dimensions.grid_cells(spark, 1), "cell", res=1).select("cell", "edge", "destination").cache()
    assert edges.count() == 6 * 842 - 12
    back = edges.alias("x").join(edges.alias("y"), F.expr("x.cell = y.destination AND x.destination = y.cell"))
    assert back.count() == edges.count()
    assert topology.pair_edges(edges.selectExpr("cell AS a", "destination AS b", "edge AS want")).filter("edge = want").count() == edges.count()


def test_disk_equals_breadth_first_search(spark):
    grid = dimensions.grid_cells(spark, 2)
    fast = traversal.disk_expand(grid, k=3, min_res=2).select("cell", "ring", "member")
    steps = topology.adjacency_edges(grid, "cell", res=2).selectExpr("cell AS _c", "destination").cache()
    reached = grid.selectExpr("cell", "cell AS member", "0 AS ring")
    for n in range(3):
        hop = reached.filter(f"ring = {n}").join(steps, F.expr("member = _c")).selectExpr("cell", "destination AS member", f"{n + 1} AS ring")
        reached = reached.unionByName(hop).groupBy("cell", "member").agg(F.min("ring").alias("ring")).cache()
    assert fast.count() == reached.count() == fast.join(reached, ["cell", "ring", "member"]).count()


def test_wide_disk_on_a_coarse_grid(spark):
    """Over more than one pentagon: rounds of joins."""
    one = dimensions.base_cells(spark).filter("(shiftright(cell, 45) & 127) = 0")
    assert traversal.disk_expand(one, k=9).count() == 122


def test_areas_cover_the_sphere(spark):
    total = indexing.cell_areas(dimensions.grid_cells(spark, 1), unit="rads^2").agg(F.sum("area")).first()[0]
    assert abs(total - 12.566370614359172) < 1e-9


def test_children_round_trip(spark):
    kids = hierarchy.drilldown_cells(dimensions.base_cells(spark), res=2)
    assert kids.select("child").distinct().count() == 5882
    packed = hierarchy.compact_table(kids.selectExpr("child AS cell"))
    assert packed.count() == 122
    assert hierarchy.uncompact_table(packed, res=2).count() == 5882


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "cells")
    dimensions.grid_cells(spark, 2).sort("cell").write.parquet(path)
    top = dimensions.base_cells(spark).filter("(shiftright(cell, 45) & 127) = 20").first().cell
    df = spark.read.parquet(path).filter(hierarchy.descendant_filter("cell", top, 2))
    assert df.count() == 49
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(cell" in plan


def test_wide_disks_without_pentagons_are_kept(spark):
    """From a face centre the nearest pentagon is further than the bound for two pentagons in a disk; counts are 1 + 3k(k + 1)."""
    cells = spark.createDataFrame([(int("829607fffffffff", 16),)], "cell long")
    for k, n in ((11, 397), (12, 469), (13, 547)):
        assert traversal.disk_expand(cells, k=k, policy="null").select("member").distinct().count() == n
        assert traversal.disk_expand(cells, k=k, policy="null", only_ring=True).count() == 6 * k


def test_min_res_never_loses_rows(spark):
    cells = spark.createDataFrame([(0x8001fffffffffff,)], "cell long")
    assert traversal.disk_expand(cells, k=2).count() == 18
    with pytest.raises(Exception, match="coarser than min_res"):
        traversal.disk_expand(cells, k=2, min_res=6).count()


def test_rollup_keeps_keys_that_are_no_cells_apart(spark):
    good, junk, coarse = 0x85283473fffffff, 12345, 0x8029fffffffffff
    df = spark.createDataFrame([(good,), (good,), (junk,), (coarse,), (None,)], "cell long")
    got = hierarchy.rollup_cells(df, [F.count(F.lit(1)).alias("n")], res=3).collect()
    assert {r.cell: r.n for r in got} == {0x832834fffffffff: 2, None: 3}


def test_array_form_by_content(spark):
    top = 0x85283473fffffff
    kids = [r.child for r in hierarchy.drilldown_cells(spark.createDataFrame([(top,)], "cell long"), res=6).collect()]
    df = spark.createDataFrame([(1, kids), (2, kids), (3, kids[:2]), (4, []), (5, [kids[0], kids[0]]), (6, None)], "k int, cells array<bigint>")
    job = lambda t: hierarchy.compact_table(t, by=["_row"])
    got = {r.k: r.out for r in hierarchy.on_arrays(df, "cells", job, "out").collect()}
    assert got == {1: [top], 2: [top], 3: sorted(kids[:2]), 4: [], 5: None, 6: None}
