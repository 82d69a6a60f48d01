"""Functions by name and as Column expressions against the table jobs, round pentagons too."""
import pytest
from pyspark.sql import functions as F

from hexatlas.functions import bits, sql
from hexatlas.operators import dimensions, hierarchy, indexing, polyfill, topology, traversal


USED = {"cell_to_lat", "cell_to_lng", "cell_to_latlng", "cell_area", "cell_to_boundary_wkt", "cell_to_boundary_wkb", "get_icosahedron_faces",
        "latlng_to_cell", "latlng_to_cell_string", "grid_disk", "grid_disk_distances", "grid_ring", "grid_disk_unsafe", "grid_distance",
        "cells_to_directed_edge", "are_neighbor_cells", "get_hexagon_area_avg", "get_hexagon_edge_length_avg", "get_res0_cells_string",
        "construct_cell_string", "get_pentagons_string", "grid_disk_rows", "cell_to_children"}


@pytest.fixture(scope="module", autouse=True)
def cells(spark):
    """Pentagons and their neighbours at two resolutions, cells far from any, an edge's bits, nulls and nonsense."""
    sql.register(spark, "fn_", USED)
    pents = dimensions.pentagon_cells(spark).where("res IN (3, 6)").select("cell")
    near = topology.adjacency_edges(pents).selectExpr("destination AS cell")
    far = spark.range(40).selectExpr("id * 4.1D - 80 AS lat", "id * 8.7D - 170 AS lng")
    far = indexing.index_points(far, res=5).select("cell")
    odd = spark.sql("SELECT * FROM VALUES (CAST(NULL AS BIGINT)), (0L), (-1L), (5L), (1608492358964346879L) AS t(cell)")
    return pents.unionByName(near).unionByName(far).unionByName(odd).distinct().cache()


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def lists(df, key, value):
    """(key, sorted values) of keys that have rows."""
    return rows(df.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias("v")).select(key, "v"))


def called(df, text, *keep):
    return df.selectExpr(*(keep or ["cell"]), f"{text} AS v")


def test_centres_outlines_and_measures(cells):
    both = indexing.cell_centroids(indexing.cell_areas(cells, unit="m^2"))
    assert rows(both.selectExpr("cell", "lat", "lng", "area")) == rows(cells.selectExpr(
        "cell", "fn_cell_to_lat(cell)", "fn_cell_to_lng(cell)", "fn_cell_area(cell, 'm^2')"))
    assert rows(both.selectExpr("CASE WHEN lat IS NOT NULL THEN array(lat, lng) END")) == rows(cells.selectExpr("fn_cell_to_latlng(cell)"))
    from hexatlas.sources.polygons import outline_binary, outline_text
    shapes = indexing.cell_outlines(cells).selectExpr("cell", outline_text("outline"), f"hex({outline_binary('outline')})")
    assert rows(shapes) == rows(cells.selectExpr("cell", "fn_cell_to_boundary_wkt(cell)", "hex(fn_cell_to_boundary_wkb(cell))"))
    assert rows(indexing.icosahedron_faces(cells)) == rows(called(cells, "fn_get_icosahedron_faces(cell)"))
    assert called(cells, "fn_cell_area(cell, 'furlong')").where("v IS NOT NULL").count() == 0


def test_points(spark):
    points = spark.sql("SELECT id, id * 1.7D - 85 AS lat, id * 3.57D - 180 AS lng, CAST(id % 18 - 1 AS INT) AS res FROM range(100)")
    got = points.selectExpr("id", "fn_latlng_to_cell(lat, lng, res) AS cell", "fn_latlng_to_cell_string(lat, lng, res) AS hex")
    job = indexing.index_points(points, res="res")
    assert rows(job.selectExpr("id", "cell", f"{bits.to_hex('cell')}")) == rows(got)
    assert rows(job.select("id", "cell")) == rows(points.select("id", sql.column("latlng_to_cell", "lat", "lng", "res")))


def test_disks_and_rings(cells):
    valid = cells.where(bits.is_valid_cell("cell"))
    for k in (2,):
        disk = traversal.disk_expand(valid, k=k, min_res=3)
        got = called(cells, f"fn_grid_disk(cell, {k})")
        assert lists(disk, "cell", "member") == rows(got.where("v IS NOT NULL").selectExpr("cell", "sort_array(v)"))
        assert got.where("v IS NULL").count() == cells.count() - valid.count()
        by_ring = called(cells, f"fn_grid_disk_distances(cell, {k})").selectExpr("cell", "posexplode(v) AS (ring, m)").selectExpr("cell", "ring", "explode(m) AS member")
        assert rows(disk.select("cell", "ring", "member")) == rows(by_ring)
        ring = called(cells, f"fn_grid_ring(cell, {k})").where("v IS NOT NULL")
        assert lists(traversal.disk_expand(valid, k=k, only_ring=True, min_res=3), "cell", "member") == rows(ring.selectExpr("cell", "sort_array(v)"))
        safe = lists(traversal.disk_expand(valid, k=k, policy="null"), "cell", "member")
        unsafe = called(cells, f"fn_grid_disk_unsafe(cell, {k})").where("v IS NOT NULL")
        assert safe == rows(unsafe.selectExpr("cell", "sort_array(v)")) and len(safe) < valid.count()
    assert called(cells, "fn_grid_disk(cell, -1)").where("v IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="disk_expand"):
        called(valid, "fn_grid_disk(cell, 100)").collect()


def test_pairs(cells):
    pairs = traversal.disk_expand(cells.where(bits.is_valid_cell("cell")), k=2, min_res=3).selectExpr("cell AS a", "member AS b")
    odd = cells.sparkSession.sql("SELECT * FROM VALUES (5L, 5L), (CAST(NULL AS BIGINT), 599686042433355775L), "
                                 "(599686042433355775L, 577199624117288959L) AS t(a, b)")
    pairs = pairs.unionByName(odd).distinct().cache()
    assert rows(traversal.pair_distances(pairs)) == rows(called(pairs, "fn_grid_distance(a, b)", "a", "b"))
    assert rows(topology.pair_edges(pairs)) == rows(pairs.selectExpr("a", "b", "fn_cells_to_directed_edge(a, b)", "fn_are_neighbor_cells(a, b)"))


def test_grid_tables(spark):
    stats = {r["res"]: r for r in dimensions.resolution_stats(spark).collect()}
    for r in spark.sql("SELECT CAST(id AS INT) AS res, fn_get_hexagon_area_avg(CAST(id AS INT), 'm^2') AS m2, "
                       "fn_get_hexagon_edge_length_avg(CAST(id AS INT), 'm') AS m FROM range(-1, 17)").collect():
        if r.res in stats:
            assert r.m2 == pytest.approx(stats[r.res]["area_avg_m2"], rel=1e-9) and r.m == pytest.approx(stats[r.res]["edge_avg_m"])
        else:
            assert r.m2 is None and r.m is None
    one = spark.sql("SELECT fn_get_hexagon_area_avg(0, 'rads^2') a, size(fn_get_res0_cells_string()) n, fn_construct_cell_string(5, array(1)) c, "
                    "fn_get_pentagons_string(20) p").first()
    assert (one.a, one.n, one.c, one.p) == (None, 122, "810a7ffffffffff", None)


def test_calls_stand_anywhere_without_a_shuffle(spark):
    found = spark.sql("""SELECT id, member FROM (SELECT id, fn_latlng_to_cell(id * 1D, id * 2D, 7) AS c FROM range(20)),
        LATERAL fn_grid_disk_rows(c, 1) WHERE fn_cell_to_lat(member) > 5 AND fn_latlng_to_cell(id * 1D, id * 2D, 2) > 0""")
    assert found.count() > 90
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(TypeError):
        sql.column("grid_disk", "c")


def test_point_to_children_to_outlines_and_back(spark, tmp_path):
    """Point to cell, children, outlines, filled one level down (seven cells each), compacted to the point's cell."""
    top = spark.sql("SELECT fn_latlng_to_cell(51.477928D, -0.001545D, 5) AS top")
    kids = top.selectExpr("top", "fn_cell_to_children(top, 6) AS kids").selectExpr("top", "explode(kids) AS kid")
    kids.selectExpr("top", "kid", "fn_cell_to_boundary_wkt(kid) AS wkt").write.parquet(f"{tmp_path}/kids")
    polyfill.polyfill(spark.read.parquet(f"{tmp_path}/kids"), "wkt", 7).select("kid", "cell").write.parquet(f"{tmp_path}/filled")
    filled = spark.read.parquet(f"{tmp_path}/filled")
    per_kid = filled.groupBy("kid").agg(F.count("*").alias("n"), F.min("cell").alias("low"), F.max("cell").alias("high")).collect()
    assert len(per_kid) == 7 and all(r.n == 7 and hierarchy.descendant_filter("x", r.kid, 7) == f"x BETWEEN {r.low}L AND {r.high}L" for r in per_kid)
    assert rows(hierarchy.compact_table(filled.select("cell"))) == rows(top)
