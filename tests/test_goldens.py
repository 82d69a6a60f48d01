"""Known values of the grid."""
import pytest
from pyspark.sql import functions as F

from hexatlas.functions import bits, sql
from hexatlas.operators import audit, hierarchy, indexing, polyfill, topology, traversal
from hexatlas.sources import polygons


def cells(spark, *texts, name="cell"):
    return spark.createDataFrame([(t,) for t in texts], "hex string").selectExpr("hex", f"{bits.parse_hex('hex')} AS {name}")


def hexes(df, column):
    return [r[0] for r in df.selectExpr(bits.to_hex(column)).collect()]


def test_index_points(spark):
    df = spark.sql("SELECT * FROM VALUES (37.7752702151959D, -122.418307270836D, 9), (0D, 0D, 1), (0D, 0D, -1), "
                   "(CAST(NULL AS DOUBLE), 0D, 1) t(lat, lng, res)")
    assert hexes(indexing.index_points(df, res="res"), "cell") == ["8928308280fffff", "81757ffffffffff", None, None]


def test_centroid(spark):
    r = indexing.cell_centroids(cells(spark, "85283473fffffff")).first()
    assert r.lat == pytest.approx(37.34579337536848, abs=1e-12)
    assert r.lng == pytest.approx(-121.9763759725512, abs=1e-12)


def test_boundary_and_area(spark):
    df = indexing.cell_areas(indexing.cell_outlines(cells(spark, "822d57fffffffff")))
    r = df.selectExpr(f"{polygons.outline_text('outline')} AS wkt", "area").first()
    assert r.wkt == ("POLYGON ((38.777546 44.198571, 39.938746 42.736298, 42.150674 42.631271, 43.258395 44.047542, "
                     "42.146575 45.539505, 39.897167 45.559577, 38.777546 44.198571))")
    assert r.area == pytest.approx(85321.69572540345, rel=1e-9)


def test_faces(spark):
    got = indexing.icosahedron_faces(cells(spark, "85283473fffffff", "801dfffffffffff", "7fffffffffffffff")).collect()
    assert [r.faces for r in got] == [[7], [1, 2, 6, 7, 11], None]


def test_edges(spark):
    edges = cells(spark, "115283473fffffff", "165283473fffffff", "0", name="edge")
    got = indexing.edge_lengths(topology.reverse_edges(topology.edge_ends(edges))).collect()
    assert got[0].length == pytest.approx(10.294736086198531, rel=1e-9)
    assert got[1].length == pytest.approx(10.302930275179133, rel=1e-9)
    assert got[2].length is None and got[2].origin is None
    assert f"{got[1].destination:x}" == "85283447fffffff" and f"{got[1].reverse:x}" == "115283447fffffff"


def test_vertices(spark):
    got = topology.cell_vertices(cells(spark, "823d6ffffffffff")).orderBy("n")
    assert hexes(got, "vertex") == ["2222597fffffffff", "2523d47fffffffff", "2423d47fffffffff", "21224b7fffffffff",
                                    "20224b7fffffffff", "2322597fffffffff"]
    r = topology.vertex_points(cells(spark, "2222597fffffffff", "823d6ffffffffff", name="vertex")).collect()
    assert (round(r[0].lat, 12), round(r[0].lng, 12)) == (39.380842841818, 88.574962137855)
    assert r[1].lat is None


def test_disk_round_a_pentagon(spark):
    disk = traversal.disk_expand(cells(spark, "8408001ffffffff"), k=2, min_res=4)
    assert [r["count"] for r in disk.groupBy("ring").count().orderBy("ring").collect()] == [1, 5, 10]
    assert traversal.disk_expand(cells(spark, "8408001ffffffff"), k=1, policy="null", min_res=4).count() == 0


def test_path_distance_local(spark):
    pair = cells(spark, "86584e9afffffff", name="a").crossJoin(cells(spark, "8658412c7ffffff", name="b").drop("hex"))
    path = traversal.path_expand(pair).orderBy("step")
    assert hexes(path, "member") == ["86584e9afffffff", "86584e91fffffff", "86584e907ffffff", "86584e92fffffff",
                                     "8658412d7ffffff", "8658412c7ffffff"]
    assert traversal.pair_distances(pair).first().distance == 5
    here = cells(spark, "8658412cfffffff", name="origin")
    assert tuple(traversal.local_coordinates(here, "origin", "origin").select("i", "j").first()) == (-123, -177)
    assert hexes(traversal.local_cells(here.selectExpr("*", "-123 AS i", "-177 AS j")), "cell") == ["8658412cfffffff"]


BOX = ("POLYGON ((-122.53401215374411 37.81666158907579, -122.53401215374411 37.70454536656959, "
       "-122.3479361380842 37.70454536656959, -122.3479361380842 37.81666158907579, -122.53401215374411 37.81666158907579))")


@pytest.mark.parametrize("mode, n", [("center", 5), ("CONTAINMENT_FULL", 2), ("overlap", 12), ("overlap_bbox", 18), ("AAA", 0)])
def test_polyfill_modes(spark, mode, n):
    df = spark.createDataFrame([(BOX,)], "wkt string")
    assert polyfill.polyfill(df, "wkt", 6, mode).count() == n


def test_polygon_text(spark):
    df = spark.createDataFrame([("POLYGON",), ("POINT (1 2)",), ("POLYGON EMPTY",), ("POLYGON ((0 0, 1 0 , 1 1)  ,(0 0,1 1,2 2))",),
                                ("POLYGON (xx(0 0))",), ("POLYGON ((0 0, xx 1))",), ("POLYGON ((0 0, 1 1) (2 2))",)], "wkt string")
    got = [r.rings for r in polygons.read_wkt(df, on_error="null").collect()]
    assert [None if g is None else len(g) for g in got] == [0, 0, 0, 2, None, None, None]
    with pytest.raises(Exception, match="Invalid polygon text"):
        polygons.read_wkt(df).collect()


def test_assemble_and_audit(spark):
    df = spark.sql("SELECT base, CAST(d AS ARRAY<INT>) AS digits FROM VALUES (0, array()), (5, array(1)), (4, array(1)), (-1, array()) t(base, d)")
    assert [r.cell for r in audit.assemble_cells(df).collect()] == [576495936675512319, 581149069884260351, None, None]
    flags = audit.audit_index(cells(spark, "85283473fffffff", "1234", "115283473fffffff", "2222597fffffffff"), vertices=True)
    assert [r.is_valid_index for r in flags.collect()] == [True, False, True, True]


def test_compact_arrays(spark):
    df = spark.sql("SELECT transform(sequence(0, 6), d -> 590768765835149311 + d * 68719476736) AS cells "
                   "UNION ALL SELECT CAST(array() AS ARRAY<BIGINT>) UNION ALL SELECT array(1L)")
    got = hierarchy.on_arrays(df, "cells", lambda t: hierarchy.compact_table(t, by=["_row"]), "out").collect()
    assert sorted(str(r.out) for r in got) == ["None", "[586265647244115967]", "[]"]


def test_sql_functions(spark):
    sql.register(spark, "t_")
    r = spark.sql("SELECT t_get_num_cells(5), t_get_num_cells(-1), size(t_get_pentagons(5)), t_great_circle_distance(5, 5, 15, 15, 'km'), "
                  "t_string_to_index('zz'), t_is_valid_cell(t_string_to_index('85283473fffffff'))").first()
    assert tuple(r)[:3] == (2016842, None, 12) and r[3] == pytest.approx(1559.5386031690684) and r[4] is None and r[5]


def test_average_areas(spark):
    from hexatlas.operators import dimensions
    r = {x.res: x for x in dimensions.resolution_stats(spark).collect()}
    assert r[0].area_avg_km2 == pytest.approx(4357449.416078383, rel=1e-9)
    assert r[1].area_avg_m2 == pytest.approx(609788441794.1339, rel=1e-9)
    assert r[5].num_cells == 2016842
