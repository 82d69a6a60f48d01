"""Unsafe disks and rings as table functions: the table job's rows, by projections and not by lambdas."""
from hexatlas.functions import sql
from hexatlas.functions.steps import Inline
from hexatlas.operators import dimensions, topology, traversal

ROWS = ("grid_ring_unsafe_rows", "grid_disk_unsafe_rows")


def test_unsafe_rows_are_those_of_the_table_job(spark):
    sql.register(spark, "ur_", ROWS)
    pents = dimensions.pentagon_cells(spark).where("res IN (3, 6)").select("cell")
    near = topology.adjacency_edges(pents).selectExpr("destination AS cell")
    next_ = topology.adjacency_edges(near).selectExpr("destination AS cell")
    far = spark.sql("SELECT * FROM VALUES (599686042433355775L), (CAST(NULL AS BIGINT)), (5L), (1608492358964346879L) AS t(cell)")
    cells = pents.unionByName(near).unionByName(next_).unionByName(far).selectExpr("cell", "CASE WHEN cell % 9 <> 4 THEN CAST(cell % 5 - 1 AS INT) END AS k")
    cells = cells.union(cells.limit(40)).cache()
    for name, only in zip(ROWS, (True, False)):
        got = spark.sql(f"SELECT c.cell, c.k, d.ring, d.member FROM {{c}} c, LATERAL ur_{name}(c.cell, c.k) d", c=cells)
        want = traversal.disk_expand(cells.where("k >= 0"), "cell", "k", "null", only).select("cell", "k", "ring", "member")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert got.count() > 100


def test_unsafe_rows_run_as_generated_code(spark):
    sql.register(spark, "ur_", ROWS)
    cells = spark.sql("SELECT 599686042433355775L AS cell")
    plan = spark.sql("SELECT member FROM {c}, LATERAL ur_grid_ring_unsafe_rows(cell, 2)", c=cells)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_max(" not in plan
    assert spark.sql("SELECT member FROM ur_grid_ring_unsafe_rows(599686042433355775L, 2)").count() == 12


def test_a_pair_of_cells_is_rounded_to_the_lattice_once():
    digit = topology.pair_edges(Inline("a", "b"), "a", "b", "edge", "adjacent").value("edge")
    assert digit.count("floor(") == 3
