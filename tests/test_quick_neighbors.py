"""Calls by name take one step by adding digits; the whole geometry is for what that leaves open."""
from hexatlas.functions import bits, shapes, sql
from hexatlas.operators import hierarchy, topology, traversal


def _grid(spark, res):
    base = spark.range(122).selectExpr(f"{bits.res0_cell('id')} AS base")
    return hierarchy.drilldown_cells(base, "base", res, "cell").select("cell")


def test_digit_steps_are_the_neighbours_and_leave_few_open(spark):
    edges = topology.adjacency_edges(_grid(spark, 3)).selectExpr(
        "destination", f"{shapes.step_inside('cell', bits.reserved('edge'))} AS quick")
    n, left, wrong = edges.selectExpr("count(*)", "count_if(quick IS NULL)", "count_if(quick <> destination)").first()
    assert n == 246960 and wrong == 0 and left < n / 10


def test_calls_by_name_equal_the_table_jobs_on_a_whole_grid(spark):
    names = ("get_directed_edge_destination", "reverse_directed_edge", "grid_distance", "directed_edge_rows")
    sql.register(spark, "qn_", names)
    edges = topology.reverse_edges(topology.adjacency_edges(_grid(spark, 2)), "edge", "rev").cache()
    wrong = spark.sql("SELECT count(*), count_if(NOT (qn_get_directed_edge_destination(edge) <=> destination)), "
                      "count_if(NOT (qn_reverse_directed_edge(edge) <=> rev)), "
                      "count_if(NOT (qn_grid_distance(cell, destination) <=> 1)) FROM {e}", e=edges).first()
    assert tuple(wrong) == (35280, 0, 0, 0)
    rows = spark.sql("SELECT c.cell, d.edge, d.destination FROM {c} c, LATERAL qn_directed_edge_rows(c.cell) d", c=_grid(spark, 2))
    assert rows.exceptAll(edges.select("cell", "edge", "destination")).isEmpty() and rows.count() == 35280
    cells = _grid(spark, 2)
    pairs = cells.selectExpr("cell AS a").crossJoin(cells.where("pmod(hash(cell), 700) = 1").selectExpr("cell AS b"))
    pairs = traversal.pair_distances(pairs, "a", "b", "d")
    assert pairs.where("d IS NOT NULL").count() > 100
    assert pairs.where("NOT (qn_grid_distance(a, b) <=> d)").isEmpty()


def test_calls_by_name_on_what_is_no_cell_or_edge(spark):
    sql.register(spark, "qn_", ("get_directed_edge_destination", "reverse_directed_edge", "grid_distance", "origin_to_directed_edges"))
    row = spark.sql("SELECT qn_get_directed_edge_destination(5L) AS a, qn_reverse_directed_edge(CAST(NULL AS BIGINT)) AS b, "
                    "qn_grid_distance(599686042433355775L, 5L) AS c, qn_grid_distance(CAST(NULL AS BIGINT), 5L) AS d, "
                    "qn_grid_distance(599686042433355775L, 599686042433355775L) AS e").first()
    assert tuple(row) == (None, None, None, None, 0)
