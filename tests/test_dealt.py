"""Rows of small files are dealt over tasks, and the work on them with them."""
from hexatlas.operators import polyfill as filling
from hexatlas.operators._common import HUGE_METHOD, dealt
from hexatlas.operators.hierarchy import compact_table
from hexatlas.operators.polyfill import polyfill
from hexatlas.plans import catalog


def test_a_task_has_no_more_rows_than_asked_for(spark):
    rows = spark.range(0, 5000, 1, 1).selectExpr("CASE WHEN id % 3 > 0 THEN 7 END AS k", "id AS v")
    out = dealt(rows, 100)
    assert out.rdd.getNumPartitions() >= 50
    assert max(out.rdd.glom().map(len).collect()) <= 150
    assert sorted(out.collect(), key=lambda r: r.v) == sorted(rows.collect(), key=lambda r: r.v)


def test_filters_on_geometry_stay_above_the_shuffle(spark, tmp_path):
    spark.range(0, 40, 1, 1).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    plan = catalog.points(spark, str(tmp_path)).filter("lat > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Repartition") and "Filter" not in plan[plan.index("Repartition"):]


def test_cells_away_from_the_boundary_are_decided_without_outlines(spark):
    square = spark.createDataFrame([(1, "POLYGON ((10 40, 13 40, 13 43, 10 43, 10 40))")], "k long, wkt string")
    got = {m: {r.cell for r in polyfill(square, "wkt", 4, m).collect()} for m in ("full", "center", "overlap", "overlap_bbox")}
    assert got["full"] < got["center"] < got["overlap"] <= got["overlap_bbox"]


def test_compaction_sets_the_limit_its_generated_code_needs(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    cells = spark.range(1).selectExpr("0 AS k", f"{catalog.keyed_cell('0', 1)} AS cell")
    assert compact_table(cells, by=["k"]).count() == 1
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == HUGE_METHOD


def test_cells_that_can_hold_nothing_go_before_the_sides_are_looked_at(spark, monkeypatch):
    made = []

    def finish(df, *args):
        made.append(df)
        return told(df, *args)

    told = filling._finish
    monkeypatch.setattr(filling, "_finish", finish)
    shapes = spark.createDataFrame([(1, "POLYGON ((10 40, 13 40, 13 43, 10 43, 10 40))"), (2, "POLYGON ((-3 88, 3 88, 3 89, -3 89, -3 88))"),
                                    (3, "POLYGON ((178 -2, -178 -2, -178 2, 178 2, 178 -2))")], "k long, wkt string")
    cells = polyfill(shapes, "wkt", 3).count()
    o = next(c for c in made[0].columns if c.endswith("px"))[:-2]
    rows = made[0].selectExpr(f"{o}px BETWEEN {o}x0 - 1e-8 AND {o}x1 + 1e-8 AND {o}py BETWEEN {o}y0 - 1e-8 AND {o}y1 + 1e-8 AS near").collect()
    assert 0 < cells <= len(rows) and all(r.near for r in rows if r.near is not None)
