"""Jobs on sets and cells that hold most of the rows."""
from pyspark.sql import functions as F

from hexatlas.functions import bits
from hexatlas.operators import hierarchy


def test_one_base_cell_is_drilled_down_by_many_tasks(spark):
    for base, pent in ((20, False), (4, True)):
        top = spark.range(1).selectExpr(f"{bits.res0_cell(base)} AS cell", "'kept' AS child_of", "7 AS item")
        got = hierarchy.drilldown_cells(top, res=8)
        per_task = got.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.sum(F.expr(f"CAST({bits.is_valid_cell('child')} AND {bits.parent('child', 0)} = cell AS INT)")).alias("ok"),
            F.min("child_of").alias("c"), F.bit_xor("child").alias("x")).collect()
        want = 1 + 5 * (7 ** 8 - 1) // 6 if pent else 7 ** 8
        assert sum(r.n for r in per_task) == want == sum(r.ok for r in per_task) and {r.c for r in per_task} == {"kept"}
        assert len(per_task) > 2 and max(r.n for r in per_task) < want / 2
        assert got.columns == ["cell", "child_of", "item", "child"]


def test_row_resolutions_above_and_below_a_block(spark):
    tops = spark.range(3).selectExpr(f"{bits.center_child(bits.res0_cell('id + 3'), 'CAST(8 + id AS INT)')} AS cell", "CAST(9 + id * 3 AS INT) AS r")
    got = {r.r: r.n for r in hierarchy.drilldown_cells(tops, res="r").groupBy("r").agg(F.countDistinct("child").alias("n")).collect()}
    assert got == {9: 7, 12: 1 + 5 * (7 ** 3 - 1) // 6, 15: 7 ** 5}
    assert hierarchy.drilldown_cells(tops, res=7).count() == 0


def test_a_hot_set_does_not_meet_in_one_task(spark, tmp_path):
    cells = hierarchy.drilldown_cells(spark.range(1).selectExpr(f"{bits.res0_cell(20)} AS cell"), res=5).select("child")
    rows = cells.selectExpr("1L AS s", "child AS cell").unionByName(cells.limit(30).selectExpr("2L AS s", "child AS cell")).unionByName(
        spark.sql("SELECT 3L AS s, 5L AS cell"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert {r.s: r.n for r in hierarchy.compact_table(rows, by=["s"]).groupBy("s").agg(F.count("*").alias("n")).collect()}.keys() == {1, 2}
    spread = hierarchy._without(rows, rows.where("cell = 5").select("s"), ["s"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        per_task = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    total = sum(r["count"] for r in per_task)
    assert total == rows.count() - 1 and max(r["count"] for r in per_task) < total / 2
    whole = hierarchy.uncompact_table(rows.where("s < 3"), res=5, by=["s"])
    assert whole.count() == rows.where("s < 3").count()
    assert hierarchy.uncompact_table(rows, res=5, by=["s"]).where("s = 3").count() == 0
