"""Sets that share cells: a cell's rows are aggregated once, not for each set."""
from pyspark.sql import functions as F

from hexatlas.functions import bits
from hexatlas.operators import hierarchy, lookup


def test_sets_that_share_cells_get_each_row_once(spark):
    base = spark.range(2).selectExpr(f"{bits.res0_cell('id + 3')} AS cell")
    rows = hierarchy.drilldown_cells(base, res=3).selectExpr("child AS cell", "pmod(xxhash64(child), 100) AS v")
    rows = rows.unionByName(rows.limit(40)).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS cell, 1L AS v"))
    covers = hierarchy.drilldown_cells(base, res=1).selectExpr("child AS cover").unionByName(base.selectExpr("cell AS cover").limit(1))
    covers = covers.unionByName(covers.limit(2)).selectExpr("cover", "explode(sequence(1, 30)) AS area").where("pmod(hash(cover, area), 3) > 0")
    covers = covers.unionByName(covers.where("area = 30").selectExpr("cover", "CAST(NULL AS INT) AS area"))
    rows, covers = (spark.createDataFrame(t.collect(), t.schema) for t in (rows, covers))
    first = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")]
    got = lookup.rollup_in_covers(rows, covers, first, [F.sum("n").alias("n"), F.sum("total").alias("total")], by=["area"], res=3)
    want = lookup.lookup_cells(rows, covers, res=3).groupBy("area").agg(*first)
    assert got.columns == ["area", "n", "total"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 31
