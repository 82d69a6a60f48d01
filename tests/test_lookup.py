"""Cells in covers of mixed resolution, against unfolding the covers."""
import pytest

from hexatlas.functions import bits
from hexatlas.operators import hierarchy, lookup


def test_ancestors_of_any_resolution(spark):
    base = spark.range(3).selectExpr(f"{bits.res0_cell('id + 3')} AS cell")  # one of them a pentagon
    leaves = hierarchy.drilldown_cells(base, res=3).selectExpr("child AS cell")
    rows = leaves.unionByName(leaves.limit(5)).unionByName(spark.sql("SELECT 5L AS cell UNION ALL SELECT CAST(NULL AS BIGINT)"))
    covers = hierarchy.drilldown_cells(base, res=1).selectExpr("CAST(pmod(xxhash64(child), 4) AS INT) AS area", "child AS cover")
    covers = covers.unionByName(leaves.selectExpr("9 AS area", "cell AS cover").limit(20)).unionByName(
        spark.sql("SELECT 7 AS area, 5L AS cover UNION ALL SELECT 7, CAST(NULL AS BIGINT)")).unionByName(
        hierarchy.drilldown_cells(base, res=4).selectExpr("8 AS area", "child AS cover").limit(3))
    covers = spark.createDataFrame(covers.collect(), covers.schema)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    unfolded = hierarchy.drilldown_cells(covers, "cover", 3, "leaf")
    want = sorted(map(tuple, unfolded.join(rows, unfolded.leaf == rows.cell).select("cell", "area", "cover").collect()))
    for res in (None, 3):
        got = lookup.lookup_cells(rows, covers, res=res)
        assert got.columns == ["cell", "area", "cover"] and sorted(map(tuple, got.collect())) == want
    assert {a for _, a, _ in want} == {0, 1, 2, 3, 9}
    assert lookup.lookup_cells(rows, covers.filter("false"), res=3).count() == 0 == lookup.lookup_cells(rows, covers.filter("false")).count()
    with pytest.raises(ValueError):
        lookup.lookup_cells(rows, covers.withColumnRenamed("cover", "CELL"), cover="CELL")


def test_ranges_reach_the_files(spark, tmp_path):
    base = spark.range(3).selectExpr(f"{bits.res0_cell('id + 3')} AS cell")
    hierarchy.drilldown_cells(base, res=3).selectExpr("child AS cell").write.parquet(f"{tmp_path}/cells")
    covers = base.limit(1).selectExpr("cell AS cover")
    got = lookup.lookup_cells(spark.read.parquet(f"{tmp_path}/cells"), covers, res=3)
    assert got.count() == 343
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(cell" in plan
