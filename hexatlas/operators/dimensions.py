"""Tables of the grid itself."""
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bits
from ..functions.constants import EDGE_LENGTH_AVG_KM, MAX_RES, NUM_BASE_CELLS
from ..functions.steps import number, pick
from .indexing import AREA_UNITS, cell_areas

BASE_COUNT = NUM_BASE_CELLS


def base_cells(spark: SparkSession) -> DataFrame:
    """The 122 cells of resolution 0."""
    return spark.range(BASE_COUNT).selectExpr(f"{bits.res0_cell('id')} AS cell")


SPHERE = 4 * math.pi  # its area on a radius of 1


def pentagon_cells(spark: SparkSession, res=None) -> DataFrame:
    """The 12 pentagons of one resolution, or of all: res, cell."""
    wanted = range(MAX_RES + 1) if res is None else [res]
    levels = spark.range(MAX_RES + 1).selectExpr("CAST(id AS INT) AS res").filter(
        f"res IN ({', '.join(map(str, wanted))})")
    return (levels.crossJoin(spark.range(12).selectExpr("CAST(id AS INT) AS _n"))
            .selectExpr("res", f"{bits.pentagon_cell('_n', 'res')} AS cell"))


def grid_cells(spark: SparkSession, res: int) -> DataFrame:
    """Every cell of a resolution, generated where it is used."""
    per = 7 ** res
    octal = bits._octal_of_base7("_q", max(res, 1))
    raw = (spark.range(BASE_COUNT * per).selectExpr(f"id DIV {per}L AS _b", f"id % {per}L AS _q")
           .selectExpr(f"{bits.CELL_MODE}L | shiftleft(CAST({res} AS BIGINT), 52) | shiftleft(_b, 45) "
                       f"| shiftleft({octal}, {3 * (MAX_RES - res)}) | {bits.unused_mask(res)} AS cell"))
    return raw.filter(bits.is_valid_cell("cell"))


def resolution_stats(spark: SparkSession) -> DataFrame:
    """Per resolution: number of cells, average hexagon area (what the sphere leaves
    beside the twelve pentagons) and average edge length."""
    pents = (cell_areas(pentagon_cells(spark), unit="rads^2").groupBy("res").agg(F.sum("area").alias("_p")))
    km2 = f"({number(SPHERE)} - _p) / (num_cells - 12) * {number(AREA_UNITS['km^2'])}"
    km = pick(EDGE_LENGTH_AVG_KM, "res")
    return pents.selectExpr("res", f"{bits.cells_at('res')} AS num_cells", "_p").selectExpr(
        "res", "num_cells", f"{km2} AS area_avg_km2", f"{km2} * 1e6D AS area_avg_m2",
        f"{km} AS edge_avg_km", f"{km} * 1000D AS edge_avg_m")


def with_averages(df: DataFrame, res="res") -> DataFrame:
    """Averages of each row's resolution; NULL outside 0-15."""
    stats = F.broadcast(resolution_stats(df.sparkSession).withColumnRenamed("res", "_sr"))
    return df.join(stats, F.expr(f"{res} = _sr"), "left").drop("_sr")
