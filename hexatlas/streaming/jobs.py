"""Streaming forms.  Point, centre, audit and hierarchy jobs keep no state and take a
streaming DataFrame as they are; roll-ups need a watermark to bound theirs."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits
from ..operators.indexing import index_points


def windowed_rollup(points: DataFrame, aggregates, time="ts", lat="lat", lng="lng", index_res=9, res=5,
                    window="10 minutes", late="30 minutes") -> DataFrame:
    """Index a stream of points and aggregate by time window and coarse cell; rows later
    than ``late`` are dropped and windows past it are final, so state stays bounded."""
    cells = index_points(points.withWatermark(time, late), lat, lng, index_res)
    return (cells.withColumn("cell", F.expr(bits.parent("cell", res)))
            .groupBy(F.window(time, window).alias("window"), "cell").agg(*aggregates))
