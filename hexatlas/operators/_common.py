from pyspark.sql import DataFrame, SparkSession

from ..functions.constants import MAX_RES
from ..functions.steps import Inline, Statement

# Beyond this size HotSpot runs a method interpreted; falling back to operator-wise
# code for such a stage is several times faster (the value Spark's documentation
# recommends for HotSpot).
HUGE_METHOD = "8000"


def tuned(df: DataFrame) -> DataFrame:
    if isinstance(df, (Inline, Statement)):
        return df
    conf = df.sparkSession.conf
    if conf.get("spark.sql.codegen.hugeMethodLimit") != HUGE_METHOD:
        conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
    return df


DEALT_ROWS = 16384


def dealt(df: DataFrame, rows=DEALT_ROWS) -> DataFrame:
    """The same rows in tasks of about ``rows`` rows each, one per core at least.

    For tables read from files: a row of a few bytes may cost milliseconds of geometry, so
    splits by bytes are too few and too long.  Counts the rows when planning (of a plain
    scan, from the files' footers).  The generator keeps the optimizer from moving filters
    on what is made of the rows, and so their work, below the shuffle."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    fields = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return df.repartition(tasks).selectExpr(f"inline(array(named_struct({fields})))")


def check_res(res):
    """A literal resolution outside 0-15 gives NULL results, so pass it as a column."""
    if isinstance(res, int) and not 0 <= res <= MAX_RES:
        return f"({res})"
    return res


def valid_res(res):
    return f"{res} BETWEEN 0 AND {MAX_RES}"
