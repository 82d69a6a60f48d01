"""Helpers shared by the operators: cut points in the shared folder, connected components, table loading."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, one inside the warehouse, which is shared too."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_cuts").rstrip("/")


def stash(df: DataFrame) -> DataFrame:
    """df written once as a table in the shared folder and read back: lineage ends there, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes a stashed table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df.stash_path)
    path.getFileSystem(conf).delete(path, True)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns of docs as one, so that theirs can't clash with an operator's own."""
    return F.struct(*[docs[quoted(c)] for c in docs.columns])


def unpacked(df: DataFrame, row: str, docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of docs out of whole_row, some of them changed."""
    cols = {c: F.col(f"{row}.{quoted(c)}") for c in docs.columns} | (changed or {})
    return df.select(*[cols[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


SIEVE_BITS = 26


def sieve(df: DataFrame, key: Column, members: DataFrame, out: bool = False) -> DataFrame:
    """The rows of df whose key hash (a long) may be in members' one column, or with `out` all others; no shuffle of df.

    A bitmap of 2^26 bits by the hash's upper bits, sent to all tasks: at most 2^20 rows of two longs, whatever the members. Where
    they are so many that it fills up, nothing more is dropped: a join on the key itself has to follow.
    """
    name = members.columns[0]
    word = F.shiftrightunsigned(F.col(name), 64 - SIEVE_BITS + 6)
    bit = F.expr(f"shiftleft(1L, int(shiftrightunsigned(`{name}`, {64 - SIEVE_BITS}) & 63))")
    words = members.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = df.withColumn("_key", key).withColumn("_word", F.shiftrightunsigned("_key", 64 - SIEVE_BITS + 6))
    test = F.expr(f"shiftrightunsigned(_bits, int(shiftrightunsigned(_key, {64 - SIEVE_BITS}) & 63)) & 1 = 1")
    joined = marked.join(F.broadcast(words), "_word", "left" if out else "inner")
    return joined.where(~F.coalesce(test, F.lit(False)) if out else test).drop("_word", "_bits", "_key")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): rows (node, root), root the smallest node reachable; self-loops and repeats are harmless.

    Alternating large-star and small-star steps. Each step keeps every component connected and adds no edges beyond one per edge
    read; a hub's edges are aggregated before the shuffle and joined by a join that Spark can split. One written table a round.
    """
    cur = stash(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        # u > v throughout; large star: neighbours on both sides, larger ones move to the smallest of the neighbourhood
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_min, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                                     F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        nxt = stash(small)
        state = nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        discard(cur)
        cur = nxt
        if state == before:
            break
        before = state
    rooted = cur.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return rooted.union(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
