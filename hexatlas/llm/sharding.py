"""Sharding: a keyed Feistel permutation with cycle walking over global row numbers. DataFrame functions only.

Law `rows`: with row number x of n rows, y = permutation(x), shard = y mod S and slot = y div S. Shard sizes differ by at most
one, slots have no gaps, and the place of a row is computable from (x, n, key) alone: no sort by a random key, no shuffle of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, stash

ROUNDS, SEED, SHARDS = 6, 20_011, 24
# Moduli and multipliers of the round function; each product stays under 2^62.
P1, P2, M1, M2 = 2_147_483_647, 1_073_741_789, 1_103_515_245, 1_299_709


def halves(n: int) -> tuple[int, int]:
    """Sides (a, b) of the permuted domain: a*b >= n, and a*b - n < a, so few numbers ever walk."""
    a = max(1, int(n ** 0.5))
    while a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def round_keys(seed: int) -> list[tuple[int, int]]:
    return [((seed + 7919 * i) * 104_729 % P2, (seed + 6101 * i) * 15_485_863 % P2) for i in range(ROUNDS)]


def permute_once(x: int, a: int, b: int, seed: int) -> int:
    """The permutation of [0, a*b) on plain integers; permuted() is the same on columns."""
    left, right = divmod(x, b)
    for i, (k1, k2) in enumerate(round_keys(seed)):
        if i % 2 == 0:
            left = (left + ((right * M1 + k1) % P1 * M2 + k2) % P2) % a
        else:
            right = (right + ((left * M1 + k1) % P1 * M2 + k2) % P2) % b
    return left * b + right


def walks(n: int, seed: int) -> int:
    """Steps after which every number under n has come back under n. Only the a*b - n (< sqrt(n) + 1) outside numbers walk."""
    a, b = halves(n)
    outside, steps = list(range(n, a * b)) if n else [], 1
    while outside:
        outside = [y for y in (permute_once(x, a, b, seed) for x in outside) if y >= n]
        steps += 1
    return steps


def permuted(df: DataFrame, x: str, out: str, n: int, seed: int = SEED) -> DataFrame:
    """df with column out: the image of row number x (0 <= x < n) under the permutation."""
    a, b = halves(n)

    def mixed(v: Column, k1: int, k2: int) -> Column:
        # row numbers' halves are under 2^31 for up to 2^62 rows, so v * M1 fits a long
        return ((v * F.lit(M1).cast("long") + F.lit(k1).cast("long")) % P1 * F.lit(M2).cast("long") + F.lit(k2).cast("long")) % P2

    df = df.withColumn(out, F.col(x))
    for step in range(walks(n, seed)):
        df = df.withColumns({"_l": F.expr(f"`{out}` div {b}L"), "_r": F.col(out) % F.lit(b).cast("long")})
        for i, (k1, k2) in enumerate(round_keys(seed)):
            side, other, m = ("_l", "_r", a) if i % 2 == 0 else ("_r", "_l", b)
            df = df.withColumn(side, (F.col(side) + mixed(F.col(other), k1, k2)) % F.lit(m).cast("long"))
        image = F.col("_l") * F.lit(b).cast("long") + F.col("_r")
        df = df.withColumn(out, image if step == 0 else F.when(F.col(out) < n, F.col(out)).otherwise(image)).drop("_l", "_r")
    return df


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """df with `row_number` from 0 in the global order of the columns; equal rows are interchangeable.

    One range exchange. The last sort key tells equal rows apart, so a value held by a third of the rows still spreads over
    partitions. Rows are written once; then a row's number is its place in its part plus the sizes of the parts before.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = stash(tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
                   .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    # one row for each written part: bounded by the number of shuffle partitions
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = [(r["_part"], r["_n"]) for r in sizes.orderBy("_part").collect()]
    starts, total = [], 0
    for p, n in before:
        starts.append((p, total))
        total += n
    spark = df.sparkSession
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    out = (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
           .withColumn("row_number", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_start", "_at"))
    out.total_rows = total
    return out


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    Row numbers follow (doc_id, CRC-32, size), null doc_ids first; rows equal in all three are interchangeable and get numbers in
    any order. Null text: size 8, CRC 0 (as the empty text). Empty table: no rows. Other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                       F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    placed = numbered(rows, ["doc_id", "text_crc32", "size"])
    spread = permuted(placed, "row_number", "_y", placed.total_rows)
    return spread.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_y") % shards).cast("int").alias("shard"),
                         F.expr(f"_y div {shards}").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(load(spark, sf_dir, "documents"))


def op3_sql() -> str:
    """The same in DuckDB SQL: row numbers by a window, CRC-32 byte by byte from its polynomial, cycle walking by recursion."""
    step = "SELECT rn, n, a, b, y // b AS l, y % b AS r, depth FROM walk WHERE depth = 0 OR y >= n"
    for i, (k1, k2) in enumerate(round_keys(SEED)):
        side, other, m = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        step = (f"SELECT rn, n, a, b, {other}, ({side} + (({other} * {M1} + {k1}) % {P1} * {M2} + {k2}) % {P2}) % {m} AS {side}, "
                f"depth FROM ({step})")
    return f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
sums AS (
  SELECT text, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(octet_length(encode(text))), lambda j: ('0x' || substr(hex(encode(text)), 2 * j + 1, 2))::BIGINT)),
      lambda acc, byte: xor(acc >> 8, t[(xor(acc, byte) & 255) + 1]))) AS crc
  FROM texts, crc_table),
base AS (
  SELECT doc_id, coalesce(octet_length(encode(d.text)), 0) + 8 AS size, coalesce(crc, 0) AS crc
  FROM documents d LEFT JOIN sums s ON d.text = s.text),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS rn, count(*) OVER () AS n FROM base),
sides AS (SELECT *, ceil(sqrt(n))::BIGINT AS a, ((n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT) AS b FROM numbered),
walk(rn, n, a, b, y, depth) AS (
  SELECT rn, n, a, b, rn, 0 FROM sides
  UNION ALL SELECT rn, n, a, b, l * b + r, depth + 1 FROM ({step}))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (y % {SHARDS})::INTEGER AS shard,
  (y // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard, rn::BIGINT AS row_number
FROM sides JOIN walk USING (rn) WHERE depth > 0 AND y < walk.n"""
