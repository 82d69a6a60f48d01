"""SimHash near-duplicates by segment popcounts.

A fingerprint's 32 two-bit segments are mapped to their bit counts (0, 1 or 2). The Manhattan distance of two such vectors is a
lower bound of the fingerprints' Hamming distance, so with at most 3 differing bits one of the two halves (16 counts each) differs
by at most 1. The grid of half vectors is joined by range: each fingerprint stands in its own cell and probes the cells one step
up on one axis. What meets in a cell is verified on the whole 64 bits.

A cell never emits all its pairs: it emits links that span the components of its verified graph, fewer than it has members. Cells of
more than CELL members are split into blocks, and each pair of blocks is a task of its own, so the result stays whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, load, stash, unpacked, whole_row

BITS, WORDS, CELL, CHUNK = 3, 3, 4096, 65_536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the shingles of a text, A-Z lower-cased, words split at ASCII white space; no words (or null): 0."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(parts) > words:
        starts, ends = starts[:len(parts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):  # a very long text is counted in pieces
        span = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in span], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows (doc_id, t, fp): t a hash of the text, fp as a signed long."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "t": b["t"], "fp": fps.view(np.int64)})

    # as text, a null doc_id passes pandas unchanged
    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    return source.mapInPandas(each, "doc_id string, t long, fp long").withColumn("doc_id", F.col("doc_id").cast("long"))


def cells(fps: DataFrame) -> DataFrame:
    """Rows (key, fp, probe): each fp in its own cell of both halves, and probing the cells one step up on one axis."""
    ones = F.lit(0x55555555).cast("long")

    def counts(half: Column) -> Column:  # 16 counts of two bits each
        return half.bitwiseAND(ones) + F.shiftrightunsigned(half, 1).bitwiseAND(ones)

    halves = F.array(counts(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))), counts(F.shiftrightunsigned("fp", 32)) + F.lit(1 << 32))

    def keys(own: Column) -> Column:
        axes = F.array(*[F.lit(1 << (2 * i)).cast("long") for i in range(16)])
        full = lambda step: own.bitwiseAND(step * 2) == 0  # noqa: E731  a count under 2 has its upper bit clear
        up = F.transform(F.filter(axes, full), lambda step: F.struct((own + step).alias("key"), F.lit(True).alias("probe")))
        return F.concat(F.array(F.struct(own.alias("key"), F.lit(False).alias("probe"))), up)

    return (fps.select("fp", F.explode(halves).alias("_own")).select("fp", F.explode(keys(F.col("_own"))).alias("_k"))
            .select(F.col("_k.key").alias("key"), "fp", F.col("_k.probe").alias("probe")))


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits; of unsigned numbers, as numpy counts the bits of a signed number's absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that span the components of the graph `at most so many differing bits` over distinct fps."""
    us, vs, rest, todo = [], [], fp, []
    while len(todo) or len(rest):
        if not todo:
            todo, rest = [rest[0]], rest[1:]
        u = todo.pop()
        near = differing(rest, u) <= bits
        if near.any():
            found = rest[near]
            us.append(np.full(len(found), u))
            vs.append(found)
            todo.extend(found)
            rest = rest[~near]
    none = np.empty(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def link_cells(rows: DataFrame, bits: int, cell: int) -> DataFrame:
    """Links within cells; rows come sorted by key within a partition. Members of cells over the size come back as heavy rows."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, fp, probe = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        heavy = None

        def settle(key, fp, probe):
            """Links of whole cells: vectorised over all cells of up to 8 rows, one by one beyond."""
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            sizes = ends - starts
            out = []
            small = np.repeat(sizes <= 8, sizes)
            k, f, p = key[small], fp[small], probe[small]
            for d in range(1, min(8, len(k))):
                ok = (k[d:] == k[:-d]) & ~(p[d:] & p[:-d])
                ok &= (differing(f[d:], f[:-d]) <= bits) & (f[d:] != f[:-d])
                out.append((f[d:][ok], f[:-d][ok]))
            for s, e in zip(starts[sizes > 8].tolist(), ends[sizes > 8].tolist()):
                if not probe[s:e].all():
                    out.append(spanning(np.unique(fp[s:e]), bits))
            return (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2

        def links(u, v):
            return pd.DataFrame({"u": u, "v": v, "heavy": np.zeros(len(u), bool)})

        def passed(k, f):
            return pd.DataFrame({"u": f, "v": np.full(len(f), k), "heavy": np.ones(len(f), bool)})

        for b in batches:
            k2, f2, p2 = b["key"].to_numpy(), b["fp"].to_numpy(), b["probe"].to_numpy(dtype=bool)
            if heavy is not None:
                n = int(np.searchsorted(k2, heavy, "right"))
                yield passed(heavy, f2[:n])
                if n == len(k2):
                    continue
                k2, f2, p2, heavy = k2[n:], f2[n:], p2[n:], None
            key, fp, probe = np.concatenate([key, k2]), np.concatenate([fp, f2]), np.concatenate([probe, p2])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            whole = np.ones(len(key), bool)
            for s, e in zip(cuts[:-1], cuts[1:]):
                if e - s > cell:
                    yield passed(key[s], fp[s:e])
                    whole[s:e] = False
                    if e == len(key):
                        heavy = key[s]
            last = int(cuts[-2]) if heavy is None and len(key) else len(key)
            done = whole[:last]
            if done.any():
                yield links(*settle(key[:last][done], fp[:last][done], probe[:last][done]))
            key, fp, probe = key[last:], fp[last:], probe[last:]
        if len(key):
            yield links(*settle(key, fp, probe))

    return rows.mapInPandas(each, "u long, v long, heavy boolean")


def link_heavy(heavy: DataFrame, bits: int, cell: int) -> DataFrame:
    """Links within large cells (rows key, fp): members are dealt to blocks of about `cell` rows, and each two blocks make a task."""
    blocks = heavy.groupBy("key").agg(F.ceil(F.count("*") / cell).cast("int").alias("n"))
    dealt = heavy.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    pairs = dealt.select("key", "fp", "b", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
    pairs = pairs.select("key", "fp", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v = spanning(pdf["fp"].drop_duplicates().to_numpy(), bits)
        return pd.DataFrame({"u": u, "v": v})

    return pairs.groupBy("key", "i", "j").applyInPandas(each, "u long, v long")


def links(fps: DataFrame, bits: int = BITS, cell: int = CELL) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of distinct fps (column fp) at most `bits` <= 3 bits apart."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves probed by one step find up to 3 differing bits")
    grid = cells(fps).repartition("key").sortWithinPartitions("key")
    found = stash(link_cells(grid, bits, cell))
    heavy = found.where("heavy").select(F.col("v").alias("key"), F.col("u").alias("fp"))
    return found.where("NOT heavy").select("u", "v").union(link_heavy(heavy, bits, cell))


def groups(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per row of docs: doc_id, t, fp (signed long), root, component_id (smallest doc_id that links reach, its own included).

    Null and empty texts have fingerprint 0 and link like any other. Null doc_ids stay and take part; a component of only null
    doc_ids has a null id; root tells components apart in any case. Repeated rows stay repeated. Empty table: no rows. Other
    columns are not read.
    """
    marked = stash(fingerprints(docs, words))
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes.select("fp"), bits)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stash(rooted.join(smallest, "root").select("fp", "root", "component_id"))
    return marked.join(named, "fp").select("doc_id", "t", "fp", "root", "component_id")


def keep_smallest(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row of docs for each root of grouped (doc_id, t, root): that of the smallest (doc_id, t), null doc_ids last; the columns of docs."""
    last = F.lit((1 << 63) - 1)
    chosen = stash(grouped.groupBy("root").agg(F.min(F.struct(F.coalesce("doc_id", last).alias("_d"), F.col("t").alias("_t"))).alias("k"))
                   .select("k.*"))
    keyed = docs.select(whole_row(docs).alias("row"), F.coalesce(docs["doc_id"].cast("long"), last).alias("_d"), F.xxhash64(docs["text"]).alias("_t"))
    kept = keyed.join(chosen, ["_d", "_t"], "left_semi").groupBy("_d", "_t").agg(F.first("row").alias("row"))
    return unpacked(kept, "row", docs)


def keep_one(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row of docs for each group: that of the smallest (doc_id, hash of the text), null doc_ids last; the columns of docs."""
    return keep_smallest(docs, groups(docs, words, bits))


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
