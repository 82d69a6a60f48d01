"""N-gram Jaccard join by vertical partitioning: documents whose sets of word shingles have a similarity of at least 9/10 are linked.

The global order of shingles is that of their hashes, cut into fragments. Sets a <= b that similar differ in at most (a + b) / 19
shingles, so of two more fragments than that at least two are the same in both. Sizes are dealt to classes, a fifth apart, each with
its own number of fragments; a set sends one key per fragment that it has something in, and one per two fragments that it has nothing
in, so any two linked sets share a key whatever their shingles. Sets are small against their fragments: about eight shingles make a key,
and a passage that many documents share brings together only those of which a whole fragment lies in it.

Sets that meet are compared with one of them, the leader: first the one that shares its keys with most sets (rounds with others may follow). What is then linked is one component and
needs no more comparing. What remains between components is compared in pairs. Before that, a 256-bit parity sketch, which differs in no
more bits than the sets in shingles, leaves out pairs that can't be alike. Links are verified: the sets that met, cut into fragments of
the order, are intersected fragment by fragment, and the partial overlaps are summed per pair.

Sets are told apart by 64-bit digests, as shingles are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, load, sieve, stash
from .grams import MULTIPLIERS, bundles, grams, mixed, words

WORDS, ROUNDS, FRAGMENT_BITS = 3, 1, 3
GAPS = b" \t\n\x0b\x0c\r"
PARITY = ["p0", "p1", "p2", "p3"]
LAST = (1 << 63) - 1
OTHER = np.uint64(MULTIPLIERS[1])


def size_classes() -> np.ndarray:
    """The smallest size of each class."""
    sizes = [1]
    while sizes[-1] < 1 << 40:
        sizes.append(max(sizes[-1] + 1, sizes[-1] * 5 // 4))
    return np.array(sizes, np.int64)


CLASSES = size_classes()


def differences(size_class: int) -> int:
    """Most shingles in which two linked sets differ whose smaller one is of this class."""
    a = int(CLASSES[size_class + 1]) - 1
    return (a + a * 10 // 9) // 19


def class_keys(shingles: np.ndarray, scrambled: np.ndarray, size_class: int) -> np.ndarray:
    """Keys of a set (hashes in order) in one class, as unsigned numbers."""
    most = differences(size_class)
    if not most:  # only equal sets are linked
        return np.empty(0, np.uint64)
    n = most + 2
    at = ((shingles >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    named = mixed(at[begins] + np.uint64(size_class << 40))
    keys = mixed(np.add.reduceat(scrambled, begins) ^ named)
    if n - len(begins) < 2:
        return keys
    empty = np.setdiff1d(np.arange(n, dtype=np.uint64), at[begins])
    i, j = np.triu_indices(len(empty), 1)
    return np.r_[keys, mixed(mixed(empty[i] + np.uint64(size_class << 40)) * OTHER + empty[j])]


def set_keys(shingles: np.ndarray, scrambled: np.ndarray) -> np.ndarray:
    """Keys in every class that the smaller of this set and a set linked with it may have."""
    n = len(shingles)
    lowest, own = np.searchsorted(CLASSES, [-(-9 * n // 10), n], "right") - 1
    return np.concatenate([class_keys(shingles, scrambled, c) for c in range(lowest, own + 1)])


def sets(texts: list, size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, in order; with fewer words than a shingle has, of the whole sequence; without words, none."""
    found = words(texts, GAPS, b"")
    lane, numbers = found.lanes[0], np.arange(len(texts))
    begin, end = np.searchsorted(found.text, numbers), np.searchsorted(found.text, numbers, "right")
    every = grams(lane, size)
    out = []
    for b, e in zip(begin.tolist(), end.tolist()):
        out.append(np.unique(every[b:e - size + 1]) if e - b >= size else grams(lane[b:e], e - b) if e > b else lane[:0])
    return out


def marked_sets(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, t, sid, n, keys, p0..p3): t a hash of the text, sid a digest of the set, n its size, p the parity sketch."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for s in bundles(texts):
                sids, ns, keys, parity = [], [], [], []
                for h in sets(texts[s], size):
                    scrambled = mixed(h * OTHER)
                    sids.append(int(mixed(scrambled.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))[0]))
                    ns.append(len(h))
                    keys.append(set_keys(h, scrambled).view(np.int64) if len(h) else np.empty(0, np.int64))
                    parity.append(np.bincount((h & np.uint64(255)).astype(np.int64), minlength=256) & 1)
                bits = np.packbits(np.array(parity, np.uint8), axis=1).view(np.int64)
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[s].to_numpy(), "t": b["t"].iloc[s].to_numpy(),
                                    "sid": np.array(sids, np.uint64).view(np.int64), "n": ns, "keys": keys,
                                    **{p: bits[:, i] for i, p in enumerate(PARITY)}})

    # as text, a null doc_id passes pandas unchanged
    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    shape = "doc_id string, t long, sid long, n long, keys array<long>, " + ", ".join(f"{p} long" for p in PARITY)
    return source.mapInPandas(each, shape).withColumn("doc_id", F.col("doc_id").cast("long"))


def fragments(docs: DataFrame, marked: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Rows (sid, f, s): the sets of wanted (sid), cut into the order's fragments f; made from one document each."""
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("d"), "t")
    chosen = stash(marked.join(wanted, "sid").groupBy("sid").agg(F.min(place).alias("k")).select("sid", "k.*"))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64("text").alias("t"), "text")
    near = sieve(keyed, F.xxhash64("d", "t"), chosen.select(F.xxhash64("d", "t").alias("doc")))
    texts = near.groupBy("d", "t").agg(F.first("text").alias("text")).join(chosen, ["d", "t"])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = b["text"].tolist()
            for s in bundles(rows):
                out = []
                for sid, h in zip(b["sid"].iloc[s].tolist(), sets(rows[s], size)):
                    at = (h >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64)
                    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    out += [(sid, f, part.view(np.int64)) for f, part in zip(at[begins].tolist(), np.split(h, begins[1:]))]
                yield pd.DataFrame(out, columns=["sid", "f", "s"])

    out = stash(texts.select("sid", "text").mapInPandas(each, "sid long, f int, s array<long>"))
    discard(chosen)
    return out


def may_link(n: Column, p: list[Column], m: Column, q: list[Column]) -> Column:
    """Whether sets of these sizes and parity sketches can be linked."""
    apart = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(p, q)), F.lit(0))
    return (F.least(n, m) * 10 >= F.greatest(n, m) * 9) & (apart * 19 <= n + m)


def verified(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (u, n, v, m) linked: partial overlaps, fragment by fragment, summed per pair."""
    left = pairs.join(parts.select(F.col("sid").alias("u"), "f", F.col("s").alias("a")), "u")
    met = left.join(parts.select(F.col("sid").alias("v"), "f", F.col("s").alias("b")), ["v", "f"])
    shared = met.select("u", "n", "v", "m", F.size(F.array_intersect("a", "b")).alias("part")).groupBy("u", "n", "v", "m").agg(
        F.sum("part").alias("both"))
    return shared.where(F.col("both") * 100 >= (F.col("n") + F.col("m") - F.col("both")) * 90).select("u", "v")


def links(docs: DataFrame, marked: DataFrame, size: int, rounds: int = ROUNDS) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of distinct sets with a similarity of at least 9/10."""
    keyed = marked.select(F.explode("keys").alias("key"), "sid", "n", *PARITY)
    shared = stash(keyed.groupBy("key").agg(F.min("sid").alias("_a"), F.max("sid").alias("_b")).where("_a <> _b").select("key"))
    met = stash(sieve(keyed, F.col("key"), shared).join(shared, "key").dropDuplicates(["key", "sid"]).withColumn("root", F.col("sid")))
    # how many sets share a set's keys: the most typical of near copies, which links most of them, leads first
    sharing = met.groupBy("key").agg(F.count("*").alias("_n"))
    ranks = met.select("key", "sid").join(sharing, "key").groupBy("sid").agg(F.sum("_n").alias("rank"))
    ranked = stash(met.join(ranks, "sid"))
    discard(met)
    met = ranked
    parts = fragments(docs, marked, met.select("sid").distinct(), size)
    discard(shared)
    own = [F.col(p) for p in PARITY]
    found = None
    for i in range(rounds + 1):
        order = F.xxhash64("sid", F.lit(i)) if i else -F.col("rank")
        lead = F.min(F.struct(order, "sid", "n", "root", *PARITY)).alias("lead")
        several = met.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), lead).where("_a <> _b").select("key", "lead")
        open_ = stash(met.join(several, "key"))
        discard(met)
        met = open_
        if open_.isEmpty():
            break
        if i < rounds:
            theirs = [F.col(f"lead.{p}") for p in PARITY]
            pairs = open_.where((F.col("root") != F.col("lead.root")) & may_link(F.col("n"), own, F.col("lead.n"), theirs)).select(
                F.col("sid").alias("u"), "n", F.col("lead.sid").alias("v"), F.col("lead.n").alias("m"))
        else:
            left = open_.select("key", F.col("sid").alias("u"), "n", "root", *PARITY)
            right = open_.select("key", F.col("sid").alias("v"), F.col("n").alias("m"), F.col("root").alias("far"),
                                 *[F.col(p).alias(f"q{p}") for p in PARITY])
            theirs = [F.col(f"q{p}") for p in PARITY]
            pairs = left.join(right, (left["key"] == right["key"]) & (F.col("root") < F.col("far"))
                              & may_link(F.col("n"), own, F.col("m"), theirs)).select("u", "n", "v", "m")
        candidates = stash(pairs.distinct())
        if candidates.isEmpty():  # other leaders may still find some
            discard(candidates)
            met = stash(open_.drop("lead"))
            discard(open_)
            continue
        new = verified(candidates, parts)
        before, found = found, stash(new if found is None else found.union(new))
        discard(candidates)
        if before is not None:
            discard(before)
        if i == rounds:
            break
        roots = components(found).select(F.col("node").alias("sid"), F.col("root").alias("_root"))
        met = stash(open_.select("key", "sid", "n", *PARITY).join(roots, "sid", "left")
                    .select("key", "sid", "n", *PARITY, F.coalesce("_root", "sid").alias("root")))
        discard(open_)
    discard(met)
    discard(parts)
    return found if found is not None else marked.select(F.col("sid").alias("u"), F.col("sid").alias("v")).limit(0)


def similar(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id that links reach, its own included).

    A document is its set of distinct shingles of `size` words, A-Z lower-cased, split at ASCII white space; with fewer words, of the
    whole sequence. Null and empty texts and texts without words are linked with nothing, each other included: their component_id is
    their doc_id. Null doc_ids stay and take part; a component of only null doc_ids has a null id. Repeated rows stay repeated. Empty
    table: no rows. Other columns are not read.
    """
    marked = stash(marked_sets(docs, size))
    classes = marked.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(docs, marked, size)).select(F.col("node").alias("sid"), "root")
    rooted = classes.join(roots, "sid", "left").select("sid", "first_id", F.coalesce("root", "sid").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stash(rooted.join(smallest, "root").select("sid", "component_id"))
    linked = marked.where("n > 0").join(named, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(marked.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op13_ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(load(spark, sf_dir, "documents"))


def op13_sql() -> str:
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= {WORDS} THEN list_distinct(list_transform(range(1, len(w) - {WORDS} + 2), lambda i: w[i:i + {WORDS} - 1]))
    WHEN len(w) > 0 THEN [w] ELSE [] END AS s FROM split),
sizes AS (SELECT doc_id, coalesce(len(s), 0) AS n, md5(list_sort(s)::VARCHAR) AS name FROM sets),
one AS (SELECT name, min(doc_id) AS id, any_value(n) AS n FROM sizes WHERE n > 0 GROUP BY name),
shingles AS (SELECT id, n, unnest(s) AS g FROM one JOIN sets ON id = doc_id),
links AS (
  SELECT a.id AS u, b.id AS v FROM shingles a JOIN shingles b ON a.g = b.g AND a.id <> b.id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(id, to_id) AS (SELECT u, v FROM links UNION SELECT r.id, l.v FROM reach r JOIN links l ON r.to_id = l.u),
least_id AS (SELECT id, min(to_id) AS m FROM reach GROUP BY id)
SELECT d.doc_id, d.n::BIGINT AS n_shingles, coalesce(least(o.id, m), d.doc_id)::BIGINT AS component_id
FROM sizes d LEFT JOIN one o ON d.n > 0 AND d.name = o.name LEFT JOIN least_id l ON l.id = o.id"""
