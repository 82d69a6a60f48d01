"""Conversation prefix trie in double arrays.

A turn is a symbol of 20 bytes (MD5 of its role and text, then its code points), a conversation the sequence of its symbols. Equal
conversations are one path with its members' number, smallest id and digest of ids. Paths in order of their symbols are cut into
shards of about SHARD turns, so a shard holds neighbouring prefixes and a prefix that many conversations share is split over many.

A task packs its shard into BASE and CHECK over dense turn ids: the child of s by turn c is t = BASE[s] + c, and CHECK[t] = s. It then
traverses the paths for the nodes' aggregates. Nodes on the path that two neighbouring shards have in common are seen by both; as a
shard knows how much of its first path the shard before it holds, each counts only what is new in it, and sums over shards are exact.

A conversation's symbols (20 bytes a turn) are one value; its texts never meet in one row. Ids of a path's members are joined in pieces
of PIECE ids by many tasks; only the digest, which SHA-256 defines over the whole text in order, is taken by one task, piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, load, stash

SYMBOL, SHARD, PIECE, TRIES, GROUP, KEEP = 20, 1 << 15, 4096, 256, 100, 6
NODE = ("shard int, state int, parent int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, shared string, shared_parent string")
NO_IDS = hashlib.sha256(b"").hexdigest()


def symbol(role: Column, text: Column) -> Column:
    """20 bytes that tell turns apart; null role and text are empty ones."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    named = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.unhex(F.concat(named, F.lpad(F.hex(F.length(text).cast("long")), 8, "0")))


def sequences(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, path): a conversation's symbols in the order of turn, null turns first, equal turns by symbol. Null conv_ids go."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                 F.struct("turn", symbol(F.col("role"), F.col("text")).alias("symbol")).alias("t"))
    sorted_ = F.transform(F.sort_array(F.collect_list("t")), lambda t: t["symbol"])
    return turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.array_join(F.transform(sorted_, F.hex), "").alias("path")).withColumn("path", F.unhex("path"))


def regrafted(seqs: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % GROUP; h is the CRC-32 of c's digits modulo KEEP."""
    first = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("_first")
    heads = seqs.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_first"), F.expr(f"substring(path, 1, {SYMBOL * (KEEP - 1)})").alias("_head"))
    taken = f"int(crc32(cast(cast(conv_id AS string) AS binary)) % {KEEP}) * {SYMBOL}"
    return seqs.select("*", first).join(heads, "_first", "left").select("conv_id", F.expr(
        f"concat(substring(coalesce(_head, cast('' AS binary)), 1, {taken}), substring(path, {taken} + 1))").alias("path"))


def pieces(seqs: DataFrame) -> DataFrame:
    """Rows (path, conv_id, n, ids): up to PIECE members of a path, their smallest id and their ids in order, comma-joined."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, ids = None, []

        def row():
            return (path, ids[0], len(ids), ",".join(map(str, ids)))

        for b in batches:
            out = []
            for p, c in zip(b["path"].tolist(), b["conv_id"].tolist()):
                if ids and (p != path or len(ids) == PIECE):
                    out.append(row())
                    ids = []
                path = p
                ids.append(c)
            yield pd.DataFrame(out, columns=["path", "conv_id", "n", "ids"])
        if ids:
            yield pd.DataFrame([row()], columns=["path", "conv_id", "n", "ids"])

    ordered = seqs.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return ordered.mapInPandas(each, "path binary, conv_id long, n long, ids string")


def paths(parts: DataFrame, shards: int) -> DataFrame:
    """Rows (path, conv_id, n, ends): each path once, in shards of neighbouring paths; ends is the digest of its members' ids."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, least, n, digest = None, 0, 0, None
        for b in batches:
            out = []
            for p, c, k, ids in zip(b["path"].tolist(), b["conv_id"].tolist(), b["n"].tolist(), b["ids"].tolist()):
                if digest is None or p != path:
                    if digest is not None:
                        out.append((path, least, n, digest.hexdigest()))
                    path, least, n, digest = p, c, 0, hashlib.sha256()
                else:
                    digest.update(b",")
                n += k
                digest.update(ids.encode())
            yield pd.DataFrame(out, columns=["path", "conv_id", "n", "ends"])
        if digest is not None:
            yield pd.DataFrame([(path, least, n, digest.hexdigest())], columns=["path", "conv_id", "n", "ends"])

    return (parts.repartitionByRange(shards, "path").sortWithinPartitions("path", "conv_id")
            .mapInPandas(each, "path binary, conv_id long, n long, ends string"))


def common_prefix(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths have in common from the start; -1 where one isn't there."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // SYMBOL
    x, y = (np.frombuffer(p, np.uint8, n * SYMBOL).reshape(n, SYMBOL) for p in (a, b))
    same = (x == y).all(axis=1)
    return n if same.all() else int(same.argmin())


def borders(placed: DataFrame) -> DataFrame:
    """Rows (shard, before, after): turns that a shard's first path shares with the last one before, and its last with the first after."""
    ends = placed.groupBy("shard").agg(F.min("path").alias("lo"), F.max("path").alias("hi"))
    order = Window.orderBy("shard")  # one row a shard
    ends = ends.select("shard", "lo", "hi", F.lag("hi").over(order).alias("last"), F.lead("lo").over(order).alias("next"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"shard": b["shard"], "before": [common_prefix(*x) for x in zip(b["lo"], b["last"])],
                                "after": [common_prefix(*x) for x in zip(b["hi"], b["next"])]})

    return ends.mapInPandas(each, "shard int, before int, after int")


class DoubleArray:
    """BASE and CHECK over turn ids from 1; the root is state 0. BASE may be negative, so that a lone child fits any free slot."""

    def __init__(self):
        self.base, self.check = np.zeros(64, np.int64), np.full(64, -1, np.int64)
        self.low, self.top = 1, 1  # the lowest free slot, and the end of those taken
        self.check[0] = 0

    def reach(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def free(self, n: int, window: int | None = None) -> np.ndarray:
        """The lowest n free slots, or as many of them as lie within a window."""
        while window is None and np.count_nonzero(self.check[self.low:] < 0) < n:
            self.reach(len(self.check) + n)
        return self.low + np.flatnonzero(self.check[self.low:self.low + window if window else None] < 0)[:n]

    def fit(self, parent: int, turns: np.ndarray) -> None:
        """Children of one parent: at the first free slot, of some, where all their places are free, else past the end."""
        steps = turns - turns[0]
        self.reach(self.low + TRIES + int(steps[-1]) + 1)
        for at in self.free(TRIES, TRIES):
            if (self.check[at + steps] < 0).all():
                break
        else:
            at = self.top
            self.reach(at + int(steps[-1]) + 1)
        self.base[parent] = at - turns[0]
        self.check[at + steps] = parent
        self.top = max(self.top, int(at + steps[-1]) + 1)

    def add(self, parents: np.ndarray, turns: np.ndarray) -> None:
        """A level's edges, sorted by parent and then turn."""
        starts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        ends = np.r_[starts[1:], len(parents)]
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            self.fit(int(parents[s]), turns[s:e])
        lone = starts[ends - starts == 1]
        if len(lone):
            at = self.free(len(lone))
            self.base[parents[lone]] = at - turns[lone]
            self.check[at] = parents[lone]
            self.top = max(self.top, int(at[-1]) + 1)
        taken = np.flatnonzero(self.check[self.low:] < 0)
        self.low = self.low + int(taken[0]) if len(taken) else len(self.check)

    def step(self, states: np.ndarray, turns: np.ndarray) -> np.ndarray:
        to = self.base[states] + turns
        if (self.check[to] != states).any():
            raise ValueError("no such transition")
        return to


def dense(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted paths: where each begins, its turns, all turns' dense ids from 1 in the order of depth, and code points by id."""
    lens = np.array([len(p) // SYMBOL for p in rows], np.int64)
    begins = np.concatenate([[0], np.cumsum(lens)[:-1]])
    symbols, which = np.unique(np.frombuffer(b"".join(rows), f"S{SYMBOL}"), return_inverse=True)
    by_depth = np.argsort(np.arange(lens.sum()) - np.repeat(begins, lens), kind="stable")
    first = np.unique(which[by_depth], return_index=True)[1]
    number = np.empty(len(symbols), np.int64)
    number[np.argsort(first)] = np.arange(1, len(symbols) + 1)
    points = np.zeros(len(symbols) + 1, np.int64)
    points[number] = np.frombuffer(symbols.tobytes(), np.uint8).reshape(-1, SYMBOL)[:, 16:].copy().view(">u4").ravel()
    return begins, lens, number[which], points


def packed(begins: np.ndarray, lens: np.ndarray, turns: np.ndarray) -> DoubleArray:
    """The double array of sorted paths, built level by level."""
    trie, state, depth = DoubleArray(), np.zeros(len(lens), np.int64), 0
    alive = np.flatnonzero(lens > 0)
    while len(alive):
        s, c = state[alive], turns[begins[alive] + depth]
        edge = np.r_[True, (s[1:] != s[:-1]) | (c[1:] != c[:-1])]
        order = np.lexsort((c[edge], s[edge]))
        trie.add(s[edge][order], c[edge][order])
        state[alive] = trie.step(s, c)
        depth += 1
        alive = alive[lens[alive] > depth]
    return trie


def nodes_of(rows: pd.DataFrame, before: int, after: int) -> pd.DataFrame:
    """A shard's nodes (columns of NODE), of paths (path, conv_id, n, ends)."""
    rows = rows.sort_values("path", kind="stable")
    keys = rows["path"].tolist()
    begins, lens, turns, points = dense(keys)
    trie = packed(begins, lens, turns)
    size = len(trie.check)
    n, least, depth = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
    cost, ends = np.zeros(size, np.int64), np.full(size, NO_IDS, object)
    count, ids = rows["n"].to_numpy(np.int64), rows["conv_id"].to_numpy(np.int64)
    n[0], least[0] = count.sum(), ids.min()
    state, alive, levels, d = np.zeros(len(keys), np.int64), np.flatnonzero(lens > 0), [np.zeros(1, np.int64)], 0
    first, last = [0], [0]  # the states along the first and the last path
    while len(alive):
        c = turns[begins[alive] + d]
        to = trie.step(state[alive], c)
        state[alive] = to
        np.add.at(n, to, count[alive])
        np.minimum.at(least, to, ids[alive])
        d += 1
        depth[to], cost[to] = d, points[c]
        levels.append(np.unique(to))
        for side, at in ((first, 0), (last, len(keys) - 1)):
            if lens[at] >= d:
                side.append(int(state[at]))
        alive = alive[lens[alive] > d]
    ends[state] = rows["ends"].to_numpy(object)
    shared = dict([(s, keys[0][:i * SYMBOL]) for i, s in enumerate(first[:before + 1])]
                  + [(s, keys[-1][:i * SYMBOL]) for i, s in enumerate(last[:after + 1])])
    new = np.ones(size, np.int64)
    new[first[:before + 1]] = 0
    every = np.concatenate(levels)
    parent = trie.check
    children, childless = np.zeros(size, np.int64), np.ones(size, bool)
    np.add.at(children, parent[every[1:]], new[every[1:]])
    childless[parent[every[1:]]] = False
    childless[last[:after + 1]] = False
    leaves, saved = childless.astype(np.int64), n * cost - new * cost
    for level in levels[:0:-1]:
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up = np.where(every == 0, -1, parent[every])
    names = {s: hashlib.md5(p).hexdigest() for s, p in shared.items()}
    return pd.DataFrame({
        "shard": np.int32(rows["shard"].iloc[0]), "state": every.astype(np.int32), "parent": up.astype(np.int32), "depth": depth[every],
        "conv_id": least[every], "parent_conv_id": pd.array(np.where(up < 0, 0, least[up]), "Int64").astype(object),
        "n_convs": n[every], "n_children": children[every], "n_leaves": leaves[every], "saved_tokens": saved[every],
        "ends_sha256": ends[every], "shared": [names.get(s) for s in every.tolist()],
        "shared_parent": [names.get(s) for s in up.tolist()]})


def trie(seqs: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the paths of seqs (conv_id, path; one row a conversation): the trie's nodes, from the root.

    conv_id is the smallest member; parent_conv_id the parent's (root: null); n_convs members, n_children children, n_leaves childless
    nodes of the subtree, saved_tokens the subtree's sum of (members - 1) x code points of the last turn, ends_sha256 the digest of the
    ids of members that end here. No conversations: no rows. A conversation without turns is a member of the root alone.
    """
    spark = seqs.sparkSession
    parts = stash(pieces(seqs))
    total = parts.agg(F.sum(F.octet_length("path"))).first()[0]
    placed = stash(paths(parts, 1 + (total or 0) // (SYMBOL * shard)).withColumn("shard", F.spark_partition_id()))
    discard(parts)

    def pack(rows: pd.DataFrame, border: pd.DataFrame) -> pd.DataFrame:
        return nodes_of(rows, int(border["before"].iloc[0]), int(border["after"].iloc[0]))

    nodes = stash(placed.groupBy("shard").cogroup(borders(placed).groupBy("shard")).applyInPandas(pack, NODE))
    discard(placed)
    own = nodes.where("shared IS NULL")
    seen = nodes.where("shared IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    digest = F.coalesce(F.max(F.nullif(F.col("ends_sha256"), F.lit(NO_IDS))), F.lit(NO_IDS)).alias("ends_sha256")
    merged = stash(seen.groupBy("shared", "shared_parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, digest))
    named = merged.select(F.col("shared").alias("_name"), F.col("conv_id").alias("_upper"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    upper = merged.join(named, merged["shared_parent"] == named["_name"], "left").withColumn("parent_conv_id", F.col("_upper"))
    # a shard's own nodes under shared ones ask by (shard, state), so that no parent's children meet in one task
    above = seen.join(named, seen["shared"] == named["_name"]).select("shard", F.col("state").alias("parent"), "_upper")
    under = own.where("shared_parent IS NOT NULL").join(above, ["shard", "parent"]).withColumn("parent_conv_id", F.col("_upper"))
    inner = own.where("shared_parent IS NULL").withColumn("parent_conv_id", F.when(F.col("parent") >= 0, F.col("parent_conv_id")))
    return upper.select(*columns).unionByName(under.select(*columns)).unionByName(inner.select(*columns))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(regrafted(sequences(load(spark, sf_dir, "conversations"))))


def op11_sql() -> str:
    return f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
own AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
kept AS (
  SELECT c, l, (xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda acc, byte: xor(acc >> 8, t[(xor(acc, byte) & 255) + 1]))) % {KEEP})::BIGINT AS h FROM own, crc_table),
rebuilt AS (
  SELECT k.c, list_concat(coalesce(f.l, [])[:k.h], k.l[k.h + 1:]) AS l
  FROM kept k LEFT JOIN own f ON f.c = k.c - k.c % {GROUP}),
prefixes AS (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM rebuilt),
nodes AS (
  SELECT l[:d] AS p, d, min(c) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CASE WHEN len(l) = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
  FROM prefixes GROUP BY l[:d], d),
children AS (SELECT p[:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY p[:d - 1]),
whole AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n - 1) * length(nodes.p[d].text) ELSE 0 END AS saved
  FROM nodes LEFT JOIN children ON nodes.p = children.p),
below AS (SELECT p, d, n_children, saved, unnest(range(d + 1)) AS k FROM whole),
sums AS (
  SELECT p[:k] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY p[:k])
SELECT w.conv_id::BIGINT AS conv_id, w.d::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, w.n::BIGINT AS n_convs,
  w.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, w.ends AS ends_sha256
FROM whole w JOIN sums s ON w.p = s.p LEFT JOIN nodes u ON w.d > 0 AND u.p = w.p[:w.d - 1]"""
