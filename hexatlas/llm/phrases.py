"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then counted exactly.

First pass: tasks send what they count, hashed, to hash partitions of the n-grams. A partition learns its mass (all occurrences in it)
first and merges the counts into a Misra-Gries summary of mass / LEAST + 1 counters: a merge that has more takes the largest one beyond
from all and drops those used up. That costs an n-gram under mass / counters < LEAST occurrences in all, so each one that
occurs LEAST times survives, whatever its partition. Survivors leave as a bitmap of 2^BITS bits, whatever the data.

Second pass: only n-grams whose bit is set are counted by their words, pre-aggregated in each task; exact counts under LEAST go. Where
so many survive that the bitmap fills up it stops helping, and the exact count does all the work.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, stash
from .grams import bundles, grams, mixed, words

LEAST, LONGEST, TOP, COVERED = 10, 3, 2000, 50
BITS, KEY_BITS, PLAIN, MASS, FLUSH = 27, 40, 3, 1 << 23, 1 << 22
GAPS, STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"


def language(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def occurrences(texts: list, langs: list[str], longest: int, lanes: int) -> Iterator[tuple]:
    """Per length: the words, where an n-gram begins, and its hashes, which hold its language and length."""
    found = words(texts, GAPS, STOPS, lanes)
    salt = np.array([language(x) for x in langs], np.uint64)[found.text]
    for n in range(1, longest + 1):
        ok = np.flatnonzero(found.piece[:len(found.piece) - n + 1] == found.piece[n - 1:])
        yield n, found, ok, [mixed(grams(h, n)[ok] ^ salt[ok]) for h in found.lanes]


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps: PLAIN low bytes each, which nothing shortens, then the high ones compressed."""
    steps = np.r_[keys[:1], keys[1:] - keys[:-1]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8].T
    return len(keys).to_bytes(8, "little") + steps[:PLAIN].tobytes() + zlib.compress(steps[PLAIN:].tobytes(), 1)


def unpacked_keys(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    cut = 8 + PLAIN * n
    out = np.zeros((n, 8), np.uint8)
    out[:, :PLAIN] = np.frombuffer(data[8:cut], np.uint8).reshape(PLAIN, n).T
    out[:, PLAIN:KEY_BITS // 8] = np.frombuffer(zlib.decompress(data[cut:]), np.uint8).reshape(KEY_BITS // 8 - PLAIN, n).T
    return out.view("<u8").ravel().cumsum(dtype=np.uint64)


def local_counts(docs: DataFrame, longest: int, split: int) -> DataFrame:
    """Rows (p, mass) and (p, once, often, counts): what a task counted of hash partition p (of 2^split), its mass in a row of its own."""

    def rows(pending: list[np.ndarray]) -> pd.DataFrame:
        h = np.concatenate(pending)
        pending.clear()
        h.sort()
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        c, h = np.diff(np.r_[first, len(h)]), h[first]
        del first
        cuts = np.searchsorted(h, np.arange(1 << split, dtype=np.uint64) << np.uint64(64 - split)) if split else [0]
        cuts = [*map(int, cuts), len(h)]
        out = []
        for p, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
            if s == e:
                continue
            k, n = (h[s:e] << np.uint64(split)) >> np.uint64(64 - KEY_BITS), c[s:e]
            many = n > 1
            out.append((p, int(n.sum()), None, None, None))
            out.append((p, None, packed(k[~many]), packed(k[many]), zlib.compress(n[many].astype("<i8").tobytes(), 1)))
        return pd.DataFrame(out, columns=["p", "mass", "once", "often", "counts"]).astype({"mass": "Int64"})

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending, size = [], 0
        for b in batches:
            texts, langs = b["text"].tolist(), b["lang"].tolist()
            for s in bundles(texts):
                for _, _, _, (h,) in occurrences(texts[s], langs[s], longest, 1):
                    pending.append(h)
                    size += len(h)
                if size >= FLUSH:
                    yield rows(pending)
                    pending, size = [], 0
        if size:
            yield rows(pending)

    return docs.mapInPandas(each, "p int, mass long, once binary, often binary, counts binary")


class Summary:
    """Misra-Gries counters of one hash partition. `lost` is the most that any n-gram's counter can lack."""

    def __init__(self, least: int):
        self.least, self.mass, self.lost = least, 0, 0
        self.keys, self.counts, self.pending, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

    @property
    def capacity(self) -> int:
        return self.mass // self.least + 1

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.pending.append((keys, counts))
        self.size += len(keys)
        if self.size >= max(FLUSH // 4, self.capacity // 2):
            self.merge()

    def merge(self) -> None:
        keys, counts = (np.concatenate(x) for x in zip((self.keys, self.counts), *self.pending))
        self.pending, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        beyond = len(self.keys) - self.capacity
        if beyond > 0:
            cut = np.partition(self.counts, beyond - 1)[beyond - 1]
            left = self.counts > cut
            self.keys, self.counts, self.lost = self.keys[left], self.counts[left] - cut, self.lost + int(cut)

    def survivors(self) -> np.ndarray:
        """Keys of all that occurred `least` times, and of few that did not."""
        self.merge()
        return self.keys[self.counts + self.lost >= self.least]


def surviving(local: DataFrame, least: int, split: int) -> np.ndarray:
    """The bitmap of survivors: bit i (from the highest of byte 0) for hashes whose upper BITS bits are i."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, summary = None, None

        def row() -> pd.DataFrame:
            bits = np.zeros(1 << (BITS - split), bool)
            bits[summary.survivors() >> np.uint64(KEY_BITS - BITS + split)] = True
            return pd.DataFrame([(part, zlib.compress(np.packbits(bits).tobytes(), 1))], columns=["p", "bits"])

        for b in batches:
            for p, mass, once, often, counts in b.itertuples(index=False, name=None):
                if p != part:
                    if summary is not None:
                        yield row()
                    part, summary = p, Summary(least)
                if once is None:
                    summary.mass += int(mass)
                else:
                    for keys, n in ((unpacked_keys(once), None), (unpacked_keys(often), np.frombuffer(zlib.decompress(counts), "<i8"))):
                        summary.add(keys, np.ones(len(keys), np.int64) if n is None else n)
        if summary is not None:
            yield row()

    ordered = local.repartition(1 << split, "p").sortWithinPartitions("p", F.col("mass").isNull())
    out = np.zeros(1 << (BITS - 3), np.uint8)
    step = 1 << (BITS - split - 3)
    for p, bits in ordered.mapInPandas(each, "p int, bits binary").toPandas().itertuples(index=False, name=None):
        out[p * step:(p + 1) * step] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return out


def exact(docs: DataFrame, kept: np.ndarray, least: int, longest: int, split: int) -> DataFrame:
    """Rows (lang, phrase, f): exact counts of at least `least` of n-grams whose bit is set; with a null phrase, of all words.

    A task sends its counts of a hash partition as one value; the partition sums them by language and words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(kept)

    def rows(counts: dict[int, dict[bytes, int]]) -> pd.DataFrame:
        return pd.DataFrame([(p, zlib.compress(pickle.dumps(c), 1)) for p, c in counts.items()], columns=["p", "counts"])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap, counts, size = sent.value, defaultdict(dict), 0
        for b in batches:
            texts, langs = b["text"].tolist(), b["lang"].tolist()
            for s in bundles(texts):
                prefix = [x.encode("utf-8", "surrogatepass") + b"\n" for x in langs[s]]  # no word holds a line feed
                for n, found, begin, (g, g2) in occurrences(texts[s], langs[s], longest, 2):
                    if n == 1:
                        for i, c in zip(*(x.tolist() for x in np.unique(found.text, return_counts=True))):
                            counts[0][prefix[i]] = counts[0].get(prefix[i], 0) + c
                    at = (g >> np.uint64(64 - BITS)).astype(np.int64)
                    some = np.flatnonzero((bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
                    if not len(some):
                        continue
                    order = some[np.lexsort((g2[some], g[some]))]
                    first = np.flatnonzero(np.r_[True, (g[order][1:] != g[order][:-1]) | (g2[order][1:] != g2[order][:-1])])
                    w = begin[order[first]]
                    lo, hi = found.start[w], found.end[w + n - 1]
                    plain = hi - lo == sum(found.end[w + i] - found.start[w + i] for i in range(n)) + n - 1
                    part = at[order[first]] >> (BITS - split)
                    times = np.diff(np.r_[first, len(order)])
                    for p, x, y, one, i, c in zip(*(v.tolist() for v in (part, lo, hi, plain, found.text[w], times))):
                        phrase = found.data[x:y].replace(b"\t", b" ")
                        key, own = prefix[i] + (phrase if one else b" ".join(phrase.split())), counts[p]
                        if key in own:
                            own[key] += c
                        else:
                            own[key] = c
                            size += 1
                if size > FLUSH // 16:
                    yield rows(counts)
                    counts, size = defaultdict(dict), 0
        if counts:
            yield rows(counts)

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, counts = None, {}

        def frame() -> pd.DataFrame:
            named = ((*k.decode("utf-8", "surrogatepass").rsplit("\n", 1), n) for k, n in counts.items())
            return pd.DataFrame([(lang, p or None, n) for lang, p, n in named if n >= least or not p], columns=["lang", "phrase", "f"])

        for b in batches:
            for p, data in b.itertuples(index=False, name=None):
                if p != part:
                    yield frame()
                    part, counts = p, {}
                for k, n in pickle.loads(zlib.decompress(data)).items():
                    counts[k] = counts.get(k, 0) + n
        yield frame()

    dealt = docs.mapInPandas(each, "p int, counts binary").repartition(1 << split, "p").sortWithinPartitions("p")
    return dealt.mapInPandas(total, "lang string, phrase string, f long")


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """Rows (lang, phrase, f), a written table: all phrases of 1 to `longest` words that occur `least` times, and with a null
    phrase the number of words of each language.

    Null texts are empty, null languages `und`. No documents or no words: no rows.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    split = min(max(size // MASS, 1).bit_length(), BITS - 9)
    kept = surviving(local_counts(docs, longest, split), least, split)
    return stash(exact(docs, kept, least, longest, split))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to 3 words.

    A phrase is cut where a * a / (l * r) is least, the score in millionths of it. One that stands in a longer phrase of at least
    `covered` hundredths of its occurrences goes. Ties: higher a, then the phrase's bytes. Repeated rows count each time; columns other
    than text and lang are not read. No documents: no rows.
    """
    counts = frequent(docs, least, 3)
    known = counts.where("phrase IS NOT NULL")
    head = F.substring_index("phrase", " ", 1)
    tail = F.substring_index("phrase", " ", -1)
    spaces = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    both = known.withColumns({"head": head, "tail": tail, "size": spaces + 1}).where("size > 1")
    both = both.withColumns({"rest": F.expr("substring(phrase, length(head) + 2)"),
                             "most": F.expr("substring(phrase, 1, length(phrase) - length(tail) - 1)")})
    cut = lambda k, x, y: F.struct(F.lit(k).alias("k"), F.col(x).alias("x"), F.col(y).alias("y"))
    cuts = both.select("lang", "phrase", F.col("f").alias("a"), F.explode(
        F.when(F.col("size") == 2, F.array(cut(1, "head", "tail"))).otherwise(F.array(cut(1, "head", "rest"), cut(2, "most", "tail")))
    ).alias("c")).select("lang", "phrase", "a", "c.*")
    part = lambda of, f: known.select("lang", F.col("phrase").alias(of), F.col("f").alias(f))
    big = lambda c: F.col(c).cast("decimal(15,0)")
    priced = cuts.join(part("x", "l"), ["lang", "x"]).join(part("y", "r"), ["lang", "y"])
    priced = priced.withColumns({"_above": F.lit(1_000_000).cast("decimal(7,0)") * big("a") * big("a"), "_below": big("l") * big("r")})
    priced = priced.withColumn("score", F.expr("_above div _below"))
    lowest = priced.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    inner = (both.where("size = 3").select("lang", "f", F.explode(F.array("most", "rest")).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("f").alias("_longer")))
    left = (lowest.join(inner, ["lang", "phrase"], "left")
            .where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * covered))
            .select("lang", "phrase", "a", "s.l", "s.r", "s.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents"))


def op12_sql() -> str:
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k)),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM counts WHERE k > 1),
priced AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
lowest AS (SELECT * FROM priced QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS phrase, a FROM cuts WHERE len(w) = 3 AND cut = 1),
gone AS (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY lang, phrase),
ranked AS (
  SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(o.phrase)) AS rank
  FROM lowest o LEFT JOIN gone g ON g.lang = o.lang AND g.phrase = o.phrase WHERE most IS NULL OR 100 * most < {COVERED} * a)
SELECT k.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked k JOIN sizes s ON s.lang = k.lang WHERE rank <= {TOP}"""
