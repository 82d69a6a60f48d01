"""Best-fit packing of token pieces into sequences by a configuration linear program over the length histogram.

The histogram has at most `capacity` entries, whatever the number of documents, so the program is solved on the driver: weights on
the lengths, multiplied after each round; a round's price query is a bounded knapsack (dynamic programming) for the configuration
of largest weight; the rounds' configurations are the fractional solution. Rounding takes whole multiples of them while pieces
remain; what is left goes to its best fit, length by length. The plan, of a size that also depends on `capacity` alone, is then
applied to all pieces by their numbers within their length.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, stash

CAPACITY, ROUNDS, RATE, END_ID, CACHE = 4096, 64, 10.0, 1, 600_000
LONG = 1 << 20  # bytes of text split into words at once
SHARES = (1.0, 0.95, 0.9, 0.8, 0.7, 0.6)  # of the fractional solution, tried in rounding


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


MARK = "\0"  # stands for the vocabulary's word end while words are encoded


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_table(path: str, word_end: str = "</w>") -> tuple[dict[bytes, int], np.ndarray]:
    """The vocabulary's merges in order as {bytes: rank}, word ends written as MARK, and the token id of each rank."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_letters()

    def raw(token: str) -> bytes:
        body = token.removesuffix(word_end)
        return bytes(letters[c] for c in body) + MARK.encode() * (body != token)

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + MARK.encode(): 256 + b for b in range(256)}
    for pair in model["merges"]:
        ranks.setdefault(raw("".join(pair if isinstance(pair, list) else pair.split(" "))), len(ranks))
    ids = np.zeros(len(ranks), dtype="<u4")
    for token, i in model["vocab"].items():
        if all(c in letters for c in token.removesuffix(word_end)) and raw(token) in ranks:
            ids[ranks[raw(token)]] = i
    return ranks, ids


class Encoder:
    """Token ids of texts as bytes (little-endian unsigned 32 bit). The vocabulary drops white space, never joins across it and ignores
    case, so a text's ids are those of its words, split at ASCII white space, in turn; a bounded cache keeps each word's.

    New words of Latin letters and ASCII signs run through the same merges many at a time; all others, which the vocabulary's
    normalizer may change, one by one through the tokenizer itself.
    """

    SPACE = re.compile(rb"[ \t-\r]")

    def __init__(self, path: str, table: tuple[dict[bytes, int], np.ndarray], cache: int = CACHE):
        import regex
        import tiktoken

        self.path, self.cache, self.known, self.tokenizer = path, cache, {}, None
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # signs and letters that composition (NFC) leaves alone and whose lower case doesn't depend on their neighbours
        self.plain = regex.compile(r"[!-~\u00c0-\u012f\u0132-\u017e]+")
        self.merges = tiktoken.Encoding("merges", pat_str=r"[^\x00]*\x00", mergeable_ranks=table[0], special_tokens={})
        self.token_ids = table[1]

    def _learn(self, words: set[bytes]) -> None:
        plain, odd, lowered = [], [], {}
        for w in words:
            text = w.decode("utf-8")
            if self.plain.fullmatch(text) and "<|" not in text:
                plain.append(w)
                lowered[w] = text.lower()
            else:
                odd.append((w, text))
        if plain:
            # every word's parts end in MARK, and a lone MARK ends the word
            marked = self.words.sub(r"\g<0>" + MARK, "\n".join(lowered.values()) + "\n").replace("\n", MARK)
            ranks = np.array(self.merges.encode_ordinary(marked), dtype=np.int64)
            ends = np.flatnonzero(ranks == 0)
            raw = self.token_ids[np.delete(ranks, ends)].tobytes()
            cuts = ((ends - np.arange(len(ends))) * 4).tolist()
            for w, start, end in zip(plain, [0, *cuts], cuts):
                self.known[w] = raw[start:end]
        if odd:
            if self.tokenizer is None:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.path)
            found = self.tokenizer.encode_batch_fast([text for _, text in odd], add_special_tokens=False)
            for (w, _), e in zip(odd, found):
                self.known[w] = np.array(e.ids, dtype="<u4").tobytes()

    def _ids(self, lists: list[list[bytes]]) -> list[bytes]:
        needed = set().union(*lists)
        fresh = needed - self.known.keys()
        if len(self.known) + len(fresh) > self.cache:
            self.known.clear()
            fresh = needed
        if fresh:
            self._learn(fresh)
        find = self.known.__getitem__
        return [b"".join(map(find, words)) for words in lists]

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text; short texts some hundred at once, long ones a megabyte at once."""
        run, size = [], 0
        for text in texts:
            raw = (text or "").encode("utf-8", "replace").lower()  # lower-cases ASCII; the vocabulary's own rule does the rest
            if len(raw) > LONG:
                yield from self._ids(run)
                run, size = [], 0
                yield self._long(raw)
            else:
                run.append(raw.split())
                size += len(raw)
                if size > LONG:
                    yield from self._ids(run)
                    run, size = [], 0
        yield from self._ids(run)

    def _long(self, raw: bytes) -> bytes:
        out, at = [], 0
        while at < len(raw):
            cut = self.SPACE.search(raw, min(len(raw), at + LONG))
            end = cut.start() if cut else len(raw)
            out += self._ids([raw[at:end].split()])
            at = end
        return b"".join(out)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, task, nth): nth numbers a task's pieces of one length from 0."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    table = docs.sparkSession.sparkContext.broadcast(merge_table(path))  # of the vocabulary's fixed size

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, seen, task = Encoder(path, table.value), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            rows = []
            for doc_id, ids in zip(b["doc_id"], encode(b["text"])):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc_id, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]).astype({"doc_id": "Int64"})

    # a null doc_id stays null: nullable integers on both ways
    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = source.mapInPandas(each, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")
    return out


def best_configuration(value: np.ndarray, lengths: np.ndarray, count: np.ndarray, capacity: int) -> dict[int, int]:
    """{index of length: copies} of largest total value within the capacity, at most `count` copies each: bounded knapsack, the
    copies of a length split into powers of two."""
    best, items, taken = np.zeros(capacity + 1), [], []
    for i, (length, most) in enumerate(zip(lengths.tolist(), count.tolist())):
        left, size = min(most, capacity // length), 1
        while left > 0:
            size = min(size, left)
            w, gain = length * size, value[i] * size
            other = best[:capacity + 1 - w] + gain
            better = other > best[w:]
            best[w:] = np.where(better, other, best[w:])
            items.append((i, size, w))
            taken.append(np.packbits(better))
            left, size = left - size, size * 2
    at, chosen = int(best.argmax()), {}
    for (i, size, w), bits in zip(reversed(items), reversed(taken)):
        if at >= w and (bits[(at - w) >> 3] >> (7 - ((at - w) & 7))) & 1:
            chosen[i] = chosen.get(i, 0) + size
            at -= w
    return chosen


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, rate: float = RATE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (times, [(length, copies), ...]) that together hold exactly the pieces of the histogram {length: count}."""
    lengths = np.array(sorted(histogram, reverse=True), dtype=np.int64)
    left = np.array([histogram[x] for x in lengths.tolist()], dtype=np.int64)
    if not len(lengths):
        return []
    demand = left.astype(float)
    # covering program: min sum x_c with sum_c a_lc x_c >= demand_l. A length's weight falls as it is covered.
    covered, chosen = np.zeros(len(lengths)), []
    total = float((lengths * demand).sum()) / capacity
    for _ in range(rounds):
        lag = -rate * covered / demand
        dual = np.exp(lag - lag.max())
        # a piece's price: its length by its dual weight; equal duals make the fullest sequence the best
        config = best_configuration(lengths * dual, lengths, np.minimum(left, capacity), capacity)
        index, copies = np.array(list(config)), np.array(list(config.values()), dtype=float)
        step = min(total / rounds, float((demand[index] / copies).min()))
        covered[index] += copies * step
        chosen.append((index, copies.astype(np.int64), step))
    roundings = (rounded(lengths, demand.astype(np.int64), chosen, share, capacity) for share in SHARES)
    return min(roundings, key=lambda patterns: sum(times for times, _ in patterns))


def rounded(lengths: np.ndarray, left: np.ndarray, chosen: list, share: float, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """The configurations taken a whole number of times each, about `share` of their fractional value as far as pieces remain; the
    remaining pieces by best fit."""
    patterns, due = [], 0.0
    for index, copies, step in chosen:
        due += step * share
        times = min(int(due), int((left[index] // copies).min()))
        if times > 0:
            due -= times
            left[index] -= copies * times
            patterns.append((times, list(zip(lengths[index].tolist(), copies.tolist()))))
    return patterns + best_fit(dict(zip(lengths.tolist(), left.tolist())), capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit of decreasing lengths, equal sequences handled together: the number of patterns doesn't depend on the counts."""
    open_: dict[int, list[list]] = {}  # free space: [times, parts]
    spaces: list[int] = []

    def put(free: int, times: int, parts: list) -> None:
        if free not in open_:
            open_[free] = []
            bisect.insort(spaces, free)
        open_[free].append([times, parts])

    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count > 0:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                free = spaces[at]
                times, parts = open_[free].pop()
                if not open_[free]:
                    del open_[free], spaces[at]
                copies = min(free // length, count)
                if count >= times * copies:
                    used = times
                else:
                    copies = 1 if count < 2 * times else min(copies, count // times)
                    used = min(times, count // copies)
                if used < times:
                    put(free, times - used, parts)
                put(free - copies * length, used, [*parts, (length, copies)])
                count -= used * copies
            else:
                copies = min(capacity // length, count)
                put(capacity - copies * length, count // copies, [(length, copies)])
                count -= count // copies * copies
    return [(times, parts) for groups in open_.values() for times, parts in groups]


def ranges(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length, rows (first number, copies, first sequence, offset): where the pieces of that length, numbered from 0, go."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for times, parts in patterns:
        offset = 0
        for length, copies in parts:
            first = used.get(length, 0)
            out.setdefault(length, []).append((first, copies, sequence, offset))
            used[length] = first + copies * times
            offset += copies * length
        sequence += times
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone. Documents longer than the capacity are cut, no others. Repeated rows are packed as
    often as they stand; null doc_ids stay. Empty table: no rows. Other columns are not read. Pieces of equal length are
    interchangeable; they are numbered by task and place in the task, from a table written once.
    """
    cut = stash(pieces(docs, path or tokenizer_path(), capacity))
    counts = stash(cut.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    spark = docs.sparkSession
    plan = spark.sparkContext.broadcast(ranges(solve(histogram, capacity, rounds)))  # bounded by the capacity
    # number of the first piece of a task within its length; a row per length and task
    before = counts.selectExpr("length", "task", "sum(n) OVER (PARTITION BY length ORDER BY task) - n AS first")
    numbered = cut.join(before, ["length", "task"]).withColumn("number", F.col("first") + F.col("nth"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length, number = b["length"].to_numpy(), b["number"].to_numpy()
            sequence, offset = np.empty(len(b), np.int64), np.empty(len(b), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(length[order])) + 1, [len(order)]])
            for s, e in zip(cuts[:-1], cuts[1:]):
                if s == e:
                    continue
                at, rows = order[s:e], plan.value[int(length[order[s]])]
                k = rows[np.searchsorted(rows[:, 0], number[at], "right") - 1]
                turn, copy = np.divmod(number[at] - k[:, 0], k[:, 1])
                sequence[at], offset[at] = k[:, 2] + turn, k[:, 3] + copy * length[at]
            yield b.drop(columns="number").assign(sequence_id=sequence, offset=offset)

    shape = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return (numbered.select(F.col("doc_id"), "piece", "start", "length", "ids_crc32", "number")
            .mapInArrow(_frames(each), f"{shape}, sequence_id long, offset long"))


def _frames(each):
    """mapInArrow with nullable integers, so that null doc_ids keep the column whole numbers."""
    import pyarrow as pa

    types = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}

    def run(batches):
        frames = (b.to_pandas(types_mapper=types.get) for b in batches)
        for out in each(frames):
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    return run


def op7_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))
