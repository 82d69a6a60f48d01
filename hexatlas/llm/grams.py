"""Words of whole texts as 64-bit hashes, many texts at a time in numpy, and the hashes of their n-grams.

A word's hash sums, over its bytes, a fixed random number for the byte times a power of an odd multiplier for its place, modulo 2^64.
Two lanes with other numbers are independent: 128 bits together. Texts are taken whole; work arrays stay within some times CHUNK bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

CHUNK = 1 << 21
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    data: bytes  # the texts, lower-cased (A-Z only), one after another
    text: np.ndarray  # number of the text that a word stands in
    piece: np.ndarray  # number of the piece: words in a row share it unless a stop stands between
    start: np.ndarray
    end: np.ndarray
    lanes: tuple[np.ndarray, ...]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0 to n-1 and their inverses modulo 2^64."""
    if lane not in _powers or len(_powers[lane][0]) < n:
        size = max(n, CHUNK + 1)
        pair = []
        for m in (MULTIPLIERS[lane], pow(MULTIPLIERS[lane], -1, 1 << 64)):
            steps = np.full(size, m, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        _powers[lane] = tuple(pair)
    return _powers[lane]


def numbers(lane: int, word_bytes: np.ndarray) -> np.ndarray:
    """A fixed random odd number for each byte of words, 0 for others."""
    drawn = np.random.default_rng(7 + lane).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
    return np.where(word_bytes, drawn, np.uint64(0))


def hashed(data: np.ndarray, word_bytes: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int) -> np.ndarray:
    out, of = np.empty(len(start), np.uint64), numbers(lane, word_bytes)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, "right")))
        lo, hi = int(start[at]), int(end[to - 1])
        up, down = powers(hi - lo, lane)
        begins = start[at:to] - lo
        out[at:to] = np.add.reduceat(of[data[lo:hi]] * up[:hi - lo], begins) * down[begins]
        at = to
    return mixed(out)


def words(texts: list[str | None], gaps: bytes, stops: bytes, lanes: int = 1) -> Words:
    """Words of all texts: runs of bytes outside gaps and stops. A line feed has to be one of them. Null: no words."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = b"\n".join(parts).lower()
    data = np.frombuffer(raw, np.uint8)
    kind = np.zeros(256, np.uint8)
    kind[list(gaps)], kind[list(stops)] = 1, 2
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data] == 0
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    bounds = np.cumsum([len(p) + 1 for p in parts])
    text = np.searchsorted(bounds, start, "right")
    piece = np.searchsorted(np.flatnonzero(kind[data] == 2), start) if stops else text
    return Words(raw, text, piece, start, end, tuple(hashed(data, kind == 0, start, end, i) for i in range(lanes)))


def grams(lane: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words in a row."""
    if len(lane) < n:
        return np.empty(0, np.uint64)
    out = mixed(lane[:len(lane) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = mixed(out * np.uint64(MULTIPLIERS[0]) + lane[i:len(lane) - n + 1 + i])
    return out


def bundles(texts: list[str | None], limit: int = CHUNK) -> Iterator[slice]:
    """Runs of texts of about `limit` characters in all, or of one longer text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > at and size + n > limit:
            yield slice(at, i)
            at, size = i, 0
        size += n + 1
    if at < len(texts):
        yield slice(at, len(texts))
