"""Prefix tries, phrases and the n-gram join against brute force, and on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hexatlas.llm import grams, ngram_join, phrases, tries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: the columns of documents and names that the operators use within
SHAPE = ("doc_id long, text string, lang string, row string, d long, t long, sid long, `key` long, n long, root long, phrase string, "
         "f long, u long, `a.b` int")


def documents(spark, rows):
    full = [(i, t, lang, "r", 1, 2, 3, 4, 5, 6, "p", 7, 8, 9) for i, t, lang in rows]
    return spark.createDataFrame(full, SHAPE)


# --- words and hashes

def test_words_are_those_of_a_pattern_and_hashes_follow_them():
    rng = random.Random(3)
    texts = ["".join(rng.choices("aAb É\t\n\x0b.,\x00\x1c", k=rng.randrange(40))) for _ in range(300)] + [None, "", "x" * 70_000 + " y", "y"]
    got = grams.words(texts, b" \t", b".,\n\x0b", 2)
    want, pieces, number = [], [], 0
    for i, text in enumerate(texts):
        for piece in re.split("[.,\n\x0b]", (text or "").translate(LOWER)):
            for w in re.findall("[^ \t]+", piece):
                want.append((i, w))
                pieces.append(number)
            number += 1
    found = [(int(i), got.data[s:e].decode()) for i, s, e in zip(got.text, got.start, got.end)]
    assert found == want
    same = lambda x: [a == b for a, b in zip(x, x[1:])]
    assert same(pieces) == same(got.piece.tolist())
    for lane in got.lanes:
        named = defaultdict(set)
        for (_, w), h in zip(want, lane.tolist()):
            named[w].add(h)
        assert all(len(v) == 1 for v in named.values()) and len({min(v) for v in named.values()}) == len(named)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(2000))
    whole = grams.words([text], b" ", b"\n").lanes[0]
    monkeypatch.setattr(grams, "CHUNK", 64)
    assert (grams.words([text], b" ", b"\n").lanes[0] == whole).all()
    assert list(grams.bundles(["a" * 100, None, "b", "c" * 200, "d"], 64)) == [slice(0, 1), slice(1, 3), slice(3, 4), slice(4, 5)]


# --- tries

def trie_by_hand(turns, graft):
    talks = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            talks[c].append(((turn is not None, turn or 0), tries_symbol(role, text), role or "", text or ""))
    talks = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in talks.items()}
    if graft:
        built = {}
        for c, own in talks.items():
            h = zlib.crc32(str(c).encode()) % 6
            first = c - int(np.fmod(c, 100))
            built[c] = talks.get(first, [])[:h] + own[h:]
        talks = built
    members, ends = defaultdict(list), defaultdict(list)
    for c, talk in talks.items():
        for d in range(len(talk) + 1):
            members[tuple(talk[:d])].append(c)
        ends[tuple(talk)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def tries_symbol(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest() + len(text).to_bytes(4, "big")


def trie_rows(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    rows = []
    for c in range(260):
        talk = [("system", "be kind")] if c % 3 else []  # two thirds share a first turn
        talk += [(rng.choice(["user", None]), rng.choice(["hé", "hello 😀", "", None, "x" * 30])) for _ in range(rng.randrange(5))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(talk)]
    rows += [(300 + c, i, "user", "same talk") for c in range(120) for i in range(3)]  # a third are one conversation
    rows += [(500, i, "user", str(i % 2)) for i in range(60)] + [(501, i, "user", str(i % 2)) for i in range(58)]
    rows += [(-7, 0, "user", "minus"), (None, 0, "user", "no id"), (None, 1, None, None), (600, None, "user", "first"),
             (600, 0, "user", "second"), (601, 0, "user", "tie b"), (601, 0, "user", "tie a"), (601, 0, "user", "tie a"), (700, 0, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [5, 200, 1 << 15])
def test_trie_equals_brute_force(spark, turns, shard):
    # whichever way the paths are cut into shards
    table = spark.createDataFrame([(c, i, r, t, 1, "k") for c, i, r, t in turns],
                                  "conv_id long, turn int, role string, text string, shard int, path string")
    seqs = tries.sequences(table)
    assert trie_rows(tries.trie(tries.regrafted(seqs), shard)) == trie_by_hand(turns, True)
    if shard == 200:
        assert trie_rows(tries.trie(seqs, shard)) == trie_by_hand(turns, False)


def test_tries_without_turns(spark):
    shape = "conv_id long, turn int, role string, text string"
    assert tries.trie(tries.sequences(spark.createDataFrame([], shape))).collect() == []
    bare = tries.trie(spark.createDataFrame([(4, bytearray(b"")), (9, bytearray(b""))], "conv_id long, path binary"))
    assert trie_rows(bare) == [(4, 0, -1, 2, 0, 1, 0, hashlib.sha256(b"4,9").hexdigest())]


def test_pieces_of_ids_are_joined_in_order(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 7)
    seqs = spark.createDataFrame([(i, bytearray(b"a" * 20)) for i in range(-30, 170)], "conv_id long, path binary")
    got = {r["depth"]: r for r in tries.trie(seqs.repartition(13)).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(-30, 170))).encode()).hexdigest()
    assert got[1]["n_convs"] == 200 and got[1]["conv_id"] == -30


def test_double_array_holds_each_path_and_no_other():
    rng = random.Random(8)
    paths = sorted({bytes(rng.choices(range(4), k=rng.randrange(1, 7))) for _ in range(400)} | {bytes([7, i]) for i in range(250)})
    rows = [b"".join(bytes([x]) * 20 for x in p) for p in paths]
    begins, lens, turns, _ = tries.dense(rows)
    trie = tries.packed(begins, lens, turns)
    prefixes, states = set(), set()
    for p, b, n in zip(paths, begins.tolist(), lens.tolist()):
        s = np.zeros(1, np.int64)
        for d in range(n):
            s = trie.step(s, turns[b + d:b + d + 1])
            prefixes.add(p[:d + 1])
            states.add((p[:d + 1], int(s[0])))
    assert len(states) == len(prefixes) == len({s for _, s in states}) == np.count_nonzero(trie.check[1:] >= 0)


# --- phrases

def phrases_by_hand(rows, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cand.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * cand.get(q, 0)}
        scored = []
        for p, a in cand.items():
            score, k = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, s[2].decode(), -s[1], s[3], s[4], sizes[lang], -s[0]) for i, s in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(9)
    zipf = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    rows = []
    for i in range(150):
        w = rng.choices(zipf, k=rng.randrange(60))
        w = [x + rng.choice(["", "", "", ".", "\n", "\t", "!?", "\x0b", "\x1cé"]) for x in w]
        rows.append((i, rng.choice([" ", "  ", " \t"]).join(w), rng.choice(["en", "en", "de", None])))
    rows += [(200 + i, "Hot phrase here, every time", "en") for i in range(80)]  # a third of all rows
    rows += [(None, None, None), (None, "", "en"), (1, "only one", "fr"), (1, "only one", "fr"), (300, "a b " * 5000, "en")]
    return rows


def test_phrases_equal_brute_force(spark, spoken, monkeypatch):
    monkeypatch.setattr(phrases, "FLUSH", 1 << 9)  # many summaries and merges
    for least, top in ((10, 2000), (3, 15)):
        got = sorted(tuple(r) for r in phrases.collocations(documents(spark, spoken), least, top).collect())
        assert got == phrases_by_hand(spoken, least, top)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    assert phrases.collocations(documents(spark, [(1, None, None), (2, " . ", "en")])).collect() == []


def test_summaries_keep_all_that_is_frequent(monkeypatch):
    monkeypatch.setattr(phrases, "FLUSH", 256)
    rng = np.random.default_rng(4)
    for least in (3, 10):
        keys = np.concatenate([rng.integers(0, 400, 4000), rng.integers(0, 10 ** 6, 20_000), np.full(9000, 5)]).astype(np.uint64)
        rng.shuffle(keys)
        summary, parts = phrases.Summary(least), [np.unique(p, return_counts=True) for p in np.array_split(keys, 200)]
        summary.mass = len(keys)
        for k, c in parts:
            summary.add(k, c)
            assert len(summary.keys) <= summary.capacity
        values, times = np.unique(keys, return_counts=True)
        assert summary.lost < least and np.isin(values[times >= least], summary.survivors()).all()
    assert (phrases.unpacked_keys(phrases.packed(np.array([0, 1, 2 ** 40 - 1], np.uint64))) == [0, 1, 2 ** 40 - 1]).all()


def test_sorted_keys_travel_in_under_four_bytes():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << phrases.KEY_BITS, 1 << 15, dtype=np.uint64))
    keys[1], keys[-1] = keys[0], (1 << phrases.KEY_BITS) - 1
    data = phrases.packed(keys)
    assert len(data) < 4 * len(keys) and (phrases.unpacked_keys(data) == keys).all()
    assert len(phrases.unpacked_keys(phrases.packed(keys[:0]))) == 0


# --- n-gram join

def components_by_hand(rows):
    sets = []
    for _, text, _ in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append(frozenset(zip(w, w[1:], w[2:])) if len(w) >= 3 else frozenset([tuple(w)] if w else []))
    distinct = sorted({s for s in sets if s}, key=len)
    at, parent = {s: i for i, s in enumerate(distinct)}, list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            both = len(a & distinct[j])
            if 100 * both >= 90 * (len(a) + len(distinct[j]) - both):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for (d, _, _), s in zip(rows, sets):
        if s and d is not None:
            ids[find(at[s])].append(d)
    return sorted((repr(d), len(s), repr((min(ids[find(at[s])]) if ids[find(at[s])] else None) if s else d)) for (d, _, _), s in zip(rows, sets))


def join_rows(df):
    return sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in df.collect())


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(60))), "en") for i in range(120)]
    hot = [f"h{rng.randrange(500)}" for _ in range(150)]
    rows += [(200 + i, edited(rng, hot, rng.randrange(5)), "en") for i in range(110)]  # a third are near copies
    rows += [(400 + i, " ".join(hot), "en") for i in range(40)]
    for size in (9, 10, 11, 12, 20, 40, 400):  # pairs close to the bound on either side
        base = [f"b{size}x{k}" for k in range(size + 2)]
        rows += [(1000 * size + k, edited(rng, base, k % 4 if size < 100 else 5 * k), "en") for k in range(6)]
        rows += [(1000 * size + 10, " ".join(base[:-1]), "en"), (1000 * size + 11, " ".join(base + ["more"]), "en")]
    rows += [(5, None, None), (6, "", "en"), (7, " \t\n", "en"), (8, "One", "en"),
             (9, "one", "en"), (12, "two Words", "en"), (None, " ".join(hot), "en"), (None, None, None), (None, "nulls only here", "en"),
             rows[0], rows[0], (0, "same id other text", "en"), (99_999, " ".join(f"v{rng.randrange(9000)}" for _ in range(30_000)), "en")]
    return rows


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_join_equals_brute_force(spark, copies, monkeypatch, rounds):
    monkeypatch.setattr(ngram_join.links, "__defaults__", (rounds,))
    assert join_rows(ngram_join.similar(documents(spark, copies))) == components_by_hand(copies)


def test_join_of_nothing(spark):
    assert ngram_join.similar(documents(spark, [])).collect() == []
    assert join_rows(ngram_join.similar(documents(spark, [(1, None, "en"), (2, "", "en")]))) == [("1", 0, "1"), ("2", 0, "2")]


def test_linked_sets_share_a_key_whatever_their_shingles():
    rng = np.random.default_rng(2)
    for _ in range(4000):
        n = int(rng.integers(9, 200))
        # hashes crowded into a few places leave fragments empty
        places = rng.integers(0, 1 << 63, int(rng.integers(1, 5)), dtype=np.uint64)
        pool = np.unique(rng.choice(places, 3 * n) + rng.integers(0, 1 << int(rng.integers(20, 61)), 3 * n, dtype=np.uint64))
        a = np.sort(rng.choice(pool, min(n, len(pool)), replace=False))
        gone = int(rng.integers(0, max(1, len(a) // 9)))
        b = np.sort(np.r_[np.delete(a, rng.integers(0, len(a), gone)), np.setdiff1d(pool, a)[:int(rng.integers(0, 3))]])
        both = len(np.intersect1d(a, b))
        if len(a) and len(b) and 100 * both >= 90 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            keys = [ngram_join.set_keys(x, ngram_join.mixed(x * ngram_join.OTHER)) for x in (a, b)]
            assert len(np.intersect1d(*keys)), (len(a), len(b), both)


def test_unlike_documents_with_a_common_line_make_no_pairs(spark):
    rng = random.Random(4)
    line = " ".join(f"boiler{i}" for i in range(12))
    rows = [(i, " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(13)) + " " + line, "en") for i in range(600)]
    marked = ngram_join.marked_sets(documents(spark, rows), 3).collect()
    cells = defaultdict(list)
    for r in marked:
        for k in r["keys"]:
            cells[k].append(r)
    assert sum(len(c) ** 2 for c in cells.values() if len(c) > 1) < 600 * 600 / 100
    apart = [sum(((a[p] ^ b[p]) & (1 << 64) - 1).bit_count() for p in ngram_join.PARITY)
             for c in cells.values() for a in c for b in c if a["sid"] < b["sid"]]
    assert apart and min(apart) * 19 > 2 * 23  # none of what meets passes the sketch
