"""The training-data operators against brute force, and on awkward tables."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexatlas.llm import licenses, line_dedup, mixing, neighbours, packing, quality, sharding, simhash, topk, toxicity
from hexatlas.llm.common import components

#: the columns of documents and names that the operators use within
SHAPE = ("doc_id long, text string, lang string, source string, n_chars long, row string, d long, t long, `key` string, prob double, "
         "_tie int, _word int, fp long, id long, `a.b` int")


def table(spark, rows):
    """documents of (doc_id, text[, lang, source]) with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "x", 1, 2, "k", 0.5, 3, 4, 5, 6, 7) for r in rows]
    return spark.createDataFrame(full, SHAPE)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(1)
    base = prose(rng, 60)
    rows = [(i, prose(rng, rng.randrange(1, 80)) + "\n" + prose(rng, 20)) for i in range(40)]
    rows += [(100 + i, base) for i in range(30)]  # a third of all rows are one text
    rows += [(200 + i, base + f" tail{i}") for i in range(5)]
    rows += [(300, None), (301, ""), (302, " \t\n "), (None, base), (None, None), (None, "only nulls here\nsecond"), (303, prose(rng, 30_000, 5000))]
    rows += [rows[0], rows[0], (0, "same id, other text")]
    return rows


def collect(df):
    return [tuple(r) for r in df.collect()]


# --- sharding

def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 10, 97, 1000):
        a, b = sharding.halves(n)
        assert sorted(sharding.permute_once(x, a, b, 5) for x in range(a * b)) == list(range(a * b))
        assert n <= a * b < n + a


def test_shards_are_even_and_slots_gapless(spark, awkward):
    got = sharding.shard(table(spark, awkward), shards=7).collect()
    assert len(got) == len(awkward)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    texts = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in awkward)
    assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    again = sharding.shard(table(spark, awkward[::-1]).repartition(5), shards=7)
    key = lambda r: (r["row_number"], r["shard"], r["slot"], r["text_crc32"])
    assert sorted(map(key, got)) == sorted(map(key, again.collect()))
    n = len(awkward)
    for r in got:  # computable from the row number alone
        y = r["row_number"]
        while True:
            y = sharding.permute_once(y, *sharding.halves(n), sharding.SEED)
            if y < n:
                break
        assert (y % 7, y // 7) == (r["shard"], r["slot"])


# --- line dedup

def edits_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_lines(rows):
    last, seen, gone = 1 << 62, [], {}
    for key, text in sorted({((last if i is None else i), t) for i, t in rows if t is not None}, key=lambda r: r[0]):
        for n, line in enumerate(text.split("\n")):
            w = [x for x in line.split(" ") if x]
            if w:
                if any(w == s or (len(w) >= 5 and len(s) >= 5 and edits_at_most_one(w, s)) for s in seen):
                    gone.setdefault((key, text), []).append(n)
                seen.append(w)
    return gone


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            w = rng.choice([prose(rng, 12, 3), "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "one two three four five", "one two three four", "six of seven words stand in here"]).split()
            how = rng.randrange(4)
            at = rng.randrange(len(w))
            w = w[:at] + w[at + 1:] if how == 0 else w[:at] + ["new"] + w[at + how % 2:] if how < 3 else w
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "a\n\na"), (None, rows[0][1]), (80, prose(rng, 3000, 50) + "\n" + rows[1][1])]
    want = brute_lines(rows)
    out = line_dedup.dedup_lines(table(spark, rows))
    assert out.schema == table(spark, rows).schema
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, t in rows:
        lost = set(want.get(((1 << 62) if i is None else i, t), []))
        assert got[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in lost)), i
    assert want


def test_line_dedup_of_hot_and_repeated_rows(spark, awkward):
    docs = table(spark, awkward)
    out = line_dedup.dedup_lines(docs).collect()
    assert len(out) == len(awkward)
    texts = Counter(r["text"] for r in out if r["doc_id"] is not None and 100 < r["doc_id"] < 130)
    assert texts == {"": 29}  # of the thirty copies only the first keeps its line
    assert [r["text"] for r in out if r["doc_id"] == 0].count(awkward[0][1]) == 3


# --- SimHash

def classes(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    import xxhash

    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("cell", [4096, 12])
def test_links_span_all_pairs_within_three_bits(spark, cell):
    rng = random.Random(7)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(80)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), cell=cell)
    root = {r["node"]: r["root"] for r in components(links).collect()}
    want = classes(fps, 3)
    pairs = {}
    for f, w in zip(signed, want):
        pairs.setdefault(w, set()).add(root.get(f, f))
    assert all(len(v) == 1 for v in pairs.values()) and len(set.union(*pairs.values())) == len(pairs)


def test_simhash_groups_and_keepers(spark, awkward):
    docs = table(spark, awkward)
    got = simhash.groups(docs).collect()
    fps = [brute_fingerprint(t) for _, t in awkward]
    want = classes(fps, 3)
    first = {}
    for (i, _), c in zip(awkward, want):
        if i is not None:
            first[c] = min(first.get(c, i), i)
    assert (Counter((i, f if f < 1 << 63 else f - (1 << 64), first.get(c)) for (i, _), f, c in zip(awkward, fps, want))
            == Counter((r["doc_id"], r["fp"], r["component_id"]) for r in got))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(want))


# --- packing

def test_plan_holds_every_piece_and_fits():
    rng = random.Random(5)
    for capacity, n in ((64, 1), (64, 50), (128, 3000)):
        histogram = Counter(rng.randrange(1, capacity + 1) for _ in range(n))
        plan = packing.solve(histogram, capacity, rounds=16)
        held = Counter()
        for times, parts in plan:
            assert times > 0 and sum(size * copies for size, copies in parts) <= capacity
            for size, copies in parts:
                held[size] += copies * times
        assert held == histogram
        best = sum(t for t, _ in packing.best_fit(histogram, capacity))
        assert sum(t for t, _ in plan) <= best * 1.02 + 1
    assert packing.solve({}) == []


def test_packed_ids_are_the_tokenizers(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = awkward + [(400 + i, t) for i, t in enumerate(["It's THE <|endoftext|> end.,", "Ünï ǅ Σας ﬁ 北京 x́ 12a", "\x00a \x1cb", "don't,stop. a.b,c", "😀 ok"])]
    got = packing.pack(table(spark, rows), capacity=512, rounds=8).collect()
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(i, k, at, len(ids[at:at + 512]), zlib.crc32(ids[at:at + 512].tobytes())) for k, at in enumerate(range(0, len(ids), 512))]
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= sum(w[3] for w in want) / 512 * 1.05 + 1


# --- toxicity

def toxic_table(spark, n=300):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(rng, 40).split()
        if bad:
            for _ in range(1 + i % 4):
                words.insert(rng.randrange(len(words)), rng.choice(["vilewort", "vileness", "grimeword"]))
        rows.append((i, " ".join(words)))
        if i < n // 2:
            labels.append((i, 1, int(bad)))
    rows += [(n, None), (n + 1, ""), (None, "w1 w2")]
    return table(spark, rows), spark.createDataFrame(labels + labels[:3] + [(None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs, labels = toxic_table(spark)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    held = range(150, 300)
    assert not {i for i in held if i % 5 == 0} & ids
    assert len({i for i in held if i % 5} & ids) >= 118 and {None, 300, 301} <= ids
    model = toxicity.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) in (1, 2)
    assert model.severity("w1 vilewort vileness grimeword w2") > model.severity("w1 w2 w3") >= 0
    assert toxicity.train(docs, labels.where("toxic = 0")) is None


def test_few_labels_and_one_telling_word(spark):
    rng = random.Random(21)
    rows = [(i, prose(rng, 30) + (" grimeword" if i % 100 == 7 or i >= 400 else "")) for i in range(420)]
    docs = table(spark, rows + [(7, "zz a later text of a repeated id")])
    labels = spark.createDataFrame([(i, 1, int(i % 100 == 7)) for i in range(400)], "doc_id long, quality int, toxic int")
    kept = Counter(r["doc_id"] for r in toxicity.keep_clean(docs, labels).collect())
    assert not {i for i in kept if i >= 400} and len([i for i in kept if i % 100 != 7]) >= 392
    assert toxicity.labelled(docs, labels).where("doc_id = 7").collect()[0]["text"] == rows[7][1]


def test_cumulative_link_orders_grades():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 3)).astype(np.float32)
    grade = np.digitize(x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=900) * 0.3, [-0.5, 1.5])
    w, t = toxicity.fit_cumulative(x, grade, ridge=0.01, steps=300)
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.4 * abs(w[1]) and t[0] < t[1]


# --- mixing

def filled_shares(raw):
    """Tempered shares of the kept tokens, no value given more than it has: found by bisection of the scale."""
    low, high = 0.0, max(raw.values()) + 1.0
    for _ in range(200):
        mid = (low + high) / 2
        kept = {k: min(v, mid * v ** mixing.POWER) for k, v in raw.items()}
        low, high = (mid, high) if sum(kept.values()) < mixing.KEEP * sum(raw.values()) else (low, mid)
    return {k: v / sum(kept.values()) for k, v in kept.items()}


def test_raking_meets_the_marginals(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 60)) + (" license" if i % 7 == 0 else ""), rng.choice(["en", "de", None]),
             "hot" if i % 3 == 0 else rng.choice(["a", "b", None])) for i in range(400)] + [(900, None), (901, ""), (None, "x y z")]
    docs = table(spark, rows)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    total = sum(r["_tokens"] for r in got)
    for c in ("_source", "_lang", "_topic"):
        raw, now = Counter(), Counter()
        for r in got:
            raw[r[c]] += r["_tokens"]
            now[r[c]] += r["_tokens"] * r["prob"]
        goal = filled_shares(raw)
        assert all(abs(now[k] - goal[k] * mixing.KEEP * total) < 2e-3 * total for k in raw)
        assert all(abs(r["factor"] * mixing.KEEP - r["prob"]) < 1e-9 for r in got)
    assert abs(sum(r["_tokens"] * r["prob"] for r in got) - mixing.KEEP * total) < 2e-3 * total
    assert all(0 <= r["prob"] <= 1 for r in got)
    kept = mixing.sample(docs)
    assert kept.schema == docs.schema
    assert abs(kept.count() - sum(r["prob"] for r in got)) < 4 * (sum(r["prob"] * (1 - r["prob"]) for r in got) ** 0.5) + 1


# --- searches

def vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=16)).tolist()) for i in range(600)]
    hot = rng.normal(size=16).tolist()
    rows += [(1000 + i, hot) for i in range(300)]  # a third alike
    rows += [(2000, None), (2001, []), (2002, [float("nan")] * 16), (2003, [float("inf")] + [0.0] * 15), (2004, [None] + [1.0] * 15),
             (2010, [0.0] * 16), (2020, [1.0, 2.0]), (2030, [2.0, 1.0]), (None, hot), rows[0]]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, v string, q int")
    good = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v):
            good[i] = np.array(v, dtype=np.float32).astype(float)
    return frame, good


def test_top_products_are_exact(spark):
    frame, good = vectors(spark)
    got = collect(topk.nearest(frame, F.col("vec_id") % 10 == 0, k=7))
    whole = {i: [int(c) for c in np.floor(1024 * v)] for i, v in good.items()}
    want = []
    for q, v in whole.items():
        if q % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in whole.items() if i != q and len(x) == len(v))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:7])]
    assert sorted(got) == sorted(want)


def test_neighbours_recall(spark):
    frame, good = vectors(spark)
    got = {}
    for q, rank, i, s in collect(neighbours.nearest(frame, F.col("vec_id") % 10 == 0)):
        got.setdefault(q, []).append((rank, i, s))
    unit = {i: v / np.sqrt(v @ v) for i, v in good.items() if (v != 0).any()}
    hits = wanted = 0
    for q, v in unit.items():
        if q % 10 == 0:
            scores = sorted((-round(float(v @ x), 12), i) for i, x in unit.items() if i != q and len(x) == len(v))[:5]
            hits += len({i for _, i in scores} & {i for _, i, _ in got.get(q, [])})
            wanted += len(scores)
            assert [r for r, _, _ in sorted(got[q])] == list(range(1, len(scores) + 1))
            assert all(abs(s - float(v @ unit[i])) < 1e-12 for _, i, s in got[q])
    assert hits >= 0.9 * wanted and set(got) == {q for q in unit if q % 10 == 0}


# --- quality

def test_kneser_ney_is_a_distribution(spark):
    rng = random.Random(6)
    texts = ["The cat sat. " * 3, prose(rng, 200), "zz", None, ""]
    model = quality.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    p = np.exp(model.log_table().astype(float)).reshape(-1, 64)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-3)
    # the highest order by hand: discounted counts plus what they leave to the lower order
    counts = Counter(int(c) for t in texts for c in quality.codes(t, quality.symbol_table()))
    context = Counter()
    for c, n in counts.items():
        context[c >> 6] += n
    n1, n2, n3, n4 = (sum(v == k for v in counts.values()) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = [min(max(x, 0.05), k - 0.05) for x, k in zip((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), (1, 2, 3))]
    lower = quality.Model(model.orders[:3]).log_table().astype(float)
    for c, n in list(counts.items())[:50]:
        spared = sum(d[min(m, 3) - 1] for k, m in counts.items() if k >> 6 == c >> 6)
        want = (n - d[min(n, 3) - 1]) / context[c >> 6] + spared / context[c >> 6] * np.exp(lower[c & 0x3FFFF])
        assert abs(p.reshape(-1)[c] - want) < 1e-4


def test_junk_goes_and_good_text_stays(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60, 300), rng.choice(["en", "de"])) for i in range(200)]
    rows += [(500 + i, "".join(rng.choice("#$%&*!ZQX ") for _ in range(200))) for i in range(20)] + [(600, None), (601, ""), (None, prose(rng, 60, 300), None)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)] + [(500, 0, 0), (None, 1, 0), (3, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(table(spark, rows), labels).collect()
    assert len(got) == len(rows)
    keep = {r["doc_id"]: r["keep"] for r in got}
    assert not any(keep[500 + i] for i in range(20)) and keep[600] and keep[601]
    assert sum(keep[i] for i in range(200)) >= 180
    assert all(r["keep"] for r in quality.judge(table(spark, rows), labels.where("quality = 0")).collect())


# --- licenses

def test_notices_are_found_and_differences_told(spark):
    rng = random.Random(9)
    noise = prose(rng, 300)
    rows = [(1, noise + "\nReleased under the MIT License.\n" + noise), (2, noise), (3, None), (4, ""), (5, "LICENSED under the apache licence version 2.0"),
            (6, "Licensed under CC BY-NC 4.0. " + noise + " Released under the MIT License."), (7, "a licensed apache pilot met the public"),
            (8, noise * 40 + " This work is licensed under the GNU General Public License, version 3."), (None, "Released under the MIT License.")]
    got = licenses.scan(table(spark, rows)).collect()
    assert Counter((r["doc_id"], r["license"], r["differences"]) for r in got) == Counter([
        (1, "MIT", ""), (5, "Apache-2.0", "-license +licence"), (6, "CC-BY-NC-4.0", ""), (6, "MIT", ""), (8, "GPL-3.0", ""), (None, "MIT", "")])
    assert all(r["bytes_saved"] > 0 for r in got)


def test_similar_licenses_are_named_right_or_not_at_all():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    right = {"Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0-short", "Licensed under CC BY 4.0.": "CC-BY-4.0-short", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Released under the BSD License.": "BSD", "Released under the ISC License.": "ISC", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
             "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0"}
    wrong = ["Licensed under the Apache License, Version 1.1.", "licensed under the apache license version 3.0", "Released under the Foo License.",
             "This work is not licensed under the GNU General Public License, version 3.", "This is not released under the MIT License.",
             "This work is licensed under a Creative Commons Attribution 3.0 International License.", "Licensed under CC BY-ND 4.0.",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]
    for text, name in right.items():
        assert [(h[1], h[4]) for h in scanner.scan("some words before " + text + " And some after.")] == [(name, "")], text
    for text in wrong:
        assert scanner.scan("some words before " + text + " And some after.") == [], text
    both = wrong[4] + " Yet that is " + "Released under the MIT License."
    assert [h[1] for h in scanner.scan(both)] == ["MIT"]


# --- empty tables

def test_empty_tables(spark):
    docs = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vecs = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for out in (sharding.shard(docs), line_dedup.dedup_lines(docs), simhash.groups(docs), simhash.keep_one(docs), packing.pack(docs),
                toxicity.keep_clean(docs, labels), toxicity.score(docs, None), mixing.sample(docs), quality.judge(docs, labels),
                licenses.scan(docs), topk.nearest(vecs, F.lit(True)), neighbours.nearest(vecs, F.lit(True))):
        assert out.count() == 0


def test_neighbours_of_extreme_lengths(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 8))
    lengths = [1.0, 1e-200, 1e200, 5e-310]
    rows = [(n, (v * lengths[n % 4]).tolist()) for n, v in enumerate(base)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 30 == 0, certainty=0.999999).collect()
    unit = base / np.linalg.norm(base, axis=1)[:, None]
    for q in range(0, 300, 30):
        want = unit @ unit[q]
        want[q] = -2
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([r[2] for r in mine], np.sort(want)[::-1][:5], atol=1e-9)
