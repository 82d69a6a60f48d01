"""The pipeline on small tables: each stage takes what the one before kept."""

import random
import re

import corpus_pipeline
import xxhash


def near_copies_kept(rows):
    """doc_ids that stay of (doc_id, text) by the contract's fingerprints, all pairs compared."""
    prints = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        grams = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first = {}
    for i in order:
        first.setdefault(group[i], rows[i][0])
    return sorted(first.values(), key=str)


def test_stages_and_run(spark, tmp_path):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    line = "this very line of boilerplate stands in a great many documents alike"
    rows = []
    for i in range(200):
        words = prose(50).split()
        if i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilewort", "grimeword"]))
        rows.append((i, " ".join(words) + "\n" + line))
    long = prose(900)
    near = []
    for k in range(6):  # copies of a few bits' difference
        words = long.split()
        words[100 * k] = "other"
        near.append(" ".join(words))
    rows += [(420 + k, t) for k, t in enumerate(near)]
    rows += [(300 + i, rows[1][1]) for i in range(60)] + [(400, None), (401, ""), (None, prose(20))]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "hot" if k % 3 else "cold", len(t or "")) for k, (i, t) in enumerate(rows)], shape)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns and kept.count() <= before.count(), name
        if name == "toxicity":
            assert not {r[0] for r in kept.select("doc_id").collect()} & set(range(0, 200, 5))
        if name == "line_dedup":
            assert kept.count() == before.count() and kept.where(f"contains(text, '{line}')").count() == 1
        if name == "simhash":
            assert sorted((r[0] for r in kept.select("doc_id").collect()), key=str) == near_copies_kept(
                [tuple(r) for r in before.select("doc_id", "text").collect()])
            assert 0 < kept.where("doc_id BETWEEN 420 AND 425").count() < 6
            # the copies lost their only lines; of all emptied documents one stays
            assert kept.where("text = '' OR text IS NULL").count() == 1
            assert kept.where("doc_id >= 300 AND doc_id < 360 AND text <> ''").count() == 0
    packed = corpus_pipeline.run(spark, str(tmp_path))
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == left
    assert all(r["s"] <= 4096 for r in packed.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "s").collect())
