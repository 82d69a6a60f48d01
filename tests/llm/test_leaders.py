"""Near copies of one text: the text itself leads, so that its copies need not be compared in pairs."""
import random

from hexatlas.llm import ngram_join


def test_the_most_typical_set_leads_first(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for v in range(1, 41):  # 4 words apart from the base (similarity 0.94), 8 from each other (0.89)
        words = list(base)
        for place in draw.sample(range(5, 395), 4):
            words[place] = f"x{v}_{place}"
        rows.append((v, " ".join(words)))
    compared, told = [], ngram_join.verified

    def verified(pairs, parts):
        compared.append(pairs.count())
        return told(pairs, parts)

    monkeypatch.setattr(ngram_join, "verified", verified)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in ngram_join.similar(docs).collect()} == {0}
    assert sum(compared) <= 4 * len(rows)
