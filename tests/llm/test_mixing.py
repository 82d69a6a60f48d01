"""Kept token shares against the targets."""

import random
from collections import Counter

import corpus_pipeline
import pytest

from hexatlas.llm import mixing


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(20, 80)) + (" license" if i % 20 == 0 else ""), rng.choice(["en"] * 9 + ["es"]),
             "hot" if i % 3 else rng.choice("abc")) for i in range(20_000)] + [(None, None, None, None), (30_000, "", "en", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()


def shares(rows, column, weight):
    out = Counter()
    for r in rows:
        out[r[column]] += r["_tokens"] * weight(r)
    total = sum(out.values())
    return {k: v / total for k, v in out.items() if v}


def filled_shares(raw):
    low, high = 0.0, 10.0
    for _ in range(100):
        mid = (low + high) / 2
        kept = {k: min(v, mid * v ** mixing.POWER) for k, v in raw.items()}
        low, high = (mid, high) if sum(kept.values()) < mixing.KEEP else (low, mid)
    return {k: v / sum(kept.values()) for k, v in kept.items()}


def test_pipeline_keeps_the_target_shares(spark, docs, tmp_path):
    told = mixing.described(docs).select("doc_id", "_source", "_lang", "_topic", "_tokens").collect()
    kept = mixing.described(corpus_pipeline.mix_sources(spark, docs, str(tmp_path))).collect()
    for c in ("_source", "_lang", "_topic"):
        raw = shares(told, c, lambda r: 1)
        goal = filled_shares(raw)
        now = shares(kept, c, lambda r: 1)
        assert all(abs(now[k] - goal[k]) < 0.01 for k in raw)
    assert abs(sum(r["_tokens"] for r in kept) / sum(r["_tokens"] for r in told) - mixing.KEEP) < 0.01


def test_probabilities_meet_given_targets_or_raise(docs):
    want = {"lang": {"en": 0.5, "es": 0.5}, "topic": {"legal": 0.2, "prose": 0.8}}
    got = mixing.mixed(docs, want).collect()
    assert all(0 <= r["prob"] <= 1 for r in got)
    for c, goal in want.items():
        now = shares(got, f"_{c}", lambda r: r["prob"])
        assert all(abs(now[k] - v) < 2e-3 for k, v in goal.items())
    with pytest.raises(ValueError, match="no tokens of lang xx"):
        mixing.mixed(docs, {"lang": {"en": 0.5, "xx": 0.5}})


def test_targets_of_columns_that_exclude_each_other_are_blended(spark):
    """The small sources want all of their tokens and are most of the large language, which has to give way."""
    rows = [(i, "w " * 10, "en" if i % 10 else "es", f"s{i}" if i % 10 else "hot") for i in range(200)]
    apart = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(apart).collect()
    assert all(0 < r["prob"] <= 1 for r in got)
    assert abs(sum(r["prob"] for r in got) / len(got) - mixing.KEEP) < 2e-3


def test_targets_that_exclude_each_other_raise(spark):
    apart = spark.createDataFrame([(i, "w " * 10, "en" if i % 2 else "es", "a" if i % 2 else "b") for i in range(100)],
                                  "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="together"):
        mixing.mixed(apart, {"lang": {"en": 0.9, "es": 0.1}, "source": {"a": 0.1, "b": 0.9}})
