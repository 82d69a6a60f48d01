"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < 2 share one weight vector; ordered thresholds t1 < t2 cut the score: P(grade > k) = sigmoid(score - t_k). The expected
severity is the sum of those probabilities. Features are words and word beginnings of 4 to 8 letters, valued by their density. The
labels are yes or no, so the grades above 0 come from the evidence itself: toxic documents whose density of the words that set toxic
documents apart lies over the median are severe (2), the others mild (1).

The model is fitted on a bounded sample of labelled documents (SAMPLE, by hash of doc_id); features are counted on Spark, the fit of
at most SAMPLE rows by FEATURES columns is done on the driver. All documents are scored, whole, on Spark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, stash

SAMPLE, FEATURES, FEW, LEAST_Z, RIDGE, ENOUGH, STEPS, REJECT = 10_000, 1_500, 50, 2.5, 1.0, 100, 300, 0.5
WORD = re.compile(r"\w+")
STEMS = range(4, 9)


def counts(text: str | None) -> tuple[Counter, int]:
    """Occurrences of each word, and the number of words."""
    found = Counter(WORD.findall((text or "").lower()))
    return found, sum(found.values())


def features(words: Counter) -> Counter:
    """Occurrences of words ('w') and of beginnings of longer words ('w*')."""
    out: Counter = Counter()
    for w, n in words.items():
        out[w] += n
        for k in STEMS:
            if k >= len(w):
                break
            out[w[:k] + "*"] += n
    return out


def density(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Value of a feature that occurs n times among total words; short documents are damped."""
    return np.log1p(200.0 * n / (total + 20.0))


@dataclass
class Model:
    """weights by feature name; two thresholds."""
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def severity(self, text: str | None) -> float:
        words, total = counts(text)
        score = 0.0
        weights = self.weights
        hit: Counter = Counter()
        for w, n in words.items():
            if w in weights:
                hit[w] += n
            for k in STEMS:
                if k >= len(w):
                    break
                if (stem := w[:k] + "*") in weights:
                    hit[stem] += n
        for name, n in hit.items():
            score += weights[name] * float(np.log1p(200.0 * n / (total + 20.0)))
        return float(sum(1.0 / (1.0 + np.exp(min(max(t - score, -500), 500))) for t in self.thresholds))


def fit_cumulative(x: np.ndarray, grade: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the largest penalised likelihood, by gradient steps scaled by each parameter's past gradients. x: rows by features."""
    n, m = x.shape
    levels = int(grade.max(initial=0))
    share = np.array([(grade > k).mean() for k in range(levels)]).clip(1e-4, 1 - 1e-4)
    w, t = np.zeros(m), np.log((1 - share) / share)
    sig = lambda v: 1 / (1 + np.exp(-v.clip(-500, 500)))
    sw, st = np.zeros(m), np.zeros(levels)
    for _ in range(steps):
        score = (x @ w.astype(x.dtype)).astype(float)
        above = np.column_stack([np.ones(n), *[sig(score - b) for b in t], np.zeros(n)])  # P(grade >= k)
        p = np.maximum(above[np.arange(n), grade] - above[np.arange(n), grade + 1], 1e-9)
        slope = above * (1 - above)  # of the inner thresholds; the outer two are 0
        lo, hi = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        gs = (lo - hi) / p
        gt = np.array([(-(lo / p)[grade == k + 1]).sum() + (hi / p)[grade == k].sum() for k in range(levels)])
        gw = (gs.astype(x.dtype) @ x).astype(float) - ridge * w
        sw, st = sw + gw * gw, st + gt * gt
        w, t = w + 0.5 * gw / np.sqrt(sw + 1e-9), np.sort(t + 0.2 * gt / np.sqrt(st + 1e-9))
    return w, t


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows (doc_id, text, toxic) of at most `sample` labelled doc_ids, the first by hash; repeated labels count by their largest, of
    texts that share a doc_id the least in byte order counts, equal rows once."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # the chosen labels are at most `sample` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return stash(rows.groupBy("doc_id").agg(F.min("text").alias("text"), (F.max("toxic") > 0).alias("toxic")))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = FEATURES) -> Model | None:
    """The model, or None where the labels hold no toxic or no clean document (then nothing can be told apart)."""
    rows = labelled(docs, labels, sample)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = size.get(True, 0), size.get(False, 0)
    if not bad or not good:
        return None

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(b["text"], b["toxic"]):
                for f in features(counts(text)[0]):
                    seen.setdefault(f, [0, 0])[bool(toxic)] += 1
            yield pd.DataFrame([(f, c[1], c[0]) for f, c in seen.items()], columns=["feature", "bad", "good"])

    found = rows.mapInPandas(tally, "feature string, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = (F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1)))
    z = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = found.withColumn("z", z).orderBy(F.abs("z").desc(), "feature").limit(most).collect()
    chosen = [r for r in best if abs(r["z"]) >= LEAST_Z] or best[:FEW]  # nothing sure: the strongest there are
    names = sorted(r["feature"] for r in chosen)
    apart = {r["feature"] for r in chosen if r["z"] > 4 and r["bad"] > r["good"]}
    place = {f: i for i, f in enumerate(names)}

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, text, toxic in zip(b["doc_id"], b["text"], b["toxic"]):
                words, total = counts(text)
                got = [(place[f], n) for f, n in features(words).items() if f in place]
                out.append((doc_id, bool(toxic), total, [g[0] for g in got], [g[1] for g in got]))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "total", "at", "n"])

    # bounded: at most `sample` rows of at most `most` pairs
    table = rows.mapInPandas(sparse, "doc_id long, toxic boolean, total long, at array<int>, n array<int>").orderBy("doc_id").toPandas()
    if not names or not len(table):
        return None
    x = np.zeros((len(table), len(names)), dtype=np.float32)
    for i, (at, n, total) in enumerate(zip(table["at"], table["n"], table["total"])):
        x[i, np.array(at, dtype=int)] = density(np.array(n, dtype=float), float(total))
    marks = np.array([f in apart for f in names])
    evidence = x[:, marks].max(axis=1, initial=0)
    toxic = table["toxic"].to_numpy(dtype=bool)
    grade = np.where(toxic, 1 + (evidence > np.median(evidence[toxic])), 0)
    weights, thresholds = fit_cumulative(x, grade, RIDGE * min(1.0, bad / ENOUGH))  # few toxic labels must still outweigh the penalty
    return Model({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-4}, tuple(float(t) for t in thresholds))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows (doc_id, severity), one per row of docs. Null and empty texts have no features and get the grade of no evidence."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "severity": [model.severity(t) if model else 0.0 for t in b["text"]]})

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return source.mapInPandas(each, "doc_id string, severity double").select(F.col("doc_id").cast("long").alias("doc_id"), "severity")


def keep_clean(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of docs whose expected severity is under `reject`; the columns of docs, names of any kind."""
    model = train(docs, labels)
    if model is None:
        return docs
    severity = F.pandas_udf(lambda texts: pd.Series([model.severity(t) for t in texts], dtype="float64"), "double")
    return docs.where(severity(docs["text"]) < reject)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its expected severity (0 to 2) and whether the pipeline rejects it."""
    docs = load(spark, sf_dir, "documents")
    model = train(docs, load(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", F.round("severity", 6).alias("severity"), (F.col("severity") >= REJECT).alias("rejected"))
