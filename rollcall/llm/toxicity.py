"""Toxicity by multiple-instance learning: only documents have labels; sentences get scores.

A sentence with words of the model is toxic with probability sigmoid(bias + weights of these words), other sentences are not. A document is toxic with
1 - (1 - leak) * product(1 - sentence), the noisy-or; the leak takes up labels that no sentence explains, so that long documents do not gather them. Weights, bias and leak are
learned from document labels through the noisy-or; the sentence scores then locate what made a document toxic.

The model is fitted on a bounded sample: at most SAMPLE labelled rows of each label, those with the smallest digests of their id, read as whole texts. Their
words are hashed to FEATURES numbers, and at most WORDS numbers that documents labelled toxic have LIFT times as often, and more often by LEAST_Z standard errors, become the model's words: what
reaches the driver is bounded.

Null and empty texts have no sentence and score the leak. Rows are scored by themselves, whatever their id. Rows whose label is null are not learned
from; a table without both labels gives a model without words (every score 0). An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.common import Remembered, kept_table

SAMPLE, FEATURES, WORDS, LEAST_Z, LIFT = 6000, 1 << 18, 2000, 5, 3
STEPS, RATE, SHRINK = 400, 0.1, 5e-5
#: Where the bias is drawn to, so that words alone make a sentence toxic, and how strongly.
QUIET, HOLD = -7.0, 1e-2
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
WORD = re.compile(r"\w+")


@dataclass
class Model:
    bias: float = -30.0
    leak: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)


class Hashed(Remembered):
    def __missing__(self, word: str) -> int:
        return self.keep(word, zlib.crc32(word.encode("utf-8", "surrogatepass")) % FEATURES)


_hashed = Hashed()


def features(text: str) -> set[int]:
    return {_hashed[w] for w in WORD.findall(text.lower())}


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, size: int) -> DataFrame:
    """The sampled rows: label and text (null: empty)."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    known = known.withColumn("digest", F.xxhash64("id", F.lit("sample")))
    chosen = known.where("label = 1").orderBy("digest", "id").limit(size).unionAll(known.where("label = 0").orderBy("digest", "id").limit(size))
    chosen = kept_table(chosen.drop("digest"), "toxicity-sample")
    # at most 2 * size rows of two numbers
    texts = docs.select(F.col(id_column).alias("of"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("of") == F.col("id")).select("label", "text")


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", size: int = SAMPLE) -> Model:
    """A model from all rows of ``labels`` that are given; the caller leaves out those it tests on."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = np.zeros((2, FEATURES), np.int64)
            for label, text in zip(batch.label, batch.text):
                sums[label, list(features(text))] += 1
            hit = np.flatnonzero(sums.sum(0))
            yield pd.DataFrame({"feature": hit, "toxic": sums[1, hit], "clean": sums[0, hit]})

    rows = kept_table(sample(docs, labels, id_column, text_column, label_column, size), "toxicity-texts")
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    counts = rows.mapInPandas(counted, "feature long, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = (F.col("toxic") + F.col("clean")) / (n[0] + n[1])
    spread = F.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    p, q = F.col("toxic") / n[1], F.col("clean") / n[0]
    z = (p - q) / F.when(spread > 0, spread)
    best = [r["feature"] for r in counts.where((z >= LEAST_Z) & (p >= LIFT * q)).orderBy(z.desc(), "feature").limit(WORDS).collect()]
    index = {f: i for i, f in enumerate(best)}

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for label, text in zip(batch.label, batch.text):
                bags = [sorted(index[f] for f in features(s) if f in index) for s in SENTENCE.findall(text)]
                kept = {tuple(b) for b in bags if b}  # sentences of one bag say the same
                out.append((label, [i for b in kept for i in b], [len(b) for b in kept]))
            yield pd.DataFrame(out, columns=["label", "words", "sizes"])

    kept = rows.mapInPandas(reduced, "label int, words array<int>, sizes array<int>").toPandas()
    bias, leak, weights = learned(kept, len(best))
    return Model(bias, leak, {f: float(w) for f, w in zip(best, weights)})


def learned(bags: pd.DataFrame, width: int) -> tuple[float, float, np.ndarray]:
    """Bias, leak and weights that maximise the likelihood of the document labels under the noisy-or (Adam, full batches)."""
    y = bags.label.to_numpy(float)
    sizes = [np.asarray(s, int) for s in bags.sizes]
    doc = np.repeat(np.arange(len(bags)), [len(s) for s in sizes])
    per = np.concatenate(sizes)
    word = np.concatenate([np.asarray(w, int) for w in bags.words])
    sentence = np.repeat(np.arange(len(per)), per)
    x = np.zeros(width + 2)  # weights, bias, leak as a logit
    x[width], x[width + 1] = QUIET, -3.0
    m, v = np.zeros(width + 2), np.zeros(width + 2)
    for step in range(1, STEPS + 1):
        theta, bias, leak = x[:width], x[width], x[width + 1]
        z = bias + np.bincount(sentence, theta[word], len(per))
        none = np.minimum(-np.bincount(doc, np.logaddexp(0, z), len(bags)) - np.logaddexp(0, leak), -1e-9)
        slope = y / np.expm1(-none) - (1 - y)  # of the loss by the logarithm of (no toxic sentence)
        g = -slope[doc] / (1 + np.exp(-z))
        grad = np.zeros(width + 2)
        grad[:width] = np.bincount(word, g[sentence], width) / len(bags) + SHRINK * theta
        grad[width] = g.sum() / len(bags) + HOLD * (bias - QUIET)
        grad[width + 1] = -slope.sum() / (1 + np.exp(-leak)) / len(bags)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(x[width]), float(1 / (1 + np.exp(-x[width + 1]))), x[:width]


class Weights(Remembered):
    """Word to weight."""

    def __init__(self, weights: dict[int, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        n = zlib.crc32(word.encode("utf-8", "surrogatepass")) % FEATURES
        return self.keep(word, self.weights.get(n, 0.0))


def scorer(model: Model):
    """A function from text to (document score, sentences as (start, end, score) with score of half or more)."""
    weights = Weights(model.weights)
    quiet = float(-np.log1p(-model.leak))

    def score(text: str) -> tuple[float, list[tuple[int, int, float]]]:
        offending, none = [], quiet
        for m in SENTENCE.finditer(text):  # lower-casing can change the length, so places are the text's own
            total = 0.0
            for w in set(WORD.findall(m[0].lower())):
                total += weights[w]
            if total == 0.0:
                continue
            z = model.bias + total
            none += np.logaddexp(0, z)
            if z >= 0:
                offending.append((m.start(), m.end(), float(1 / (1 + np.exp(-z)))))
        return float(-np.expm1(-none)), offending

    return score


SCORED = "struct<score:double,offending:array<struct<start:int,end:int,score:double>>>"


def scores(text: Column, model: Model) -> Column:
    """A text's score and offending sentences (score and place)."""

    @F.pandas_udf(SCORED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer(model)
        for batch in batches:
            got = [score(t) for t in batch]
            sentences = [[{"start": a, "end": b, "score": s} for a, b, s in g[1]] for g in got]
            yield pd.DataFrame({"score": [g[0] for g in got], "offending": sentences})

    return run(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score, offending (sentences: start, end, score), per row."""
    found = scores(F.col(text_column), model)
    return docs.select(F.col(id_column).alias("doc_id"), found.alias("found")).select("doc_id", "found.*")


def without_toxic(docs: DataFrame, model: Model, text_column: str = "text", at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score under ``at``, all columns as they are."""
    return docs.where(scores(F.col(text_column), model)["score"] < at)
