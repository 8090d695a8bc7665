"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import fresh

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """``weights`` by word, the ``bias`` of a sentence and the ``leak`` of a document (log-odds)."""

    weights: dict[str, float]
    bias: float
    leak: float


def _softplus(z):
    return np.logaddexp(0.0, z)


def _sentences(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _SENTENCE.finditer(text)]


def _word_set(sentence: str) -> set[str]:
    return set(_WORD.findall(sentence.lower()))


def _without_copies(texts: list[set[str]]) -> list[int]:
    """Indexes of texts that share at most half of eight min-hashes with every text kept before."""
    import xxhash

    kept, seen = [], {}
    for i, words in enumerate(texts):
        if not words:
            continue
        raw = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
        mins = [(j, int((raw * np.uint64(2 * j + 1) ^ (raw >> np.uint64(31 - j))).min())) for j in range(8)]
        votes: dict[int, int] = {}
        for key in mins:
            for other in seen.get(key, ()):
                votes[other] = votes.get(other, 0) + 1
        if max(votes.values(), default=0) <= 4:
            kept.append(i)
            for key in mins:
                seen.setdefault(key, []).append(i)
    return kept


def fit(texts: list[str], labels: list[int], n_words: int = 2048, steps: int = 300) -> Model:
    """Train on whole documents and their labels.

    The probability of label 1 is ``1 - (1 - leak) * prod(1 - p_s)``, where ``p_s`` is the logistic
    score of sentence ``s``. With ``S = softplus(leak) + sum(softplus(z_s))`` the loss is ``S`` for label
    0 and ``-log(1 - exp(-S))`` for label 1. Features are the ``n_words`` words most associated with
    either label; weights are shrunk towards zero. Near copies count once, so that a copied document
    does not teach its own words. Without labels of both classes no word is learnt and every document
    scores 0.05 at most, so that none is called toxic.
    """
    bags = [_word_set(t) for t in texts]
    kept = _without_copies(bags)
    y = np.array([labels[i] for i in kept], dtype=np.float64)
    if len(kept) == 0 or y.min() == y.max():
        rate = min(0.05, (sum(labels) + 0.5) / (len(labels) + 1.0))
        return Model({}, -20.0, float(np.log(rate / (1 - rate))))
    counts: dict[str, list[int]] = {}
    for i, label in zip(kept, y, strict=True):
        for word in bags[i]:
            counts.setdefault(word, [0, 0])[int(label)] += 1
    n1, n0 = y.sum(), len(y) - y.sum()

    def association(word: str) -> float:
        c0, c1 = counts[word]
        p = (c0 + c1) / (n0 + n1)
        return abs(c1 / n1 - c0 / n0) / np.sqrt(p * (1 - p) * (1 / n0 + 1 / n1) + 1e-9)

    frequent = [w for w, c in counts.items() if 5 <= sum(c) < len(y)]
    chosen = sorted(frequent, key=lambda w: (-association(w), w))[:n_words]
    chosen = [w for w in chosen if association(w) > 3.5]
    column = {w: j for j, w in enumerate(chosen)}

    doc_of, plain, entries, rows = [], np.zeros(len(y)), [], []
    for d, i in enumerate(kept):
        for start, end in _sentences(texts[i]):
            found = [column[w] for w in _word_set(texts[i][start:end]) if w in column]
            if found:
                entries.extend(found)
                rows.extend([len(doc_of)] * len(found))
                doc_of.append(d)
            else:
                plain[d] += 1
    doc_of, entries, rows = (np.array(x, dtype=np.int64) for x in (doc_of, entries, rows))
    theta = np.zeros(len(chosen) + 2)
    theta[-2], theta[-1] = -8.0, np.log(0.05 / 0.95)
    m, v, rate = np.zeros_like(theta), np.zeros_like(theta), 0.1
    balance = np.where(y == 1, n0 / n1, 1.0) ** 0.5
    for step in range(1, steps + 1):
        w, bias, leak = theta[:-2], theta[-2], theta[-1]
        z = bias + np.bincount(rows, w[entries], minlength=len(doc_of))
        total = _softplus(leak) + plain * _softplus(bias) + np.bincount(doc_of, _softplus(z), minlength=len(y))
        total = np.maximum(total, 1e-9)
        slope = balance * np.where(y == 1, -1.0 / np.expm1(np.minimum(total, 50.0)), 1.0)
        dz = slope[doc_of] / (1 + np.exp(-z))
        grad = np.empty_like(theta)
        grad[:-2] = np.bincount(entries, dz[rows], minlength=len(w)) / len(y)
        grad[-2] = (dz.sum() + (slope * plain).sum() / (1 + np.exp(-bias))) / len(y)
        grad[-1] = slope.sum() / (1 + np.exp(-leak)) / len(y)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta[:-2] = np.sign(theta[:-2]) * np.maximum(np.abs(theta[:-2]) - 0.002, 0)
        theta[-2] = min(theta[-2], -6.0)
        theta[-1] = min(theta[-1], 0.0)
    weights = {word: float(x) for word, x in zip(chosen, theta[:-2], strict=True) if abs(x) > 0.05}
    return Model(weights, float(theta[-2]), float(theta[-1]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "toxic",
    per_class: int = 3000,
    max_chars: int = 65536,
) -> Model:
    """Fit on a bounded sample: ``per_class`` labelled documents a class, of at most ``max_chars``.

    ``usable`` is a condition on ``doc_id`` that marks rows to learn from. The sample is taken by a hash
    of the id, so that reruns agree. Bound on what reaches the driver: ``2 * per_class`` texts.
    """
    marked = (
        labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("_label"))
        .withColumn("_order", F.xxhash64(F.col("doc_id").cast("string")))
    )
    sides = [marked.filter(F.col("_label") == side).orderBy("_order", "doc_id").limit(per_class) for side in (0, 1)]
    chosen = sides[0].unionByName(sides[1])
    text = docs.select("doc_id", "text").filter(F.length("text") <= max_chars)
    rows = (
        text.join(F.broadcast(chosen), "doc_id")
        .orderBy("_order", "doc_id", F.xxhash64("text"))
        .limit(2 * per_class)
        .select("text", "_label")
        .toPandas()
    )
    return fit(rows["text"].tolist(), rows["_label"].astype(int).tolist())


def scorer(model: Model):
    """A column function: text to ``(score, offending, start, end)``.

    ``score`` is the probability of label 1; a null or empty text gets the leak alone. ``offending``
    counts the sentences with a probability of 0.5 or more, ``start`` and ``end`` are the code points of
    the worst of them (null if there is none).
    """
    weights, bias, leak = model.weights, model.bias, model.leak
    base, base_leak = float(np.logaddexp(0, bias)), float(np.logaddexp(0, leak))

    def one(text: str) -> tuple:
        total, offending, worst = base_leak, 0, (0.0, None, None)
        for match in _SENTENCE.finditer(text):
            hits = [w for w in _WORD.findall(match.group().lower()) if w in weights]
            if not hits:
                total += base
                continue
            z = bias + sum(weights[w] for w in set(hits))
            total += float(np.logaddexp(0, z))
            if z >= 0:
                offending += 1
                if z > worst[0] or worst[1] is None:
                    worst = (z, match.start(), match.end())
        return -np.expm1(-total), offending, worst[1], worst[2]

    def score(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([one(t or "") for t in texts], columns=["score", "offending", "start", "end"])
        return out.astype({"score": "float64", "offending": "int64", "start": "Int64", "end": "Int64"})

    return F.pandas_udf(score, "score DOUBLE, offending BIGINT, start BIGINT, end BIGINT")


def locate(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``toxicity``: score, offending sentences and the span of the worst one.

    Null and empty texts get the leak as score and no span; repeated rows are scored each on its own.
    An own column ``toxicity`` of ``docs`` stays, and the new one gets underscores before its name.
    """
    return docs.withColumn(fresh(docs, "toxicity"), scorer(model)(F.col(text)))
