"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed; their share of the document times the inverse
document frequency (over all rows that may be learned from) is the feature. Follow-the-regularised-leader with an elastic-net penalty
trains on a bounded sample, and a temperature is fitted on rows the training left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import bounded_sample, hash_unit

UNKNOWN = "und"
ORDERS = (1, 2, 3)
SLICE = 1 << 18  # characters handled at a time


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, times idf
    bias: np.ndarray
    temperature: float


def gram_ids(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-case text, slice by slice, each slice reaching into the next."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for at in range(0, len(codes), SLICE):
        part = codes[at:at + SLICE + max(ORDERS) - 1].astype(np.uint64)
        h = np.zeros(len(part), np.uint64)
        for n in ORDERS:
            size = min(len(part) - n + 1, SLICE)
            if size <= 0:
                break
            h = (h[:size] + part[n - 1:n - 1 + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            yield ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % buckets


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their share of all n-grams of the text."""
    counts = np.zeros(buckets, np.int64)
    for ids in gram_ids(text, buckets):
        counts += np.bincount(ids, minlength=buckets)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at] / max(1, counts.sum())


def document_frequencies(texts: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """Count of texts, and texts per bucket, over all rows; ``buckets`` sums reach the driver whatever the input."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                seen = np.zeros(buckets, bool)
                for ids in gram_ids(text, buckets):
                    seen[ids] = True
                total[:-1] += seen
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets + 1, np.int64)
    out[rows["bucket"]] = rows["n"]
    return int(out[-1]), out[:-1]


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, buckets: int, alpha: float, beta: float, l1: float, l2: float, epochs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader (proximal, per coordinate) for softmax loss; the last row of the state is the bias."""
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))
    order = np.random.default_rng(seed)

    def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            ids, values, y = rows[k]
            at, x = np.append(ids, buckets), np.append(values, 1.0)
            zs, ns = z[at], n[at]
            w = leader(zs, ns)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p
            g2 = g * g
            z[at] = zs + g - (np.sqrt(ns + g2) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g2
    w = leader(z, n)
    return w[:-1], w[-1]


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss, by golden-section search over its logarithm.

    Targets are kept from 0 and 1 as in Platt scaling, so that rows without an error give a finite temperature.
    """
    if not len(y):
        return 1.0
    target = np.full(scores.shape, 1 / (len(y) + scores.shape[1]))
    target[np.arange(len(y)), y] += 1 - target.sum(axis=1)
    loss = lambda t: -(target * np.log(np.maximum(softmax(scores / np.exp(t)), 1e-12))).sum(axis=1).mean()
    low, high, r = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(learn: DataFrame, buckets: int = 1 << 16, max_rows: int = 3000, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3, seed: int = 7) -> LanguageModel | None:
    """Train on columns ``doc_id``, ``text`` and ``lang`` of the rows given; None if no row has text and language.

    At most about ``max_rows`` rows (evenly over languages) train the weights and the temperature; document frequencies cover all rows.
    """
    usable = learn.filter("text is not null and lang is not null").select("doc_id", "text", "lang")
    documents, frequency = document_frequencies(usable, buckets)
    if not documents:
        return None
    idf = np.log((1 + documents) / (1 + frequency)) + 1

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t, buckets) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "rest": batch["rest"], "ids": [f[0] for f in found], "share": [f[1].astype(np.float32) for f in found]})

    sample = bounded_sample(usable, "lang", "doc_id", max_rows, "lang").withColumn("rest", hash_unit(F.col("doc_id").cast("string"), "temperature") < 0.2)
    rows = sample.mapInPandas(extract, "lang string, rest boolean, ids array<int>, share array<float>").toPandas()
    rows = rows.iloc[np.lexsort((rows["ids"].map(len), rows["lang"]))]  # one order whatever the partitions
    languages = sorted(rows["lang"].unique())
    scale = 20.0  # shares are small; the penalties are meant for values near one
    data = [(np.asarray(i, np.int64), np.asarray(s, np.float64) * idf[np.asarray(i, np.int64)] * scale, languages.index(c)) for i, s, c in zip(rows["ids"], rows["share"], rows["lang"], strict=True)]
    rest = rows["rest"].to_numpy(bool)
    train = [d for d, r in zip(data, rest, strict=True) if not r] or data
    w, b = train_ftrl(train, len(languages), buckets, alpha, beta, l1, l2, epochs, seed)
    kept = [d for d, r in zip(data, rest, strict=True) if r]
    scores = np.array([v @ w[i] + b for i, v, _ in kept]).reshape(-1, len(languages))
    return LanguageModel(languages, (w * idf[:, None] * scale).astype(np.float32), b, fit_temperature(scores, np.array([d[2] for d in kept], int)))


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (columns of these names are replaced).

    ``und`` with score 0 for null texts, texts without a letter, and for all if there is no model. The whole text counts.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers, whatever the input

    @F.pandas_udf("lang string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        m: LanguageModel = shared.value
        langs, values = [], []
        for t in texts:
            if not has_letter(t):
                langs.append(UNKNOWN)
                values.append(0.0)
                continue
            total, n = np.zeros(len(m.languages)), 0
            for ids in gram_ids(t, len(m.weights)):
                total += np.bincount(ids, minlength=len(m.weights)) @ m.weights if len(ids) > len(m.weights) // 4 else m.weights[ids].sum(axis=0, dtype=np.float64)
                n += len(ids)
            p = softmax(((total / max(1, n) + m.bias) / m.temperature)[None])[0]
            langs.append(m.languages[int(p.argmax())])
            values.append(float(p.max()))
        return pd.DataFrame({"lang": langs, "score": values})

    out = docs.withColumn("_found", score(F.col(text)))
    return out.withColumns({"lang_pred": F.col("_found.lang"), "score": F.col("_found.score")}).drop("_found")
