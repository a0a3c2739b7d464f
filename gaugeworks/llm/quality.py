"""Quality classifier: Naive Bayes support vectors.

Indicators of word and shape n-grams are scaled by the log-count ratio of the classes, a linear model with hinge
loss is fitted to them by dual coordinate descent, and a logistic curve turns its margin into a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import bounded_sample, hash_unit

TOKEN = re.compile(r"\w+|[^\w\s]+|\n")
CACHE = 300_000


class TokenIds(dict):
    """Hash of a token (upper 32 bits) and of its shape (lower); forgotten when too many."""

    def __missing__(self, token: str) -> int:
        if token.isalpha():
            shape = "aa" if token.islower() else "AA" if token.isupper() and len(token) > 1 else "Aa"
        elif token.isdigit():
            shape = "0" * min(len(token), 4)
        else:
            shape = token[:4] if not token[0].isalnum() else "a0"
        word = zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
        self[token] = pair = word << 32 | zlib.crc32(b"\0" + shape.encode("utf-8", "surrogatepass"))
        return pair


def indicators(text: str | None, buckets: int, ids: TokenIds) -> np.ndarray:
    """Distinct hashed n-grams of the whole text: words and word pairs; single shapes, pairs and triples of shapes."""
    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.zeros(0, np.int32)
    if len(ids) > CACHE:
        ids.clear()
    both = np.fromiter(map(ids.__getitem__, tokens), np.uint64, len(tokens))
    mix = np.uint64(0x9E3779B97F4A7C15)
    grams = []
    for one, longest in ((both >> np.uint64(32), 2), (both & np.uint64(0xFFFFFFFF), 3)):
        h = one * mix
        grams.append(h)
        for n in range(2, longest + 1):
            if len(one) >= n:
                h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * mix + one[n - 1:]
                grams.append(h * mix)
    seen = np.zeros(buckets, bool)
    for g in grams:
        seen[(g >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class QualityModel:
    weights: np.ndarray  # per bucket: ratio times weight
    bias: float
    slope: float
    shift: float


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, buckets: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(buckets, alpha), np.full(buckets, alpha)
    for ids, label in zip(rows, y, strict=True):
        (p if label else q)[ids] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, buckets: int, cost: float, passes: int, seed: int) -> tuple[np.ndarray, float]:
    """L1-loss linear support vectors; row i has values[rows[i]] at rows[i] and a constant 1 for the bias."""
    w, b = np.zeros(buckets), 0.0
    sign = np.where(y > 0, 1.0, -1.0)
    balance = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y <= 0).sum())))
    a = np.zeros(len(rows))
    norm = np.array([(values[i] ** 2).sum() + 1.0 for i in rows])
    order = np.random.default_rng(seed)
    for _ in range(passes):
        most = 0.0
        for k in order.permutation(len(rows)):
            ids = rows[k]
            x = values[ids]
            gradient = sign[k] * (x @ w[ids] + b) - 1
            new = min(max(a[k] - gradient / norm[k], 0.0), cost * balance[k])
            step = (new - a[k]) * sign[k]
            if step:
                w[ids] += step * x
                b += step
                most = max(most, abs(gradient))
                a[k] = new
        if most < 1e-3:
            break
    return w, b


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps for a logistic curve over the columns of x and a constant (last)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y <= 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (target - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(learn: DataFrame, buckets: int = 1 << 18, max_rows: int = 4000, cost: float = 0.01, passes: int = 20, seed: int = 11) -> QualityModel | None:
    """Train on ``doc_id``, ``text`` and ``label`` (0 or 1, others ignored); None unless both classes occur.

    A bounded sample of about ``max_rows`` labelled rows is used, as even over the classes as they allow. A fifth of it gives the
    margins for the logistic curve.
    """
    usable = learn.filter("label in (0, 1)").select("doc_id", "text", "label")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = TokenIds()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "rest": batch["rest"], "ids": [indicators(t, buckets, ids) for t in batch["text"]]})

    sample = bounded_sample(usable, "label", "doc_id", max_rows, "quality").withColumn("rest", F.coalesce(hash_unit(F.col("doc_id").cast("string"), "curve") < 0.2, F.lit(False)))
    rows = sample.mapInPandas(extract, "label int, rest boolean, ids array<int>").toPandas()
    rows = rows.iloc[np.lexsort((rows["ids"].map(lambda i: int(np.sum(i))), rows["ids"].map(len), rows["label"]))]
    y = rows["label"].to_numpy()
    if len(set(y)) < 2:
        return None
    data = [np.asarray(i, np.int64) for i in rows["ids"]]
    rest = rows["rest"].to_numpy(bool)
    if len(set(y[rest])) < 2 or len(set(y[~rest])) < 2:
        rest = np.zeros(len(y), bool)
    train = [d for d, r in zip(data, rest, strict=True) if not r]
    ratio = log_count_ratio(train, y[~rest], buckets)
    w, b = dual_coordinate_descent(train, ratio, y[~rest], buckets, cost, passes, seed)
    weights = ratio * w
    use = rest if rest.any() else ~rest
    margins = np.array([weights[d].sum() + b for d, u in zip(data, use, strict=True) if u])
    slope, shift = fit_logistic(margins[:, None], y[use])
    return QualityModel(weights.astype(np.float32), float(b), float(slope), float(shift))


def score(docs: DataFrame, model: QualityModel | None, text: str = "text", into: str = "score") -> DataFrame:
    """Add the score (0 to 1) of every whole text; a column of that name is replaced.

    Null and empty texts have no n-grams and get the score of the bias; without a model every score is 0.5.
    """
    if model is None:
        return docs.withColumn(into, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket, whatever the input

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m: QualityModel = shared.value
        ids = TokenIds()
        for texts in batches:
            margin = np.array([m.weights[indicators(t, len(m.weights), ids)].sum(dtype=np.float64) for t in texts]) + m.bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -30, 30))))

    return docs.withColumn(into, scores(F.col(text)))
