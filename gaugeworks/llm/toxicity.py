"""Toxic spans: a linear-chain conditional random field over the words of a sentence.

Labelled tokens come from labelled documents: words and word beginnings that occur in clearly more toxic
documents than others mark their tokens, in toxic documents only. The field has two states and features of the word itself;
forward-backward marginals give the spans, and their sum and maximum the score of the document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import bounded_sample, hash_unit
from gaugeworks.llm.quality import fit_logistic

TOKEN = re.compile(r"\w+|[.!?\n]")
CHAIN = 256  # words; a longer run without a sentence end is cut into chains of so many
CACHE = 300_000  # words whose log odds a worker keeps
CHARS = 1_000_000  # characters of the texts that are taken apart at once
STEMS = (4, 5, 6)
MAX_ROWS = 5000  # labelled documents that a model learns from
FALLBACK_MARKS = 20  # words that mark tokens where none stands out clearly
BUCKETS = 1 << 18


def marks(word: str) -> list[str]:
    """What may mark a token as toxic: the word, and its beginnings if it goes on."""
    w = word.lower()
    return [w] + [f"{w[:n]}*" for n in STEMS if len(w) >= n]


def feature_ids(word: str) -> list[int]:
    w = word.lower()
    names = [f"w={w}", *(f"p{n}={w[:n]}" for n in (3, *STEMS)), f"s3={w[-3:]}", f"l={min(len(w), 12)}", f"c={word[:1].isupper()}{word.isupper()}"]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in names]


@dataclass
class ToxicModel:
    emission: np.ndarray  # per feature bucket: log odds of the toxic state
    chain: np.ndarray  # start odds and transition potentials: [start, stay out, go in, go out, stay in]
    curve: np.ndarray  # logistic curve over the evidence of a document


def marginals(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Probability of the toxic state of each word, from the ratios of the two states' forward and backward sums.

    ``e``: log odds of the words of all chains, one chain after another. Steps go over the place in the chain, all chains at once.
    """
    start, oo, ot, to, tt = np.exp(chain)
    r, b = np.empty(len(e)), np.ones(len(e))
    odds = np.exp(np.clip(e, -30, 30))
    order = np.argsort(-lengths, kind="stable")
    s, n = starts[order], lengths[order]
    longest = int(n[0]) if len(n) else 0
    active = [int(np.searchsorted(-n, -t, side="left")) for t in range(longest + 1)]  # chains of more than t words
    if longest:
        r[s] = start * odds[s]
    for t in range(1, longest):
        at = s[:active[t]] + t
        q = r[at - 1]
        r[at] = odds[at] * (ot + q * tt) / (oo + q * to)
    for t in range(longest - 2, -1, -1):
        at = s[:active[t + 1]] + t
        q = odds[at + 1] * b[at + 1]
        b[at] = (to + tt * q) / (oo + ot * q)
    odds = np.clip(r * b, 1e-300, 1e300)
    return odds / (1 + odds)


def pair_probability(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Expected counts of the four transitions and of toxic starts, over all chains (for the gradient)."""
    start, oo, ot, to, tt = np.exp(chain)
    odds = np.exp(np.clip(e, -30, 30))
    r, b = np.empty(len(e)), np.ones(len(e))
    total = np.zeros(5)
    order = np.argsort(-lengths, kind="stable")
    s, n = starts[order], lengths[order]
    r[s] = start * odds[s]
    active = [int(np.searchsorted(-n, -t, side="left")) for t in range(int(n[0]) + 1)]
    for t in range(1, int(n[0])):
        at = s[:active[t]] + t
        r[at] = odds[at] * (ot + r[at - 1] * tt) / (oo + r[at - 1] * to)
    for t in range(int(n[0]) - 2, -1, -1):
        at = s[:active[t + 1]] + t
        q = odds[at + 1] * b[at + 1]
        p, a = r[at], np.empty((4, len(at)))
        a[0], a[1], a[2], a[3] = oo, ot * q, p * to, p * tt * q
        total[1:] += (a / a.sum(axis=0)).sum(axis=1)
        b[at] = (to + tt * q) / (oo + ot * q)
    total[0] = (r[s] * b[s] / (1 + r[s] * b[s])).sum()
    return total


def train(chains: list[tuple[list[str], list[int]]], rounds: int = 80, rate: float = 0.3, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of labelled chains by adaptive gradient steps over all of them."""
    lengths = np.array([len(c[0]) for c in chains])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    y = np.concatenate([np.array(c[1]) for c in chains]).astype(float)
    ids = np.array([feature_ids(w) for words, _ in chains for w in words])
    w, chain = np.zeros(BUCKETS), np.array([-3.0, 0.0, -3.0, 0.0, 0.0])
    real = np.zeros(5)
    real[0] = y[starts].sum()
    follows = np.ones(len(y), bool)
    follows[starts] = False
    before, after = y[:-1][follows[1:]], y[1:][follows[1:]]
    real[1:] = [((before == a) & (after == c)).sum() for a in (0, 1) for c in (0, 1)]
    flat = ids.ravel()
    gw, gc = np.full(BUCKETS, 1e-8), np.full(5, 1e-8)
    scale = 1.0 / len(y)
    for _ in range(rounds):
        e = w[ids].sum(axis=1)
        p = marginals(e, starts, lengths, chain)
        g = np.bincount(flat, weights=np.repeat(p - y, ids.shape[1]), minlength=BUCKETS) * scale + ridge * w
        h = (pair_probability(e, starts, lengths, chain) - real) * scale
        h[1] = 0.0  # the weight of staying out is the scale of the others
        gw += g * g
        gc += h * h
        w -= rate * g / np.sqrt(gw)
        chain = chain - rate * h / np.sqrt(gc)
    return w, chain


class Emissions(dict):
    """Log odds of each word; not a number for a sentence end; forgotten when too many."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> float:
        self[token] = value = float("nan") if token in ".!?\n" else float(self.weights[feature_ids(token)].sum())
        return value


def by_size(texts: list[str], chars: int = CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters together, one text at least."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, k
            start, size = k, 0
        size += len(t)
    yield start, len(texts)


def batch_marginals(texts: list[str], model: ToxicModel, known: Emissions) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all tokens of the texts (0 at sentence ends), and where each text's tokens start."""
    if len(known) > CACHE:
        known.clear()
    tokens = [TOKEN.findall(t) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    e = np.fromiter((known[x] for t in tokens for x in t), np.float64, int(bounds[-1]))
    p = np.zeros(len(e))
    word = ~np.isnan(e)
    at = np.flatnonzero(word)
    if len(at):
        cut = np.ones(len(at), bool)  # does a chain begin at this word?
        cut[1:] = np.diff(at) > 1
        cut[np.searchsorted(at, bounds[:-1][bounds[:-1] < at[-1] + 1])] = True
        first = np.flatnonzero(cut)
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        starts = np.flatnonzero(place % CHAIN == 0)
        p[at] = marginals(e[at], starts, np.diff(np.append(starts, len(at))), model.chain)
    return p, bounds


def evidence(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: logit of the largest marginal, logarithm of the sum of squared marginals (many faint words weigh little)."""
    padded = np.append(p, 0.0)
    top = np.maximum.reduceat(padded, np.minimum(bounds[:-1], len(p))) if len(bounds) > 1 else np.zeros(0)
    total = np.add.reduceat(padded**2, np.minimum(bounds[:-1], len(p))) if len(bounds) > 1 else np.zeros(0)
    empty = np.diff(bounds) == 0
    top, total = np.where(empty, 0.0, top), np.where(empty, 0.0, total)
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log(top / (1 - top)) / 10, np.log(total + 1e-3)])


def toxic_marks(sample: DataFrame, least_documents: int, least_z: float) -> set[str]:
    """Words and beginnings whose log odds of a toxic document exceed zero by so many standard errors."""

    def document_marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found = {m for w in set(TOKEN.findall(text or "")) if w[0].isalnum() for m in marks(w)}
                if found:
                    yield pd.DataFrame({"mark": list(found), "toxic": np.full(len(found), label)})

    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    toxic, other = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    counts = sample.mapInPandas(document_marks, "mark string, toxic int").groupBy("mark").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (toxic - a + 0.5)) - F.log((b + 0.5) / (other - b + 0.5))
    error = F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (toxic - a + 0.5) + 1 / (other - b + 0.5))
    least = max(1, min(least_documents, int(toxic) // 5))  # few toxic rows cannot share a word often
    rated = counts.withColumns({"z": odds / error, "odds": odds})
    # few pass: the sample bounds the words, and the count of documents the number of marks
    found = {r[0] for r in rated.filter((a >= least) & (a >= 20 * b) & (F.col("z") >= least_z)).select("mark").collect()}
    if found:
        return found
    # no word stands out that clearly: take the most telling ones, whole words before their beginnings
    best = rated.filter((a >= least) & (F.col("odds") > 0)).orderBy(F.desc("z"), F.col("mark").endswith("*"), "mark").limit(FALLBACK_MARKS)
    return {r[0] for r in best.select("mark").collect()}


def fit(learn: DataFrame, max_rows: int = MAX_ROWS, max_chains: int = 20_000, least_documents: int = 8, least_z: float = 3.0) -> ToxicModel | None:
    """Train on ``doc_id``, ``text`` and ``label`` (1 toxic, 0 not, others ignored); None unless both occur.

    A bounded sample of about ``max_rows`` labelled rows is used; of its sentences all with a marked token (at most about
    ``max_chains``, by hash) and as many others.
    """
    usable = learn.filter("label in (0, 1)").select("doc_id", "text", F.col("label").cast("int").alias("label"))
    sample = bounded_sample(usable, "label", "doc_id", max_rows, "toxic")
    marked = toxic_marks(sample, least_documents, least_z)
    if not marked:
        return None

    def sentences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words: list[str] = []
                for t in [*TOKEN.findall(text or ""), "."]:
                    if t not in ".!?\n" and len(words) < CHAIN:
                        words.append(t)
                        continue
                    if words:
                        y = [int(label == 1 and not marked.isdisjoint(marks(w))) for w in words]
                        rows.append((words, y, max(y), zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass")) / 2**32))
                    words = [] if t in ".!?\n" else [t]
            if rows:
                yield pd.DataFrame(rows, columns=["words", "y", "hit", "draw"])

    chains = sample.mapInPandas(sentences, "words array<string>, y array<int>, hit int, draw double")
    sizes = {r[0]: r[1] for r in chains.groupBy("hit").count().collect()}
    hits = min(1.0, max_chains / max(1, sizes.get(1, 0)))
    others = min(1.0, max(1000, min(max_chains, sizes.get(1, 0))) / max(1, sizes.get(0, 0)))
    rows = chains.filter(F.col("draw") < F.when(F.col("hit") == 1, hits).otherwise(others)).toPandas()
    rows = rows.iloc[np.lexsort((rows["words"].map(len), rows["draw"], rows["hit"]))]
    emission, chain = train([(list(w), list(y)) for w, y in zip(rows["words"], rows["y"], strict=True)])
    model = ToxicModel(emission.astype(np.float32), chain, np.zeros(3))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Emissions(model.emission)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            x = np.concatenate([evidence(*batch_marginals(texts[a:b], model, known)) for a, b in by_size(texts)])
            yield pd.DataFrame({"label": batch["label"].to_numpy(), "top": x[:, 0], "total": x[:, 1]})

    found = sample.mapInPandas(gather, "label int, top double, total double").toPandas().sort_values(["label", "top", "total"])
    model.curve = fit_logistic(found[["top", "total"]].to_numpy(), found["label"].to_numpy())
    return model


def tagged(texts: list[str], model: ToxicModel, known: Emissions, least: float) -> tuple[np.ndarray, list[list[dict]]]:
    """Evidence and spans of some texts."""
    p, bounds = batch_marginals(texts, model, known)
    spans: list[list[dict]] = [[] for _ in texts]
    hits = np.flatnonzero(p >= least)
    for k in np.unique(np.searchsorted(bounds, hits, side="right") - 1):
        own = p[bounds[k]:bounds[k + 1]]
        spans[k] = [{"start": f.start(), "end": f.end(), "probability": float(q)} for f, q in zip(TOKEN.finditer(texts[k]), own, strict=True) if q >= least]
    return evidence(p, bounds), spans


def score(docs: DataFrame, model: ToxicModel | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """Add ``score`` (0 to 1) and ``toxic_spans`` (start, end, probability of words of at least ``least``); such columns are replaced.

    Offsets are code points of the whole text. Null and empty texts have no spans and the least score; without a model every score is 0.
    """
    spans_type = "array<struct<start:int,end:int,probability:double>>"
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "toxic_spans": F.from_json(F.lit("[]"), spans_type)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per feature bucket, whatever the input

    @F.pandas_udf(f"score double, spans {spans_type}")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: ToxicModel = shared.value
        known = Emissions(m.emission)
        for batch in batches:
            texts = [t or "" for t in batch]
            evidences, spans = [], []
            for a, b in by_size(texts):
                x, found = tagged(texts[a:b], m, known, least)
                evidences.append(x)
                spans += found
            x = np.concatenate(evidences)
            z = np.column_stack([x, np.ones(len(x))]) @ m.curve
            yield pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "spans": pd.Series(spans, dtype=object)})

    out = docs.withColumn("_found", tag(F.col(text)))
    return out.withColumns({"score": F.col("_found.score"), "toxic_spans": F.col("_found.spans")}).drop("_found")


def predicted(score_column: Column, least: float) -> Column:
    return F.when(score_column >= least, 1).otherwise(0)
