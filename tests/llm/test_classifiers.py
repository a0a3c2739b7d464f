"""Language, quality and toxicity: held-out accuracy, exact parts, odd rows."""

import itertools

import numpy as np
import pytest

from gaugeworks.llm import langid, quality, queries, toxicity
from gaugeworks.llm.common import table
from tests.conftest import SF

ODD = [(1, None), (2, ""), (3, "\n\n"), (4, "123 456"), (4, "123 456"), (None, "the of and"), (7, "the of and " * 60_000), (8, "word"), (9, "퟿ é 𝄞 ß")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in ODD], "doc_id long, text string, score string, lang_pred string, toxic_spans string")


@pytest.fixture(scope="module")
def truth(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    return {r.doc_id: r for r in docs.join(labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic").collect()}


def accuracy(rows, truth, got, want):
    held = [r for r in rows if r.held_out and getattr(truth[r.doc_id], want) is not None]
    return sum(getattr(r, got) == getattr(truth[r.doc_id], want) for r in held) / len(held)


def test_language_held_out(spark, truth):
    rows = queries.op8_language(spark, SF).collect()
    assert len(rows) == len(truth) and accuracy(rows, truth, "lang_pred", "lang") > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_held_out(spark, truth):
    rows = queries.op1_quality(spark, SF).collect()
    assert len(rows) == len(truth) and accuracy(rows, truth, "predicted", "quality") > 0.9


def test_toxicity_held_out(spark, truth):
    rows = queries.op6_toxicity(spark, SF).collect()
    assert len(rows) == len(truth) and accuracy(rows, truth, "predicted", "toxic") > 0.9


def test_language_odd_rows(spark, odd):
    learn = spark.createDataFrame([(i, "the of and in", "en") for i in range(6)] + [(i + 10, "der die und ich", "de") for i in range(6)] + [(30, None, "de"), (31, "x", None)], "doc_id long, text string, lang string")
    model = langid.fit(learn)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == len(ODD)
    by = [(r.text, r.lang_pred, r.score) for r in rows]
    assert all((lang == "und" and score == 0) == (not t or not any(c.isalpha() for c in t)) for t, lang, score in by)
    assert {lang for t, lang, _ in by if t and t.startswith("the")} == {"en"}
    assert langid.fit(learn.filter("false")) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(odd.filter("false"), model).count() == 0


def test_gram_ids_do_not_depend_on_slices(monkeypatch):
    text = "abcdefghij" * 7
    whole = sorted(np.concatenate(list(langid.gram_ids(text, 1 << 16))))
    monkeypatch.setattr(langid, "SLICE", 8)
    assert sorted(np.concatenate(list(langid.gram_ids(text, 1 << 16)))) == whole and len(whole) == 70 + 69 + 68


def test_quality_odd_rows(spark, odd):
    learn = spark.createDataFrame([(i, f"plain words here {i}", 1) for i in range(8)] + [(i + 10, f"BAD!! %%% {i} ###", 0) for i in range(8)] + [(40, None, 1), (41, "x", None), (42, "x", 3)], "doc_id long, text string, label int")
    rows = quality.score(odd, quality.fit(learn)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality.fit(learn.filter("label = 1")) is None and quality.fit(learn.filter("false")) is None
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    r = np.random.default_rng(1)
    rows = [np.flatnonzero(r.random(12) < 0.5) for _ in range(40)]
    y = np.array([int(3 in i) ^ int(r.random() < 0.1) for i in rows])
    values = np.ones(12)
    w, b = quality.dual_coordinate_descent(rows, values, y, 12, 0.5, 500, 0)
    balance = np.where(y > 0, 20 / (y > 0).sum(), 20 / (y <= 0).sum())

    def loss(w, b):
        margins = np.array([w[i].sum() + b for i in rows]) * np.where(y > 0, 1, -1)
        return 0.5 * ((w**2).sum() + b * b) + 0.5 * (balance * np.maximum(0, 1 - margins)).sum()

    best = loss(w, b)
    for _ in range(2000):
        assert loss(w + r.normal(0, 0.05, 12), b + r.normal(0, 0.05)) >= best - 1e-3


def chain_brute(e, chain):
    total, toxic = 0.0, np.zeros(len(e))
    for states in itertools.product((0, 1), repeat=len(e)):
        score = sum(x for x, s in zip(e, states, strict=True) if s) + (chain[0] if states[0] else 0)
        score += sum(chain[1 + 2 * a + b] for a, b in zip(states, states[1:], strict=False))
        total += np.exp(score)
        toxic += np.exp(score) * np.array(states)
    return toxic / total


def test_marginals_match_enumeration():
    r = np.random.default_rng(2)
    lengths = np.array([1, 4, 6, 2, 1])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    e, chain = r.normal(0, 2, lengths.sum()), np.array([-1.0, 0.2, -2.0, 0.5, 1.0])
    want = np.concatenate([chain_brute(e[a:a + n], chain) for a, n in zip(starts, lengths, strict=True)])
    assert np.allclose(toxicity.marginals(e, starts, lengths, chain), want)
    counts = toxicity.pair_probability(e, starts, lengths, chain)
    assert counts[1:].sum() == pytest.approx((lengths - 1).sum()) and counts[0] == pytest.approx(want[starts].sum())


def test_toxicity_odd_rows(spark, odd):
    r = np.random.default_rng(3)
    words = [f"w{c}" for c in "abcdefghijkl"]
    make = lambda bad: ". ".join(" ".join([*r.choice(words, 5), *(["nasty"] if bad else [])]) for _ in range(4))
    learn = spark.createDataFrame([(i, make(i % 2), i % 2) for i in range(80)] + [(200, None, 1), (201, "x", None)], "doc_id long, text string, label int")
    model = toxicity.fit(learn)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows) and all(r.toxic_spans == [] for r in rows)
    hit = toxicity.score(spark.createDataFrame([(1, "𝄞 wa wb nasty wc. Nasty")], "doc_id long, text string"), model).first()
    assert hit.score > 0.7 and [(x.start, x.end) for x in hit.toxic_spans] == [(8, 13), (18, 23)]
    assert toxicity.fit(learn.filter("label = 0")) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.score(odd.filter("false"), model).count() == 0
