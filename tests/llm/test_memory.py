"""What bounds the memory of a worker changes no result; few toxic rows still give a model."""

from gaugeworks.llm import packing, toxicity
from gaugeworks.llm.queries import labelled_sample, tokenizer_path


def learnable(spark, toxic, clean):
    rows = [(k, f"you are a zorgling fool number {k}. it rains", 1) for k in range(toxic)]
    rows += [(100 + k, f"the water level was {k} today. it rains", 0) for k in range(clean)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_five_toxic_rows_give_a_model(spark):
    learn = learnable(spark, 5, 60)
    model = toxicity.fit(learn)
    assert model is not None
    scored = toxicity.score(learn, model).select("label", "score").collect()
    assert min(r.score for r in scored if r.label) > max(r.score for r in scored if not r.label)


def test_texts_are_taken_apart_in_ranges(spark, monkeypatch):
    assert list(toxicity.by_size(["aaa", "b", "", "cccc", "d"], 4)) == [(0, 3), (3, 4), (4, 5)] and list(toxicity.by_size([])) == [(0, 0)]
    learn = learnable(spark, 12, 40)
    model = toxicity.fit(learn)
    whole = toxicity.score(learn, model).select("doc_id", "score", "toxic_spans").orderBy("doc_id").collect()
    monkeypatch.setattr(toxicity.by_size, "__defaults__", (50,))
    assert toxicity.score(learn, model).select("doc_id", "score", "toxic_spans").orderBy("doc_id").collect() == whole


def test_sample_of_labels(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(300)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(300)] + [(None, 0, 1), (7, 0, None), (999, 0, 1)], "doc_id long, quality int, toxic int")
    got = labelled_sample(docs, labels, "toxic", 3, 1, 40, "toxic").collect()
    assert 15 <= len(got) <= 80 and all(r.text == f"text {r.doc_id}" and r.label == r.doc_id % 2 for r in got)


def test_small_caches_give_the_same_pieces(spark):
    docs = spark.createDataFrame([(k, " ".join(f"word{j * k % 97} Ärger," for j in range(50 * k))) for k in range(12)] + [(None, None)], "doc_id long, text string")
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(packing.pieces(docs, tokenizer_path(), 64, 0, words=20, chars=300)) == order(packing.pieces(docs, tokenizer_path(), 64, 0))
