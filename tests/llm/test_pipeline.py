"""The whole pipeline on odd tables, and the choice among rows of one id."""

import zlib
from array import array

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gaugeworks.llm import jaccard, secret_scan
from gaugeworks.llm.queries import tokenizer_path
from gaugeworks.session import scratch_path

SMALL = "/root/testdata/sf0.001"


def written(spark, docs):
    folder = scratch_path(spark, "pipeline-run")
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_run_without_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("false")
    got = corpus_pipeline.run(spark, written(spark, docs))
    assert got.count() == 0 and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns)


def test_run_on_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 60").withColumns({"piece": F.lit("x"), "_text": F.lit(1), "size": F.lit(2)})
    one = docs.filter("lang = 'en' and length(text) > 200").orderBy("doc_id").first()
    secret = one.text + " token=abcdefghijklmnop"
    extra = [
        {"doc_id": None, "text": one.text}, {"doc_id": 900, "text": None}, {"doc_id": 901, "text": ""}, {"doc_id": 902, "text": "!!!"},
        {"doc_id": 903, "text": secret}, {"doc_id": 903, "text": secret}, {"doc_id": 904, "text": " ".join([one.text[::-1]] + [f"{one.text} {k}" for k in range(2000)])},
    ]
    odd = spark.createDataFrame([one.asDict() | e for e in extra], docs.schema)
    got = corpus_pipeline.run(spark, written(spark, docs.union(odd))).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= corpus_pipeline.CAPACITY
    ids = {r.doc_id for r in got}
    assert ids <= {r.doc_id for r in docs.collect()} | {None, 903, 904} and not ids & {900, 901, 902}
    # what is left of a document whose id is kept is the text of its row, without secrets
    library = Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in secret_scan.redact(secret_scan.scan(docs.union(odd))).collect()}
    for key in ids:
        whole = [*library.encode(texts[key], add_special_tokens=False).ids, 0]
        cuts = {k // 2048: zlib.crc32(array("I", whole[k:k + 2048]).tobytes()) for k in range(0, len(whole), 2048)}
        assert {(r.piece, r.ids_crc32) for r in got if r.doc_id == key} == set(cuts.items())


@pytest.mark.parametrize("parts", [1, 7])
def test_rows_of_one_id_are_chosen_alike(spark, parts):
    rows = [(1, f"one two three four five six {k}", {"k": k}) for k in range(20)] + [(2, "other words", {}), (None, "no id", {}), (None, "no id", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` map<string,int>").repartition(parts)
    kept = jaccard.keep_one(docs, jaccard.join(docs))
    least = docs.filter("doc_id = 1").orderBy(F.xxhash64("doc_id", "text")).first().text
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "no id"), (0, "no id"), (1, least), (2, "other words")]
