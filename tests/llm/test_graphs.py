"""Jaccard join, components, nearest neighbours and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm import jaccard, neighbours, secret_scan
from gaugeworks.llm.graphs import components
from gaugeworks.session import scratch_path
from tests.conftest import SMALL


def runs(text, width=5):
    words = (text or "").split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_join(rows, threshold=0.8):
    """doc_id: (class, links) of rows with distinct ids."""
    sets = {k: runs(t) for k, t in rows}
    parent, links = {k: k for k in sets}, dict.fromkeys(sets, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (find(k), links[k]) for k in sets}


def near_copies(seed, count=160):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows, base = [], []
    for k in range(count):
        if not base or r.random() < 0.2:
            base.append([word() for _ in range(r.randint(1, 120))])
        text = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
            text[r.randrange(len(text))] = word()
        rows.append((k * 3, r.choice([" ", "  ", "\n"]).join(text)))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "lone"), (1004, "lone")]


def test_join_finds_every_link(spark):
    rows = near_copies(1)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, class_id int, node string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(docs).collect()}
    assert got == brute_join(rows)
    kept = {r.doc_id for r in jaccard.keep_one(docs, jaccard.join(docs)).collect()}
    assert kept == {c for c, _ in got.values()}


def test_blocks_change_nothing(spark, monkeypatch):
    rows = near_copies(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(docs).collect()} == brute_join(rows)


def test_join_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (5, "very long " * 50_000), (6, "very long " * 50_001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.class_id, r.copies, r.n_links) for r in jaccard.join(docs).collect())
    assert got == [(False, 0, None, 1, 0), (True, 1, 1, 3, 2), (True, 1, 1, 3, 2), (True, 2, 1, 3, 2), (True, 5, 5, 2, 1), (True, 6, 5, 2, 1)]
    kept = jaccard.keep_one(docs, jaccard.join(docs)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept) == [(False, 0), (True, 1), (True, 5)]
    assert jaccard.join(docs.filter("false")).count() == 0


def test_depth_meets_the_recall():
    for trees, recall in ((32, 0.9999), (8, 0.95), (1, 0.99)):
        d = jaccard.depth_for(trees, 8, 0.8, recall)
        assert d == 1 or 1 - (1 - 0.8**d) ** trees >= recall
        assert d == 8 or 1 - (1 - 0.8 ** (d + 1)) ** trees < recall


def test_components(spark):
    r = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 140)] + [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(7, 7), (200, 200)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def exact(vectors, query, k):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    d = np.sqrt(((x - x[list(ids).index(query)]) ** 2).sum(1))
    order = [o for o in np.lexsort((ids, d)) if ids[o] != query][:k]
    return [(int(ids[o]), float(d[o])) for o in order]


def test_search_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(7)
    monkeypatch.setattr(neighbours, "CELL", 64)
    good = [(int(i), r.normal(size=12).astype(np.float32).tolist()) for i in range(600)]
    good += [(int(i), good[5][1]) for i in range(600, 640)]
    bad = [(700, None), (701, [0.0] * 12), (702, [None] + [1.0] * 11), (703, [float("nan")] + [1.0] * 11), (704, [float("inf")] + [1.0] * 11), (705, [1.0]), (None, [1.0] * 12)]
    frame = spark.createDataFrame([(*v, "x") for v in good + bad], "vec_id long, embedding array<float>, node string")
    index = neighbours.build(frame)
    asked = spark.createDataFrame([(i,) for i in [*range(0, 640, 20), 700, 703]], "query_id long")
    got = {}
    for row in neighbours.search(index, asked).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert set(got) == set(range(0, 640, 20))
    hits = 0
    for q, found in got.items():
        want = exact(good, q, 10)
        hits += len({i for i, _ in found} & {i for i, _ in want})
        all_of = dict(exact(good, q, 1000))
        assert len(found) == 10 and all(s == pytest.approx(all_of[i], abs=1e-12) for i, s in found)
    assert hits / (10 * len(got)) >= 0.95
    assert [i for i, _ in got[600]] == [5, *range(601, 610)]  # equal vectors: the smallest ids


def test_search_of_few_and_none(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = neighbours.search(neighbours.build(frame), frame.select(F.col("vec_id").alias("query_id"))).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in rows) == [(1, 1, 2), (2, 1, 1)]
    one = frame.limit(1)
    assert neighbours.search(neighbours.build(one), one.select(F.col("vec_id").alias("query_id"))).count() == 0
    assert neighbours.build(frame.filter("false")) is None


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    odd = spark.createDataFrame([(900_001, None, "en", "src0", 0), (900_002, "!!! ???", "en", "src0", 7), (900_003, "password=abcdefghijklmn and the rest of that", "en", None, 43)], docs.schema)
    path = scratch_path(spark, "pipeline-test")
    docs.union(odd).write.parquet(path)
    docs = spark.read.parquet(path)
    stages = dict(corpus_pipeline.STAGES)
    before = {r.doc_id: r for r in docs.collect()}
    first = stages["language"](spark, docs, SMALL)
    assert first.columns == docs.columns
    ids = {r.doc_id for r in first.collect()}
    assert {900_001, 900_002}.isdisjoint(ids) and len(ids) >= len(before) - 4
    second = stages["near_duplicates"](spark, first, SMALL)
    want = brute_join([(k, before[k].text) for k in ids])
    assert second.columns == docs.columns and sorted(r.doc_id for r in second.collect()) == sorted({c for c, _ in want.values()})
    third = {r.doc_id: r for r in stages["secrets"](spark, second, SMALL).collect()}
    for k, r in third.items():
        spans = secret_scan.find_spans(before[k].text, re.compile("|".join(f"(?:{a})" for a in secret_scan.ALLOW)))
        assert (r.text == before[k].text) == (not spans) and (r.n_chars == len(r.text) if spans else r.n_chars == before[k].n_chars)
    assert third[900_003].text == "[secret] and the rest of that"
    mixed = stages["mixture"](spark, stages["secrets"](spark, second, SMALL), SMALL)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= set(third)
    packed = stages["sequences"](spark, mixed, SMALL)
    pieces = packed.filter("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048


def test_search_beside_a_far_outlier(spark, monkeypatch):
    r = np.random.default_rng(11)
    monkeypatch.setattr(neighbours, "CELL", 64)
    x = r.normal(size=(400, 8)).astype(np.float32)
    x[7] *= 1e8
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    asked = [7, *range(0, 400, 20)]
    rows = neighbours.search(neighbours.build(frame), spark.createDataFrame([(i,) for i in asked], "query_id long"), beam=32, width=16).collect()
    hits = sum(len({s.vec_id for s in rows if s.query_id == q} & {i for i, _ in exact(vectors, q, 10)}) for q in asked)
    assert hits >= 0.95 * 10 * len(asked)


def test_dense_cluster_in_first_graph(spark, monkeypatch):
    r = np.random.default_rng(13)
    monkeypatch.setattr(neighbours, "CELL", 32)
    x = r.normal(size=(3000, 16))
    x[:1000] = x[0] + 1e-3 * r.normal(size=(1000, 3)) @ r.normal(size=(3, 16))  # a third of the rows
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, v binary")
    cells = neighbours.split_cells(nodes, "<f8", 16, 4, 5)
    assert cells.groupBy("tree", "cell", "part").count().agg(F.max("count")).first()[0] <= 48
    assert cells.filter("part > 0").isEmpty() and cells.groupBy("node").count().filter("count = 4").count() == 3000
    found = {}
    for e in neighbours.first_graph(nodes, "<f8", 16, 24, 16, 5).filter("node < 1000").collect():
        found.setdefault(e.node, set()).add(e.other)
    vectors = list(enumerate(x))
    asked = range(0, 1000, 50)
    assert sum(len(found[q] & {i for i, _ in exact(vectors, q, 10)}) for q in asked) >= 0.9 * 10 * len(asked)


def test_graph_settles(spark, monkeypatch):
    r = np.random.default_rng(17)
    monkeypatch.setattr(neighbours, "CELL", 16)
    vectors = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(1500, 8)))]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    index = neighbours.build(frame, k=12, trees=2)  # a poor first graph
    found = {}
    for e in index.edges.collect():
        found.setdefault(e.node, set()).add(e.other)
    asked = range(0, 1500, 50)
    assert sum(len(found[q] & {i for i, _ in exact(vectors, q, 10)}) for q in asked) >= 0.95 * 10 * len(asked)
    with pytest.raises(RuntimeError, match="still changes"):
        neighbours.build(frame, k=12, trees=2, most_rounds=1)
