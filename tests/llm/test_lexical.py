"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import pytest

from gaugeworks.llm import lexical

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [t.translate(LOWER) for t in SPLIT.findall(text or "")]


def brute_force(docs, items, most):
    bags = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, all_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = []
    for item, own in wanted.items():
        found = []
        for (doc_id, bag), n in zip(bags, sizes):
            score = 0
            for t in own & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * n_docs) // all_terms
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:most], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=str)


def made(seed, n, copies):
    r = random.Random(seed)
    vocabulary = ["Fox", "fox", "über", "ÜBER", "a1", "the", "the", "the", "x_y", "don't", "中文", "ǅ", "K"] + [f"w{k}" for k in range(40)]
    docs = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 30)))) for k in range(n)]
    docs += [(1000 + k, docs[3][1] + " the fox w1") for k in range(copies)]
    r.shuffle(docs)
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 8)))) for k in range(12)]
    return docs, items


@pytest.mark.parametrize("most,max_items,max_pairs", [(5, 4096, 10**6), (50, 4096, 10**6), (7, 4, 10**6), (7, 4096, 9)])
def test_equals_brute_force(spark, most, max_items, max_pairs):
    docs, items = made(3, 150, 90)
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string"),
                           most, max_items=max_items, max_pairs=max_pairs)
    assert sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute_force(docs, items, most)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "fox the"), (3, "fox the"), (3, "fox the"), (3, "the"), (4, "long " * 50_000 + "fox"), (5, "- . !")]
    items = [(1, "Fox"), (1, "the"), (2, None), (3, ""), (None, "long"), (4, "absent"), (1, "Fox")]
    d = spark.createDataFrame([(*x, 7, "h") for x in docs], "doc_id long, text string, m long, bag string")
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, terms int")
    found = lexical.search(d, i)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(docs, items, 50)
    assert lexical.search(d.limit(0), i).count() == 0
    assert lexical.search(d, i.limit(0)).count() == 0
    assert lexical.search(d.filter("doc_id = 2"), i).count() == 0


def test_equal_bags_are_one_class(spark):
    docs, _ = made(5, 30, 40)
    held = lexical.bags(spark.createDataFrame(docs, "doc_id long, text string"), {b"fox": 0, b"the": 1, b"w1": 2}, "doc_id", "text")
    keyed, found = lexical.classes(held.withColumn("m", held["n"]))
    real = Counter((tuple(Counter(w for w in words(t) if w in ("fox", "the", "w1")).items()) and (Counter(words(t))["fox"], Counter(words(t))["the"], Counter(words(t))["w1"], len(words(t)))) or None for _, t in docs)
    real.pop(None, None)
    assert sorted(r.members for r in found.collect()) == sorted(real.values())
    assert keyed.count() == len(docs)


def test_measure_beyond_64_bits(spark):
    row = spark.range(1).select(lexical.measure(lexical.F.lit(10**9).cast("long"), 10**11, 7 * 10**13 + 1).alias("m")).first()
    assert row.m == 50 + (50 * 10**9 * 10**11) // (7 * 10**13 + 1)
