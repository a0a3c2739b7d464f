"""Mixing and fingerprints against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import fingerprint, mixing
from gaugeworks.llm.common import bounded_sample, range_buckets, running

SCHEMA = "doc_id long, text string, source string, size string, target string"


def brute_targets(sizes, weights=(3, 1, 2)):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_matches_plain_python(spark, seed):
    r = random.Random(seed)
    rows = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.randint(0, 40) * (9 if i % 4 == 0 else 1))), r.choice(["b", "a", "ä", "Z", None]), "x", "y") for i in range(80)]
    rows += [(None, "one two", "a", "x", "y"), (500, None, "b", "x", "y"), (501, "", "only empty", "x", "y"), rows[0], rows[0]]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for d in rows:
        sizes[d[2]] += len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))
    want = brute_targets(sizes)
    for g in got:
        assert g["source_size"] == sizes[g["source"]]
        assert g["target"] == pytest.approx(want[g["source"]])
        rate = want[g["source"]] / sizes[g["source"]] if sizes[g["source"]] else 0
        draw = int(hashlib.md5(f"mix:{'' if g['doc_id'] is None else g['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        assert g["taken"] == g["size"] * (int(rate) + (draw < rate - int(rate)))
        assert g["taken"] <= 2 * g["size"]
    emitted = mixing.emit(mixing.mix(spark.createDataFrame(rows, SCHEMA)), ["doc_id"])
    assert emitted.count() == sum(g["copies"] for g in got)


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_running_and_buckets(spark):
    rows = [(i, i % 7) for i in range(300)]
    random.Random(3).shuffle(rows)
    got = {r[0]: r[2] for r in running(spark.createDataFrame(rows, "k long, v long"), ["k"], {"s": F.col("v")}).collect()}
    assert got == {k: sum(i % 7 for i in range(k)) for k in range(300)}
    frame = spark.createDataFrame([(None,), *[(k * k,) for k in range(200)]], "k long")
    marked = frame.withColumn("b", range_buckets(frame, "k", 300)).orderBy(F.col("k").asc_nulls_first()).collect()
    assert [r.b for r in marked] == sorted(r.b for r in marked) and len({r.b for r in marked}) > 100
    empty = frame.filter("false")
    assert empty.withColumn("b", range_buckets(empty, "k", 8)).count() == 0


def test_bounded_sample(spark):
    rows = spark.range(2000).selectExpr("id", "cast(id % 10 = 0 as int) as label")
    taken = bounded_sample(rows, "label", "id", 300, "s").groupBy("label").count().collect()
    assert all(110 < r["count"] < 190 for r in taken) and len(taken) == 2
    assert bounded_sample(rows, "label", "id", 5000, "s").count() == 2000


TEXTS = [(5, "one two three\nfour five six"), (1, "four five six\none two three"), (2, ""), (None, None), (9, "Ärger 𝄞 über alles"), (9, "Ärger 𝄞 über alles"), (7, "x"), (12, "word " * 3000)]


def plain_fingerprint(text):
    equal, counters, n = [0] * 4, [0] * 20, 0
    for p in (text or "").split("\n"):
        d = hashlib.sha256(p.encode()).hexdigest()
        equal = [(e + int(d[15 * i:15 * i + 15], 16)) % 2**60 for i, e in enumerate(equal)]
        words = p.split(" ")
        for a, b in zip(words, [*words[1:], ""], strict=True):
            h = int(hashlib.md5(f"{a} {b}".encode()).hexdigest()[:15], 16)
            counters = [c + ((h >> i) & (1 | 1 << 20 | 1 << 40)) for i, c in enumerate(counters)]
            n += 1
    return "".join(f"{x:015x}" for x in equal + counters) + f"{n:08x}"


def test_fingerprints_of_edits(spark):
    docs = spark.createDataFrame([(*t, "x") for t in TEXTS], "doc_id long, text string, fingerprint string")
    got = fingerprint.fingerprint_edits(docs).collect()
    ordered = sorted(TEXTS, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or ""))
    edits = defaultdict(list)
    for (key, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        t = text or ""
        k = len(t) // 4
        edits[key].append((len(t), hashlib.sha256((t[:len(t) - k] + (after or "")[:k]).encode()).hexdigest(), plain_fingerprint(t), plain_fingerprint(t[:len(t) - k] + (after or "")[:k])))
    assert len(got) == len(TEXTS)
    found = defaultdict(list)
    for g in got:
        found[g.doc_id].append((g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint))
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in edits.items()}
    by = {g.doc_id: g for g in got}
    assert by[5].fingerprint == by[1].fingerprint  # order of paragraphs
    assert by[9].near_edited > 0.4 and by[12].near_edited > 0.9


def test_single_and_no_document(spark):
    one = spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")
    row = fingerprint.fingerprint_edits(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0
    assert fingerprint.fingerprint_edits(one.filter("false")).count() == 0


def test_paragraphs_come_and_go(spark):
    make = lambda text: fingerprint.fingerprints(spark.createDataFrame([(1, text)], "k long, t string"), ["k"], "t")
    whole, start, part = make("a b\nc d\ne f"), make("a b\ne f"), make("c d")
    assert fingerprint.combine(start, part, ["k"]).first().fingerprint == whole.first().fingerprint
    assert fingerprint.combine(whole, part, ["k"], -1).first().fingerprint == start.first().fingerprint
