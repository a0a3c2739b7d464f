"""Tokens, plane files and packing: exact round trips and brute force."""

import io
import itertools
import random
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeworks.llm import packing, plane_files
from gaugeworks.llm.queries import tokenizer_path
from gaugeworks.llm.tokens import Encoder
from gaugeworks.session import scratch_path

ROWS = [(4, "the quick brown fox. It's!"), (2, ""), (None, None), (9, "Ärger <|endoftext|> ÉTÉ"), (9, "Ärger <|endoftext|> ÉTÉ"), (1, "word thingy " * 3000), (7, "\x1c ab.\tc,\r\nd")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_words_give_the_ids_of_whole_texts(library):
    r = random.Random(1)
    bits = ["the", "Thing", "don't", "'s", ".", "..", ",", "é", "é", "İ", "Σ", "ΑΣ", " ", "  ", "\n", "\t", "\x1c", "12", "½", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "a.b", "x!?", "Ärger$$$", "ab-c)", "Å", "ᄒ", "a_", "Ǆ", "ß", "{}", "ſ", "K", "́", "中文", "ﬁ"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    encoder = Encoder(tokenizer_path(), limit=200)
    assert encoder.by_word and encoder.lower
    got = [ids for at in range(0, len(texts), 100) for ids in encoder.encode(texts[at:at + 100])]
    assert got == [array("I", e.ids).tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_word_is_looked_up_once_a_call(library):
    """However often a word stands there, Python meets it once; one that was set aside is not encoded again."""

    class Counted(dict):
        looked_up = 0

        def get(self, *args):
            self.looked_up += 1
            return super().get(*args)

    encoder = Encoder(tokenizer_path())
    texts = ["fox, den. fox " * 5000, "", "den fox\n" * 5000]
    for _ in range(2):
        encoder.known = Counted(encoder.known)
        assert encoder.encode(texts) == [array("I", e.ids).tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
        assert encoder.known.looked_up <= 10
    encoder.known, encoder.older, encoder.library = {}, encoder.known, None
    assert len(encoder.encode(["den, fox."])[0]) > 8


@pytest.mark.parametrize("width", [1, 8])
def test_plane_file_round_trip(width):
    r = np.random.default_rng(2)
    docs = [(k - 3, r.integers(0, 2 ** int(r.integers(1, 32)), int(r.integers(0, 90)), dtype=np.uint32)) for k in range(60)]
    out = io.BytesIO()
    writer = plane_files.Writer(out, block=64, width=width)
    for k, ids in docs:
        writer.add(k, ids)
    writer.close()
    size = out.tell()
    got = list(plane_files.read_documents(out, size))
    starts = np.concatenate([[0], np.cumsum([len(d[1]) for d in docs])])
    assert [(k, a) for k, a, _ in got] == [(k, s) for (k, _), s in zip(docs, starts, strict=False)]
    assert all(raw == ids.astype("<u4").tobytes() for (_, ids), (*_, raw) in zip(docs, got, strict=True))
    out.seek(size - 1)
    out.write(b"!")
    with pytest.raises(ValueError):
        plane_files.read_index(out, size)


def test_files_hold_all_documents_in_order(spark, library):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, ids string")
    files = plane_files.write_files(docs, scratch_path(spark, "planes"), tokenizer_path())
    got = plane_files.read_files(spark, files).orderBy("start").collect()
    start = 0
    for g, (key, text) in zip(got, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), strict=True):
        ids = array("I", [*library.encode(text or "", add_special_tokens=False).ids, 1])
        assert (g.doc_id, g.start, g.n_tokens, bytes(g.ids)) == (key, start, len(ids), ids.tobytes())
        start += len(ids)
    none = plane_files.write_files(docs.filter("false"), scratch_path(spark, "planes"), tokenizer_path())
    assert none == [] and plane_files.read_files(spark, none).count() == 0


def test_knapsack_is_the_best_multiset():
    r = random.Random(3)
    for _ in range(30):
        price = np.zeros(13)
        for length in r.sample(range(1, 13), 4):
            price[length] = r.random()
        lengths = np.flatnonzero(price)
        best = max(sum(price[x] for x in c) for n in range(13) for c in itertools.combinations_with_replacement(lengths, n) if sum(c) <= 12)
        got = packing.knapsack(price, 12)
        assert sum(k * n for k, n in got.items()) <= 12 and sum(price[k] * n for k, n in got.items()) == pytest.approx(best)


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_the_demand_exactly(seed):
    r = random.Random(seed)
    demand = {n: r.randint(1, 60 if n < 40 else 5) for n in r.sample(range(1, 101), 40)}
    configs = packing.plan(demand, 100)
    total = {}
    for config, uses in configs.items():
        assert sum(n * k for n, k in config) <= 100 and uses > 0
        for n, k in config:
            total[n] = total.get(n, 0) + k * uses
    assert total == demand
    least = -(-sum(n * k for n, k in demand.items()) // 100)
    assert sum(configs.values()) <= max(least + 3, 1.03 * least, sum(packing.best_fit(demand, 100).values()))
    uses = packing.solve(demand, 100)
    assert all(sum(u * dict(c).get(n, 0) for c, u in uses.items()) <= k + 1e-6 for n, k in demand.items())


@pytest.mark.parametrize("pieces", [20_000, 3_000_000])
def test_the_program_places_nearly_all_tokens(pieces):
    lengths = np.random.default_rng(8).lognormal(6, 1.2, pieces).astype(int) + 1
    rest, n = np.unique(lengths % 2048, return_counts=True)
    demand = {int(k): int(c) for k, c in zip(rest, n, strict=True) if k}
    demand[2048] = int((lengths // 2048).sum())
    total = sum(k * c for k, c in demand.items())
    placed, left = packing.by_program(demand, 2048)
    assert sum(k * c for k, c in left.items()) <= 0.05 * total
    assert {k: sum(u * dict(c).get(k, 0) for c, u in placed.items()) + left.get(k, 0) for k in demand} == demand
    assert all(sum(k * c for k, c in config) <= 2048 and uses > 0 for config, uses in placed.items())
    assert sum(packing.plan(demand, 2048).values()) <= 1.001 * total / 2048 + 1


def test_no_plan_is_below_the_bound():
    r = random.Random(9)
    for cap in (12, 50, 100):
        for _ in range(10):
            demand = {n: r.randint(1, 400) for n in r.sample(range(1, cap + 1), r.randint(1, 10))}
            uses, dual = packing.program(demand, cap)
            got = sum(packing.plan(demand, cap).values())
            assert packing.lower_bound(demand, cap, dual) <= got + 1e-9 and sum(k * n for k, n in demand.items()) <= cap * got
            assert got <= sum(packing.best_fit(demand, cap).values())
            assert all(sum(u * dict(c).get(n, 0) for c, u in uses.items()) <= k * (1 + 1e-6) for n, k in demand.items())
    assert packing.plan({}, 10) == {} and packing.plan({10: 7}, 10) == {((10, 1),): 7}


def test_pieces_fill_sequences_without_gaps(spark, library):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, ids string, offset int")
    cut = packing.pieces(docs, tokenizer_path(), 64, 0)
    packed = packing.pack(cut, 64, ["doc_id", "piece", "ids"]).collect()
    want = []
    for key, text in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(key, k // 64, k, len(ids[k:k + 64]), array("I", ids[k:k + 64]).tobytes()) for k in range(0, len(ids), 64)]
    order = lambda x: (x[0] is not None, *[v or 0 for v in x[:2]])
    assert sorted(((p.doc_id, p.piece, p.start, p.length, bytes(p.ids)) for p in packed), key=order) == sorted(want, key=order)
    by = {}
    for p in packed:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length, bytes(p.ids)))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-sum(w[3] for w in want) // 64) + 1
    joined = packing.sequences(packing.pack(cut, 64, ["doc_id", "piece", "ids"])).collect()
    assert sum(len(j.ids) for j in joined) == 4 * sum(w[3] for w in want) and len(joined) == len(by)
    assert packing.pack(cut.filter("false"), 64, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(cut.withColumn("length", F.lit(65)), 64, ["doc_id"])


def test_crc_is_the_stated_one(spark):
    ids = array("I", [1, 2, 49_407]).tobytes()
    assert spark.createDataFrame([(bytearray(ids),)], "ids binary").select(F.crc32("ids")).first()[0] == zlib.crc32(ids)
