"""Conversation repair against an exhaustive search over edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from gaugeworks.llm import conversations as cv
from gaugeworks.llm.queries import op11_conversations

GRAMMAR = re.compile("(s?(ua)+)?")
SEEN = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """First fault of each row, rows in order."""
    out, seen = [], set()
    for role, text in rows:
        letters = SEEN.findall(text)
        out.append("blank" if not letters else "duplicate" if (role, text) in seen else "none" if letters[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def search(rows, fault, limit):
    """All (audit, repaired rows) of cost at most ``limit`` that end in the grammar, by trying every edit."""
    found = []

    def go(k, left, audit, made):
        if k == len(rows) and GRAMMAR.fullmatch("".join(r[0][:1] if r[0] else "-" for r in made)):
            found.append((audit, made))
        if left >= 3:
            for role in ("user", "assistant"):
                go(k, left - 3, audit + "I", [*made, (role, "")])
        if k == len(rows):
            return
        role, text = rows[k]
        if left >= 4:
            go(k + 1, left - 4, audit + "D", made)
        if fault[k] in ("blank", "duplicate"):
            return
        extra = 3 if fault[k] == "truncated" else 0
        if left >= extra:
            go(k + 1, left - extra, audit + "K", [*made, (role, text)])
        if left >= extra + 3:
            for to in ("user", "assistant"):
                go(k + 1, left - extra - 3, audit + "R", [*made, (to, text)])

    go(0, limit, "", [])
    return found


def brute_force(rows):
    fault = faults(rows)
    for limit in itertools.count():
        if found := search(rows, fault, limit):
            audit, made = min(found, key=lambda f: f[0])
            pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(rows)]
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
            return (*(fault.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), limit, audit, digest)


def expected(table):
    """Per id: gaps and what brute force finds, of rows (id, turn, role, text); nulls count as one space."""
    groups = defaultdict(list)
    for key, turn, role, text in table:
        groups[key].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for key, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = {r[0] for r in rows} - {None}
        out[key] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *brute_force([r[1:] for r in rows]))
    return out


def made(seed, n, longest):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "supervisor"]
    texts = ["Hi.", "Hi.", "ok", "What?", "", " \t", "no\u00a0", "end. \n", None, "\u3000", "x!"]
    rows = []
    for key in range(n):
        turn = r.randint(-2, 3)
        for _ in range(r.randint(1, longest)):
            rows.append((key if key else None, None if r.random() < 0.1 else turn, r.choice(roles), r.choice(texts)))
            turn += r.choice([0, 1, 1, 1, 2])
    return rows


def repaired(spark, table, schema="conv_id long, turn long, role string, text string"):
    rows = spark.createDataFrame(table, schema)
    found = cv.analyse(rows)
    both = found.join(cv.repaired_digests(rows, found).withColumnRenamed("key", "k"), found["key"].eqNullSafe(cv.F.col("k")))
    return {None if r.key is None else int(r.key): (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in both.collect()}


def test_equals_exhaustive_search(spark):
    table = made(1, 120, 4)
    random.Random(2).shuffle(table)
    assert repaired(spark, table) == expected(table)


def test_graph_makes_each_ending_once():
    r = random.Random(3)
    words = {"".join(r.choice("ABCEIMNO") for _ in range(r.randint(0, 7))) for _ in range(400)}
    graph = cv.Graph()
    got = {w: graph.add(w) for w in sorted(words, key=lambda w: w[::-1])}
    assert graph.made == len({w[k:] for w in words for k in range(len(w))})
    assert got == {w: cv.Graph().add(w) for w in words}
    assert len(graph._known) < graph.made


def test_long_conversations_and_clashing_columns(spark):
    table = [(7, k, "user" if k % 2 else "assistant", f"line {k}.") for k in range(25_001)] + [(8, k, "user", "x" * 300_000) for k in range(3)]
    found = repaired(spark, [(*t, "audit", 5) for t in table], "conv_id long, turn long, role string, text string, key string, cost int")
    assert found[7][:5] == (0, 0, 0, 0, 0) and found[7][5] == 3
    assert len(found[7][6]) == 25_002 and found[7][6].startswith("IK") and set(found[7][6][1:]) == {"K"}
    assert found[8][1:6] == (0, 2, 1, 2, 12)
    rows = spark.createDataFrame([t for t in table if t[0] == 8], "conv_id long, turn long, role string, text string")
    lines = cv.repaired_rows(rows, cv.analyse(rows)).collect()
    assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in sorted(lines, key=lambda x: x.place)).encode()).hexdigest() == found[8][7]
    assert cv.analyse(rows.limit(0)).count() == 0


def damaged(table):
    out = []
    for key, turn, role, text in table:
        name = f"{' ' if key is None else key}:{' ' if turn is None else turn}"
        role, text, d = " " if role is None else role, " " if text is None else text, zlib.crc32(name.encode()) % 20
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            out += [(key, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


@pytest.mark.parametrize("table", [made(5, 150, 4), []])
def test_query(spark, tmp_path, table):
    spark.createDataFrame(table, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    none = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    want = {key: none for key, *_ in table} | expected(damaged(table))
    got = {r[0]: tuple(r[1:]) for r in op11_conversations(spark, str(tmp_path)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == want
