"""Conversation structure repair on a suffix-shared word graph.

A conversation's signature has one letter per row, its role and its first fault. All distinct signatures of the table are words of one acyclic
graph that is minimised from the end: a node stands for one ending, whichever signatures share it. Cost-to-go and the next letter of the
best audit are computed once per node and state of the grammar; an audit is read off by following those letters.

The graph is never held whole. Signatures come in the order of their reversed letters, so the nodes that a signature shares with any
earlier one are those it shares with the one before, and a stack of the present word's nodes is enough. Ranges of that order are
tasks; only the nodes on the way to a range's first word are made twice.

Rows of a conversation pass one task as a stream in the order of turns, since its digest is one hash over all its rows;
a task holds a letter per row, not the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import join_hot
from gaugeworks.session import cut_lineage

# White space, sentence ends, costs.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LARGEST = (1 << 63) - 1

FAULTS = ["none", "blank", "duplicate", "truncated"]
INITIALS = "sua"  # any other initial is the fourth class
START, AFTER_S, AFTER_U, AFTER_A = range(4)  # states of (s?(ua)+)?
TAKES = [{START: AFTER_S}, {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, {AFTER_U: AFTER_A}, {}]  # by role class
WANTED = [AFTER_U, AFTER_U, AFTER_A, AFTER_U]  # where the one role to insert or change to leads
ROLE_TO = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
RANGE_LETTERS = 1024  # letters of a signature that tell ranges apart

Costs = tuple[int, int, int, int]


def letter_of(role_class: int, fault: int) -> str:
    return chr(ord("A") + 4 * fault + role_class)


def parts_of(letter: str) -> tuple[int, int]:
    """Role class and fault."""
    fault, role_class = divmod(ord(letter) - ord("A"), 4)
    return role_class, fault


def _settled(base: list[dict[str, int]]) -> tuple[Costs, str]:
    """Costs and first letters per state, when roles may be inserted before all else; ties go to the least letter."""
    cost = [min(o.values()) if o else LARGEST for o in base]
    for _ in range(3):
        cost = [min(c, INSERT + cost[WANTED[s]]) for s, c in enumerate(cost)]
    letters = []
    for s, options in enumerate(base):
        if INSERT + cost[WANTED[s]] == cost[s]:
            options = options | {"I": cost[s]}
        letters.append(min((a for a, c in options.items() if c == cost[s]), default=""))
    return tuple(cost), "".join(letters)


#: At the end the grammar may stop before all (an empty conversation) or after an assistant; "." stands for stopping.
END: tuple[Costs, str] = _settled([{".": 0}, {}, {}, {".": 0}])


def step(letter: str, after: Costs) -> tuple[Costs, str]:
    """Cost-to-go and best first edit, per state, of a node whose edge ``letter`` leads to a node of the costs ``after``."""
    role_class, fault = parts_of(letter)
    base: list[dict[str, int]] = [{"D": DELETE + after[s]} for s in range(4)]
    if FAULTS[fault] not in ("blank", "duplicate"):
        extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
        for s in range(4):
            base[s]["R"] = REROLE + extra + after[WANTED[s]]
            if s in TAKES[role_class]:
                base[s]["K"] = extra + after[TAKES[role_class][s]]
    return _settled(base)


class Graph:
    """The nodes of the present word, from the end; words must come in the order of their reversed letters."""

    def __init__(self):
        self.word = ""  # reversed
        self.costs: list[Costs] = [END[0]]
        self.edits: list[str] = [END[1]]
        self.counts: list[tuple[int, int, int, int]] = [(0, 0, 0, 0)]  # blank, duplicate, truncated, illegal
        self.made = 0
        self._known: dict[tuple[str, Costs], tuple[Costs, str]] = {}

    def _step(self, letter: str, after: Costs) -> tuple[Costs, str]:
        """Nodes that differ by a constant cost have the same edits, so few of them are ever computed."""
        least = min(after)
        key = (letter, tuple(c - least for c in after))
        if key not in self._known:
            self._known[key] = step(*key)
        costs, edits = self._known[key]
        return tuple(c + least for c in costs), edits

    def add(self, signature: str) -> tuple[tuple[int, int, int, int], int, str]:
        """Counts, cost and audit of a signature."""
        word = signature[::-1]
        shared = _common(self.word, word)
        del self.costs[shared + 1:], self.edits[shared + 1:], self.counts[shared + 1:]
        for k in range(shared, len(word)):
            costs, edits = self._step(word[k], self.costs[k])
            self.costs.append(costs)
            self.edits.append(edits)
            role_class, fault = parts_of(word[k])
            b, d, t, i = self.counts[k]
            follows = bool(k) and (role_class, parts_of(word[k - 1])[0]) not in LEGAL
            self.counts.append((b + (fault == 1), d + (fault == 2), t + (fault == 3), i + follows))
            self.made += 1
        self.word = word
        return self.counts[-1], self.costs[-1][START], self._audit()

    def _audit(self) -> str:
        k, state, out = len(self.word), START, []
        while (edit := self.edits[k][state]) != ".":
            out.append(edit)
            if edit == "K":
                state = TAKES[parts_of(self.word[k - 1])[0]][state]
            elif edit != "D":
                state = WANTED[state]
            if edit != "I":
                k -= 1
        return "".join(out)


def _common(a: str, b: str) -> int:
    """Letters that both begin with, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def audits(signatures: DataFrame) -> DataFrame:
    """``signature`` (distinct), ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``."""
    n = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ending = F.reverse("signature")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = Graph()
        for batch in batches:
            rows = []
            for s in batch["signature"]:
                counts, cost, audit = graph.add(s)
                rows.append((s, *counts, cost, audit))
            yield pd.DataFrame(rows, columns=["signature", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    ranged = signatures.select("signature").repartitionByRange(n, F.substring(ending, 1, RANGE_LETTERS)).sortWithinPartitions(ending)
    return ranged.mapInPandas(read, "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _rows(rows: DataFrame, key: str) -> DataFrame:
    """``key`` (text; Arrow would turn whole numbers beside nulls into doubles), ``turn``, ``role``, ``text``, ``digest``; null role or text: one space."""
    plain = rows.select(F.col(key).cast("string").alias("key"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    return plain.withColumn("digest", F.md5(F.col("text").cast("binary")))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def signatures(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` (as text), ``signature`` and ``gaps`` of each conversation that has rows."""
    plain = _rows(rows, key)
    core = F.trim(F.col("text"), F.lit(SPACE))
    plain = plain.select("key", "turn", "role", "digest", (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(*ENDS)).alias("open"))
    dealt = plain.repartition("key")
    seen = F.row_number().over(Window.partitionBy("key", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("blank"), 1).when(seen > 1, 2).when(F.col("open"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    role_class = F.coalesce(*[F.when(initial == c, k) for k, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    lettered = dealt.withColumn("letter", (ord("A") + 4 * fault + role_class).cast("byte"))
    lettered = lettered.sortWithinPartitions("key", *_order())
    lettered = lettered.select("key", "letter", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("dated"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, letters, turns = None, None, None  # of the conversation that is open; turns: least, largest, count

        def closed() -> tuple:
            gaps = min(turns[1] - turns[0] + 1 - turns[2], LARGEST) if turns else 0
            return key, b"".join(letters).decode(), gaps

        for batch in batches:
            done = []
            keys, code = batch["key"].to_numpy(object), batch["letter"].to_numpy(np.uint8)
            turn, dated = batch["turn"].to_numpy(), batch["dated"].to_numpy(bool)
            cuts = (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if letters is None or keys[a] != key:
                    if letters is not None:
                        done.append(closed())
                    key, letters, turns = keys[a], [], None
                letters.append(code[a:b].tobytes())
                own = turn[a:b][dated[a:b]]
                if len(own):
                    fresh = int(np.count_nonzero(own[1:] != own[:-1])) + (turns is None or int(own[0]) != turns[1])
                    turns = (turns[0] if turns else int(own[0]), int(own[-1]), (turns[2] if turns else 0) + fresh)
            yield pd.DataFrame(done, columns=["key", "signature", "gaps"])
        if letters is not None:
            yield pd.DataFrame([closed()], columns=["key", "signature", "gaps"])

    return lettered.mapInPandas(sign, "key string, signature string, gaps long")


def _edited(rows: DataFrame, found: DataFrame, key: str, make: Callable, schema: str) -> DataFrame:
    """Stream the rows of every conversation behind its audit; ``make(key)`` gives the object that takes the repaired rows."""
    plain = _rows(rows, key).withColumn("audit", F.lit(None).cast("string"))
    heads = found.select("key", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("digest"), "audit")
    both = plain.unionByName(heads).repartition("key").sortWithinPartitions("key", F.col("audit").asc_nulls_last(), *_order())
    both = both.select("key", "audit", "role", "text")

    def edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taker, audit, at, state = None, "", 0, START
        for batch in batches:
            done: list[tuple] = []
            for key, head, role, text in zip(batch["key"], batch["audit"], batch["role"], batch["text"], strict=True):
                if head is not None:
                    if taker is not None:
                        _inserts(taker, audit[at:], state)
                        done += taker.close()
                    taker, audit, at, state = make(key), head, 0, START
                    continue
                stop = at
                while audit[stop] == "I":
                    stop += 1
                state = _inserts(taker, audit[at:stop], state)
                letter, at = audit[stop], stop + 1
                if letter == "R":
                    state = WANTED[state]
                    taker.take(letter, ROLE_TO[state], text)
                elif letter == "K":
                    state = TAKES[INITIALS.index(role[0])][state]
                    taker.take(letter, role, text)
                done += taker.ready()
            yield pd.DataFrame(done, columns=columns)
        if taker is not None:
            _inserts(taker, audit[at:], state)
            yield pd.DataFrame(taker.close(), columns=columns)

    columns = [c.split()[0] for c in schema.split(", ")]
    return both.mapInPandas(edit, schema)


def _inserts(taker, letters: str, state: int) -> int:
    for _ in letters:
        state = WANTED[state]
        taker.take("I", ROLE_TO[state], "")
    return state


class _Digest:
    """SHA-256 of the lines ``role:text``, joined by line feeds."""

    def __init__(self, key: str | None):
        self.key, self.hash, self.begun = key, hashlib.sha256(), False

    def take(self, edit: str, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.begun = True

    def ready(self) -> list[tuple]:
        return []

    def close(self) -> list[tuple]:
        return [(self.key, self.hash.hexdigest())]


class _Lines:
    """The repaired rows themselves."""

    def __init__(self, key: str | None):
        self.key, self.place, self.rows = key, 0, []

    def take(self, edit: str, role: str, text: str) -> None:
        self.rows.append((self.key, self.place, edit, role, text))
        self.place += 1

    def ready(self) -> list[tuple]:
        out, self.rows = self.rows, []
        return out

    close = ready


def analyse(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation: ``key`` (as text), ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``.

    Rows are taken by turn (nulls first), equal turns by role and then by the MD5 of the text. A null id is a conversation of its own, a null role or text
    counts as one space; repeated rows are rows. Only the columns of the key, ``turn``, ``role`` and ``text`` are read.
    An empty table gives an empty table.
    """
    found = cut_lineage(signatures(rows, key))
    counts = found.groupBy("signature").agg(F.count(F.lit(1)).alias("conversations"))
    known = cut_lineage(audits(counts).join(counts, "signature"))
    return join_hot(found, known, "signature", "conversations").drop("signature", "conversations")


def repaired_rows(rows: DataFrame, found: DataFrame, key: str = "conv_id") -> DataFrame:
    """The rows that the audits of ``analyse`` leave: ``key``, ``place``, ``edit`` (K, R or I), ``role``, ``text``."""
    return _edited(rows, found, key, _Lines, "key string, place long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` and ``repaired_sha256`` of every conversation of ``analyse``."""
    return _edited(rows, found, key, _Digest, "key string, repaired_sha256 string")


def damage(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows damaged by crc32 of ``key:turn`` modulo 20 (nulls: one space): 0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats
    it, 4 makes its role user. Columns: the key, ``turn``, ``role``, ``text``."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(key, "turn", plain("role").alias("role"), plain("text").alias("text"), F.concat(plain(key), F.lit(":"), plain("turn")).alias("_name"))
    drawn = named.withColumn("_d", F.crc32(F.col("_name").cast("binary")) % 20).filter("_d <> 0")
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_d") == 3, 2).otherwise(1)))
    return drawn.select(key, "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")
