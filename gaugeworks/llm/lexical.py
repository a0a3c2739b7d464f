"""Ranked lexical search by bag deduplication.

A document's bag holds its counts of the terms that the items use. Documents with the same bag and the same length measure ``m`` score alike
for every item, so they form one class: classes are found by a hash, the hash is verified, and each class is scored once
against all items. The best classes of an item are then expanded into their documents by ascending id. At most ``most``
documents of a class are ever wanted, so a class of any size sends that many rows per task.

Items are searched in parts of bounded size (``MAX_ITEMS``, ``MAX_PAIRS``); what a part sends to all tasks has that bound, whatever the documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import running
from gaugeworks.session import cut_lineage

#: What parts terms is all of ASCII but digits and letters. In UTF-8 all bytes of other characters are 0x80 and above.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
WEIGHT_SCALE, TF_SCALE = 1000, 1_000_000_000

MAX_ITEMS = 4096  # items searched at once
MAX_PAIRS = 1_000_000  # their (item, term) pairs
CELLS = 500_000  # scores a task holds at once

CLASS = ["h", "g", "m"]


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text in UTF-8; only A-Z change case, as ``bytes.lower`` does."""
    return TERM.findall(text.encode("utf-8", "replace").lower()) if text else []


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct ``item_id`` and ``term``; rows under one id are one item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"].astype("Int64").repeat([len(f) for f in found]).to_numpy(), "term": [t for f in found for t in f]}).astype({"item_id": "Int64"})

    rows = items.select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, "item_id long, term binary").distinct()


def item_parts(items: DataFrame, key: str, text: str, max_items: int, max_pairs: int) -> list[DataFrame]:
    """(item_id, list of terms) in parts of at most ``max_items`` items and ``max_pairs`` pairs and those of its last item."""
    lists = cut_lineage(item_terms(items, key, text).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")))
    sizes = lists.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    if not sizes[0]:
        return []
    if sizes[0] <= max_items and sizes[1] <= max_pairs:
        return [lists]
    placed = running(lists, ["item_id"], {"items_before": F.lit(1), "pairs_before": F.size("terms")})
    part = F.struct(F.floor(F.col("items_before") / max_items).alias("a"), F.floor(F.col("pairs_before") / max_pairs).alias("b"))
    placed = cut_lineage(placed.withColumn("part", part))
    return [placed.filter((F.col("part.a") == a) & (F.col("part.b") == b)) for (a, b), in sorted(map(tuple, placed.select("part").distinct().collect()))]


def bags(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """``doc_id``, ``n`` (terms of the whole text) and ``bag``: numbers of the vocabulary's terms in it, ascending, then their counts,
    all as little-endian unsigned 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most MAX_PAIRS terms

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            sizes, found = [], []
            for t in batch["text"]:
                words = terms(t)
                sizes.append(len(words))
                own = sorted((known[w], c) for w, c in Counter(words).items() if w in known)
                found.append(np.array(own, "<u4").reshape(-1, 2).T.tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n": np.array(sizes, np.int64), "bag": found})

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(count, "doc_id long, n long, bag binary")


def measure(n: Column, documents: int, all_terms: int) -> Column:
    """100 - 50 + (50 n N) div L; the product in decimals, as it may pass 64 bits."""
    whole = F.lit(50).cast("decimal(38,0)") * n.cast("decimal(19,0)") * F.lit(documents).cast("decimal(16,0)")
    return (F.lit(50) + F.floor((whole - F.pmod(whole, F.lit(all_terms).cast("decimal(19,0)"))) / F.lit(all_terms).cast("decimal(19,0)"))).cast("long")


def classes(held: DataFrame, seeds: int = 4) -> tuple[DataFrame, DataFrame]:
    """The rows with their class key (two hashes of the bag, and m), and the classes: key, bag, count and least id.

    Grouping compares whole bags; the key is verified to tell all classes apart, otherwise it is made anew with another seed.
    """
    for seed in range(seeds):
        keyed = held.withColumns({"h": F.xxhash64(F.lit(2 * seed), "bag"), "g": F.xxhash64(F.lit(2 * seed + 1), "bag")})
        found = cut_lineage(keyed.filter(F.length("bag") > 0).groupBy(*CLASS, "bag").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first")))
        if found.count() == found.select(*CLASS).distinct().count():
            return keyed.drop("bag"), found
    raise RuntimeError("no seed tells all bags apart")


def postings(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of all bags of a batch, ordered by term."""
    raw = [np.frombuffer(b, "<u4").reshape(2, -1) for b in batch["bag"]]
    row = np.repeat(np.arange(len(raw)), [r.shape[1] for r in raw])
    both = np.concatenate(raw, axis=1).astype(np.int64)
    order = np.argsort(both[0], kind="stable")
    return row[order], both[0][order], both[1][order]


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            row, term, _ = postings(batch)
            np.add.at(total, term, batch["members"].to_numpy()[row])
        held = np.flatnonzero(total)
        yield pd.DataFrame({"term": held.astype(np.int32), "df": total[held]})

    out = np.zeros(size, np.int64)
    for r in found.select("bag", "members").mapInPandas(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df  # one row per term of the vocabulary
    return out


def best_classes(found: DataFrame, members: list[np.ndarray], weights: np.ndarray, most: int) -> DataFrame:
    """``item`` (its number), class key, ``first`` and ``score`` of the best classes of each item, those of equal score by least id.

    ``members``: per term the numbers of the items that use it. A task keeps at most ``most`` classes per item.
    """
    items = 1 + max((int(m.max()) for m in members if len(m)), default=0)
    shared = found.sparkSession.sparkContext.broadcast((members, weights))  # bounded by MAX_PAIRS
    step = max(1, CELLS // items)

    def best(top: pd.DataFrame) -> pd.DataFrame:
        top = top.sort_values(["item", "score", "first"], ascending=[True, False, True], na_position="last", kind="stable")
        return top[top.groupby("item").cumcount() < most]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        users, weight = shared.value
        floor, top, waiting, waits = np.zeros(items, np.int64), [], [], 0
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.iloc[at:at + step]
                row, term, tf = postings(batch)
                m = batch["m"].to_numpy()[row]
                part = TF_SCALE * tf // (1000 * tf + 20 * m) * weight[term]
                scores = np.zeros((items, len(batch)), np.int64)
                cuts = np.flatnonzero(np.diff(term)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(term)], strict=True):
                    if a < b:
                        scores[users[term[a]][:, None], row[a:b]] += part[a:b]
                hit = scores > 0
                hit &= scores >= floor[:, None]
                if len(batch) > most:
                    hit &= scores >= np.partition(scores, len(batch) - most, axis=1)[:, len(batch) - most, None]
                item, place = np.nonzero(hit)
                if not len(item):
                    continue
                own = batch[[*CLASS, "first"]].iloc[place].reset_index(drop=True)
                waiting.append(own.assign(item=item.astype(np.int32), score=scores[item, place]))
                waits += len(item)
                if waits > 8 * most * items:
                    top = best(pd.concat([*top, *waiting]) if len(top) else pd.concat(waiting))
                    full = top.groupby("item")["score"].agg(["size", "min"])
                    full = full[full["size"] >= most]
                    floor[full.index] = full["min"]
                    top, waiting, waits = [top], [], 0
        if len(top) or waiting:
            yield best(pd.concat([*top, *waiting]))[["item", *CLASS, "first", "score"]]

    rows = found.select(*CLASS, "bag", F.col("first")).mapInPandas(score, "item int, h long, g long, m long, first long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("first").asc_nulls_last())
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def search_part(docs: DataFrame, part: DataFrame, most: int, key: str, text: str) -> DataFrame:
    found_items = sorted(part.select("item_id", "terms").collect(), key=lambda r: (r[0] is None, r[0]))  # bounded by MAX_ITEMS and MAX_PAIRS
    vocabulary = {t: k for k, t in enumerate(sorted({bytes(t) for r in found_items for t in r[1]}))}
    users: list[list[int]] = [[] for _ in vocabulary]
    for k, r in enumerate(found_items):
        for t in r[1]:
            users[vocabulary[bytes(t)]].append(k)
    held = cut_lineage(bags(docs, vocabulary, key, text))
    documents, all_terms = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    spark = docs.sparkSession
    if not documents:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    keyed, found = classes(held.withColumn("m", measure(F.col("n"), documents, all_terms)))
    counts = document_counts(found, len(vocabulary))
    weights = np.floor(WEIGHT_SCALE * np.log((2 * documents + 2) / (2 * counts + 1))).astype(np.int64)
    top = cut_lineage(best_classes(found, [np.array(u, np.int64) for u in users], weights, most))
    wanted = top.select(*CLASS).distinct()  # at most MAX_ITEMS * most keys
    members = keyed.join(F.broadcast(wanted), CLASS, "left_semi").select(*CLASS, "doc_id")
    order = Window.partitionBy(*CLASS).orderBy(F.col("doc_id").asc_nulls_last())
    members = members.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).drop("nth")
    names = spark.createDataFrame([(k, r[0]) for k, r in enumerate(found_items)], "item int, item_id long")
    ranked = top.join(members, CLASS).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())))
    return ranked.filter(F.col("rank") <= most).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, most: int = 50, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
           max_items: int = MAX_ITEMS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``most`` documents of highest score above 0 of each item.

    Equal scores are ranked by ascending id. Null and empty texts have no terms: such documents are found by no item and do not count as documents, such
    items find nothing. Repeated rows of documents are documents of their own and take a rank each; a null id comes after all
    others. Rows of items under one id are one item. An empty table on either side gives an empty table; other columns are ignored.
    """
    out = None
    for part in item_parts(items, item_key, item_text, max_items, max_pairs):
        one = search_part(docs, part, most, key, text)
        out = one if out is None else out.unionByName(one)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
