"""N-gram Jaccard join: a MinHash forest proposes, exact sets decide.

Documents with equal shingle sets are one node. Every node has a signature per tree; a tree is a prefix trie of them, and two nodes meet where
their prefixes agree. The prefix starts at full depth and is shortened until pairs at the threshold meet in
some tree with the target recall. Nodes that meet are joined into candidate groups through the least node
of each trie node, so rows grow with nodes, not pairs. Groups are verified in blocks: each pair of blocks compares
its sets exactly and returns one row per node, its count of links and its least linked node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.graphs import components
from gaugeworks.session import cut_lineage

MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 128  # nodes; a task compares at most two blocks


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``width`` words (white space parts words); a shorter text is one run."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.uint64)
    one = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = max(1, len(one) - width + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(width, len(one))):
        h = (h ^ (h >> np.uint64(29))) * MIX + one[k:k + n]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(29)))


def depth_for(trees: int, most: int, threshold: float, recall: float) -> int:
    """The longest prefix at which a pair at the threshold meets in one of the trees with the target recall."""
    for depth in range(most, 1, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    return 1


def signature(found: np.ndarray, xors: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Least value of the set under each of the hash functions."""
    low = np.full(len(xors), 0xFFFFFFFF, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        np.minimum(low, ((short[at:at + 512, None] ^ xors) * odds).min(axis=0), out=low)
    return low


def signed(docs: DataFrame, width: int, trees: int, depth: int, key: str, text: str) -> DataFrame:
    """``doc_id``, ``set_key`` (128 bits as text; null without words) and the trie nodes of each document, one per tree."""
    random = np.random.default_rng(20_240_229)
    xors = random.integers(0, 1 << 32, trees * depth, dtype=np.uint32)
    odds = random.integers(0, 1 << 31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, nodes = [], []
            for t in batch["text"]:
                found = shingles(t, width)
                if not len(found):
                    keys.append(None)
                    nodes.append(None)
                    continue
                keys.append(hashlib.md5(found.tobytes()).hexdigest())
                low = signature(found, xors, odds).reshape(trees, depth).astype(np.uint64)
                h = np.arange(1, trees + 1, dtype=np.uint64) * MIX
                for d in range(depth):
                    h = (h ^ (h >> np.uint64(31))) * MIX + low[:, d]
                nodes.append((h ^ (h >> np.uint64(29))).view(np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "set_key": keys, "nodes": pd.Series(nodes, dtype=object)})

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(sign, "doc_id long, set_key string, nodes array<long>")


def compare(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, exactly, from counts of common shingles."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common, step = np.zeros((n, n), np.float32), 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, (at, at + step))
        part = np.zeros((n, step), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None] - common
    linked = common >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    return linked


def local_labels(linked: np.ndarray) -> np.ndarray:
    """Least row of each connected part."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(linked, label[None], n).min(axis=1, initial=n))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified(members: DataFrame, docs: DataFrame, width: int, threshold: float, key: str, text: str) -> DataFrame:
    """``node``, ``links`` (documents of other nodes at the threshold) and ``label`` (a linked node or itself), for each pair of blocks.

    ``members``: node, set_key, copies, component, blocks (of its component).
    """
    pairs = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(members, "node")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, width) for t in batch["text"]]
            own = np.array([hashlib.md5(f.tobytes()).hexdigest() == k for f, k in zip(found, batch["set_key"], strict=True)], bool)
            out = batch.drop(columns=["text", "set_key"]).assign(found=[f.tobytes() for f in found])
            yield out[own]

    rows = rows.mapInPandas(sets, "node long, copies long, component long, blocks int, pack long, found binary")
    rows = rows.withColumn("block", block).withColumn("other", pairs)
    rows = rows.select("node", "copies", "component", "block", "found", "pack", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby("component"):
            part = part.sort_values(["node", "found"])
            sets = [np.frombuffer(f, np.uint64) for f in part["found"]]
            linked = compare(sets, threshold)
            if part["i"].iloc[0] != part["j"].iloc[0]:  # pairs within a block are counted by the block's own task
                linked &= part["block"].to_numpy()[:, None] != part["block"].to_numpy()[None]
            node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
            out.append(pd.DataFrame({"node": node, "links": linked @ copies, "label": node[local_labels(linked)]}))
        return pd.concat(out)

    return rows.groupBy("pack", "i", "j").applyInPandas(verify, "node long, links long, label long")


def join(docs: DataFrame, threshold: float = 0.8, width: int = 5, trees: int = 32, most_depth: int = 8, recall: float = 0.9999, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``copy_of``, ``class_id``, ``copies``, ``n_links``.

    ``copy_of``: least id with the same shingle set; ``class_id``: least id of all that links connect; ``copies``: documents with
    that set; ``n_links``: other documents at or above the threshold, copies included. Documents without words, or without an id,
    are linked to none and are their own class. Repeated rows count as copies; different texts under one id share a class. Other columns are
    ignored. An empty table gives an empty table.
    """
    depth = depth_for(trees, most_depth, threshold, recall)
    rows = cut_lineage(signed(docs, width, trees, depth, key, text))
    usable = rows.filter("doc_id is not null and set_key is not null")
    nodes = cut_lineage(usable.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    first = usable.join(nodes.select("set_key", F.col("node").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    meets = first.select(F.col("doc_id").alias("node"), F.explode("nodes").alias("trie"))
    leads = cut_lineage(meets.groupBy("trie").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    edges = meets.join(leads, "trie").filter("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v")).distinct()
    groups = cut_lineage(components(edges))
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    blocks = cut_lineage(sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    total = groups.count()
    packs = max(1, total // (2 * BLOCK))  # small groups share a task, a large one has tasks of its own
    members = groups.join(blocks, "component").join(nodes, "node").select(
        "node", "set_key", "copies", "component", "blocks",
        F.when(F.col("blocks") > 1, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(packs))).alias("pack"))
    found = cut_lineage(verified(members, docs, width, threshold, key, text))
    classes = components(found.filter("links > 0").select(F.col("node").alias("u"), F.col("label").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = cut_lineage(nodes.join(links, "node", "left").join(classes, "node", "left").select(
        "set_key", "node", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("class_id")))
    out = usable.select("doc_id", "set_key").join(known, "set_key").select(
        "doc_id", F.col("node").alias("copy_of"), "class_id", "copies", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    alone = rows.filter("doc_id is null or set_key is null").select(
        "doc_id", F.col("doc_id").alias("copy_of"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, joined: DataFrame, key: str = "doc_id") -> DataFrame:
    """One document of each class (the one whose id is the class), whole rows; rows without an id stay.

    Of different rows under that id the one with the least hash of its columns (maps aside) stays, so reruns agree.
    """
    first = joined.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("_first")).distinct()
    kept = docs.join(first, docs[key].cast("long") == F.col("_first"), "left_semi")
    hashed = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = kept.groupBy(key).agg(F.min_by(row, hashed).alias("_row")).select("_row.*")
    return one.unionByName(docs.filter(F.col(key).isNull()))
