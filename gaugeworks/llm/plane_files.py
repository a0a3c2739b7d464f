"""Token ids in bit-plane files.

Ids are cut into blocks of a fixed size; a block is transposed into one plane per bit (or byte) of its
largest id, and each plane is compressed with zstandard. A file ends with an index of its chunks (blocks)
and of its documents. Files are shards of the ascending order of the document ids.

Layout: ``MAGIC``; planes of all blocks, one after another; the index (zstandard); its length as 8 bytes, little-endian; ``MAGIC``.
The index is, in 64-bit little-endian integers: count of documents, of ids, of blocks, ids a block, bits a plane; per
block its count of planes; per plane its compressed length; per document its id and its count of ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.tokens import batches_by_size, encoder

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
NULL_ID = -(1 << 63)  # stands for a null document id in the index


def to_planes(ids: np.ndarray, width: int) -> list[bytes]:
    """Planes of ``width`` bits (1 or 8), from the lowest; as many as the largest id needs."""
    top = int(ids.max()) if len(ids) else 0
    count = max(1, -(-top.bit_length() // width))
    if width == 8:
        return [((ids >> np.uint32(8 * k)) & np.uint32(255)).astype(np.uint8).tobytes() for k in range(count)]
    narrow = ids.astype(np.uint16) if top < 1 << 16 else ids
    return [np.packbits((narrow & narrow.dtype.type(1 << k)) != 0).tobytes() for k in range(count)]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    kind = np.uint16 if width * len(planes) <= 16 else np.uint32
    ids = np.zeros(n, kind)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        part = raw if width == 8 else np.unpackbits(raw, count=n)
        ids |= part.astype(kind) << kind(width * k)
    return ids.astype(np.uint32)


class Writer:
    """Writes one file; blocks leave memory as they fill."""

    def __init__(self, out, block: int = BLOCK, width: int = 1, level: int = 3):
        import zstandard

        self.out, self.block, self.width = out, block, width
        self.press = zstandard.ZstdCompressor(level=level)
        self.planes: list[int] = []
        self.sizes: list[int] = []
        self.docs: list[tuple[int, int]] = []
        self.pending, self.waiting, self.total = [], 0, 0
        out.write(MAGIC)

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.total += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            whole = np.concatenate(self.pending)
            for at in range(0, len(whole) - self.block + 1, self.block):
                self._flush(whole[at:at + self.block])
            self.pending = [whole[len(whole) // self.block * self.block:]]
            self.waiting = len(self.pending[0])

    def _flush(self, ids: np.ndarray) -> None:
        planes = to_planes(ids, self.width)
        self.planes.append(len(planes))
        for p in planes:
            data = self.press.compress(p)
            self.sizes.append(len(data))
            self.out.write(data)

    def close(self) -> None:
        if self.waiting:
            self._flush(np.concatenate(self.pending))
        head = [len(self.docs), self.total, len(self.planes), self.block, self.width]
        index = np.concatenate([np.array(x, "<i8").ravel() for x in (head, self.planes, self.sizes, self.docs)])
        data = self.press.compress(index.tobytes())
        self.out.write(data + len(data).to_bytes(8, "little") + MAGIC)


@dataclass
class Index:
    block: int
    width: int
    total: int
    planes: np.ndarray
    sizes: np.ndarray
    docs: np.ndarray  # document id, count of ids


def read_index(source, size: int) -> Index:
    import zstandard

    source.seek(size - 16)
    tail = source.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a plane file, or cut short")
    length = int.from_bytes(tail[:8], "little")
    source.seek(size - 16 - length)
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(source.read(length)), "<i8")
    docs, total, blocks, block, width = (int(v) for v in x[:5])
    planes, rest = x[5:5 + blocks], x[5 + blocks:]
    n = int(planes.sum())
    return Index(block, width, total, planes, rest[:n], rest[n:n + 2 * docs].reshape(docs, 2))


def read_blocks(source, index: Index) -> Iterator[np.ndarray]:
    """Ids block by block."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    source.seek(len(MAGIC))
    k = 0
    for b, count in enumerate(index.planes):
        n = min(index.block, index.total - b * index.block)
        planes = []
        for size in index.sizes[k:k + count]:
            planes.append(expand.decompress(source.read(int(size))))
        k += int(count)
        yield from_planes(planes, n, index.width)


def read_documents(source, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Document id, place of its first id in the file, and its ids, in the order of the file."""
    index = read_index(source, size)
    blocks, left, at = read_blocks(source, index), np.zeros(0, np.uint32), 0
    for doc_id, n in index.docs:
        parts, missing = [], int(n)
        while missing > len(left):
            parts.append(left)
            missing -= len(left)
            left = next(blocks)
        parts.append(left[:missing])
        left = left[missing:]
        yield int(doc_id), at, b"".join(p.astype("<u4").tobytes() for p in parts)
        at += int(n)


def _store(uri: str):
    """File system and path of a folder; local, HDFS and object stores alike."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (FileSystem.from_uri(f"file://{uri}")[0], uri)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text", block: int = BLOCK, width: int = 1) -> list[tuple[str, int, int]]:
    """Encode whole texts and write one file per range of ascending ids; (path, documents, ids) of each file in order.

    ``folder`` must be a shared store. A file gets its name only when it is whole, so a repeated task does no harm. Null text counts as empty; a
    null id comes first; equal ids are ordered by a hash of the text; an empty table writes no file. The result has one row per shuffle partition.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]  # a sample of the order goes to the driver, so no text in it
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        end, out, writer = np.array([end_id], np.uint32), None, None
        for batch in batches:
            for part in batches_by_size(batch, "text"):
                if writer is None:
                    store, base = _store(folder)
                    store.create_dir(base, recursive=True)
                    final = f"{base.rstrip('/')}/{shard:06d}.planes"
                    temporary = f"{final}.{uuid.uuid4().hex}"
                    out = store.open_output_stream(temporary)
                    writer = Writer(out, block, width)
                for doc_id, ids in zip(part["key"], encoder(tokenizer).encode(list(part["text"])), strict=True):
                    writer.add(NULL_ID if pd.isna(doc_id) else int(doc_id), np.concatenate([np.frombuffer(ids, "<u4"), end]))
        if writer is not None:
            writer.close()
            out.close()
            store.move(temporary, final)
            yield pd.DataFrame({"shard": [shard], "path": [f"{folder.rstrip('/')}/{shard:06d}.planes"], "docs": [len(writer.docs)], "ids": [writer.total]})

    found = ranged.mapInPandas(write, "shard int, path string, docs long, ids long").collect()
    return [(r.path, r.docs, r.ids) for r in sorted(found)]


def read_files(spark: SparkSession, files: list[tuple[str, int, int]]) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` (binary) of every document of the files."""
    begins = np.concatenate([[0], np.cumsum([f[2] for f in files])]).astype(int)
    rows = [(k, f[0], int(b)) for k, (f, b) in enumerate(zip(files, begins, strict=False))]
    listing = spark.createDataFrame(rows, "shard int, path string, begin long").repartitionByRange(max(1, len(rows)), "shard")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, begin in zip(batch["path"], batch["begin"], strict=True):
                store, place = _store(path)
                with store.open_input_file(place) as source:
                    found, size = [], 0
                    for doc_id, at, ids in read_documents(source, source.size()):
                        found.append((None if doc_id == NULL_ID else doc_id, begin + at, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 16_000_000:
                            yield frame(found)
                            found, size = [], 0
                    yield frame(found)

    def frame(found: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=["doc_id", "start", "n_tokens", "ids"])
        return out.astype({"doc_id": "Int64"})

    return listing.mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")
