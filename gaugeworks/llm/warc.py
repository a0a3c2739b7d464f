"""Web archives with a shared dictionary (``.warc.zst``).

An archive begins with a skippable frame that holds a Zstandard dictionary; every record after it is a frame of its own, compressed with that
dictionary. So small records compress well, and each can be read alone from its offset. The dictionary is made once, from whole archived
records of a bounded sample, and is at most ``DICTIONARY`` bytes.

Payloads that occur more than once are stored once: the page with the smallest id is a response, others are revisit records that refer to it.
Which pages share a payload is told by SHA-256, counted per payload before any text moves. Payloads of a thousandth of all pages or more
are known to every task, so their pages stay where they are; only other pages are joined by digest.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import hot_keys
from gaugeworks.llm.plane_files import _store
from gaugeworks.session import cut_lineage

# The skippable frame of a dictionary, the profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY = 64 << 10  # bytes
SAMPLE_PAGES, SAMPLE_BYTES = 400, 32 << 10  # whole pages of at most so many bytes
LEAST_SHARED = 100  # bytes of a payload that revisits may refer to
ARCHIVE_BYTES = 1 << 30
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
READ = 1 << 20

MANIFEST = "path string, records long, bytes long"


def record_id(kind: str, *names: object) -> str:
    """An id that depends on what the record is, so a repeated task gives the same."""
    name = "\x00".join([kind, *map(str, names)])
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode('utf-8', 'surrogatepass')).digest()[:16], version=4)}>"


def clean_uri(url: str | None, page_id: int | None) -> str:
    """The address as a header may hold it: what is not visible ASCII is percent-encoded."""
    return quote(url, safe="".join(map(chr, range(33, 127)))) if url else f"urn:page:{page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        kind, block, own = "response", http + payload, record_id("response", page_id, digest)
    else:
        kind, block, own = "revisit", http, record_id("revisit", page_id, url, digest)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Date: {date}", f"WARC-Target-URI: {clean_uri(url, page_id)}",
            f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id('response', refers_to, digest)}", f"Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; ValueError if it is not whole."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {n.lower(): v for n, _, v in (x.partition(": ") for x in lines[1:])}
    length = int(fields.get("content-length", -1))
    if not lines[0].startswith("WARC/") or length < 0 or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    return fields, rest[:length]


def make_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; where there is too little to train on, the end of the samples themselves serves as one."""
    import zstandard

    pieces = [s[at:at + 4096] for s in samples for at in range(0, len(s), 4096)]
    try:
        return zstandard.train_dictionary(size, pieces, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Writer:
    """Writes one archive: the dictionary, then each record as a frame of its own."""

    def __init__(self, out, dictionary: bytes, level: int = LEVEL):
        import zstandard

        held = zstandard.ZstdCompressor(level=19).compress(dictionary)
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held)
        words = zstandard.ZstdCompressionDict(dictionary)
        words.precompute_compress(level=level)
        self.press = zstandard.ZstdCompressor(level=level, dict_data=words, write_checksum=True)
        self.out, self.size, self.records = out, 8 + len(held), 0

    def add(self, raw: bytes) -> tuple[int, int]:
        """Offset and length of the frame."""
        frame = self.press.compress(raw)
        self.out.write(frame)
        self.size += len(frame)
        self.records += 1
        return self.size - len(frame), len(frame)


def read_dictionary(source) -> bytes:
    """The dictionary at the head of an archive; the source then stands at the first record."""
    import zstandard

    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary at the head of the archive")
    held = source.read(size)
    return zstandard.ZstdDecompressor().decompress(held) if held[:4] == struct.pack("<I", FRAME_MAGIC) else held


def read_records(source) -> Iterator[bytes]:
    """Every record of an archive, one frame each."""
    import zstandard

    expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(read_dictionary(source)))
    left = source.read(READ)
    while left:
        frame, parts = expand.decompressobj(), []
        while True:
            parts.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data or source.read(READ)
                break
            left = source.read(READ)
            if not left:
                raise ValueError("the archive ends within a record")
        yield b"".join(parts)


def shared_payloads(named: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``digest``, ``owner`` (smallest id) and ``pages`` of payloads that more than one page has."""
    large = named.filter(F.col("size") >= least)
    return large.groupBy("digest").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("pages")).filter("pages > 1 and owner is not null")


def with_owner(named: DataFrame, shared: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Add ``refers_to``: the owner's id for all but the owner; pages that need no look-up are not shuffled."""
    hot = hot_keys(shared, "pages")
    refers_to = F.when(F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner")).alias("refers_to")
    small = named.filter(F.col("size") < least).withColumn("refers_to", F.lit(None).cast("long"))
    large = named.filter(F.col("size") >= least)
    kept = [c for c in named.columns]
    if hot is None:
        return small.unionByName(large.join(shared, "digest", "left").select(*kept, refers_to))
    held = large.join(F.broadcast(hot), "digest").select(*kept, refers_to)
    rest = large.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(shared, "digest", "left").select(*kept, refers_to)
    return small.unionByName(held).unionByName(rest)


def sample_records(named: DataFrame, pages: int = SAMPLE_PAGES, most: int = SAMPLE_BYTES) -> list[bytes]:
    """Whole records of about ``pages`` pages (twice as many at most), drawn by hash among pages of at most ``most`` bytes."""
    short = named.filter(F.col("size") <= most)
    share = pages / max(pages, short.count())
    drawn = short.filter(F.pmod(F.xxhash64("page_id", "digest"), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else short
    rows = drawn.select("page_id", "url", "payload", "digest").limit(2 * pages).collect()
    return [record(r.page_id, r.url, bytes(r.payload), r.digest, None) for r in sorted(rows, key=lambda r: (r.digest, r.page_id is None, r.page_id))]


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write a record per page below ``folder`` (a shared store) and return the manifest: ``path``, ``records``, ``bytes`` of each archive.

    A null html is an empty payload. Payloads of under 100 bytes are always responses. Pages of one payload that share the smallest id are all responses; a
    page without an id refers to the smallest one there is, and is a response if there is none. Repeated rows get a record each. An archive is closed when it
    passes ``archive_bytes``; it gets its name only when it is whole. An empty table writes nothing. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    named = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    named = named.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    shared = cut_lineage(shared_payloads(named))
    dictionary = make_dictionary(sample_records(named))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, out, done = TaskContext.get().partitionId(), None, None, []

        def close() -> None:
            out.close()
            store.move(temporary, final)
            done.append((f"{folder.rstrip('/')}/{final.rsplit('/', 1)[1]}", writer.records, writer.size))

        for batch in batches:
            ids, urls, payloads, digests, owners = (batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))
            for k in range(batch.num_rows):
                if writer is None:
                    store, base = _store(folder)
                    store.create_dir(base, recursive=True)
                    final = f"{base.rstrip('/')}/{part:06d}-{len(done):04d}.warc.zst"
                    temporary = f"{final}.{uuid.uuid4().hex}"
                    out = store.open_output_stream(temporary)
                    writer = Writer(out, dictionary)
                writer.add(record(ids[k].as_py(), urls[k].as_py(), payloads[k].as_py(), digests[k].as_py(), owners[k].as_py(), date))
                if writer.size >= archive_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "records", "bytes"), d, strict=True)) for d in done],
                                         schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return cut_lineage(with_owner(named, shared).mapInArrow(write, MANIFEST))


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """``page_id``, ``uri``, ``record_type``, ``payload_digest``, ``payload_bytes``, ``refers_to`` of every record, and its ``payload`` (null for revisits).

    Payloads are hashed again; one that is not what its record says, or an archive that is cut short, fails.
    """
    columns = ["page_id", "uri", "record_type", "payload_digest", "payload_bytes", "refers_to"] + (["payload"] if payload else [])
    types = "page_id long, uri string, record_type string, payload_digest string, payload_bytes long, refers_to long" + (", payload binary" if payload else "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                store, place = _store(path)
                with store.open_input_file(place) as source:
                    found, size = [], 0
                    for raw in read_records(source):
                        found.append(described(raw))
                        size += len(raw) if payload else 200
                        if size > 8_000_000:
                            yield frame(found)
                            found, size = [], 0
                    yield frame(found)

    def frame(found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([f[:len(columns)] for f in found], columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})

    return manifest.select("path").mapInPandas(read, types)


def described(raw: bytes) -> tuple:
    """The record as a row of ``read_archives``."""
    fields, block = parse(raw)
    kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["payload-length"])
    body = None
    if kind == "response":
        body = block.partition(b"\r\n\r\n")[2]
        if len(body) != size or hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} is not what its digest says")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("page-id"), fields["warc-target-uri"], kind, digest, size, number("refers-to-page-id"), body
