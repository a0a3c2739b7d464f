"""Web archives: round trips, revisits, frames that can be read alone."""

import hashlib
import io
import random

import pytest
import zstandard

from gaugeworks.llm import warc
from gaugeworks.session import scratch_path

LONG = "<html>" + "z" * 200 + "é</html>"
PAGES = [(5, "http://a/1", LONG), (3, "http://a/2", LONG), (3, "http://a/3", LONG), (9, None, LONG), (None, "http://a/\r\nX: 1 é", LONG), (1, "u", "short"), (2, "u", "short"),
         (4, "", None), (6, "v", ""), (7, "w", "x" * 99), (8, "w", "x" * 99), (11, "w", "y" * 100), (10, "w", "y" * 100), (None, "n", "n" * 150), (None, "n", "n" * 150), (12, "long", "ab\x00<>\r\n\r\n" * 200_000)]


def expected(pages):
    """Brute force: (id, bytes, digest, type, refers to) of each row."""
    out = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        ids = [p for p, _, h in pages if h == html and p is not None]
        twins = sum(h == html for _, _, h in pages)
        owner = min(ids) if len(body) >= 100 and twins > 1 and ids else None
        revisit = owner is not None and page_id != owner
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", owner if revisit else None))
    return sorted(out, key=str)


def read(manifest):
    rows = warc.read_archives(manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("archive_bytes", [1 << 30, 500])
def test_pages_come_back(spark, archive_bytes):
    rows = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, digest string, size int").repartition(3)
    manifest = warc.write_archives(rows, scratch_path(spark, "warc"), archive_bytes=archive_bytes)
    assert read(manifest) == expected(PAGES)
    assert manifest.agg({"records": "sum"}).first()[0] == len(PAGES)
    got = warc.read_archives(manifest).filter("record_type = 'response'").select("page_id", "payload").collect()
    kept = [(e[0], e[2]) for e in expected(PAGES) if e[3] == "response"]
    assert sorted(((r.page_id, hashlib.sha256(bytes(r.payload)).hexdigest()) for r in got), key=str) == sorted(kept, key=str)


def test_hot_payloads_stay_where_they_are(spark, monkeypatch):
    pages = [(k, f"u{k}", LONG if k % 3 else "h" * 120 + str(k % 50)) for k in range(600)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    monkeypatch.setattr(warc, "hot_keys", lambda keyed, weight: keyed.filter("pages >= 100"))
    assert read(warc.write_archives(rows, scratch_path(spark, "warc"))) == expected(pages)


def test_empty_table(spark):
    rows = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(rows, scratch_path(spark, "warc"))
    assert manifest.count() == 0 and read(manifest) == []


def archive(records, dictionary):
    out = io.BytesIO()
    writer = warc.Writer(out, dictionary)
    places = [writer.add(r) for r in records]
    return out, places


def test_records_are_frames_of_their_own():
    r = random.Random(4)
    bodies = ["".join(r.choice(["<p>", "water", "level", " ", "é"]) for _ in range(r.randint(0, 900))).encode() for _ in range(60)]
    records = [warc.record(k, f"http://a/{k}", b, hashlib.sha256(b).hexdigest(), 7 if k % 9 == 8 else None) for k, b in enumerate(bodies)]
    dictionary = warc.make_dictionary(records)
    out, places = archive(records, dictionary)
    out.seek(0)
    assert warc.read_dictionary(out) == dictionary
    out.seek(0)
    assert list(warc.read_records(out)) == records
    words = zstandard.ZstdCompressionDict(dictionary)
    for raw, (at, size) in zip(records, places, strict=True):
        assert zstandard.ZstdDecompressor(dict_data=words).decompress(out.getvalue()[at:at + size]) == raw
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(x)) for x in records)
    assert sum(size for _, size in places) < plain


def test_headers_cannot_be_broken_and_damage_is_seen():
    raw = warc.record(1, "http://a/\r\nEvil: 1\r\n\r\n", b"body", hashlib.sha256(b"body").hexdigest(), None)
    fields, block = warc.parse(raw)
    assert "evil" not in fields and fields["warc-target-uri"] == "http://a/%0D%0AEvil:%201%0D%0A%0D%0A"
    with pytest.raises(ValueError):
        warc.described(raw.replace(b"body", b"bode"))
    with pytest.raises(ValueError):
        warc.parse(raw[:-1])
    out, _ = archive([raw, raw], b"")
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(out.getvalue()[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"x" * 20)))
    revisit, _ = warc.parse(warc.record(2, None, b"body", "d", 1))
    assert revisit["warc-refers-to"] == warc.record_id("response", 1, "d") and revisit["warc-target-uri"] == "urn:page:2"
