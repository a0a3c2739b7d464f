"""One query per operator of the training-data pipeline, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import conversations, fingerprint, jaccard, langid, lexical, mixing, neighbours, packing, plane_files, quality, secret_scan, toxicity, warc
from gaugeworks.session import cut_lineage, scratch_path
from gaugeworks.llm.common import bounded_batches, bounded_sample, is_held_out, may_learn, table


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int) -> DataFrame:
    """Rows a model may learn from: ``doc_id``, ``text``, ``label``."""
    ids = labels.select("doc_id", F.col(label).alias("label")).filter(F.col("label").isNotNull() & may_learn(F.col("doc_id"), modulus, rest))
    return docs.select("doc_id", "text").filter(may_learn(F.col("doc_id"), modulus, rest)).join(ids, "doc_id")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int, max_rows: int, seed: str) -> DataFrame:
    """As ``labelled``, of about ``max_rows`` labels drawn by hash (twice as many at most), so no text but theirs moves."""
    ids = labels.select("doc_id", F.col(label).alias("label")).filter(F.col("label").isin(0, 1) & may_learn(F.col("doc_id"), modulus, rest))
    drawn = bounded_sample(ids, "label", "doc_id", max_rows, seed).limit(2 * max_rows)
    return cut_lineage(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(labelled(docs, table(spark, sf_dir, "labels"), "quality", 5, 0))
    return quality.score(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = neighbours.build(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return neighbours.search(index, vectors.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id")))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def tokenizer_path() -> str:
    """The tokenizer file that the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, tokenizer_path(), 2048, 0)
    slim = cut_lineage(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return packing.pack(slim, 2048, ["doc_id", "piece", "ids_crc32"])


def op5_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = plane_files.write_files(table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "planes"), tokenizer_path(), 1)
    return plane_files.read_files(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", 3, 1, toxicity.MAX_ROWS, "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", toxicity.predicted(F.col("score"), 0.7).alias("predicted"),
        F.size("toxic_spans").alias("n_spans"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = secret_scan.span_text(F.filter("spans", lambda s: s["kind"] != "entropy"))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(may_learn(F.col("doc_id"), 5, 0)))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", is_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumns({c: F.round(c, 9) for c in ("near_edited", "near_next")})


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    broken = conversations.damage(rows)
    found = cut_lineage(conversations.analyse(broken))
    texts = conversations.repaired_digests(broken, found).withColumnRenamed("key", "_key")
    ids = rows.select("conv_id").distinct()
    named = ids.join(found, F.col("conv_id").cast("string").eqNullSafe(F.col("key")), "left").join(texts, F.col("conv_id").cast("string").eqNullSafe(F.col("_key")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return named.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch_path(spark, "warc"))
    return warc.read_archives(manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical.search(docs.select("doc_id", "text"), items.select("item_id", "text"), 50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_neighbours, op3_jaccard, op4_packing, op5_planes, op6_toxicity, op7_secrets, op8_language, op9_mixing, op10_fingerprint,
                                    op11_conversations, op12_warc, op13_lexical)
}

ORACLE: dict[str, str] = {
    "op10_fingerprint": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST, encode(coalesce(text, ''))) AS place FROM documents
        ), edits AS (
            SELECT a.doc_id, a.place, a.text, CAST(length(a.text) AS BIGINT) AS n_chars,
                   a.text[1:length(a.text) - length(a.text) // 4] || b.text[1:length(a.text) // 4] AS edited
            FROM docs a JOIN docs b ON b.place = CASE WHEN a.place = (SELECT max(place) FROM docs) THEN 1 ELSE a.place + 1 END
        ), versions AS (
            SELECT place, FALSE AS changed, text AS t FROM edits UNION ALL SELECT place, TRUE, edited FROM edits
        ), paragraphs AS (
            SELECT place, changed, unnest(string_split(t, chr(10))) AS p FROM versions
        ), digests AS (
            SELECT place, changed, sha256(p) AS d, string_split(p, ' ') AS w FROM paragraphs
        ), equal AS (
            SELECT place, changed,
                   [sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) % 1152921504606846976, sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) % 1152921504606846976,
                    sum(CAST('0x' || substr(d, 31, 15) AS BIGINT)) % 1152921504606846976, sum(CAST('0x' || substr(d, 46, 15) AS BIGINT)) % 1152921504606846976] AS e
            FROM digests GROUP BY place, changed
        ), pairs AS (
            SELECT place, changed, unnest(list_transform(range(1, len(w) + 1), lambda i: CAST('0x' || substr(md5(w[i] || ' ' || coalesce(w[i + 1], '')), 1, 15) AS BIGINT))) AS h FROM digests
        ), counted AS (
            SELECT place, changed, CAST(count(*) AS BIGINT) AS n, [""" + ", ".join(f"CAST(sum((h >> {i}) & 1099512676353) AS BIGINT)" for i in range(20)) + r"""] AS s
            FROM pairs GROUP BY place, changed
        ), prints AS (
            SELECT place, changed, n, array_to_string(list_transform(e || s, lambda x: lpad(printf('%x', CAST(x AS BIGINT)), 15, '0')), '') || lpad(printf('%x', n), 8, '0') AS f,
                   list_transform(range(0, 60), lambda j: CAST(2 * ((s[j % 20 + 1] >> CAST(20 * (j // 20) AS BIGINT)) & 1048575) - n AS DOUBLE)) AS v
            FROM counted JOIN equal USING (place, changed)
        ), vectors AS (
            SELECT *, list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b) AS l FROM prints
        ), compared AS (
            SELECT a.place, a.f AS fa, e.f AS fe, n.f AS fn, a.l * e.l AS le, a.l * n.l AS ln,
                   list_reduce(list_transform(range(1, 61), lambda j: a.v[j] * e.v[j]), lambda x, y: x + y) AS de,
                   list_reduce(list_transform(range(1, 61), lambda j: a.v[j] * n.v[j]), lambda x, y: x + y) AS dn
            FROM vectors a JOIN vectors e ON NOT a.changed AND e.changed AND e.place = a.place
            JOIN vectors n ON NOT n.changed AND n.place = CASE WHEN a.place = (SELECT max(place) FROM docs) THEN 1 ELSE a.place + 1 END
        )
        SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fa AS fingerprint, fe AS edited_fingerprint,
               round(CASE WHEN fa = fe THEN 1.0 WHEN le > 0 THEN greatest(0.0, least(1.0, de / sqrt(le))) ELSE 0.0 END, 9) + 0.0 AS near_edited,
               round(CASE WHEN fa = fn THEN 1.0 WHEN ln > 0 THEN greatest(0.0, least(1.0, dn / sqrt(ln))) ELSE 0.0 END, 9) + 0.0 AS near_next
        FROM compared JOIN edits USING (place)
    """,
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM sized GROUP BY source
        ), weighed AS (
            SELECT *, CAST([3, 1, 2][(place - 1) % 3 + 1] AS BIGINT) AS w FROM sources
        ), filled AS (
            SELECT *, sum(s) OVER () AS all_s, sum(w) OVER () AS all_w,
                   coalesce(sum(s) OVER o, 0) AS s_before, coalesce(sum(w) OVER o, 0) AS w_before
            FROM weighed WINDOW o AS (ORDER BY CAST(s AS DOUBLE) / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), limits AS (
            SELECT *, w * (1.5::DOUBLE * CAST(all_s AS DOUBLE) - 2 * CAST(s_before AS DOUBLE)) >= 2 * CAST(s AS DOUBLE) * CAST(all_w - w_before AS DOUBLE) AS reached FROM filled
        ), rest AS (
            SELECT CAST(coalesce(sum(CASE WHEN reached THEN s END), 0) AS DOUBLE) AS full_s, CAST(coalesce(sum(CASE WHEN NOT reached THEN w END), 0) AS DOUBLE) AS open_w FROM limits
        ), targets AS (
            SELECT source, s, CASE WHEN reached THEN 2 * CAST(s AS DOUBLE) ELSE w * (1.5::DOUBLE * CAST(all_s AS DOUBLE) - 2 * full_s) / open_w END AS target FROM limits, rest
        ), rated AS (
            SELECT d.doc_id, d.size, t.s, t.target, CASE WHEN t.s > 0 THEN t.target / CAST(t.s AS DOUBLE) ELSE 0 END AS rate,
                   CAST(('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
            FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, s AS source_size, target, size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM rated
    """,
    "op13_lexical": r"""
        WITH doc_terms AS (
            SELECT place, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS place, doc_id, text FROM documents)
        ), counts AS (
            SELECT place, doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM doc_terms GROUP BY ALL
        ), sizes AS (
            SELECT place, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY place
        ), whole AS (
            SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sizes
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * (SELECT nd FROM whole) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM counts GROUP BY term
        ), item_terms AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), scored AS (
            SELECT item_id, place, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // l))))) AS BIGINT) AS score
            FROM item_terms JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (place), whole GROUP BY item_id, place, doc_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op12_warc": r"""
        WITH named AS (
            SELECT page_id, coalesce(octet_length(encode(html)), 0) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), owned AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS owner FROM named
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN owner IS NULL OR owner IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN owner IS DISTINCT FROM page_id THEN owner END AS refers_to
        FROM owned
    """,
    "op11_conversations": r"""
        WITH RECURSIVE bits AS (
            SELECT n, n AS c, 0 AS k FROM (SELECT unnest(range(256)) AS n)
            UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
        ), crc AS (
            SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8
        ), drawn AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)),
                                   lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS BIGINT) + 1]), 4294967295), 4294967295) % 20 AS d
            FROM conversations, crc
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
            FROM drawn WHERE d <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, left(role, 1) AS i
            FROM damaged
        ), rows AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
                   lag(i) OVER (PARTITION BY conv_id ORDER BY place) || i AS pair
            FROM placed
        ), sums AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS n
            FROM rows GROUP BY conv_id
        ), steps AS (
            SELECT conv_id, n + 1 AS place, {'c': 0, 'a': '', 't': []::VARCHAR[]} AS s0, {'c': 6, 'a': 'II', 't': ['user:', 'assistant:']} AS s1,
                   {'c': 3, 'a': 'I', 't': ['assistant:']} AS s2, {'c': 0, 'a': '', 't': []::VARCHAR[]} AS s3
            FROM sums
            UNION ALL
            SELECT conv_id, place, list_min([b0, {'c': f2.c + 3, 'a': 'I' || f2.a, 't': ['user:'] || f2.t}]), list_min([b1, {'c': f2.c + 3, 'a': 'I' || f2.a, 't': ['user:'] || f2.t}]), f2, f3
            FROM (
                SELECT *, list_min([b2, {'c': b3.c + 3, 'a': 'I' || b3.a, 't': ['assistant:'] || b3.t}]) AS f2, list_min([b3, {'c': b2.c + 3, 'a': 'I' || b2.a, 't': ['user:'] || b2.t}]) AS f3
                FROM (SELECT s.conv_id, r.place, list_min([{'c': s0.c + 4, 'a': 'D' || s0.a, 't': s0.t}, CASE WHEN fault NOT IN ('b', 'd') THEN {'c': s2.c + 3 + extra, 'a': 'R' || s2.a, 't': ['user:' || text] || s2.t} END, CASE WHEN fault NOT IN ('b', 'd') AND (i IN ('s', 'u')) THEN {'c': (CASE WHEN i = 's' THEN s1 ELSE s2 END).c + extra, 'a': 'K' || (CASE WHEN i = 's' THEN s1 ELSE s2 END).a, 't': [role || ':' || text] || (CASE WHEN i = 's' THEN s1 ELSE s2 END).t} END]) AS b0, list_min([{'c': s1.c + 4, 'a': 'D' || s1.a, 't': s1.t}, CASE WHEN fault NOT IN ('b', 'd') THEN {'c': s2.c + 3 + extra, 'a': 'R' || s2.a, 't': ['user:' || text] || s2.t} END, CASE WHEN fault NOT IN ('b', 'd') AND (i = 'u') THEN {'c': s2.c + extra, 'a': 'K' || s2.a, 't': [role || ':' || text] || s2.t} END]) AS b1, list_min([{'c': s2.c + 4, 'a': 'D' || s2.a, 't': s2.t}, CASE WHEN fault NOT IN ('b', 'd') THEN {'c': s3.c + 3 + extra, 'a': 'R' || s3.a, 't': ['assistant:' || text] || s3.t} END, CASE WHEN fault NOT IN ('b', 'd') AND (i = 'a') THEN {'c': s3.c + extra, 'a': 'K' || s3.a, 't': [role || ':' || text] || s3.t} END]) AS b2, list_min([{'c': s3.c + 4, 'a': 'D' || s3.a, 't': s3.t}, CASE WHEN fault NOT IN ('b', 'd') THEN {'c': s2.c + 3 + extra, 'a': 'R' || s2.a, 't': ['user:' || text] || s2.t} END, CASE WHEN fault NOT IN ('b', 'd') AND (i = 'u') THEN {'c': s2.c + extra, 'a': 'K' || s2.a, 't': [role || ':' || text] || s2.t} END]) AS b3
                      FROM steps s JOIN (SELECT *, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS extra FROM rows) r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.place = s.place - 1)
            )
        )
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
               CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit,
               sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN (SELECT * FROM steps WHERE place = 1) p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
