"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is hashed to a wide vector, and the fingerprint is the sum of the vectors modulo powers
of two. So the order of paragraphs does not matter, and inserting or deleting a paragraph adds or
subtracts its vector. The vector has two parts: four numbers from its SHA-256 (modulo 2**60), which decide
equality, and how often each of 60 bits is set in the hashes of its word pairs (three 20-bit counters in each
of 20 numbers), plus the number of pairs. The counters of a bit, centred, are a random projection of the multiset of word pairs, so
their cosine estimates the likeness of two documents with a standard error of about 0.13.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import range_buckets
from gaugeworks.session import cut_lineage

EQUAL, FIELDS, STEP = 4, 3, 20
MODULUS = 1 << 60
SPREAD = sum(1 << (STEP * f) for f in range(FIELDS))
E_COLS = [f"_e{i}" for i in range(EQUAL)]
S_COLS = [f"_s{i}" for i in range(STEP)]


def _number(hexadecimal: Column, at: int) -> Column:
    return F.conv(F.substring(hexadecimal, at, 15), 16, 10).cast("long")


def pair_hashes(paragraph: Column) -> Column:
    """60-bit hashes of each word with its successor, the last word alone; words end at spaces."""
    words = F.split(paragraph, " ")
    after = F.slice(words, F.lit(2), F.size(words))  # one shorter; a lambda must not look into the array itself, it would split again for each word
    return F.zip_with(words, after, lambda w, v: _number(F.md5(F.concat(w, F.lit(" "), F.coalesce(v, F.lit(""))).cast("binary")), 1))


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key with ``fingerprint`` (hexadecimal) and the sums it is made of; null text counts as empty.

    Paragraphs end at line feeds. Keys identify rows. Sums combine before any shuffle. Texts beyond a million words wrap their
    counters (equality is not touched); sums beyond 64 bits would count as zero.
    """
    paragraphs = rows.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_p"))
    # the numbers of the digest come first, each paragraph's are read once; then its pairs
    digest = F.transform(F.array(F.sha2(F.col("_p").cast("binary"), 256)), lambda d: F.array(*[_number(d, 1 + 15 * i) for i in range(EQUAL)]))
    parts = paragraphs.select(*keys, F.posexplode(F.concat(F.flatten(digest), pair_hashes(F.col("_p")))).alias("_at", "_h"))
    first, value = F.col("_at") < EQUAL, F.col("_h")
    half = F.lit((1 << 30) - 1)  # sums of 30-bit halves cannot overflow
    halves = [(f"_{k}{i}", i, value.bitwiseAND(half) if k == "low" else F.shiftright(value, 30)) for i in range(EQUAL) for k in ("low", "high")]
    sums = [F.sum(F.when(F.col("_at") == i, v).otherwise(0)).alias(c) for c, i, v in halves]
    lanes = [F.try_sum(F.when(first, 0).otherwise(F.shiftright(value, i).bitwiseAND(F.lit(SPREAD)))).alias(c) for i, c in enumerate(S_COLS)]
    summed = parts.groupBy(*keys).agg(*sums, *lanes, F.sum(F.when(first, 0).otherwise(1)).alias("_n"))

    def whole(i: int) -> Column:
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return F.shiftleft((high + F.shiftright(low, 30)).bitwiseAND(half), 30).bitwiseOR(low.bitwiseAND(half))

    return with_text(summed.select(*keys, *[whole(i).alias(c) for i, c in enumerate(E_COLS)],
                                   *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in S_COLS], "_n"))


def with_text(sums: DataFrame) -> DataFrame:
    """The fingerprint as text: equality numbers, then counters, then the count of pairs."""
    padded = [F.lpad(F.lower(F.hex(F.col(c))), 15, "0") for c in [*E_COLS, *S_COLS]]
    return sums.withColumn("fingerprint", F.concat(*padded, F.lpad(F.lower(F.hex(F.col("_n"))), 8, "0")))


def combine(left: DataFrame, right: DataFrame, keys: list[str], sign: int = 1) -> DataFrame:
    """Fingerprints of texts with paragraphs inserted (``sign`` 1) or deleted (-1), from sums alone; a key without a partner keeps its own."""
    other = right.select(*keys, *[F.col(c).alias(f"{c}_") for c in [*E_COLS, *S_COLS, "_n"]])
    both = left.drop("fingerprint").join(other, keys, "left")
    added = lambda c: F.col(c) + sign * F.coalesce(F.col(f"{c}_"), F.lit(0))
    out = both.withColumns({c: F.pmod(added(c), F.lit(MODULUS)) for c in E_COLS} | {c: added(c) for c in [*S_COLS, "_n"]})
    return with_text(out.drop(*[f"{c}_" for c in [*E_COLS, *S_COLS, "_n"]]))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the centred counters of two fingerprints (structs of ``parts``), 0 to 1; 1 for equal fingerprints."""
    mask = F.lit((1 << STEP) - 1)

    def centred(x: Column) -> Column:
        counters = F.array(*[x[c] for c in S_COLS])
        field = lambda f: F.transform(counters, lambda c: (2 * F.shiftright(c, STEP * f).bitwiseAND(mask) - x["_n"]).cast("double"))
        return F.concat(*[field(f) for f in range(FIELDS)])

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda total, p: total + p)

    lengths = F.sqrt(dot(centred(a), centred(a)) * dot(centred(b), centred(b)))
    value = F.when(lengths > 0, dot(centred(a), centred(b)) / lengths).otherwise(F.lit(0.0))
    return F.when(a["fingerprint"] == b["fingerprint"], F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def neighbour_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with the edited text that takes its last quarter from the start of the next one, in ascending key order.

    Columns: key, ``_bucket``, ``_row`` (place in the bucket), ``n_chars``, ``text``, ``edited``. Null keys come first; equal keys are ordered by text; a single
    document is its own successor. The text is shuffled once, by ranges of the key.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ranged = base.withColumn("_bucket", range_buckets(base, "_key", 4 * n))
    order = [F.col("_key").asc_nulls_first(), F.col("_text")]
    w = Window.partitionBy("_bucket").orderBy(*order)
    # at most 4 buckets per shuffle partition: the first key of each, then the first text of each
    heads = [tuple(r) for r in ranged.groupBy("_bucket").agg(F.min("_key")).orderBy("_bucket").collect()]
    schema = "_before int, _head long"
    links = docs.sparkSession.createDataFrame([(heads[i - 1][0], h[1]) for i, h in enumerate(heads)], schema)
    firsts = base.join(F.broadcast(links), F.col("_key").cast("long").eqNullSafe(F.col("_head"))).groupBy("_before").agg(F.min("_text").alias("_head_text"))
    rows = ranged.withColumn("_row", F.row_number().over(w)).withColumn("_next", F.lead("_text").over(w)).withColumn("_last", F.col("_next").isNull())
    rows = rows.join(firsts, F.col("_last") & (F.col("_bucket") == F.col("_before")), "left") if heads else rows.withColumn("_head_text", F.lit(""))
    chars = F.length("_text")
    cut = F.floor(chars / 4).cast("int")
    edited = F.concat(F.expr("left(_text, length(_text) - cast(floor(length(_text) / 4) as int))"),
                      F.substring(F.coalesce("_next", "_head_text", F.lit("")), F.lit(1), cut))
    return rows.select(F.col("_key").alias(key), "_bucket", "_row", chars.cast("long").alias("n_chars"), F.col("_text").alias("text"), edited.alias("edited"))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text, and how alike they and the next document's are.

    Rows are those of ``docs`` (repeated rows too); other columns are ignored. Empty and null texts have the fingerprint of one empty paragraph.
    """
    rows = neighbour_edits(docs, key, text)
    place = ["_bucket", "_row"]
    both = rows.select(*place, key, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.explode(F.array(F.struct(F.lit(False).alias("changed"), F.col("text").alias("t")), F.struct(F.lit(True).alias("changed"), F.col("edited").alias("t")))).alias("v"))
    flat = both.select(*place, key, "n_chars", "edited_sha256", F.col("v.changed").alias("_changed"), F.col("v.t").alias("_t"))
    prints = cut_lineage(fingerprints(flat, [*place, key, "n_chars", "edited_sha256", "_changed"], "_t"))
    parts = ["fingerprint", *S_COLS, "_n"]
    own = prints.filter(~F.col("_changed"))
    changed = prints.filter("_changed").select(*place, F.struct(*parts).alias("_edit"))
    w = Window.partitionBy("_bucket").orderBy("_row")
    own = own.withColumn("_own", F.struct(*parts)).withColumn("_next", F.lead("_own").over(w))
    # again one row per bucket: the first fingerprint of the bucket that follows
    buckets = sorted(r[0] for r in prints.select("_bucket").distinct().collect())
    links = docs.sparkSession.createDataFrame([(buckets[i - 1], b) for i, b in enumerate(buckets)], "_before int, _after int")
    heads = prints.filter("not _changed and _row = 1").join(F.broadcast(links), F.col("_bucket") == F.col("_after")).select("_before", F.struct(*parts).alias("_head"))
    out = own.join(changed, place).join(F.broadcast(heads), F.col("_bucket") == F.col("_before"), "left")
    after = F.coalesce(F.col("_next"), F.col("_head"))
    return out.select(key, "n_chars", "edited_sha256", F.col("_own.fingerprint").alias("fingerprint"), F.col("_edit.fingerprint").alias("edited_fingerprint"),
                      likeness(F.col("_own"), F.col("_edit")).alias("near_edited"), likeness(F.col("_own"), after).alias("near_next"))
