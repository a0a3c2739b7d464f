"""From raw documents to packed training sequences: five stages, each over all that its predecessor kept.

Language ID rejects documents without a language, the Jaccard join keeps one document of each near-duplicate class, secret
scans replace what they find, mixing repeats or drops documents by their source's target, and packing cuts the rest into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import jaccard, langid, mixing, packing, secret_scan
from gaugeworks.llm.common import bounded_batches, may_learn, table
from gaugeworks.llm.queries import tokenizer_path
from gaugeworks.session import cut_lineage, scratch_path

#: A document whose best language is less probable than this is rejected.
LEAST_LANGUAGE_SCORE = 0.4
CAPACITY = 2048


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject null texts, texts without a letter, and texts of no clear language; the model learns from the documents' own ``lang``.

    Without any labelled document only texts without a letter go.
    """
    bounded_batches(spark)
    model = langid.fit(docs.filter(may_learn(F.col("doc_id"), 5, 0)))
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs.withColumn("_text", F.col("text")), model, "_text")
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each class that shares five-word shingles to a similarity of 0.8."""
    bounded_batches(spark)
    return jaccard.keep_one(docs, jaccard.join(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark and count characters anew where that changed the text."""
    bounded_batches(spark)
    clean = secret_scan.redact(secret_scan.scan(docs, into="_spans"), spans="_spans")
    return clean.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks."""
    return mixing.emit(mixing.mix(docs), docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences; repeated documents give their pieces each."""
    bounded_batches(spark)
    cut = packing.pieces(docs.select("doc_id", "text"), tokenizer_path(), CAPACITY, 0, words=50_000, chars=250_000)
    slim = cut_lineage(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return packing.pack(slim, CAPACITY, ["doc_id", "piece", "ids_crc32"])


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("sequences", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
