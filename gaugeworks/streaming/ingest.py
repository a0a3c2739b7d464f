"""Incremental ingest of a drop folder (I1), in two ways.

``ingest_tables`` merges each micro-batch into the tables that batch loads write, as a load of its own. The batch is
entered in ``load_ledger`` in the same change as its rows, so it counts once even if the stream runs it again.

The other way keeps a state of its own. Each micro-batch writes its rows, merged per key but still carrying their load order, to its own
directory ``batch_id=<n>``; writing again after a failure replaces that directory. The current
table is the same merge over all batches. The picks are associative, so files may come in any
grouping, twice or after a restart, and the table equals one batch load of the same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.operators import cleaning, merge
from gaugeworks.plans import jobs
from gaugeworks.schemas import MEASUREMENT_CALENDAR, MEASUREMENT_KEY, MEASUREMENT_VALUES, PHENOMENON_CALENDAR, PHENOMENON_VALUES
from gaugeworks.session import configure
from gaugeworks.sources import observations as obs
from gaugeworks.sources import tables
from gaugeworks.sources.tables import exists as _exists


KINDS = ["codz", "zjaw"]
COMPACTED = -1  # no batch has this number, so a stream that goes on never writes over a compacted table


def partial_upsert(rows: DataFrame, key: list[str], overwrite: list[str], keep: list[str]) -> DataFrame:
    """Per key: last values and first calendar fields, each with the order that chose it."""
    return rows.groupBy(*key).agg(
        F.min(F.struct("load_order", *keep)).alias("first"), F.max(F.struct("load_order", *overwrite)).alias("last")
    )


def final_upsert(partials: DataFrame, key: list[str], overwrite: list[str], keep: list[str]) -> DataFrame:
    merged = partials.groupBy(*key).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.select(*key, *[F.col(f"first.{c}") for c in keep], *[F.col(f"last.{c}") for c in overwrite])


def _stream(spark: SparkSession, path: str, glob: str, fields: list[str], max_files: int | None) -> DataFrame:
    reader = spark.readStream.options(**obs._OPTIONS).option("pathGlobFilter", glob).schema(obs.raw_schema(fields))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return obs.with_origin(reader.csv(path))


def _start(rows: DataFrame, table: str, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _write_names(typed: DataFrame, table: str, kind: str, batch_id: int) -> None:
    """Gauge names and the audit of a batch; level files come before ice files, as in a batch load."""
    order = F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.col("load_order.file").alias("file"), F.col("load_order.pos").alias("pos"))
    names = cleaning.gauge_rows(typed).groupBy("station_code").agg(F.min(F.struct(order.alias("load_order"), "station_name", "river_name")).alias("first"))
    names.write.mode("overwrite").parquet(f"{table}/gauges/kind={kind}/batch_id={batch_id}")
    cleaning.reject_audit(typed).write.mode("overwrite").parquet(f"{table}/audit/kind={kind}/batch_id={batch_id}")


def ingest_codz(
    spark: SparkSession, path: str, table: str, checkpoint: str, max_files: int | None = None,
    glob: str = obs.CODZ_GLOB,
) -> StreamingQuery:
    """Load all waiting level / flow / temperature files into ``table``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        typed = cleaning.type_codz(obs.tidy_codz(batch)).persist()
        partial = partial_upsert(cleaning.measurement_rows(typed), MEASUREMENT_KEY, MEASUREMENT_VALUES, MEASUREMENT_CALENDAR)
        partial.write.mode("overwrite").parquet(f"{table}/measurements/batch_id={batch_id}")
        _write_names(typed, table, "codz", batch_id)
        typed.unpersist()

    return _start(_stream(spark, path, glob, obs.CODZ_FIELDS, max_files), table, checkpoint, write)


def ingest_zjaw(
    spark: SparkSession, path: str, table: str, checkpoint: str, max_files: int | None = None,
    glob: str = obs.ZJAW_GLOB,
) -> StreamingQuery:
    """Load all waiting ice / vegetation files into ``table``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        typed = cleaning.type_zjaw(obs.tidy_zjaw(batch)).persist()
        rows = cleaning.phenomenon_rows(typed)
        partial = partial_upsert(rows, MEASUREMENT_KEY, PHENOMENON_VALUES, PHENOMENON_CALENDAR)
        partial.write.mode("overwrite").parquet(f"{table}/phenomena/batch_id={batch_id}")
        _write_names(typed, table, "zjaw", batch_id)
        typed.unpersist()

    return _start(_stream(spark, path, glob, obs.ZJAW_FIELDS, max_files), table, checkpoint, write)


def current_measurements(spark: SparkSession, table: str) -> DataFrame:
    return final_upsert(
        spark.read.parquet(f"{table}/measurements"), MEASUREMENT_KEY, MEASUREMENT_VALUES, MEASUREMENT_CALENDAR
    )


def current_phenomena(spark: SparkSession, table: str) -> DataFrame:
    return final_upsert(
        spark.read.parquet(f"{table}/phenomena"), MEASUREMENT_KEY, PHENOMENON_VALUES, PHENOMENON_CALENDAR
    )


def current_gauges(spark: SparkSession, table: str) -> DataFrame:
    merged = spark.read.parquet(f"{table}/gauges").groupBy("station_code").agg(F.min("first").alias("first"))
    return merge.add_uuid(merged.select("station_code", "first.station_name", "first.river_name"))


def current_audit(spark: SparkSession, table: str) -> DataFrame:
    """Rows kept and rejected per file; a file that came twice shows its last batch."""
    rows = spark.read.parquet(f"{table}/audit")
    values = ["rows", "rejected", "reasons", "ok"]
    return rows.groupBy("file").agg(F.max_by(F.struct(*values), "batch_id").alias("v")).select("file", "v.*")


LEDGER = "load_ledger"


def ingest_tables(
    spark: SparkSession, path: str, root: str, checkpoint: str, kind: str = "codz", max_files: int | None = None, glob: str | None = None
) -> StreamingQuery:
    """Merge all waiting files of one kind into the raw tables below ``root``; only the years of a batch are written anew.

    A batch counts as later than all that the tables hold, so batch loads and streams may follow one another in any order and give what
    the same loads give one by one. ``kind`` is ``codz`` or ``zjaw``. The checkpoint names the stream in the ledger.
    """
    fields, tidy, typed, usual = {
        "codz": (obs.CODZ_FIELDS, obs.tidy_codz, cleaning.type_codz, obs.CODZ_GLOB),
        "zjaw": (obs.ZJAW_FIELDS, obs.tidy_zjaw, cleaning.type_zjaw, obs.ZJAW_GLOB),
    }[kind]

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        entry = session.createDataFrame([(checkpoint, int(batch_id))], "stream string, batch_id bigint")
        ledger = tables.stored(session, root, LEDGER)
        if ledger is not None and not ledger.join(entry, ["stream", "batch_id"], "left_semi").isEmpty():
            return

        def enter(change: tables.Change) -> dict[str, DataFrame]:
            change.append(entry, LEDGER)
            return {}

        jobs.merge_load(session, root, more=enter, **{kind: typed(tidy(batch))})

    configure(spark)
    return _start(_stream(spark, path, glob or usual, fields, max_files), root, checkpoint, write)


def publish(spark: SparkSession, table: str, root: str) -> None:
    """Merge the current state into the tables that the other jobs read, as one load; what other loads brought stays."""
    def rows(name: str, current: Callable[[SparkSession, str], DataFrame]) -> DataFrame | None:
        return current(spark, table).withColumn("load_order", F.lit(0).cast("bigint")) if _exists(spark, f"{table}/{name}") else None

    with tables.change(spark, root) as change:
        jobs.merge_rows(change, rows("measurements", current_measurements), rows("phenomena", current_phenomena))
        jobs.merge_names(change, current_gauges(spark, table).drop("uuid"), current_audit(spark, table))


def compact(spark: SparkSession, table: str, target: str) -> None:
    """Fold all batches into one at ``target``; readers switch when it is complete."""
    for name in ("measurements", "phenomena"):
        if not _exists(spark, f"{table}/{name}"):
            continue
        partials = spark.read.parquet(f"{table}/{name}")
        partials.groupBy(*MEASUREMENT_KEY).agg(F.min("first").alias("first"), F.max("last").alias("last")).write.mode(
            "overwrite"
        ).parquet(f"{target}/{name}/batch_id={COMPACTED}")
    if _exists(spark, f"{table}/gauges"):
        spark.read.parquet(f"{table}/gauges").groupBy("station_code").agg(F.min("first").alias("first")).write.mode(
            "overwrite"
        ).parquet(f"{target}/gauges/kind=all/batch_id={COMPACTED}")
        current_audit(spark, table).write.mode("overwrite").parquet(f"{target}/audit/kind=all/batch_id={COMPACTED}")
