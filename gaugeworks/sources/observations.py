"""Scans of the headerless daily observation files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeworks.functions import text

# Positional fields of the two file kinds.
CODZ_FIELDS = [
    "station_code", "station_name", "river_name", "hydro_year", "hydro_month", "day",
    "water_level_cm", "flow_m3s", "water_temp_c", "calendar_month",
]
ZJAW_FIELDS = [
    "station_code", "station_name", "river_name", "hydro_year", "hydro_month", "day",
    "ice_thickness_cm", "ice_phenomenon_code", "ice_phenomenon_pct", "overgrowth_code",
]
CODZ_NUMBERS = [
    "hydro_year", "hydro_month", "day", "water_level_cm", "flow_m3s", "water_temp_c", "calendar_month",
]
ZJAW_NUMBERS = ["hydro_year", "hydro_month", "day", "ice_thickness_cm", "ice_phenomenon_pct"]
CODZ_GLOB = "codz_*.csv"
ZJAW_GLOB = "zjaw_*.csv"
#: Bits for the place of a row in its file; the ordinal of the file stands above them.
PLACE_BITS = 40

_OVERFLOW = "_overflow"
_OPTIONS = {
    "header": "false", "sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
    "encoding": "ISO-8859-1", "recursiveFileLookup": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def raw_schema(fields: list[str]) -> str:
    """All text, plus one column that only an over-long row fills."""
    return ", ".join(f"{c} string" for c in [*fields, _OVERFLOW])


def place_in_file() -> Column:
    """Byte offset of the split plus the running row number in the task: it grows along a file
    (a row takes at least one byte), so no sort and no shuffle is needed to know it."""
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("block_start") + row_in_task


def load_order() -> Column:
    """Order of a row over files that are not all known yet: file path, then place in the file."""
    return F.struct("file", place_in_file().alias("pos"))


def ordered(rows: DataFrame) -> DataFrame:
    """Put one bigint in place of a ``load_order`` of file and place: ordinal of the file in path order, then place.

    Fixed width keeps the merges in hash aggregates and the path out of their shuffles. There is one row per file,
    as in the listing that the driver holds anyway.
    """
    ordinal = rows.select("file").distinct().withColumn("_ordinal", F.row_number().over(Window.orderBy("file")).cast("bigint"))
    place = F.shiftleft(F.col("_ordinal"), PLACE_BITS) + F.col("load_order.pos")
    return rows.join(F.broadcast(ordinal), "file").withColumn("load_order", place).drop("_ordinal")


def with_origin(raw: DataFrame) -> DataFrame:
    """Add the file and the byte offset of the split a row comes from."""
    return raw.select(
        *raw.columns, F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def tidy_fields(
    df: DataFrame,
    fields: list[str],
    numbers: list[str] | None = None,
    decode: bool = True,
    order: Column | None = None,
) -> DataFrame:
    """Flag over-long rows; decode, null the missing-value words, trim; read ``numbers``.

    ``order`` is added in the same projection. The first number is tied to the row number (which is
    never negative): the optimizer then keeps later filters above this projection instead of
    copying the parsing of every field into them.
    """
    numbers = numbers or []
    here = F.monotonically_increasing_id() >= 0
    keep = [c for c in df.columns if c not in (*fields, _OVERFLOW, "block_start")]
    flag = [F.col(_OVERFLOW).isNotNull().alias("too_long")] if _OVERFLOW in df.columns else []

    def tidy(c: str) -> Column:
        if c in numbers:  # no missing-value word is a number
            number = text.to_number(F.col(c))
            return (F.when(here, number) if c == numbers[0] else number).alias(c)
        value = text.missing_to_null(F.col(c))
        return text.clean_text(text.decode_cp1250(value) if decode else value).alias(c)

    extra = [] if order is None else [order.alias("load_order")]
    return df.select(*[tidy(c) for c in fields], *keep, *flag, *extra)


def tidy_codz(rows: DataFrame) -> DataFrame:
    """Rows of a raw scan (see ``with_origin``) as cleaned text and numbers."""
    return tidy_fields(rows, CODZ_FIELDS, CODZ_NUMBERS, order=load_order())


def tidy_zjaw(rows: DataFrame) -> DataFrame:
    return tidy_fields(rows, ZJAW_FIELDS, ZJAW_NUMBERS, order=load_order())


def _scan(
    spark: SparkSession, path: str, glob: str, fields: list[str], file_limit: int | None
) -> DataFrame:
    reader = spark.read.options(**_OPTIONS).option("pathGlobFilter", glob).schema(raw_schema(fields))
    raw = reader.csv(path)
    if file_limit is not None:
        # The file listing is already on the driver, so other files are never opened.
        chosen = sorted(unquote(f) for f in raw.inputFiles())[:file_limit]
        raw = reader.csv(chosen) if chosen else raw.limit(0)
    return with_origin(raw)


def scan_codz(
    spark: SparkSession, path: str, file_limit: int | None = None, glob: str = CODZ_GLOB
) -> DataFrame:
    """Level / flow / temperature rows with ``load_order`` and ``file``."""
    return tidy_codz(_scan(spark, path, glob, CODZ_FIELDS, file_limit))


def scan_zjaw(
    spark: SparkSession, path: str, file_limit: int | None = None, glob: str = ZJAW_GLOB
) -> DataFrame:
    """Ice and vegetation rows with ``load_order`` and ``file``."""
    return tidy_zjaw(_scan(spark, path, glob, ZJAW_FIELDS, file_limit))


def first_files(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of the first ``limit`` files in path order; ``None`` keeps all.

    The broadcast side holds at most ``limit`` paths. It is a top-k over distinct paths,
    never a ranking of the rows.
    """
    if limit is None:
        return df
    first = df.select("file").distinct().orderBy("file").limit(limit)
    return df.join(F.broadcast(first), "file", "left_semi")


# Write one column as it is, without quoting or escaping.
_VERBATIM = {
    "encoding": "ISO-8859-1", "sep": "\x01", "quote": "\x00", "escapeQuotes": "false", "emptyValue": "",
    "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a column ``line``, encoded by ``text.encode_cp1250``, as cp1250 files.

    Spark's text sink knows UTF-8 only.
    """
    lines.select("line").write.mode("overwrite").options(**_VERBATIM).csv(path)
