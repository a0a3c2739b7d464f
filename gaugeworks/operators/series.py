"""Station series ``(station_code, t, x)`` and their ranks.

A series has one row per station and block (year, month, ...). Blocks are made by ``max`` with
map-side combine, so a station that fills a third of the raw table still yields only as many
series rows as there are blocks in its time span. Windows partition by station and sort, hence
spill; none holds more than one station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from gaugeworks.schemas import ANNUAL, SUMMER, WINTER


def per_station() -> WindowSpec:
    return Window.partitionBy("station_code")


def by_time() -> WindowSpec:
    return per_station().orderBy("t")


def by_value() -> WindowSpec:
    return per_station().orderBy("x", "t")


def block_maxima(df: DataFrame, station: Column, block: Column, value: Column) -> DataFrame:
    """Largest value per station and block; blocks without a value are left out."""
    return (
        df.filter(value.isNotNull())
        .groupBy(station.alias("station_code"), block.alias("t"))
        .agg(F.max(value).alias("x"))
    )


def is_finite(x: Column) -> Column:
    """False for not-a-number and infinity, which pass a comparison with 0; null for null."""
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def finite(series: DataFrame) -> DataFrame:
    """Values that are no numbers count as missing (P15); their rows stay, so no station is lost."""
    return series.withColumn("x", F.when(is_finite(F.col("x").cast("double")), F.col("x").cast("double")))


def spread(series: DataFrame) -> DataFrame:
    """Stations over a fixed number of tasks, for work that outweighs its few bytes of input.

    Adaptive execution sizes tasks by bytes and would fold thousands of short series into one.
    Windows and sums by station then need no further shuffle. Rows whose value is no number are left out.
    """
    spark = series.sparkSession
    series = series.filter(F.col("x").isNull() | is_finite(F.col("x").cast("double")))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return series.repartition(tasks, "station_code")


def annual_maxima(annual_stats: DataFrame) -> DataFrame:
    """WQ by hydrological year."""
    return annual_stats.filter("WQ is not null").select(
        "station_code", F.col("hydro_year").alias("t"), F.col("WQ").alias("x")
    )


def seasonal_maxima(seasonal_stats: DataFrame, season: str) -> DataFrame:
    """WQ of one half-year by hydrological year."""
    return seasonal_stats.filter((F.col("season") == season) & F.col("WQ").isNotNull()).select(
        "station_code", F.col("hydro_year").alias("t"), F.col("WQ").alias("x")
    )


def frequency_series(annual_stats: DataFrame, seasonal_stats: DataFrame) -> DataFrame:
    """Annual, winter and summer maxima as one frame with ``frequency_id``."""
    half = seasonal_stats.filter("WQ is not null").select(
        "station_code", F.when(F.col("season") == "winter", WINTER).otherwise(SUMMER).alias("frequency_id"),
        F.col("hydro_year").alias("t"), F.col("WQ").alias("x"))
    return annual_maxima(annual_stats).withColumn("frequency_id", F.lit(ANNUAL)).unionByName(half)


_MARK = "\x01"  # parts a station's code from its frequency; no code holds it


def frequency_key(station: Column, frequency_id: Column) -> Column:
    """Station and frequency as one code; annual series keep the station's own."""
    return F.when(frequency_id == ANNUAL, station).otherwise(F.concat_ws(_MARK, station, frequency_id.cast("string")))


def keyed(series: DataFrame) -> DataFrame:
    """Series that carry a ``frequency_id`` as series of (station, frequency); others as they are."""
    if "frequency_id" not in series.columns:
        return series
    return series.select(frequency_key(F.col("station_code"), F.col("frequency_id")).alias("station_code"), "t", "x")


def unkeyed(df: DataFrame) -> DataFrame:
    """Give rows made of ``keyed`` series their station code and ``frequency_id`` back."""
    parts = F.split("station_code", _MARK)
    return df.withColumns({"frequency_id": F.coalesce(F.get(parts, 1).cast("int"), F.lit(ANNUAL)), "station_code": parts[0]})


def longer_than(series: DataFrame, min_count: int) -> DataFrame:
    """Series with more than ``min_count`` values."""
    return series.withColumn("_n", F.count("x").over(per_station())).filter(F.col("_n") > min_count).drop("_n")


def describe(series: DataFrame) -> DataFrame:
    """First and last block and number of values."""
    return series.groupBy("station_code").agg(
        F.min("t").alias("year_start"), F.max("t").alias("year_end"),
        F.count("x").cast("int").alias("n"),
    )


def hazen_positions(series: DataFrame) -> DataFrame:
    """Exceedance position (n - m + 0.5) / n, m = ascending rank."""
    n, m = F.count("x").over(per_station()), F.row_number().over(by_value())
    return series.withColumns({"m": m, "p": (n - m + 0.5) / n})


def split_groups(series: DataFrame, k: int) -> DataFrame:
    """k consecutive groups of near-equal size, larger ones first."""
    return series.withColumn("grp", F.ntile(k).over(by_time()))


def split_label(series: DataFrame) -> DataFrame:
    """First block of the second half."""
    return split_groups(series, 2).filter("grp = 2").groupBy("station_code").agg(
        F.min("t").alias("split_t")
    )


def mid_ranks(series: DataFrame) -> DataFrame:
    """Average rank under ties, and the number of equal values."""
    ties = F.count(F.lit(1)).over(Window.partitionBy("station_code", "x"))
    rank = F.rank().over(per_station().orderBy("x"))
    return series.withColumns({"ties": ties, "mid_rank": rank + (ties - 1) / 2.0})


def median_signs(series: DataFrame) -> DataFrame:
    """Values off the station median with their sign and whether a run starts there.

    Extent and length of the whole series ride along, ties included.
    """
    signed = series.withColumns({
        "sign": F.signum(F.col("x") - F.median("x").over(per_station())).cast("int"),
        "period_start": F.min("t").over(per_station()), "period_end": F.max("t").over(per_station()),
        "n": F.count(F.lit(1)).over(per_station()).cast("int"),
    }).filter(F.col("sign") != 0)
    previous = F.lag("sign").over(by_time())
    starts = F.when(previous.isNull() | (previous != F.col("sign")), 1).otherwise(0)
    return signed.withColumn("starts_run", starts)


def ecdf_bounds(series: DataFrame) -> DataFrame:
    """Empirical distribution just below and at each value (W6). Both windows share one order, hence one sort."""
    whole = by_value().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, i = F.count("x").over(whole), F.row_number().over(by_value())
    return series.withColumns({"n": n, "below": (i - 1) / n, "upto": i / n})


def peak(series: DataFrame) -> DataFrame:
    """Largest value and its block, the latest on ties."""
    return series.groupBy("station_code").agg(
        F.max("x").alias("WWQ"), F.max_by("t", F.struct("x", "t")).alias("peak_t")
    )


def rank_digits(series: DataFrame) -> DataFrame:
    """Gain of every value at every binary digit of its rank (see ``concordance``)."""
    ranked = series.withColumn("r", F.dense_rank().over(per_station().orderBy("x")))
    ranked = ranked.withColumn("top", F.max("r").over(per_station()))
    digits = ranked.withColumn("level", F.explode(F.sequence(F.lit(0), F.length(F.bin("top")) - 1)))
    digits = digits.withColumns({
        "one": F.expr("cast(shiftright(r, level) & 1 as bigint)"),
        "prefix": F.expr("shiftright(r, level + 1)"),
    })
    earlier = (
        Window.partitionBy("station_code", "level", "prefix").orderBy("t")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ones = F.coalesce(F.sum("one").over(earlier), F.lit(0))
    seen = F.count(F.lit(1)).over(earlier)
    gain = F.when(F.col("one") == 1, seen - ones).otherwise(-ones)
    return digits.select("station_code", "t", "level", gain.alias("gain"))


def concordance(series: DataFrame) -> DataFrame:
    """Concordant minus discordant pairs per station, without forming pairs.

    Two dense ranks differ first at some binary digit; there the larger one has a 1. So for each
    digit, among rows that agree on all higher digits, a row with a 1 gains the number of earlier
    rows with a 0, and a row with a 0 loses the number of earlier rows with a 1. Equal values
    never differ. This is n log n rows in sorted windows instead of n² pairs, and all windows keep
    the partitioning by station.
    """
    return rank_digits(series).groupBy("station_code").agg(F.sum("gain").alias("s"))
