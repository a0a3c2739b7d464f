"""End-to-end jobs: files to tables, tables to statistics, tests, estimates and exports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import bootstrap, cleaning, export, extremes, frequency, goodness, hypothesis, merge, quality
from gaugeworks.operators import series as srs
from gaugeworks.operators import statistics as st
from gaugeworks.schemas import CONSTRAINTS, MIN_YEARS
from gaugeworks.session import configure, cut_lineage, free_scratch, scratch_path
from gaugeworks.sources import archives, tables
from gaugeworks.sources import observations as obs

STAT_TABLES = ["stats_monthly", "stats_annual", "stats_seasonal", "stats_alltime"]


def load_observations(
    spark: SparkSession, path: str, root: str, file_limit: int | None = None, globs: tuple[str, str] = (obs.CODZ_GLOB, obs.ZJAW_GLOB)
) -> dict[str, DataFrame]:
    """Scan, clean, date all files below ``path`` and merge them into the raw tables below ``root``.

    What the tables hold counts as older than every row of the load, so loads may come in pieces and be repeated: later
    values win, gauges and calendar fields stay as first seen. ``file_limit`` loads the first files only.
    """
    configure(spark)
    raw = obs.scan_codz(spark, path, file_limit, globs[0]), obs.scan_zjaw(spark, path, file_limit, globs[1])
    return merge_load(spark, root, cleaning.type_codz(raw[0]), cleaning.type_zjaw(raw[1]))


def load_archives(spark: SparkSession, path: str, root: str) -> dict[str, DataFrame]:
    """The same for the members of all zip archives below ``path``; unreadable archives are named in ``archive_audit``."""
    configure(spark)
    lines = cut_lineage(archives.scan_members(spark, path))
    codz = archives.member_rows(lines, obs.CODZ_GLOB, obs.CODZ_FIELDS, obs.CODZ_NUMBERS)
    zjaw = archives.member_rows(lines, obs.ZJAW_GLOB, obs.ZJAW_FIELDS, obs.ZJAW_NUMBERS)

    def with_audit(change: tables.Change) -> dict[str, DataFrame]:
        audit, held = archives.archive_audit(lines), change.stored("archive_audit")
        return {"archive_audit": change.rebuild(audit if held is None else merge.replace_by_key(held, audit, ["archive"]), "archive_audit")}

    return merge_load(spark, root, cleaning.type_codz(codz), cleaning.type_zjaw(zjaw), with_audit)


def merge_load(
    spark: SparkSession, root: str, codz: DataFrame | None = None, zjaw: DataFrame | None = None,
    more: Callable[[tables.Change], dict[str, DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """Merge typed rows of either kind into the raw tables; ``more`` may write further tables in the same change.

    Text is parsed once into a columnar staging table, from which names, measurements and audit
    read only their own columns; it is removed at the end. Tables are partitioned by hydrological year and
    only the years of the load are written anew. All tables change at once. The (station, year) pairs of the load wait in
    ``stats_pending`` for ``refresh_statistics``.
    """
    staging = scratch_path(spark, "staging")
    try:
        staged = {kind: obs.ordered(tables.rebuild(df, staging, name))
                  for kind, (name, df) in enumerate((("codz", codz), ("zjaw", zjaw))) if df is not None}
        with tables.change(spark, root) as change:
            out = _merge_names(change, staged)
            if 0 in staged:
                rows = cleaning.measurement_rows(staged[0])
                out["measurements"] = _merge_years(change, "measurements", rows, merge.merge_measurements)
                change.append(rows.select("station_code", "hydro_year").distinct(), "stats_pending")
            if 1 in staged:
                out["phenomena"] = _merge_years(change, "phenomena", cleaning.phenomenon_rows(staged[1]), merge.merge_phenomena)
            if more is not None:
                out |= more(change)
        return out
    finally:
        tables.remove(spark, staging)


def _merge_names(change: tables.Change, staged: dict[int, DataFrame]) -> dict[str, DataFrame]:
    """Gauges and the audit of a load."""
    names = audit = None
    for kind, df in staged.items():  # level files come before ice files
        one = cleaning.gauge_rows(df).withColumn("load_order", F.col("load_order") + F.lit(kind << 62))
        names = one if names is None else names.unionByName(one)
        one = cleaning.reject_audit(df)
        audit = one if audit is None else audit.unionByName(one)
    return merge_names(change, merge.merge_gauges(names), audit)


def merge_names(change: tables.Change, gauges: DataFrame, audit: DataFrame) -> dict[str, DataFrame]:
    """Gauges stay as first seen; a file's audit is that of its last load."""
    none = F.lit(None).cast("double")
    gauges = merge.add_uuid(gauges).select("station_code", "station_name", "river_name", none.alias("lat"), none.alias("lon"), "uuid")
    held = change.stored("gauges_list")
    if held is not None:
        gauges = merge.insert_absent(held, gauges, ["station_code"])
    held = change.stored("load_audit")
    if held is not None:
        audit = merge.replace_by_key(held, audit, ["file"])
    return {"gauges_list": change.rebuild(gauges, "gauges_list"), "load_audit": change.rebuild(audit, "load_audit")}


def _merge_years(change: tables.Change, name: str, rows: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Merge a load into the years it touches; the time of a row fixes its year, so no other year can hold its key."""
    held = change.stored(name, merged(rows).schema)
    if held is not None:
        years = [r[0] for r in rows.select("hydro_year").distinct().collect()]
        held = held.filter(F.col("hydro_year").isin(years)).withColumn("load_order", F.lit(merge.OLD).cast("bigint"))
        rows = held.select(*rows.columns).unionByName(rows)
    return change.rebuild_partitions(merged(rows), name, "hydro_year", ["station_code", "measured_at"])


def merge_rows(change: tables.Change, measurements: DataFrame | None = None, phenomena: DataFrame | None = None) -> dict[str, DataFrame]:
    """Merge rows that have a ``load_order`` of their own (any bigint from 0) into the raw tables, as a later load."""
    out = {}
    if measurements is not None:
        out["measurements"] = _merge_years(change, "measurements", measurements, merge.merge_measurements)
        change.append(measurements.select("station_code", "hydro_year").distinct(), "stats_pending")
    if phenomena is not None:
        out["phenomena"] = _merge_years(change, "phenomena", phenomena, merge.merge_phenomena)
    return out


_KEYS = {"stats_monthly": ["station_code", "year", "month"], "stats_annual": ["station_code", "hydro_year"], "stats_seasonal": ["station_code", "hydro_year", "season"]}
_YEAR = {"stats_monthly": "year", "stats_annual": "hydro_year", "stats_seasonal": "hydro_year"}


def _periods(spark: SparkSession, measurements: DataFrame) -> dict[str, DataFrame]:
    """Monthly, annual and seasonal statistics from one scan and one exchange of the raw table."""
    path = scratch_path(spark, "periods")
    st.periods(measurements).write.partitionBy("grain").parquet(path)
    made = spark.read.schema(st.PERIODS).parquet(path)
    return {f"stats_{grain}": st.of_grain(made, grain) for grain in ("monthly", "annual", "seasonal")}


def compute_statistics(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Rebuild all statistics tables, which change at once; all-time values come from the monthly rows."""
    configure(spark)
    with tables.change(spark, root) as change:
        measurements = change.stored("measurements")
        if measurements is None:
            raise ValueError("measurements is empty")
        made = _periods(spark, tables.require_rows(measurements, "measurements"))
        out = {name: change.rebuild(df, name, [_YEAR[name]], ["station_code"]) for name, df in made.items()}
        out["stats_alltime"] = change.rebuild(st.alltime(out["stats_monthly"]), "stats_alltime")
        change.rebuild(measurements.select("station_code", "hydro_year").limit(0), "stats_pending")
    return out


def refresh_statistics(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Make anew the statistics of the (station, year) pairs that loads have changed since the last time.

    Of the measurements only the years concerned are read, of the statistics only their years are written. All-time values of the
    stations concerned come from their monthly rows. The result equals ``compute_statistics``, which runs where there are no statistics yet.
    """
    configure(spark)
    held = {name: tables.stored(spark, root, name) for name in (*STAT_TABLES, "stats_pending", "measurements")}
    if any(held[name] is None for name in (*STAT_TABLES, "stats_pending")):
        return compute_statistics(spark, root)
    with tables.change(spark, root) as change:
        changed = cut_lineage(change.stored("stats_pending").distinct())
        years = [r[0] for r in changed.select("hydro_year").distinct().collect()]  # as many as there are years
        if not years:
            return {name: held[name] for name in STAT_TABLES}
        made = _periods(spark, changed_rows(change.stored("measurements"), changed, years))
        out = {}
        for name, fresh in made.items():
            old, touched = change.stored(name), years
            hydro_year = F.col("hydro_year")
            if name == "stats_monthly":  # a hydrological year has months of two calendar years
                touched = sorted({y - k for y in years for k in (0, 1)})
                hydro_year = F.col("year") + F.when(F.col("month") > 10, 1).otherwise(0)
            old = old.filter(F.col(_YEAR[name]).isin(touched)).withColumn("_h", hydro_year)
            same = (F.col("_h") == changed["hydro_year"]) & (old["station_code"] == changed["station_code"])
            rows = old.join(changed, same, "left_anti").drop("_h").unionByName(fresh)
            out[name] = change.rebuild_partitions(rows, name, _YEAR[name], ["station_code"], drop=touched)
        stations = changed.select("station_code").distinct()
        renewed = st.alltime(out["stats_monthly"].join(stations, "station_code", "left_semi"))
        kept = change.stored("stats_alltime").join(stations, "station_code", "left_anti")
        out["stats_alltime"] = change.rebuild(kept.unionByName(renewed.select(*kept.columns)), "stats_alltime")
        change.rebuild(changed.limit(0), "stats_pending")
    return out


def changed_rows(measurements: DataFrame, changed: DataFrame, years: list[int]) -> DataFrame:
    """Measurements of the changed (station, year) pairs; other years are not read."""
    return measurements.filter(F.col("hydro_year").isin(years)).join(changed, ["station_code", "hydro_year"], "left_semi")


def eligible_series(gauges: DataFrame, series: DataFrame, min_count: int = MIN_YEARS) -> DataFrame:
    """Long series of known gauges."""
    return srs.longer_than(series, min_count).join(gauges.select("station_code"), "station_code", "left_semi")


def only(series: DataFrame, stations: list[str] | None) -> DataFrame:
    """A few named stations, or all."""
    return series if stations is None else series.filter(F.col("station_code").isin(stations))


def test_results(series: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New rows of the test log. The series feeds every test, so it is computed once."""
    rows = cut_lineage(hypothesis.run_tests(cut_lineage(series)))
    return merge.append_log(existing, rows, "station_code", ["station_code", "test_id"])


def estimate(
    series: DataFrame,
    models: list[str] | None = None,
    existing: dict[str, DataFrame] | None = None,
    n_samples: int = bootstrap.DEFAULT_SAMPLES,
    alpha: float = bootstrap.DEFAULT_ALPHA,
    frequency_id: int = 1,
) -> dict[str, DataFrame]:
    """Fits, design flows, bands and failures of all stations (F9) as rows for the logs.

    Series that carry a ``frequency_id`` (see ``series.frequency_series``) are fitted by station and frequency, in one pass.
    Series and fits are small and feed every other result, so each is checkpointed once. Bands are large: they get their ids as they are made, so that
    they are neither moved nor kept beside the log.
    """
    series = cut_lineage(series)
    free_scratch(series.sparkSession)  # what the series were made of
    existing = existing or {}
    order = ["station_code", "distribution_id", "estimation_method_id", "frequency_id"]
    by_frequency = "frequency_id" in series.columns
    fits = cut_lineage(extremes.fit_frequencies(series, models) if by_frequency else frequency.fit_all(series, models, frequency_id))
    fitted = merge.append_log(
        existing.get("fitted_distributions"), frequency.fitted_rows(fits), "station_code", order
    )
    flows = merge.append_log(
        existing.get("estimated_discharges"),
        cut_lineage(frequency.discharge_rows(frequency.design_flows(fits))),
        "station_code", [*order, "return_period"],
    )
    names = fits.select(*order, "model").distinct()
    tied = fitted.withColumnRenamed("id", "fitted_distribution_id").join(names, order)
    if by_frequency:
        tied = tied.withColumn("station_code", srs.frequency_key(F.col("station_code"), F.col("frequency_id")))
    named, of_station = bootstrap.band_models(models), srs.keyed(series)
    drawn = [n for n in named if n in bootstrap.RESAMPLERS]
    others = [n for n in named if n not in drawn]  # whether these have a band shows when it is made
    made = bootstrap.written_bands(bootstrap.bootstrap_ci(of_station, others, n_samples, alpha)) if others else None
    keys = [bootstrap.ci_keys(b, tied) for b in (bootstrap.band_stations(of_station, drawn) if drawn else None, made) if b is not None]
    numbered = cut_lineage(merge.append_log(
        existing.get("ci_estimates"), cut_lineage(reduce(DataFrame.unionByName, keys)),
        "fitted_distribution_id", ["fitted_distribution_id"],
    ))
    free_scratch(series.sparkSession)
    parts = [bootstrap.ci_rows(bootstrap.bootstrap_ci(of_station, drawn, n_samples, alpha, keys=numbered))] if drawn else []
    ci = reduce(DataFrame.unionByName, [*parts, *([bootstrap.ci_rows(made, numbered)] if others else [])])
    return {
        "fitted_distributions": fitted, "estimated_discharges": flows, "ci_estimates": ci,
        "fit_failures": frequency.fit_failures(fits),
    }


def distribution_test_results(
    series: DataFrame, fitted: DataFrame, existing: DataFrame | None = None, model: str = "pearson3"
) -> DataFrame:
    """Goodness of fit of the latest fit of one model on every station (T6), as rows for the log."""
    rows = cut_lineage(goodness_rows(series, fitted, model))
    return merge.append_log(existing, rows, "fitted_distribution_id", ["fitted_distribution_id"])


def _latest_fits(series: DataFrame, fitted: DataFrame, model: str) -> DataFrame:
    m = frequency.MODELS[model]
    key = ["station_code", "distribution_id", "estimation_method_id", "frequency_id"]
    chosen = fitted.filter(
        (F.col("distribution_id") == m.distribution_id) & (F.col("estimation_method_id") == m.estimation_method_id)
    )
    code = srs.frequency_key(F.col("station_code"), F.col("frequency_id")) if "frequency_id" in series.columns else F.col("station_code")
    return merge.latest_per_key(chosen, key).select(
        code.alias("station_code"), F.lit(model).alias("model"), F.col("id").alias("fitted_distribution_id"),
        F.from_json("distribution_params", "map<string,double>").alias("params"),
    )


_TEST_COLUMNS = ["fitted_distribution_id", "test_id", "result_notes", "result"]


def goodness_rows(series: DataFrame, fitted: DataFrame, model: str | list[str]) -> DataFrame:
    """The test of the latest fits of one model, or of several in one pass, as rows for the log. The series is read once."""
    fits = None
    for name in [model] if isinstance(model, str) else model:
        one = _latest_fits(series, fitted, name)
        fits = one if fits is None else fits.unionByName(one)
    return goodness.lambda_kolmogorov(srs.keyed(series), fits, model).select(*_TEST_COLUMNS)


def chi_square_rows(series: DataFrame, fitted: DataFrame, model: str) -> DataFrame:
    """The chi-square test of the latest fit of one model, as rows for the log; a model needs no distribution function for it.

    The series is read twice, so pass a written or checkpointed one.
    """
    return goodness.chi_square(srs.keyed(series), _latest_fits(series, fitted, model), model).select(*_TEST_COLUMNS)


def log_tests(spark: SparkSession, root: str, series: DataFrame) -> DataFrame:
    """Run all tests and append their rows to the test log (K5); returns the new rows."""
    configure(spark)
    with tables.change(spark, root) as change:
        rows = cut_lineage(test_results(series, change.stored("stat_test_results")))
        change.append(rows, "stat_test_results")
    return rows


def log_estimates(spark: SparkSession, root: str, series: DataFrame, **options) -> dict[str, DataFrame]:
    """Fit all models and append fits, design flows, bands and goodness of fit (T6, chi-square) to their logs (F9), all at once; ``options`` as in ``estimate``."""
    configure(spark)
    names = ["fitted_distributions", "estimated_discharges", "ci_estimates"]
    with tables.change(spark, root) as change:
        held = {n: t for n in names if (t := change.stored(n)) is not None}
        series = cut_lineage(series)
        out = estimate(series, existing=held, **options)
        made = {n: change.append(out[n], n, "zstd" if n == "ci_estimates" else None) for n in names}  # bands are long texts of digits, written once and packed well
        rows, models = None, options.get("models") or frequency.usual_models()
        known = [n for n in models if n in goodness.KNOWN]
        plain = [n for n in known if not frequency.MODELS[n].python]
        tests = [(chi_square_rows, n) for n in models] + [(goodness_rows, n) for n in known if n not in plain] + [(goodness_rows, plain)] * bool(plain)
        for test, chosen in tests:
            one = test(series, made["fitted_distributions"], chosen)
            rows = one if rows is None else rows.unionByName(one)
        if rows is not None:
            order = ["fitted_distribution_id", "test_id"]
            numbered = merge.append_log(change.stored("dist_test_results"), cut_lineage(rows), "fitted_distribution_id", order)
            made["dist_test_results"] = change.append(numbered, "dist_test_results")
    return made | {"fit_failures": out["fit_failures"]}


def export_all(spark: SparkSession, root: str, target: str | None = None) -> dict[str, DataFrame]:
    """The four export tables from the written tables, merged into those below ``target`` (``root``/export); they change at once.

    Stations and all-time rows replace those of the same station (K7); a station with new estimations loses all its
    old ones and their flows (K8). What the run does not know stays.
    """
    configure(spark)
    gauges = tables.read_table(spark, root, "gauges_list")
    fits = export.estimations(tables.read_table(spark, root, "fitted_distributions"))
    flows = export.estimated_flows(tables.read_table(spark, root, "estimated_discharges"))
    alltime = export.alltime(tables.read_table(spark, root, "stats_alltime"), gauges)
    out = {}
    with tables.change(spark, target or f"{root}/export") as change:
        for name, rows in (("stations", export.stations(gauges)), ("stats_alltime", alltime)):
            held = change.stored(name)
            out[name] = change.rebuild(rows if held is None else merge.replace_by_key(held.select(*rows.columns), rows, ["station_code"]), name)
        ids = "id bigint, estimation_id bigint, return_period int, probability double, q_estimated_m3s double"
        held, held_flows = change.stored("estimations"), change.stored("estimated_flows")
        if held is None:
            held = fits.limit(0).select(F.lit(0).cast("bigint").alias("id"), "*")
        if held_flows is None:
            held_flows = spark.createDataFrame([], ids)
        merged, merged_flows = merge.replace_export(held, held_flows, cut_lineage(fits), cut_lineage(flows))
        # both read both old tables, so they are settled before either is replaced
        merged, merged_flows = cut_lineage(merged), cut_lineage(merged_flows)
        out |= {"estimations": change.rebuild(merged, "estimations"), "estimated_flows": change.rebuild(merged_flows, "estimated_flows")}
    return out


def quality_report(tables_by_name: dict[str, DataFrame]) -> DataFrame:
    """Violations of every declared constraint over the tables given."""
    out = None
    for name, df in sorted(tables_by_name.items()):
        if name in CONSTRAINTS:
            one = quality.report(name, df, CONSTRAINTS[name], tables_by_name)
            out = one if out is None else out.unionByName(one)
    return out
