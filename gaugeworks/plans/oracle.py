"""DuckDB SQL giving the same rows as :mod:`gaugeworks.plans.queries`.

Series tests are restated here from their textbook definitions (all pairs for the trend count,
bisection for critical values, power series for probabilities), not from the Spark plans.
"""

from __future__ import annotations

from statistics import NormalDist

from gaugeworks.operators.frequency import ci_grid
from gaugeworks.plans import adapters as ad
from gaugeworks.plans import plots
from gaugeworks.plans.queries import CURVE_GRID, MIN_COUNT, SAMPLES
from gaugeworks.schemas import DISTRIBUTIONS, ESTIMATION_METHODS, FREQUENCIES, STAT_TESTS


# Fixed values, stated again so that a mistake in the engine's own does not show on both sides.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


def _z(p: float) -> float:
    """Standard normal value that is exceeded with probability p, from the standard library."""
    return -NormalDist().inv_cdf(p)


def _r(x: str, digits: int = 6) -> str:
    return f"(round({x}, {digits}) + 0.0)"


def _cols(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in expressions.items())


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


_CLOCK = "strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at"
_LINE_ORDER = ad.LINE_ORDER

ROWS = f"meas_rows AS (SELECT {_cols(ad.MEASUREMENT)}, {_LINE_ORDER} AS load_order FROM lineitem)"
MEAS = ROWS + """, measurements AS (
  SELECT station_code, measured_at, f.hydro_year, f.hydro_month, f.calendar_month,
         l.water_level_cm, l.flow_m3s, l.water_temp_c
  FROM (SELECT station_code, measured_at,
               arg_min({'hydro_year': hydro_year, 'hydro_month': hydro_month, 'calendar_month': calendar_month}, load_order) AS f,
               arg_max({'water_level_cm': water_level_cm, 'flow_m3s': flow_m3s, 'water_temp_c': water_temp_c}, load_order) AS l
        FROM meas_rows GROUP BY station_code, measured_at))"""
GAUGES = f"gauges AS (SELECT {_cols(ad.GAUGE)} FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
PHEN_ROWS = f"phen_rows AS (SELECT {_cols(ad.PHENOMENON)}, event_id AS load_order FROM events)"
PHEN = PHEN_ROWS + """, phenomena AS (
  SELECT station_code, measured_at, f.hydro_year, f.hydro_month,
         l.ice_thickness_cm, l.ice_phenomenon_code, l.ice_phenomenon_pct, l.overgrowth_code
  FROM (SELECT station_code, measured_at,
               arg_min({'hydro_year': hydro_year, 'hydro_month': hydro_month}, load_order) AS f,
               arg_max({'ice_thickness_cm': ice_thickness_cm, 'ice_phenomenon_code': ice_phenomenon_code,
                        'ice_phenomenon_pct': ice_phenomenon_pct, 'overgrowth_code': overgrowth_code}, load_order) AS l
        FROM phen_rows GROUP BY station_code, measured_at))"""

_EIGHT = ", ".join(
    f"round({agg}({col}), 2) AS {p}{s}"
    for col, s in (("flow_m3s", "Q"), ("water_level_cm", "W"))
    for p, agg in (("N", "min"), ("S", "avg"), ("Z", "median"), ("W", "max"))
).replace("round(min(water_level_cm)", "round(min(water_level_cm)::DOUBLE").replace(
    "round(max(water_level_cm)", "round(max(water_level_cm)::DOUBLE"
) + ", CAST(count(*) AS INT) AS mes_count"
MONTHLY = f"""monthly AS (SELECT station_code, CAST(year(measured_at) AS INT) AS year, calendar_month AS month, {_EIGHT}
  FROM measurements GROUP BY ALL)"""
ANNUAL = f"annual AS (SELECT station_code, hydro_year, {_EIGHT} FROM measurements WHERE hydro_year IS NOT NULL GROUP BY ALL)"
SEASONAL = f"""seasonal AS (SELECT station_code, hydro_year,
  CASE WHEN hydro_month BETWEEN 1 AND 6 THEN 'winter' ELSE 'summer' END AS season, {_EIGHT}
  FROM measurements WHERE hydro_year IS NOT NULL AND hydro_month IS NOT NULL GROUP BY ALL)"""


def _mean2(c: str) -> str:
    return f"round(CAST(sum(CAST({c} AS DECIMAL(20,2))) AS DOUBLE) / count({c}), 2)"


ALLTIME = f"""alltime AS (SELECT station_code, round(min(NQ), 2) AS NNQ, round(max(WQ), 2) AS WWQ,
  {_mean2('WQ')} AS SWQ, {_mean2('NQ')} AS SNQ, {_mean2('SQ')} AS SSQ, CAST(count(*) AS INT) AS mes_count
  FROM monthly GROUP BY station_code)"""


def _one_series(name: str, which: str, prefix: bool) -> str:
    table, station, block, value = ad.SERIES[which]
    code = f"'{which}:' || {station}" if prefix else station
    return f"""{name} AS (SELECT {code} AS station_code, {block.format(us='epoch_us(ts)')} AS t, max({value}) AS x
  FROM {table} WHERE {value} IS NOT NULL GROUP BY ALL)"""


SERIES = ", ".join(_one_series("series_" + w.lower(), w, True) for w in "ABC") + (
    ", series AS (SELECT * FROM series_a UNION ALL SELECT * FROM series_b UNION ALL SELECT * FROM series_c)"
)
_PERIOD = "CAST(min(t) AS INT) AS period_start, CAST(max(t) AS INT) AS period_end, CAST(count(*) AS INT) AS n"
WHOLE = f"whole AS (SELECT station_code, {_PERIOD} FROM series GROUP BY station_code)"


# ---- probabilities ----------------------------------------------------------------------------

def _phi(z: str) -> str:
    return f"(exp(-({z})*({z})/2.0) / 2.5066282746310002)"


def _central(z: str) -> str:
    """P(0 < Z < z) as a power series."""
    return (
        f"({_phi(z)} * list_reduce(range(1, 121), lambda acc_, el_: {{'k': 0::BIGINT, 'term': acc_.term * ({z}) * ({z}) / (2 * el_.k + 1), "
        f"'total': acc_.total + acc_.term * ({z}) * ({z}) / (2 * el_.k + 1)}}, "
        f"{{'k': 0::BIGINT, 'term': CAST({z} AS DOUBLE), 'total': CAST({z} AS DOUBLE)}}).total)"
    ).replace("range(1, 121)", "list_transform(range(1, 121), lambda idx_: {'k': idx_, 'term': 0.0::DOUBLE, 'total': 0.0::DOUBLE})")


def _normal_cdf(z: str) -> str:
    return f"(CASE WHEN {z} > 8 THEN 1.0 WHEN {z} < -8 THEN 0.0 ELSE 0.5 + {_central(z)} END)"


def _two_sided(z: str) -> str:
    return f"(CASE WHEN abs({z}) > 8 THEN 0.0 ELSE 1.0 - 2.0 * {_central(f'abs({z})')} END)"


def _student_central(angle: str, df: str) -> str:
    """P(|T| < t) for tan(angle) = t / sqrt(df)."""
    step = f"acc_.term * cos({angle}) * cos({angle}) * (2 * el_.k - ({df} + 1) % 2) / (2 * el_.k + 1 - ({df} + 1) % 2)"
    first = f"(CASE WHEN {df} % 2 = 1 THEN cos({angle}) ELSE 1.0 END)"
    terms = f"(CASE WHEN {df} % 2 = 1 THEN ({df} - 1) // 2 ELSE {df} // 2 END)"
    total = (
        f"list_reduce(list_transform(range(1, {terms}), lambda idx_: {{'k': idx_, 'term': 0.0::DOUBLE, 'total': 0.0::DOUBLE}}), "
        f"lambda acc_, el_: {{'k': 0::BIGINT, 'term': {step}, 'total': acc_.total + {step}}}, "
        f"{{'k': 0::BIGINT, 'term': CAST({first} AS DOUBLE), 'total': CAST({first} AS DOUBLE)}}).total"
    )
    return (
        f"(CASE WHEN {df} = 1 THEN {angle} * 2 / pi() WHEN {df} % 2 = 1 THEN ({angle} + sin({angle}) * {total}) * 2 / pi() "
        f"ELSE sin({angle}) * {total} END)"
    )


def _p4(p: str) -> str:
    return f"printf('%.4f', {p})"


def _test(ctes: str, test_id: int, frm: str, statistic: str, p: str, notes: str) -> str:
    return _with(SERIES, WHOLE, ctes, f"""scored AS (SELECT w.station_code, w.period_start, w.period_end, w.n, {statistic} AS stat, q.*
  EXCLUDE (station_code) FROM whole w JOIN {frm} q USING (station_code)), judged AS (SELECT *, {p} AS p FROM scored)""") + (
        f"SELECT station_code, {test_id} AS test_id, period_start, period_end, n, {_r('stat')} AS statistic, {_r('p')} AS p_value, "
        f"{notes} AS result_notes, p >= 0.05 AS result FROM judged"
    )


_NOTES = "'n=' || n || ', α=5%, p=' || " + _p4("p")

RANKED = """ranked AS (SELECT station_code, t, x, count(*) OVER (PARTITION BY station_code, x) AS ties,
  rank() OVER (PARTITION BY station_code ORDER BY x) + (count(*) OVER (PARTITION BY station_code, x) - 1) / 2.0::DOUBLE AS mid_rank,
  ntile(2) OVER (PARTITION BY station_code ORDER BY t) AS grp,
  row_number() OVER (PARTITION BY station_code ORDER BY t) AS i FROM series)"""
SIGNS = """medians AS (SELECT station_code, median(x) AS med FROM series GROUP BY station_code),
signs AS (SELECT station_code, t, CASE WHEN x > med THEN 1 ELSE -1 END AS sign FROM series JOIN medians USING (station_code) WHERE x <> med),
starts AS (SELECT *, CASE WHEN lag(sign) OVER (PARTITION BY station_code ORDER BY t) = sign THEN 0 ELSE 1 END AS st FROM signs),
runs AS (SELECT station_code, count(*) FILTER (sign > 0) AS n1, count(*) FILTER (sign < 0) AS n2, CAST(sum(st) AS BIGINT) AS runs
  FROM starts GROUP BY station_code)"""
PAIRS = """pairs AS (SELECT a.station_code, CAST(sum(sign(b.x - a.x)) AS BIGINT) AS s
  FROM series a JOIN series b ON a.station_code = b.station_code AND a.t < b.t GROUP BY a.station_code)"""

_BISECT = f"""moments AS (SELECT station_code, count(*) FILTER (x > 0) AS n_pos, avg(log10(x)) FILTER (x > 0) AS m,
  stddev_samp(log10(x)) FILTER (x > 0) AS sd FROM (SELECT station_code, CASE WHEN x > 0 THEN x END AS x FROM series) GROUP BY station_code),
angle(n, lo, hi, step) AS (
  SELECT DISTINCT n_pos, 0.0::DOUBLE, pi() / 2, 0 FROM moments WHERE n_pos >= 3
  UNION ALL
  SELECT n, CASE WHEN 1.0 - {_student_central('((lo + hi) / 2)', '(n - 2)')} < 0.10::DOUBLE / n THEN lo ELSE (lo + hi) / 2 END,
         CASE WHEN 1.0 - {_student_central('((lo + hi) / 2)', '(n - 2)')} < 0.10::DOUBLE / n THEN (lo + hi) / 2 ELSE hi END, step + 1
  FROM angle WHERE step < 60),
crit AS (SELECT n AS n_pos, (n - 1) / sqrt(n) * sqrt(pow(tan((lo + hi) / 2), 2) / (1 + pow(tan((lo + hi) / 2), 2))) AS k FROM angle WHERE step = 60),
limits AS (SELECT station_code, k, pow(10, m - k * sd) AS low, pow(10, m + k * sd) AS high FROM moments JOIN crit USING (n_pos)),
hits AS (SELECT l.station_code, any_value(k) AS k,
  string_agg(t || ': ' || printf('%.1f', x), ', ' ORDER BY t) FILTER (x > 0 AND (x < low OR x > high)) AS labels
  FROM limits l JOIN series USING (station_code) GROUP BY l.station_code)"""

LN = """ln_moments AS (SELECT station_code, CAST(min(t) AS INT) AS year_start, CAST(max(t) AS INT) AS year_end, CAST(count(x) AS INT) AS n,
  avg(ln(CASE WHEN x > 0 THEN x END)) AS mu_log, stddev_samp(ln(CASE WHEN x > 0 THEN x END)) AS sigma_log,
  count(*) FILTER (x > 0) AS n_pos FROM {s} GROUP BY station_code)"""
LN3 = """ends AS (SELECT station_code, CAST(count(*) AS INT) AS n, min(x) AS low, max(x) AS high, median(x) AS mid FROM {s} GROUP BY station_code),
bound AS (SELECT *, (high * low - mid * mid) / nullif(high + low - 2 * mid, 0) AS epsilon FROM ends),
ln3 AS (SELECT s.station_code, any_value(n) AS n, any_value(epsilon) AS epsilon, avg(ln(x - epsilon)) AS mu, stddev_samp(ln(x - epsilon)) AS sigma
  FROM {s} s JOIN bound b ON s.station_code = b.station_code WHERE n >= 3 AND low > 0 AND epsilon < low
  GROUP BY s.station_code HAVING stddev_samp(ln(x - epsilon)) > 0)"""
PROFILE = """lows AS (SELECT station_code, min(x) AS low, count(*) AS n FROM series WHERE x > 0 GROUP BY station_code HAVING count(*) >= 3),
grid AS (SELECT station_code, n, CAST(g AS INT) AS grid_no, CASE WHEN g = 199 THEN low * 0.999::DOUBLE
  ELSE low * 1e-4 + g * ((low * 0.999::DOUBLE - low * 1e-4) / 199) END AS epsilon FROM lows, range(200) r(g)),
sums AS (SELECT g.station_code, grid_no, epsilon, any_value(n)::DOUBLE AS n, sum(x - epsilon) AS sd, sum(ln(x - epsilon)) AS sl
  FROM grid g JOIN series s ON g.station_code = s.station_code AND s.x > 0 GROUP BY ALL),
shape AS (SELECT *, ln(sd / n) - sl / n AS a FROM sums),
shaped AS (SELECT *, (1 + sqrt(1 + 4 * a / 3)) / (4 * a) AS lam FROM shape WHERE a > 0),
prof AS (SELECT station_code, grid_no, epsilon, lam, lam * n / sd AS alpha,
  n * lam * ln(lam * n / sd) - n * lgamma(lam) + (lam - 1) * sl - lam * n AS loglik FROM shaped),
pearson AS (SELECT * FROM prof QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY loglik DESC, grid_no) = 1)"""
WEIBULL = """packed AS (SELECT station_code, CAST(count(*) AS INT) AS n, list(ln(x)) AS ys, max(ln(x)) AS top, avg(ln(x)) AS mean_y, stddev_pop(ln(x)) AS sd
  FROM (SELECT station_code, x, min(x) OVER (PARTITION BY station_code) AS low FROM series) WHERE low > 0 GROUP BY station_code
  HAVING count(*) >= 3 AND stddev_pop(ln(x)) >= 1e-12),
root(station_code, lo, hi, step) AS (
  SELECT station_code, 1e-3::DOUBLE, 5.12e4::DOUBLE, 0 FROM packed
  UNION ALL
  SELECT r.station_code, CASE WHEN score > 0 THEN mid ELSE lo END, CASE WHEN score > 0 THEN hi ELSE mid END, step + 1 FROM (
    SELECT q.station_code, lo, hi, step, (lo + hi) / 2 AS mid,
      1 / ((lo + hi) / 2) + mean_y - list_sum(list_transform(ys, lambda y: y * exp((lo + hi) / 2 * (y - top))))
        / list_sum(list_transform(ys, lambda y: exp((lo + hi) / 2 * (y - top)))) AS score
    FROM root q JOIN packed USING (station_code) WHERE step < 70) r),
weib AS (SELECT station_code, n, (lo + hi) / 2 AS beta,
  exp(-top - ln(list_sum(list_transform(ys, lambda y: exp((lo + hi) / 2 * (y - top)))) / n) / ((lo + hi) / 2)) AS alpha
  FROM root JOIN packed USING (station_code) WHERE step = 70)"""


def _points(grid: list[float]) -> str:
    rows = ", ".join(f"({p!r}::DOUBLE, {_z(p)!r}::DOUBLE)" for p in grid)
    return f"points(p, z) AS (VALUES {rows})"


CLOSED = """closed AS (
  SELECT station_code, 'lognormal_mom' AS model, p, z, exp(mu_log + sigma_log * z) AS q FROM ln_moments, points WHERE n_pos >= 3
  UNION ALL SELECT station_code, 'lognormal_3p', p, z, epsilon + exp(mu + sigma * z) FROM ln3, points
  UNION ALL SELECT station_code, 'weibull', p, z, pow(-ln(p), 1 / beta) / alpha FROM weib, points)"""
ALL_CLOSED = ", ".join([SERIES, LN.format(s="series"), LN3.format(s="series"), WEIBULL])


def _gamma_cdf(x: str, a: str) -> str:
    """Series of the incomplete gamma function with enough terms for the arguments met here."""
    terms = f"CAST(200 + greatest({x}, 0) * 2 AS BIGINT)"
    return (
        f"(CASE WHEN {x} <= 0 THEN 0.0 ELSE exp({a} * ln(greatest({x}, 1e-300)) - {x} - lgamma({a})) * "
        f"list_reduce(list_transform(range(1, {terms}), lambda idx_: {{'k': idx_, 'term': 0.0::DOUBLE, 'total': 0.0::DOUBLE}}), "
        f"lambda acc_, el_: {{'k': 0::BIGINT, 'term': acc_.term * {x} / ({a} + el_.k), 'total': acc_.total + acc_.term * {x} / ({a} + el_.k)}}, "
        f"{{'k': 0::BIGINT, 'term': 1 / {a}, 'total': 1 / {a}}}).total END)"
    )


def _gamma_flows(grid: list[float], label: str) -> str:
    """Pearson III quantiles by bisection of the distribution function."""
    below = f"{_gamma_cdf('((lo + hi) / 2)', 'lam')} < 1 - p"
    root = f"""gamma_root(station_code, p, lam, lo, hi, step) AS (
  SELECT station_code, p, lam, 0.0::DOUBLE, lam + 40 * sqrt(lam) + 40, 0 FROM pearson, points
  UNION ALL SELECT station_code, p, lam, CASE WHEN {below} THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {below} THEN hi ELSE (lo + hi) / 2 END, step + 1 FROM gamma_root WHERE step < 60)"""
    return "WITH RECURSIVE " + ", ".join([SERIES, PROFILE, _points(grid), root]) + (
        f" SELECT r.station_code, {label}, {_r('epsilon + (lo + hi) / 2 / alpha', 4)} AS q "
        "FROM gamma_root r JOIN pearson f ON r.station_code = f.station_code WHERE step = 60")


def _ks(fit: str, cdf: str) -> str:
    return f"""places AS (SELECT station_code, x, count(*) OVER (PARTITION BY station_code) AS n,
  row_number() OVER (PARTITION BY station_code ORDER BY x, t) AS i FROM series),
dist AS (SELECT station_code, n, i, {cdf} AS f FROM places JOIN {fit} USING (station_code)),
ks AS (SELECT station_code, CAST(any_value(n) AS INT) AS n, max(greatest(i / n - f, f - (i - 1) / n)) AS d FROM dist GROUP BY station_code)"""


_KS_OUT = f"""SELECT station_code, 7 AS test_id, n, {_r('d')} AS d, {_r('d * sqrt(n)')} AS lambda_stat, d * sqrt(n) < 1.36 AS result FROM ks"""

# ---- logs -------------------------------------------------------------------------------------

_BUCKET = "substr(md5(station_code), 1, 3)"
USERS = _one_series("users", "B", False)
SUPPLIERS = _one_series("suppliers", "C", False)


def _number(source: str, order: str) -> str:
    return f"row_number() OVER (ORDER BY {_BUCKET}, {order})"


RUNS = ", ".join([
    USERS, SUPPLIERS,
    LN.format(s="users").replace("ln_moments", "u1"), LN3.format(s="users"),
    LN.format(s="suppliers").replace("ln_moments", "s1"),
    """run1 AS (SELECT station_code, 2 AS d, 1 AS m, mu_log, sigma_log, NULL::DOUBLE AS epsilon, n, year_start, year_end FROM u1 WHERE n_pos >= 3
  UNION ALL SELECT l.station_code, 2, 2, mu, sigma, epsilon, l.n, year_start, year_end FROM ln3 l JOIN u1 USING (station_code)),
run2 AS (SELECT station_code, 2 AS d, 1 AS m, mu_log, sigma_log, NULL::DOUBLE AS epsilon, n, year_start, year_end FROM s1 WHERE n_pos >= 3)""",
    f"""log1 AS (SELECT {_number('run1', 'station_code, d, m')} AS id, * FROM run1),
fitted AS (SELECT * FROM log1 UNION ALL SELECT {_number('run2', 'station_code, d, m')} + (SELECT max(id) FROM log1), * FROM run2),
newest AS (SELECT *, CASE m WHEN 1 THEN 'Method of Moments' ELSE 'Maximum Likelihood' END AS method FROM fitted
  WHERE id IN (SELECT max(id) FROM fitted GROUP BY station_code, d, m))""",
])
_NAMES = "'Log-Normal' AS distribution, method, 'annual' AS frequency"
_FLOW = "CASE m WHEN 1 THEN exp(mu_log + sigma_log * z) ELSE epsilon + exp(mu_log + sigma_log * z) END"
PERIODS = f"periods(rp, z) AS (VALUES (100, {_z(0.01)!r}::DOUBLE), (1000, {_z(0.001)!r}::DOUBLE))"

OLD = "old AS (SELECT DISTINCT station_code, 'user' AS station_name, 'events' AS river_name FROM phen_rows)"

# ---- raw text ---------------------------------------------------------------------------------


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WHITE_SQL = "(" + " || ".join(f"chr({c})" for c in BLANKS) + ")"


def _tidy(c: str) -> str:
    na = ", ".join(_quote(t) for t in MISSING)
    trimmed = f"trim(trim(trim({c}, {_WHITE_SQL}), '\"'), {_WHITE_SQL})"
    return f"CASE WHEN {c} IN ({na}) THEN NULL ELSE {trimmed} END"


def _num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _whole(c: str) -> str:
    return f"({c} IS NULL OR {c} = floor({c}))"


def _raw(expressions: dict[str, str], extra: str = "l_returnflag, l_partkey") -> str:
    tidy = ", ".join(f"{_tidy(c)} AS {c}" for c in expressions)
    return f"raw AS (SELECT {_cols(expressions)}, {extra} FROM lineitem), tidy AS (SELECT {tidy}, {extra} FROM raw)"


_DATE = """numbers AS (SELECT * EXCLUDE (hydro_year, hydro_month, day), TRY_CAST(hydro_year AS DOUBLE) AS hydro_year,
  TRY_CAST(hydro_month AS DOUBLE) AS hydro_month, TRY_CAST(day AS DOUBLE) AS day, {month} AS month_given FROM tidy),
months AS (SELECT *, coalesce(month_given, (hydro_month + 9) % 12 + 1) AS calendar_month_n FROM numbers),
dated AS (SELECT *, TRY_CAST(printf('%04d-%02d-%02d 07:00:00', CAST(CASE WHEN calendar_month_n <= 10 THEN hydro_year ELSE hydro_year - 1 END AS INT),
  CAST(calendar_month_n AS INT), CAST(day AS INT)) AS TIMESTAMP) AS measured_at FROM months)"""
_DATE_CODZ = _DATE.format(month="TRY_CAST(calendar_month AS DOUBLE)")
_DATE_ZJAW = _DATE.format(month="NULL::DOUBLE")
_CODZ_TYPED = _DATE_CODZ + f""", typed AS (SELECT *, CASE WHEN {_num('water_level_cm')} = 9999 THEN NULL ELSE {_num('water_level_cm')} END AS lv,
  CASE WHEN {_num('flow_m3s')} >= 99999.999 THEN NULL ELSE {_num('flow_m3s')} END AS fl,
  CASE WHEN {_num('water_temp_c')} = 99.9 THEN NULL ELSE {_num('water_temp_c')} END AS tp FROM dated)"""
_CODZ_OUT = f"""SELECT station_code, station_name, river_name, {_CLOCK}, CAST(hydro_year AS INT) AS hydro_year,
  CAST(hydro_month AS INT) AS hydro_month, CAST(calendar_month_n AS INT) AS calendar_month, CAST(lv AS INT) AS water_level_cm,
  fl AS flow_m3s, tp AS water_temp_c FROM typed WHERE hydro_year IS NOT NULL AND hydro_month IS NOT NULL AND day IS NOT NULL
  AND measured_at IS NOT NULL AND {_whole('lv')} AND {_whole('day')} AND station_code <> ''"""
# Lines of the written files: over-long and blank ones go, short ones lack their last two fields.
_LINES = {
    **ad.RAW_CODZ,
    "water_temp_c": f"case when l_partkey % 223 = 0 then null else {ad.RAW_CODZ['water_temp_c']} end",
    "calendar_month": f"case when l_partkey % 223 = 0 then null else {ad.RAW_CODZ['calendar_month']} end",
}
_WHOLE_LINES = " AND NOT (l_partkey % 211 = 0) AND NOT (l_partkey % 227 = 0 AND l_partkey % 223 <> 0)"
_FILES = _with(_raw(_LINES), _CODZ_TYPED) + _CODZ_OUT + _WHOLE_LINES


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stats_annual"] = q["rebuild_stats"] = _with(MEAS, ANNUAL) + "SELECT * FROM annual"
    q["stats_monthly"] = _with(MEAS, MONTHLY) + "SELECT * FROM monthly"
    q["stats_seasonal"] = _with(MEAS, SEASONAL) + "SELECT * FROM seasonal"
    q["stats_alltime"] = _with(MEAS, MONTHLY, ALLTIME) + "SELECT * FROM alltime"
    q["seasonal_sorted"] = _with(MEAS, SEASONAL) + (
        "SELECT station_code, hydro_year, season, CASE season WHEN 'winter' THEN 0 ELSE 1 END AS place, WQ FROM seasonal")
    q["station_daily"] = _with(MEAS) + f"SELECT * REPLACE ({_CLOCK}) FROM measurements WHERE station_code = '7'"
    q["station_ice"] = _with(PHEN) + f"SELECT * REPLACE ({_CLOCK}) FROM phenomena WHERE station_code = '7'"
    q["station_monthly"] = _with(MEAS, MONTHLY) + "SELECT * FROM monthly WHERE station_code = '7' ORDER BY year, month"
    q["station_seasons"] = _with(MEAS, SEASONAL) + "SELECT * FROM seasonal WHERE station_code = '7'"
    q["stations_min_years"] = _with(SERIES) + (
        "SELECT station_code, 'Station ' || station_code AS station_name, substr(station_code, 1, 1) AS river_name "
        "FROM series GROUP BY station_code HAVING count(*) > 30")
    q["top_peak_flow"] = _with(MEAS, MONTHLY, ALLTIME, GAUGES) + (
        "SELECT station_code, station_name, river_name, NNQ, SNQ, SSQ, SWQ, WWQ FROM alltime JOIN gauges USING (station_code) "
        "ORDER BY WWQ DESC NULLS LAST, station_code LIMIT 10")
    q["ice_days"] = _with(PHEN, GAUGES) + (
        "SELECT station_name, river_name, count(*) AS ice_days FROM phenomena JOIN gauges USING (station_code) "
        "WHERE ice_phenomenon_code IS NOT NULL GROUP BY 1, 2 ORDER BY ice_days DESC, station_name, river_name LIMIT 10")
    q["series_descriptor"] = _with(SERIES) + (
        "SELECT station_code, CAST(min(t) AS INT) AS year_start, CAST(max(t) AS INT) AS year_end, CAST(count(x) AS INT) AS n FROM series GROUP BY station_code")
    q["annual_maxima"] = _with(MEAS, ANNUAL) + "SELECT station_code, hydro_year AS t, WQ AS x FROM annual WHERE WQ IS NOT NULL"
    q["winter_maxima"] = _with(MEAS, SEASONAL) + (
        "SELECT station_code, hydro_year AS t, WQ AS x FROM seasonal WHERE WQ IS NOT NULL AND season = 'winter'")
    q["table_counts"] = _with(MEAS, PHEN, GAUGES) + (
        "SELECT 'gauges_list' AS table_name, count(*) AS row_count FROM gauges UNION ALL SELECT 'measurements', count(*) FROM measurements "
        "UNION ALL SELECT 'phenomena', count(*) FROM phenomena")
    q["sql_view"] = _with(PHEN, GAUGES) + (
        "SELECT river_name, count(*) AS days, max(ice_thickness_cm) AS thickest FROM phenomena JOIN gauges USING (station_code) GROUP BY river_name")
    q["refresh_set"] = _with(SERIES) + "SELECT DISTINCT station_code FROM series"

    q["scan_codz"] = q["scan_zip"] = _FILES
    q["scan_zjaw"] = _with(_raw(ad.RAW_ZJAW), _DATE_ZJAW) + f"""SELECT station_code, station_name, river_name, {_CLOCK},
  CAST(hydro_year AS INT) AS hydro_year, CAST(hydro_month AS INT) AS hydro_month,
  CAST(nullif({_num('ice_thickness_cm')}, 999) AS INT) AS ice_thickness_cm, nullif(ice_phenomenon_code, '') AS ice_phenomenon_code,
  CAST({_num('ice_phenomenon_pct')} AS INT) AS ice_phenomenon_pct, nullif(overgrowth_code, '') AS overgrowth_code
  FROM dated WHERE hydro_year IS NOT NULL AND measured_at IS NOT NULL AND {_whole('day')} AND station_code <> ''"""
    q["scan_first_files"] = f"""WITH f AS (SELECT 'codz_' || {ad.Y} || '_' || lpad(CAST({ad.M} AS VARCHAR), 2, '0') || '.csv' AS file FROM lineitem)
  SELECT file, count(*) AS rows FROM f WHERE file IN (SELECT DISTINCT file FROM f ORDER BY file LIMIT 12) GROUP BY file"""
    q["clean_text"] = _with(_raw(ad.RAW_CODZ)) + f"SELECT {', '.join(ad.RAW_CODZ)} FROM tidy"
    q["clean_documents"] = (
        f"SELECT doc_id, CAST(length(c) AS INT) AS cleaned_chars, md5(c) AS digest FROM (SELECT doc_id, {_tidy('text')} AS c FROM documents)")
    q["numeric_coercion"] = _with(_raw(ad.RAW_CODZ)) + "SELECT station_code, " + ", ".join(
        f"{_num(c)} AS {c}" for c in ("hydro_year", "hydro_month", "day", "calendar_month", "water_level_cm", "flow_m3s", "water_temp_c")) + " FROM tidy"
    q["hydro_calendar"] = f"""SELECT CAST(y AS INT) AS y, CAST(m AS INT) AS m, CAST(d AS INT) AS d, CAST(CASE WHEN m >= 11 THEN y + 1 ELSE y END AS INT) AS hydro_year,
  CAST(CASE WHEN m >= 11 THEN m - 10 ELSE m + 2 END AS INT) AS hydro_month, CAST(m AS INT) AS calendar_month, CAST(y AS INT) AS calendar_year,
  CASE WHEN m IN (11, 12, 1, 2, 3, 4) THEN 'winter' ELSE 'summer' END AS season FROM (SELECT {ad.Y} AS y, {ad.M} AS m, {ad.D} AS d FROM lineitem)"""
    q["measured_at"] = f"""SELECT l_orderkey, l_linenumber, CAST({ad.Y} + CASE WHEN {ad.M} >= 11 THEN 1 ELSE 0 END AS INT) AS hydro_year,
  CAST({ad.M} AS INT) AS calendar_month, CAST({ad.D} + 3 AS INT) AS day, {_CLOCK} FROM (SELECT *, TRY_CAST(printf('%04d-%02d-%02d 07:00:00', {ad.Y}, {ad.M}, {ad.D} + 3) AS TIMESTAMP) AS measured_at
  FROM lineitem) WHERE measured_at IS NOT NULL"""
    q["sentinels"] = """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_quantity AS INT) END AS water_level_cm,
  CASE WHEN l_linenumber IN (6, 7) OR l_extendedprice >= 99999.999 THEN NULL ELSE l_extendedprice END AS flow_m3s,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_tax END AS water_temp_c,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS INT) END AS ice_thickness_cm,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS code FROM lineitem"""
    q["reject_audit"] = _with(_raw(ad.RAW_CODZ), _CODZ_TYPED) + f"""SELECT l_returnflag AS file, count(*) FILTER (r IS NULL) AS rows, count(*) FILTER (r IS NOT NULL) AS rejected,
  string_agg(DISTINCT r, '; ' ORDER BY r) AS reasons, count(*) FILTER (r IS NOT NULL) = 0 AS ok FROM (SELECT l_returnflag, CASE
  WHEN station_code = '' THEN 'missing station' WHEN hydro_year IS NULL OR hydro_month IS NULL OR day IS NULL THEN 'missing date part'
  WHEN NOT {_whole('day')} THEN 'day not integral' WHEN NOT {_whole('lv')} THEN 'water_level_cm not integral'
  WHEN measured_at IS NULL THEN 'no such date' END AS r FROM typed) GROUP BY 1"""
    q["load_twice"] = f"""WITH {_raw(ad.RAW_CODZ, 'l_orderkey, l_linenumber, l_partkey')}, {_CODZ_TYPED},
  good AS (SELECT * FROM ({_CODZ_OUT.replace('SELECT station_code', f'SELECT l_orderkey, {_LINE_ORDER} AS place, station_code', 1)})),
  loads AS (SELECT *, 1 AS load FROM good WHERE l_orderkey % 3 <> 0 UNION ALL SELECT *, 2 AS load FROM good WHERE l_orderkey % 3 <> 1),
  ranked AS (SELECT *, row_number() OVER (ORDER BY load, place) AS o FROM loads),
  names AS (SELECT station_code, arg_min({{'a': station_name, 'b': river_name}}, o) AS f FROM ranked GROUP BY 1),
  merged AS (SELECT station_code, measured_at, arg_min({{'y': hydro_year, 'm': hydro_month, 'c': calendar_month}}, o) AS f,
    arg_max({{'w': water_level_cm, 'q': flow_m3s, 't': water_temp_c}}, o) AS l FROM ranked GROUP BY ALL)
  SELECT station_code, n.f.a AS station_name, n.f.b AS river_name, measured_at, m.f.y AS hydro_year, m.f.m AS hydro_month, m.f.c AS calendar_month,
    m.l.w AS water_level_cm, m.l.q AS flow_m3s, m.l.t AS water_temp_c FROM merged m JOIN names n USING (station_code)"""
    q["gauges_first_wins"] = f"""SELECT station_code, f.a AS station_name, f.b AS river_name FROM (SELECT CAST(l_suppkey AS VARCHAR) AS station_code,
  arg_min({{'a': 'name ' || l_orderkey, 'b': l_returnflag}}, {_LINE_ORDER}) AS f FROM lineitem GROUP BY 1)"""
    q["measurements_upsert"] = _with(MEAS) + f"SELECT * REPLACE ({_CLOCK}, {_r('water_temp_c')} AS water_temp_c) FROM measurements"
    q["phenomena_upsert"] = _with(PHEN) + f"SELECT * REPLACE ({_CLOCK}) FROM phenomena"
    uuid = "concat_ws('-', substr(md5({c}), 1, 8), substr(md5({c}), 9, 4), substr(md5({c}), 13, 4), substr(md5({c}), 17, 4), substr(md5({c}), 21, 12))".format(c="station_code")
    q["gauge_uuid"] = _with(GAUGES) + f"SELECT *, {uuid} AS uuid FROM gauges"
    q["insert_absent"] = q["merge_export"] = _with(PHEN_ROWS, OLD, GAUGES) + (
        "SELECT * FROM gauges UNION ALL SELECT * FROM old WHERE station_code NOT IN (SELECT station_code FROM gauges)")

    q["pk_violations"] = _with(ROWS) + f"SELECT station_code, {_CLOCK}, copies FROM (SELECT station_code, measured_at, count(*) AS copies FROM meas_rows GROUP BY ALL HAVING count(*) > 1)"
    q["fk_orphans"] = _with(PHEN_ROWS, GAUGES) + (
        "SELECT station_code, count(*) AS rows FROM phen_rows WHERE station_code NOT IN (SELECT station_code FROM gauges) GROUP BY 1")
    q["null_report"] = _with(ROWS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM meas_rows"
        for c in ("station_code", "measured_at", "water_level_cm", "flow_m3s", "water_temp_c"))
    q["check_violations"] = _with(SERIES, LN.format(s="series")) + (
        f"SELECT station_code, 50 AS return_period, {_r(f'exp(mu_log + sigma_log * {_z(0.02)!r}::DOUBLE)', 4)} AS q FROM ln_moments WHERE n_pos >= 3")
    dup = "(SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1))"
    lines = []
    for t, src, k, nn in (
        ("gauges_list", "gauges", "station_code", []),
        ("measurements", "meas_rows", "station_code,measured_at", ["station_code", "measured_at"]),
        ("phenomena", "phen_rows", "station_code,measured_at", ["station_code", "measured_at"]),
        ("stats_annual", "annual", "station_code,hydro_year", ["station_code", "hydro_year", "mes_count"]),
    ):
        lines.append(f"SELECT '{t}' AS table_name, 'key {k}' AS check_name, {dup.format(t=src, k=k)} AS violations")
        lines += [f"SELECT '{t}', 'not null {c}', (SELECT count(*) FROM {src} WHERE {c} IS NULL)" for c in nn]
    q["quality_report"] = _with(MEAS, PHEN_ROWS, GAUGES, ANNUAL) + " UNION ALL ".join(lines)

    q["hazen"] = _with(SERIES) + f"""SELECT station_code, t, x, CAST(m AS INT) AS m, {_r('(n - m + 0.5) / n', 9)} AS p FROM (SELECT *,
  row_number() OVER (PARTITION BY station_code ORDER BY x, t) AS m, count(*) OVER (PARTITION BY station_code) AS n FROM series)"""
    q["split_groups"] = _with(SERIES) + """SELECT station_code, CAST(grp AS INT) AS grp, count(*) AS size, min(t) AS first_t, max(t) AS last_t FROM
  (SELECT *, ntile(3) OVER (PARTITION BY station_code ORDER BY t) AS grp FROM series) GROUP BY 1, 2"""
    q["split_label"] = _with(SERIES) + """SELECT station_code, t AS split_t FROM (SELECT *, row_number() OVER (PARTITION BY station_code ORDER BY t) AS i,
  count(*) OVER (PARTITION BY station_code) AS n FROM series) WHERE i = (n + 1) // 2 + 1"""
    q["mid_ranks"] = _with(SERIES, RANKED) + "SELECT station_code, t, x, ties, mid_rank FROM ranked"
    q["median_runs"] = _with(SERIES, SIGNS) + "SELECT * FROM runs"
    q["ecdf_bounds"] = _with(SERIES) + f"""SELECT station_code, t, {_r('(i - 1) / n', 9)} AS below, {_r('i / n', 9)} AS upto FROM (SELECT *,
  row_number() OVER (PARTITION BY station_code ORDER BY x, t) AS i, count(*) OVER (PARTITION BY station_code) AS n FROM series)"""
    q["series_peak"] = _with(SERIES) + "SELECT station_code, x AS WWQ, t AS peak_t FROM series QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY x DESC, t DESC) = 1"
    q["concordance"] = _with(SERIES, PAIRS) + "SELECT * FROM pairs"

    q["grubbs_beck"] = "WITH RECURSIVE " + ", ".join([SERIES, WHOLE, _BISECT]) + f""" SELECT station_code, 1 AS test_id, period_start, period_end, n,
  {_r('k')} AS statistic, NULL::DOUBLE AS p_value, CASE WHEN labels IS NULL THEN 'No outliers (n=' || n || ', α=10%)'
  ELSE 'Outliers detected (n=' || n || ', α=10%): ' || labels || ' m³/s' END AS result_notes, labels IS NULL AS result FROM whole JOIN hits USING (station_code)"""
    h = "(12 / (n * (n + 1.0::DOUBLE)) * squares - 3 * (n + 1)) / (1 - tie_term / (pow(n, 3) - n))"
    q["kruskal_wallis"] = _test(
        RANKED + """, parts AS (SELECT station_code, grp, sum(mid_rank) AS r, count(*) AS c, sum(ties * ties - 1)::DOUBLE AS tt, min(t) AS t0 FROM ranked GROUP BY 1, 2),
kw AS (SELECT station_code, sum(r * r / c) AS squares, sum(tt) AS tie_term, min(t0) FILTER (grp = 2) AS split_t FROM parts GROUP BY 1)""",
        2, "kw", h, _two_sided("sqrt(greatest(stat, 0))"),
        "'k=2 groups split at ' || split_t || ' (n=' || n || ', α=5%, p=' || " + _p4("p") + " || ')'")
    q["wald_wolfowitz"] = _test(
        SIGNS + ", ww AS (SELECT station_code, n1::DOUBLE AS n1, n2::DOUBLE AS n2, runs FROM runs WHERE n1 + n2 >= 2)", 4, "ww",
        "(runs - (2 * n1 * n2 / (n1 + n2) + 1)) / sqrt(2 * n1 * n2 * (2 * n1 * n2 - n1 - n2) / (pow(n1 + n2, 2) * (n1 + n2 - 1)))",
        _two_sided("stat"), _NOTES)
    q["mann_kendall"] = _test(
        PAIRS + ", mk AS (SELECT * FROM pairs)", 5, "mk", "(s - sign(s)) / sqrt(n * (n - 1.0::DOUBLE) * (2 * n + 5) / 18)", _two_sided("stat"), _NOTES)
    q["spearman"] = _test(
        RANKED + ", sp AS (SELECT station_code, corr(mid_rank, i) AS rho FROM ranked GROUP BY 1 HAVING count(*) >= 3)", 6, "sp", "rho",
        f"1 - {_student_central('atan(abs(stat) / sqrt(1 - stat * stat))', '(n - 2)')}",
        "'ρ=' || printf('%.4f', stat) || ', ' || " + _NOTES)
    results = []
    for name in ("grubbs_beck", "kruskal_wallis", "wald_wolfowitz", "mann_kendall", "spearman"):
        results.append(f"SELECT 'WQ_annual' AS series_type, station_code, test_id, period_start, period_end, result_notes, result FROM ({q[name]}) WHERE n > {MIN_COUNT}")
    q["test_results"] = " UNION ALL ".join(results)
    run = f"SELECT 'WQ_annual' AS series_type, station_code, test_id, result, {_number('', 'station_code')} AS i FROM ({q['mann_kendall']})"
    q["append_results"] = f"WITH r AS ({run}) SELECT i AS id, * EXCLUDE (i) FROM r UNION ALL SELECT i + (SELECT max(i) FROM r), * EXCLUDE (i) FROM r"

    q["fit_lognormal_mom"] = _with(SERIES, LN.format(s="series")) + (
        f"SELECT station_code, year_start, year_end, n, {_r('mu_log')} AS mu_log, {_r('sigma_log')} AS sigma_log FROM ln_moments WHERE n_pos >= 3")
    q["fit_lognormal_3p"] = _with(SERIES, LN3.format(s="series")) + (
        f"SELECT station_code, n, {_r('epsilon')} AS epsilon, {_r('mu')} AS mu, {_r('sigma')} AS sigma FROM ln3")
    q["pearson_profile"] = _with(SERIES, PROFILE) + f"SELECT station_code, grid_no, {_r('epsilon', 4)} AS epsilon, {_r('loglik', 4)} AS loglik FROM prof"
    q["fit_pearson3"] = _with(SERIES, PROFILE) + (
        "SELECT station_code, (SELECT CAST(count(*) AS INT) FROM series s WHERE s.station_code = pearson.station_code) AS n, grid_no, "
        + ", ".join(f'{_r(c, 5)} AS "{a}"' for c, a in (("epsilon", "epsilon"), ("lam", "lambda"), ("alpha", "alpha"), ("loglik", "loglik"))) + " FROM pearson")
    q["fit_weibull"] = "WITH RECURSIVE " + ", ".join([SERIES, WEIBULL]) + f" SELECT station_code, n, {_r('alpha', 9)} AS alpha, {_r('beta')} AS beta FROM weib"
    q["fit_failures"] = _with(SERIES, LN3.format(s="series")) + """SELECT station_code, model, reason FROM (
  SELECT station_code, unnest(['lognormal_mom', 'lognormal_3p', 'pearson3', 'weibull']) AS model, unnest([
    CASE WHEN p < 3 THEN 'fewer than 3 usable values' END,
    CASE WHEN n < 3 THEN 'fewer than 3 usable values' WHEN low <= 0 THEN 'values must be positive' WHEN epsilon IS NULL THEN 'largest plus smallest equals twice the median'
         WHEN epsilon >= low THEN 'bound not below the smallest value' END,
    CASE WHEN p < 3 THEN 'fewer than 3 usable values' END,
    CASE WHEN n < 3 THEN 'fewer than 3 usable values' WHEN low <= 0 THEN 'values must be positive' END]) AS reason
  FROM bound JOIN (SELECT station_code, count(*) FILTER (x > 0) AS p FROM series GROUP BY 1) USING (station_code)) WHERE reason IS NOT NULL"""
    q["design_flows"] = "WITH RECURSIVE " + ", ".join([ALL_CLOSED, _points([0.01, 0.001]), CLOSED]) + (
        f" SELECT station_code, model, CAST(round(1 / p) AS INT) AS return_period, {_r('q', 4)} AS q FROM closed")
    q["design_flows_pearson3"] = _gamma_flows([0.01, 0.001], "CAST(round(1 / p) AS INT) AS return_period")
    q["quantile_curve_pearson3"] = _gamma_flows(CURVE_GRID, "p")
    q["quantile_curve"] = "WITH RECURSIVE " + ", ".join([ALL_CLOSED, _points(CURVE_GRID), CLOSED]) + (
        f" SELECT station_code, model, p, {_r('q', 4)} AS q FROM closed")
    lo, hi, n = 0.0005, 0.9995, 1000
    grid = [lo + i * ((hi - lo) / (n - 1)) for i in range(n - 1)] + [hi]
    q["plot_curve"] = "WITH RECURSIVE " + ", ".join([ALL_CLOSED, _points(grid), CLOSED]) + (
        " SELECT station_code, model, count(q) AS points, round(min(q), 3) AS lowest, round(max(q), 3) AS highest, round(avg(q), 3) AS mean_q, "
        "round(max(-z), 6) AS max_z FROM closed GROUP BY 1, 2")
    q["bootstrap_ci"] = _with(
        SERIES, """packed AS (SELECT station_code, list(x ORDER BY x) AS xs, count(*) AS n FROM series WHERE x > 0 GROUP BY 1 HAVING count(*) >= 3)""",
        f"""draws AS (SELECT station_code, rep, xs[1 + CAST(('0x' || substr(md5(concat_ws('|', '42', station_code, CAST(rep AS VARCHAR), CAST(j AS VARCHAR))), 1, 8)) AS BIGINT) % n] AS x
  FROM (SELECT *, unnest(range(n)) AS j FROM (SELECT *, unnest(range({SAMPLES})) AS rep FROM packed)))""",
        """stat AS (SELECT station_code, rep, avg(ln(x)) AS mu, stddev_samp(ln(x)) AS sigma, min(x) AS low,
  (max(x) * min(x) - median(x) * median(x)) / nullif(max(x) + min(x) - 2 * median(x), 0) AS epsilon FROM draws GROUP BY 1, 2)""",
        """three AS (SELECT d.station_code, d.rep, any_value(epsilon) AS epsilon, avg(ln(x - epsilon)) AS mu, stddev_samp(ln(x - epsilon)) AS sigma
  FROM draws d JOIN stat s ON d.station_code = s.station_code AND d.rep = s.rep WHERE epsilon < low GROUP BY 1, 2)""",
        _points(ci_grid()),
        """curves AS (SELECT station_code, 'lognormal_mom' AS model, p, exp(mu + sigma * z) AS q FROM stat, points
  UNION ALL SELECT station_code, 'lognormal_3p', p, epsilon + exp(mu + sigma * z) FROM three, points WHERE sigma > 0)""",
    ) + (f"SELECT station_code, model, p, {_r('quantile_cont(q, 0.05)', 4)} AS q_lower, {_r('quantile_cont(q, 0.95)', 4)} AS q_upper, "
         "CAST(count(q) AS INT) AS n_valid FROM curves GROUP BY 1, 2, 3")
    q["batch_estimation"] = _with(SERIES, LN3.format(s="series")) + f"""SELECT {_number('', 'station_code, distribution_id, estimation_method_id')} AS id, * FROM (
  SELECT e.station_code, d AS distribution_id, m AS estimation_method_id, 1 AS frequency_id, e.n, CAST(year_start AS INT) AS year_start, CAST(year_end AS INT) AS year_end
  FROM ends e JOIN (SELECT station_code, min(t) AS year_start, max(t) AS year_end FROM series GROUP BY 1) USING (station_code)
  CROSS JOIN (VALUES (2, 1), (2, 2), (3, 2), (6, 2)) v(d, m)
  WHERE e.n > {MIN_COUNT} AND (NOT (d = 2 AND m = 2) OR e.station_code IN (SELECT station_code FROM ln3)))"""
    q["lambda_kolmogorov_weibull"] = "WITH RECURSIVE " + ", ".join([
        SERIES, WEIBULL, _ks("(SELECT station_code, alpha, beta FROM weib)", "1 - exp(-pow(alpha * x, beta))")]) + " " + _KS_OUT
    q["lambda_kolmogorov_lognormal"] = _with(
        SERIES, "two AS (SELECT station_code, avg(ln(x)) AS mu, stddev_samp(ln(x)) AS sigma FROM series WHERE x > 0 GROUP BY 1 HAVING count(*) >= 3)",
        "unit AS (SELECT s.station_code, s.t, s.x AS raw, (ln(s.x) - mu) / sigma AS z FROM series s JOIN two USING (station_code) WHERE s.x > 0)",
        _ks("(SELECT station_code, t, " + _normal_cdf("z") + " AS cdf FROM unit)", "coalesce(cdf, 0)").replace("USING (station_code)", "USING (station_code, t)").replace(
            "SELECT station_code, x, count", "SELECT station_code, t, x, count")) + _KS_OUT
    q["lambda_kolmogorov_lognormal_3p"] = _with(
        SERIES, LN3.format(s="series"),
        "unit AS (SELECT s.station_code, s.t, (ln(s.x - f.epsilon) - f.mu) / f.sigma AS z FROM series s JOIN ln3 f USING (station_code))",
        _ks("(SELECT station_code, t, " + _normal_cdf("z") + " AS cdf FROM unit)", "cdf").replace("USING (station_code)", "USING (station_code, t)").replace(
            "SELECT station_code, x, count", "SELECT station_code, t, x, count")) + _KS_OUT
    q["lambda_kolmogorov"] = _with(SERIES, PROFILE, _ks("pearson", _gamma_cdf("((x - epsilon) * alpha)", "lam"))) + _KS_OUT

    q["export_stations"] = _with(GAUGES) + f"SELECT station_code, station_name, river_name, NULL::DOUBLE AS lat, NULL::DOUBLE AS lon, {uuid} AS uuid FROM gauges"
    q["export_alltime"] = _with(MEAS, MONTHLY, ALLTIME, GAUGES) + "SELECT a.* FROM alltime a JOIN gauges USING (station_code)"
    q["export_estimations"] = _with(RUNS) + (
        f"SELECT station_code, {_NAMES}, CASE m WHEN 1 THEN {_r('mu_log')} END AS mu_log, CASE m WHEN 1 THEN {_r('sigma_log')} END AS sigma_log, n, year_start, year_end FROM newest")
    q["export_flows"] = _with(RUNS, PERIODS) + (
        f"SELECT station_code, {_NAMES}, rp AS return_period, 1.0::DOUBLE / rp AS probability, round({_FLOW}, 3) AS q_estimated_m3s FROM newest, periods")
    q["latest_fit"] = _with(RUNS) + (
        "SELECT id AS fitted_id, station_code, d AS distribution_id, 'Log-Normal' AS distribution, m AS estimation_method_id, method FROM newest")
    q["latest_fit_station"] = q["latest_fit"] + " WHERE station_code = '7'"
    q["replace_export"] = _with(RUNS, PERIODS, f"""e1 AS (SELECT {_number('', "station_code, method")} AS id, * FROM (
    SELECT *, CASE m WHEN 1 THEN 'Method of Moments' ELSE 'Maximum Likelihood' END AS method FROM run1)),
e2 AS (SELECT {_number('', "station_code, method")} + (SELECT max(id) FROM e1) AS id, * FROM (SELECT *, 'Method of Moments' AS method FROM run2)),
est AS (SELECT * FROM e1 WHERE station_code NOT IN (SELECT station_code FROM e2) UNION ALL SELECT * FROM e2)""") + (
        f"SELECT id, station_code, {_NAMES}, n, rp AS return_period, 1.0::DOUBLE / rp AS probability, {_r(_FLOW, 4)} AS q_estimated_m3s FROM est, periods")
    bands = """banded AS (SELECT f.id AS fitted_id, f.station_code FROM newest f JOIN (SELECT DISTINCT station_code FROM suppliers) USING (station_code) WHERE m = 1)"""
    q["latest_ci"] = _with(RUNS, bands) + "SELECT fitted_id AS fitted_distribution_id, 0.1::DOUBLE AS alpha, 5000 AS n_bootstrap, station_code FROM banded"
    q["plot_bundle"] = _with(RUNS, bands, GAUGES) + f"""SELECT station_code, station_name, CASE WHEN station_name IS NOT NULL THEN {uuid} END AS uuid, u.n,
  CASE WHEN f.id IS NOT NULL THEN 'Log-Normal' END AS distribution, method, b.fitted_id IS NOT NULL AS has_band,
  CASE WHEN u.n IS NULL THEN 'no WQ data' WHEN f.id IS NULL THEN 'no fitted params' WHEN station_name IS NULL THEN 'not in gauges_list' END AS skip_reason
  FROM u1 u FULL JOIN gauges USING (station_code) LEFT JOIN newest f USING (station_code) LEFT JOIN banded b ON b.fitted_id = f.id"""
    usage = []
    for label, rows, src, col in (
        ("distributions", DISTRIBUTIONS, "fitted", "d"), ("estimation_methods", ESTIMATION_METHODS, "fitted", "m"),
        ("frequencies", FREQUENCIES, "(SELECT 1 AS f FROM fitted)", "f"),
        ("stat_tests", STAT_TESTS, "(SELECT unnest([5, 6]) AS k FROM (SELECT DISTINCT station_code FROM series))", "k"),
    ):
        values = ", ".join(f"({i}, {_quote(name)})" for i, name in sorted(rows.items()))
        usage.append(f"SELECT '{label}' AS catalogue, c.id, c.name, (SELECT count(*) FROM {src} u WHERE u.{col} = c.id) AS uses FROM (VALUES {values}) c(id, name)")
    q["catalogue_usage"] = _with(RUNS, SERIES) + " UNION ALL ".join(usage)

    newton = (
        f"list_reduce([p, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[], lambda z, i: z - ({_normal_cdf('z')} - p) / {_phi('z')}, "
        "CAST(4.91 * (pow(p, 0.14) - pow(1 - p, 0.14)) AS DOUBLE))"
    )
    q["plot_points"] = _with(SERIES) + f"""SELECT station_code, t, x, {_r('p', 9)} AS p, {_r(newton)} AS z FROM (SELECT *, (count(*) OVER (PARTITION BY station_code)
  - row_number() OVER (PARTITION BY station_code ORDER BY x, t) + 0.5::DOUBLE) / count(*) OVER (PARTITION BY station_code) AS p FROM series)"""
    marks = [("line", p, label) for p, label in plots.REFERENCE_LINES.items()] + [("tick", p, label) for p, label in plots.AXIS_TICKS.items()]
    rows = ", ".join(f"('{k}', {p!r}::DOUBLE, {_quote(label)}, {_z(p)!r}::DOUBLE)" for k, p, label in marks)
    q["plot_marks"] = _with(SERIES, LN.format(s="series"), f"marks(kind, p, label, z) AS (VALUES {rows})") + (
        f"SELECT station_code, kind, label, p, {_r('-z')} AS z, {_r('exp(mu_log + sigma_log * z)', 4)} AS q FROM ln_moments, marks WHERE n_pos >= 3")
    return q


ORACLE: dict[str, str] = _sql()
