"""NumPy kernels for what Spark's expressions cannot do well: gamma quantiles, Weibull shape.

Each works on whole Arrow batches. Spark decides which rows a task sees.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

_EPS = 1e-16


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Γ for positive arrays below 1e35: shift by eight, then Stirling's series."""
    x = np.asarray(x, dtype=float)
    y = x + 8.0
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    r2 = 1.0 / (y * y)
    series = 1 / 12 - r2 * (1 / 360 - r2 * (1 / 1260 - r2 * (1 / 1680 - r2 / 1188)))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series / y - np.log(product)


def normal_quantile(p: np.ndarray) -> np.ndarray:
    inv = NormalDist().inv_cdf
    return np.fromiter((inv(v) for v in np.ravel(p)), float, np.size(p)).reshape(np.shape(p))


def gamma_cdf(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma: series below a + 1, continued fraction above."""
    x, a = np.broadcast_arrays(np.asarray(x, float), np.asarray(a, float))
    out = np.where(np.isnan(x) | np.isnan(a), np.nan, np.where(x > 0, 1.0, 0.0))
    low = (x > 0) & (x < a + 1.0)
    if low.any():
        out[low] = _series(x[low], a[low])
    high = (x >= a + 1.0) & np.isfinite(x)
    if high.any():
        out[high] = 1.0 - _fraction(x[high], a[high])
    return out


def _scale(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    return np.exp(a * np.log(x) - x - log_gamma(a))


def _series(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    term = 1.0 / a
    total = term.copy()
    k = 0
    while k < 100_000:
        k += 1
        term = term * x / (a + k)
        total += term
        if np.all(term < total * _EPS):
            break
    # what has not settled is no number, and its fit gets a reason
    return np.where(term < total * _EPS, total, np.nan) * _scale(x, a)


def _fraction(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Lentz's evaluation of the upper tail."""
    b = x + 1.0 - a
    c = np.full_like(x, 1e300)
    d = 1.0 / b
    h = d.copy()
    for i in range(1, 100_000):
        an = -i * (i - a)
        b = b + 2.0
        d = an * d + b
        d = 1.0 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = b + an / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        step = d * c
        h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return np.where(np.abs(step - 1.0) < 1e-12, h, np.nan) * _scale(x, a)


def gamma_quantile(p: np.ndarray, a: np.ndarray) -> np.ndarray:
    """x with gamma_cdf(x, a) = p: Newton in ln x kept inside a bracket."""
    p, a = np.broadcast_arrays(np.asarray(p, float), np.asarray(a, float))
    ok = (p > 0) & (p < 1) & (a > 0) & np.isfinite(a)
    out = np.where(p == 0, 0.0, np.where(p == 1, np.inf, np.nan))
    if not ok.any():
        return out
    p, a = p[ok], a[ok]
    z = normal_quantile(p)
    c = 1.0 / (9.0 * a)
    cube = 1.0 - c + z * np.sqrt(c)
    small = (np.log(p) + log_gamma(a + 1.0)) / a
    guess = np.where(cube > 0.2, np.log(a) + 3.0 * np.log(np.maximum(cube, 0.2)), small)
    lo, hi = np.minimum(guess, small) - 2.0, np.log(a + 40.0 * np.sqrt(a) + 800.0)
    u = np.clip(guess, lo, hi)
    log_norm = log_gamma(a)
    active = np.arange(len(p))
    for _ in range(100):
        x = np.exp(u[active])
        aa = a[active]
        gap = gamma_cdf(x, aa) - p[active]
        above = gap > 0
        hi[active[above]] = u[active[above]]
        lo[active[~above]] = u[active[~above]]
        slope = np.exp(aa * u[active] - x - log_norm[active])
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            new = u[active] - gap / slope
        inside = (new >= lo[active]) & (new <= hi[active])
        new = np.where(inside, new, (lo[active] + hi[active]) / 2.0)
        moved = np.abs(new - u[active])
        u[active] = new
        going = (moved > 1e-14 * np.maximum(1.0, np.abs(new))) & (gap != 0)
        far = active[going & (moved > 1e-9 * np.maximum(1.0, np.abs(new)))]
        active = active[going]
        if not len(active):
            break
    else:
        u[far] = np.nan
    out[ok] = np.exp(u)
    return out


def student_central(angle: float, df: int) -> float:
    """P(|T| < tan(angle) * sqrt(df)) as a finite trigonometric sum."""
    odd = df % 2
    cosine = math.cos(angle)
    term = total = cosine if odd else 1.0
    for j in range(1, (df - 1) // 2 if odd else df // 2):
        term *= cosine * cosine * (2 * j + odd - 1) / (2 * j + odd)
        total += term
    if df == 1:
        total = 0.0
    value = math.sin(angle) * total
    return (angle + value) * 2 / math.pi if odd else value


@lru_cache(maxsize=4096)
def grubbs_critical(n: int, alpha: float) -> float:
    """K_n of the two-sided outlier test on n values."""
    lo, hi = 0.0, math.pi / 2
    for _ in range(60):
        mid = (lo + hi) / 2
        if 1.0 - student_central(mid, n - 2) < alpha / n:
            hi = mid
        else:
            lo = mid
    slope = math.tan((lo + hi) / 2) ** 2
    return (n - 1) / math.sqrt(n) * math.sqrt(slope / (1.0 + slope))


def weibull_shape(log_y: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Root of the shape score for many weighted samples laid end to end.

    ``starts`` holds the first position of each sample. The score falls from +inf, so the root is
    unique. NaN where it has no sign change up to the largest bracket.
    """
    sizes = np.diff(np.append(starts, len(log_y)))
    total = np.add.reduceat(weight, starts)
    mean = np.add.reduceat(weight * log_y, starts) / total
    peak = np.maximum.reduceat(np.where(weight > 0, log_y, -np.inf), starts)
    shifted = np.where(weight > 0, log_y - np.repeat(peak, sizes), 0.0)

    def moments(beta: np.ndarray):
        e = weight * np.exp(np.repeat(beta, sizes) * shifted)
        s0 = np.add.reduceat(e, starts)
        s1 = np.add.reduceat(e * shifted, starts) / s0
        s2 = np.add.reduceat(e * shifted * shifted, starts) / s0
        score = 1.0 / beta + (mean - peak) - s1
        return score, -1.0 / (beta * beta) - (s2 - s1 * s1)

    lo = np.full(len(starts), 1e-3)
    hi = np.full(len(starts), 1e2)
    open_ = np.ones(len(starts), bool)
    for _ in range(10):
        open_ = moments(hi)[0] >= 0
        if not open_.any():
            break
        hi = np.where(open_, hi * 2.0, hi)
    bad = open_ | ~(moments(lo)[0] > 0)
    # Start at the moment estimate: the standard deviation of ln y is about 1.28 / shape.
    square = np.add.reduceat(weight * log_y * log_y, starts) / total - mean * mean
    beta = np.clip(1.2825 / np.sqrt(np.maximum(square, 1e-20)), lo, hi)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(200):
            score, slope = moments(beta)
            lo = np.where(score > 0, beta, lo)
            hi = np.where(score > 0, hi, beta)
            new = beta - score / slope
            new = np.where((new >= lo) & (new <= hi), new, (lo + hi) / 2.0)
            done = np.abs(new - beta) <= 1e-15 * beta
            beta = new
            if np.all(done | bad):
                break
        else:
            bad |= ~(np.abs(score) <= 1e-9 * (1.0 + 1.0 / beta))
    return np.where(bad, np.nan, beta)


def weibull_scale(log_y: np.ndarray, weight: np.ndarray, starts: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """mean(y^beta)^(-1/beta), shifted by the largest term."""
    sizes = np.diff(np.append(starts, len(log_y)))
    peak = np.maximum.reduceat(np.where(weight > 0, log_y, -np.inf), starts)
    shifted = np.where(weight > 0, log_y - np.repeat(peak, sizes), 0.0)
    e = weight * np.exp(np.repeat(beta, sizes) * shifted)
    mean = np.add.reduceat(e, starts) / np.add.reduceat(weight, starts)
    return np.exp(-peak - np.log(mean) / beta)


def gumbel_fit(xs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood location and scale of many ascending samples laid end to end, none of them constant.

    The profile score in the scale rises, and its root lies below mean minus smallest value: it is bisected in units of that bracket.
    """
    sizes = np.diff(np.append(starts, len(xs)))
    low = xs[starts]
    span = np.add.reduceat(xs, starts) / sizes - low
    gaps = (xs - np.repeat(low, sizes)) / np.repeat(span, sizes)

    def sums(scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the weights, and of the gaps by weight."""
        w = np.exp(-gaps / np.repeat(scale, sizes))
        return np.add.reduceat(w, starts), np.add.reduceat(gaps * w, starts)

    lo, hi = np.zeros(len(starts)), np.ones(len(starts))
    for _ in range(60):
        mid = (lo + hi) / 2.0
        w, g = sums(mid)
        above = mid - 1.0 + g / w < 0
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    unit = (lo + hi) / 2.0
    return low - unit * span * np.log(sums(unit)[0] / sizes), unit * span


_AT_ONCE = 100_000  # values that are solved together, whatever the batch holds


@pandas_udf(StructType([StructField("location", DoubleType()), StructField("scale", DoubleType())]))
def gumbel_udf(values: pd.Series) -> pd.DataFrame:
    """Location and scale per ascending array."""
    found, part, held = [], [], 0
    for xs in values:
        part.append(np.asarray(xs, dtype=float))
        held += len(xs)
        if held >= _AT_ONCE:
            found.append(gumbel_fit(np.concatenate(part), np.cumsum([0, *map(len, part[:-1])])))
            part, held = [], 0
    if part:
        found.append(gumbel_fit(np.concatenate(part), np.cumsum([0, *map(len, part[:-1])])))
    return pd.DataFrame({"location": np.concatenate([f[0] for f in found] or [[]]), "scale": np.concatenate([f[1] for f in found] or [[]])})


@pandas_udf(ArrayType(DoubleType()))
def grid_logs_udf(values: pd.Series, grids: pd.Series) -> pd.Series:
    """Sums of ln(x - bound) over the values of each array, one for every bound of its grid."""
    def sums(xs: np.ndarray, grid: np.ndarray) -> np.ndarray:
        total = np.zeros(len(grid))
        with np.errstate(divide="ignore", invalid="ignore"):
            for at in range(0, len(xs), 1000):
                total += np.log(np.asarray(xs[at:at + 1000], dtype=float)[:, None] - grid).sum(axis=0)
        return total

    return pd.Series([None if xs is None or grid is None else sums(xs, np.asarray(grid, dtype=float)) for xs, grid in zip(values, grids)], dtype=object)


@pandas_udf(DoubleType())
def grubbs_critical_udf(n: pd.Series, alpha: pd.Series) -> pd.Series:
    """One solution per distinct length in the batch."""
    sizes, place = np.unique(n.to_numpy(int), return_inverse=True)
    return pd.Series(np.array([grubbs_critical(int(k), float(alpha.iloc[0])) for k in sizes])[place])


@pandas_udf(DoubleType())
def gamma_cdf_udf(x: pd.Series, a: pd.Series) -> pd.Series:
    return pd.Series(gamma_cdf(x.to_numpy(float), a.to_numpy(float)))


@pandas_udf(DoubleType())
def gamma_quantile_udf(p: pd.Series, a: pd.Series) -> pd.Series:
    return pd.Series(gamma_quantile(p.to_numpy(float), a.to_numpy(float)))


def gamma_product(lo, hi, p, terms: list) -> np.ndarray:
    """x between lo and hi at which the distribution functions of two gamma variables have the product 1 - p, by bisection.

    ``terms``: origin, rate (negative where bounded above) and shape of both.
    """
    lo, hi = np.array(lo, float), np.array(hi, float)

    def below(x: np.ndarray, origin: np.ndarray, rate: np.ndarray, shape: np.ndarray) -> np.ndarray:
        f = gamma_cdf((x - origin) * rate, shape)
        return np.where(rate > 0, f, 1.0 - f)

    for _ in range(60):
        mid = (lo + hi) / 2
        above = below(mid, *terms[:3]) * below(mid, *terms[3:]) < 1.0 - p
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return (lo + hi) / 2


@pandas_udf(DoubleType())
def gamma_product_udf(lo: pd.Series, hi: pd.Series, p: pd.Series, a1: pd.Series, b1: pd.Series, c1: pd.Series, a2: pd.Series, b2: pd.Series, c2: pd.Series) -> pd.Series:
    return pd.Series(gamma_product(lo, hi, p.to_numpy(float), [c.to_numpy(float) for c in (a1, b1, c1, a2, b2, c2)]))


@pandas_udf(DoubleType())
def normal_quantile_udf(p: pd.Series) -> pd.Series:
    return pd.Series(normal_quantile(p.to_numpy(float)))


@pandas_udf(StructType([StructField("alpha", DoubleType()), StructField("beta", DoubleType())]))
def weibull_udf(log_values: pd.Series) -> pd.DataFrame:
    """Shape and scale per array of ln y; NaN where the shape has no root."""
    sizes = log_values.str.len().to_numpy(int)
    flat = np.concatenate(log_values.to_list()).astype(float)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    weight = np.ones_like(flat)
    beta = weibull_shape(flat, weight, starts)
    return pd.DataFrame({"alpha": weibull_scale(flat, weight, starts, beta), "beta": beta})
