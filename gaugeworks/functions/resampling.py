"""Fits of many resamples of one series at once.

A resample is a row of multiplicities over the sorted values, so sums over it are matrix
products. ``fit(xs, counts)`` returns parameter arrays (NaN where a resample cannot be fitted);
``curve(params, p, z)`` returns one quantile row per resample.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

from gaugeworks.functions.special import gamma_quantile, log_gamma, normal_quantile, weibull_scale, weibull_shape

Params = dict[str, np.ndarray]
Resampler = tuple[
    Callable[[np.ndarray, np.ndarray], Params],
    Callable[[Params, np.ndarray, np.ndarray], np.ndarray],
]

_NODES = 24

# Euler's constant, offset of the plotting position of weighted moments.
EULER = 0.5772156649015329
PLOTTING = 0.35
#: Bracket of the GEV shape; shapes below ``SMALL_SHAPE`` count as Gumbel, skews below ``SMALL_SKEW`` go by expansion.
SHAPE_LOW, SHAPE_HIGH = -0.999999, 60.0
SMALL_SHAPE, SMALL_SKEW = 1e-9, 1e-3
LARGE_SHAPE = 3e4  # gamma quantiles of larger shapes go by their expansion about the normal one (relative error below 1e-7)


def lognormal_mom_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    ln = np.log(xs)
    shift = ln.mean()
    n = counts.sum(axis=1)
    centred = counts @ (ln - shift) / n
    square = counts @ (ln - shift) ** 2 - n * centred**2
    return {"mu_log": centred + shift, "sigma_log": np.sqrt(np.maximum(square, 0.0) / (n - 1))}


def lognormal_mom_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return np.exp(v["mu_log"][:, None] + v["sigma_log"][:, None] * z)


def _order_statistic(cumulative: np.ndarray, k: int) -> np.ndarray:
    return (cumulative > k).argmax(axis=1)


def lognormal_3p_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    n = int(counts[0].sum())
    cumulative = np.cumsum(counts, axis=1)
    low, high = xs[_order_statistic(cumulative, 0)], xs[_order_statistic(cumulative, n - 1)]
    mid = (xs[_order_statistic(cumulative, (n - 1) // 2)] + xs[_order_statistic(cumulative, n // 2)]) / 2.0
    spread = high + low - 2.0 * mid
    with np.errstate(divide="ignore", invalid="ignore"):
        eps = np.where(spread == 0, np.nan, (high * low - mid * mid) / spread)
        ok = eps < low
        gap = np.where((counts > 0) & ok[:, None], xs - eps[:, None], 1.0)
        ln = np.log(gap)
        mu = (counts * ln).sum(axis=1) / n
        sigma = np.sqrt((counts * (ln - mu[:, None]) ** 2).sum(axis=1) / (n - 1))
    ok &= sigma > 0
    return {k: np.where(ok, v, np.nan) for k, v in (("epsilon", eps), ("mu", mu), ("sigma", sigma))}


def lognormal_3p_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return v["epsilon"][:, None] + np.exp(v["mu"][:, None] + v["sigma"][:, None] * z)


def pearson3_fit(
    xs: np.ndarray, counts: np.ndarray, grid_size: int = 200, low: float = 1e-4, high: float = 0.999
) -> Params:
    """The grid depends only on the smallest value drawn, so the logarithms are taken once for
    each distinct smallest value and shared by all resamples that have it."""
    total = len(counts)
    out = {k: np.full(total, np.nan) for k in ("epsilon", "lambda", "alpha")}
    first = (counts > 0).argmax(axis=1)
    n = counts.sum(axis=1).astype(float)
    for i in np.unique(first):
        rows = np.flatnonzero(first == i)
        grid = np.linspace(low * xs[i], high * xs[i], grid_size)
        logs = np.log(xs[i:, None] - grid)
        c, m = counts[rows, i:].astype(float), n[rows, None]
        sl = c @ logs
        sd = (c @ xs[i:])[:, None] - m * grid
        a = np.log(sd / m) - sl / m
        with np.errstate(divide="ignore", invalid="ignore"):
            a = np.where(a > 0, a, np.nan)
            lam = (1.0 + np.sqrt(1.0 + 4.0 * a / 3.0)) / (4.0 * a)
            alpha = lam * m / sd
            ll = m * lam * np.log(alpha) - m * log_gamma(lam) + (lam - 1.0) * sl - alpha * sd
        ll = np.where(np.isnan(ll), -np.inf, ll)
        best = ll.argmax(axis=1)
        pick = np.arange(len(rows))
        good = np.isfinite(ll[pick, best])
        out["epsilon"][rows] = np.where(good, grid[best], np.nan)
        out["lambda"][rows] = np.where(good, lam[pick, best], np.nan)
        out["alpha"][rows] = np.where(good, alpha[pick, best], np.nan)
    return out


def normal_expansion(z: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Quantile of a standardised Pearson III of skew 6 h, next to the normal quantile z, for small h."""
    return z + (z**2 - 1) * h + (z**3 - 6 * z) * h**2 / 3 - (z**2 - 1) * h**3 + z * h**4 + h**5 / 3


class GammaCurves:
    """Gamma quantiles at fixed probabilities for many shapes.

    ln quantile is smooth in ln shape, so shapes are read off Chebyshev interpolants on pieces of
    unit length. A piece is built once per Python worker and serves every station; it is checked
    against direct values when built, and its shapes are computed directly if it misses.
    """

    def __init__(self, prob: np.ndarray) -> None:
        self.prob = prob
        angle = (2 * np.arange(_NODES) + 1) * np.pi / (2 * _NODES)
        self._nodes = 0.5 + 0.5 * np.cos(angle)
        self._weights = (-1.0) ** np.arange(_NODES) * np.sin(angle)
        self._pieces: dict[int, np.ndarray | None] = {}

    def _direct(self, lam: np.ndarray) -> np.ndarray:
        return gamma_quantile(self.prob[None, :], lam[:, None])

    def _read(self, k: int, table: np.ndarray, lam: np.ndarray) -> np.ndarray:
        gap = np.log(lam)[:, None] - (k + self._nodes)
        w = self._weights / np.where(gap == 0, 1e-300, gap)
        return np.exp((w @ table) / w.sum(axis=1)[:, None])

    def _piece(self, k: int) -> np.ndarray | None:
        if k not in self._pieces:
            table = np.log(self._direct(np.exp(k + self._nodes)))
            probe = np.exp(k + np.linspace(0.01, 0.99, 9))
            miss = np.max(np.abs(self._read(k, table, probe) / self._direct(probe) - 1.0))
            self._pieces[k] = table if miss < 1e-9 else None
        return self._pieces[k]

    def rows(self, lam: np.ndarray) -> np.ndarray:
        out = np.full((len(lam), len(self.prob)), np.nan)
        large = np.flatnonzero(np.isfinite(lam) & (lam > LARGE_SHAPE))
        root = np.sqrt(lam[large])[:, None]
        out[large] = root * root + root * normal_expansion(normal_quantile(self.prob), 1.0 / (3.0 * root))
        good = np.flatnonzero(np.isfinite(lam) & (lam > 0) & (lam <= LARGE_SHAPE))
        piece = np.floor(np.log(lam[good])).astype(int)
        for k in np.unique(piece):
            rows = good[piece == k]
            table = self._piece(int(k))
            out[rows] = self._direct(lam[rows]) if table is None else self._read(int(k), table, lam[rows])
        return out


@lru_cache(maxsize=8)
def _gamma_curves(prob: tuple[float, ...]) -> GammaCurves:
    return GammaCurves(np.array(prob))


def pearson3_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return v["epsilon"][:, None] + _gamma_curves(tuple(1.0 - p)).rows(v["lambda"]) / v["alpha"][:, None]


def weibull_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    rows, n = counts.shape
    ln = np.log(xs)
    weight = counts.astype(float)
    size = weight.sum(axis=1)
    mean = weight @ ln / size
    spread = np.sqrt((weight * (ln - mean[:, None]) ** 2).sum(axis=1) / size)
    varied = spread >= 1e-12
    out = {k: np.full(rows, np.nan) for k in ("alpha", "beta")}
    if varied.any():
        flat = np.tile(ln, int(varied.sum()))
        w = weight[varied].ravel()
        starts = np.arange(int(varied.sum())) * n
        beta = weibull_shape(flat, w, starts)
        out["beta"][varied] = beta
        out["alpha"][varied] = weibull_scale(flat, w, starts, beta)
    return out


def weibull_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return (-np.log(p)) ** (1.0 / v["beta"][:, None]) / v["alpha"][:, None]


def _rank_sums(counts: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per value, the sums of its copies' weights for b1 and b2; copies take consecutive ranks, so they are differences of closed sums."""
    upto = np.concatenate([np.zeros((len(counts), 1)), np.cumsum(counts, axis=1)], axis=1)
    n = upto[:, -1:]
    if weighted:
        plain = upto * (upto + 1) / 2
        first = (plain - PLOTTING * upto) / n
        second = (upto * (upto + 1) * (2 * upto + 1) / 6 - 2 * PLOTTING * plain + PLOTTING**2 * upto) / n**2
    else:
        first = upto * (upto - 1) / 2 / (n - 1)
        second = upto * (upto - 1) * (upto - 2) / 3 / ((n - 1) * (n - 2))
    return np.diff(first, axis=1), np.diff(second, axis=1)


def linear_moments(xs: np.ndarray, counts: np.ndarray, weighted: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l1, l2 and the L-skewness of every resample; NaN where the values do not vary."""
    n = counts.sum(axis=1)
    first, second = _rank_sums(counts, weighted)
    b0, b1, b2 = counts @ xs / n, first @ xs / n, second @ xs / n
    l2 = 2 * b1 - b0
    l2 = np.where((l2 > 0) & ((counts > 0).sum(axis=1) > 1), l2, np.nan)
    return b0, l2, (6 * b2 - 6 * b1 + b0) / l2


def gev_shape(t3: np.ndarray) -> np.ndarray:
    """Shape of each L-skewness, by bisection; NaN beyond -1 to 1."""
    lo, hi = np.full(t3.shape, SHAPE_LOW), np.full(t3.shape, SHAPE_HIGH)
    for _ in range(80):
        k = (lo + hi) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(k == 0, np.log(3) / np.log(2), np.expm1(-k * np.log(3)) / np.expm1(-k * np.log(2)))
        above = 2 * ratio - 3 > t3
        lo, hi = np.where(above, k, lo), np.where(above, hi, k)
    return np.where(np.abs(t3) < 1, (lo + hi) / 2, np.nan)


def gev_fit(xs: np.ndarray, counts: np.ndarray, weighted: bool = False) -> Params:
    l1, l2, t3 = linear_moments(xs, counts, weighted)
    k = gev_shape(t3)
    near = np.abs(k) < SMALL_SHAPE
    safe = np.where(near, 1.0, k)
    gamma = np.exp(log_gamma(1.0 + k))
    scale = np.where(near, l2 / np.log(2), l2 * safe / (-np.expm1(-safe * np.log(2)) * gamma))
    location = np.where(near, l1 - EULER * scale, l1 - scale * (1.0 - gamma) / safe)
    return {"location": np.where(np.isnan(k), np.nan, location), "scale": np.where(np.isnan(k), np.nan, scale), "shape": k}


def gev_weighted_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    return gev_fit(xs, counts, weighted=True)


def gev_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    k, u = v["shape"][:, None], np.log(-np.log1p(-p))
    near = np.abs(k) < SMALL_SHAPE
    return v["location"][:, None] - v["scale"][:, None] * np.where(near, u, np.expm1(k * u) / np.where(near, 1.0, k))


def gumbel_lmom_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    l1, l2, _ = linear_moments(xs, counts)
    return {"location": l1 - EULER * l2 / np.log(2), "scale": l2 / np.log(2)}


def gumbel_mom_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    n = counts.sum(axis=1)
    shift = xs.mean()
    mean = counts @ (xs - shift) / n
    scale = np.sqrt(np.maximum(counts @ (xs - shift) ** 2 - n * mean**2, 0.0) / (n - 1)) * (np.sqrt(6) / np.pi)
    scale = np.where((counts > 0).sum(axis=1) > 1, scale, np.nan)
    return {"location": mean + shift - EULER * scale, "scale": scale}


def gumbel_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    """Maximum likelihood by bisection of the profile score, scales in units of mean minus smallest value."""
    n = counts.sum(axis=1)
    first = (counts > 0).argmax(axis=1)
    low, varied = xs[first], (counts > 0).sum(axis=1) > 1
    span = np.where(varied, counts @ xs / n - low, 1.0)
    gaps = np.where(counts > 0, (xs - low[:, None]) / span[:, None], 0.0)
    lo, hi = np.zeros(len(counts)), np.ones(len(counts))
    for _ in range(60):
        scale = (lo + hi) / 2
        w = counts * np.exp(-gaps / scale[:, None])
        above = scale - 1.0 + (w * gaps).sum(axis=1) / w.sum(axis=1) < 0
        lo, hi = np.where(above, scale, lo), np.where(above, hi, scale)
    unit = np.where(varied, (lo + hi) / 2, np.nan)
    with np.errstate(invalid="ignore"):
        weight = (counts * np.exp(-gaps / unit[:, None])).sum(axis=1)
        return {"location": low - unit * span * np.log(weight / n), "scale": unit * span}


def gumbel_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return v["location"][:, None] - v["scale"][:, None] * np.log(-np.log1p(-p))


def pearson3_lmom_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    l1, l2, t3 = linear_moments(xs, counts)
    t = np.abs(t3)
    with np.errstate(divide="ignore", invalid="ignore"):
        low, high = 3 * np.pi * t * t, 1.0 - t
        inner = (1.0 + 0.2906 * low) / (low * (1.0 + low * (0.1882 + 0.0442 * low)))
        outer = high * (0.36067 + high * (-0.59567 + 0.25361 * high)) / (1.0 + high * (-2.78861 + high * (2.56096 - 0.77045 * high)))
        lam = np.where((t < 1) & (t >= 1e-6), np.where(t < 1 / 3, inner, outer), np.nan)
        alpha = np.sign(t3) / (l2 * np.sqrt(np.pi) * np.exp(log_gamma(lam) - log_gamma(lam + 0.5)))
        return {"epsilon": l1 - lam / alpha, "lambda": lam, "alpha": alpha}


def _by_sign(up: np.ndarray, lam: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Gamma quantiles at 1 - p where ``up``, at p elsewhere."""
    out = np.full((len(lam), len(p)), np.nan)
    for rows, prob in ((np.flatnonzero(up), 1.0 - p), (np.flatnonzero(~up), p)):
        if len(rows):
            out[rows] = _gamma_curves(tuple(prob)).rows(lam[rows])
    return out


def pearson3_lmom_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return v["epsilon"][:, None] + _by_sign(v["alpha"] > 0, v["lambda"], p) / v["alpha"][:, None]


def log_pearson3_fit(xs: np.ndarray, counts: np.ndarray) -> Params:
    n = counts.sum(axis=1)
    ln = np.log(xs)
    mean = counts @ (ln - ln.mean()) / n + ln.mean()
    gap = np.where(counts > 0, ln - mean[:, None], 0.0)
    sigma = np.sqrt((counts * gap**2).sum(axis=1) / (n - 1))
    sigma = np.where(sigma > 1e-12, sigma, np.nan)
    return {"mu_log": mean, "sigma_log": sigma, "skew_log": n * (counts * gap**3).sum(axis=1) / ((n - 1) * (n - 2) * sigma**3)}


def log_pearson3_curve(v: Params, p: np.ndarray, z: np.ndarray) -> np.ndarray:
    g = v["skew_log"]
    far = np.abs(g) >= SMALL_SKEW
    safe = np.where(far, g, 1.0)
    shape = 4.0 / safe**2
    h = (g / 6.0)[:, None]
    near = normal_expansion(z, h)
    k = np.where(far[:, None], (_by_sign(safe > 0, shape, p) - shape[:, None]) * safe[:, None] / 2, near)
    return np.exp(v["mu_log"][:, None] + v["sigma_log"][:, None] * k)


RESAMPLERS: dict[str, Resampler] = {
    "gumbel_mom": (gumbel_mom_fit, gumbel_curve),
    "gumbel": (gumbel_fit, gumbel_curve),
    "gumbel_lmom": (gumbel_lmom_fit, gumbel_curve),
    "gev": (gev_fit, gev_curve),
    "gev_weighted": (gev_weighted_fit, gev_curve),
    "pearson3_lmom": (pearson3_lmom_fit, pearson3_lmom_curve),
    "log_pearson3": (log_pearson3_fit, log_pearson3_curve),
    "lognormal_mom": (lognormal_mom_fit, lognormal_mom_curve),
    "lognormal_3p": (lognormal_3p_fit, lognormal_3p_curve),
    "pearson3": (pearson3_fit, pearson3_curve),
    "weibull": (weibull_fit, weibull_curve),
}


#: Models whose curves are straight lines in some ordered u(p) under a rising function: start and slope of each resample with u, and that function.
LINES: dict[str, tuple[Callable[[Params, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], Callable[[np.ndarray], np.ndarray]]] = {
    "lognormal_mom": (lambda v, p, z: (v["mu_log"], v["sigma_log"], z), np.exp),
    "weibull": (lambda v, p, z: (-np.log(v["alpha"]), 1.0 / v["beta"], np.log(-np.log(p))), np.exp),
} | dict.fromkeys(("gumbel_mom", "gumbel", "gumbel_lmom"), (lambda v, p, z: (v["location"], -v["scale"], np.log(-np.log1p(-p))), np.asarray))


def register_resampler(name: str, fit: Callable, curve: Callable) -> None:
    RESAMPLERS[name] = (fit, curve)
    LINES.pop(name, None)
