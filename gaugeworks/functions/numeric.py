"""Probability functions as Column expressions (JVM side, no Python worker)."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_of_exceedance(p: float) -> float:
    """Standard normal quantile at 1 - p, for literals and fixed grids."""
    return -NormalDist().inv_cdf(p)


def linspace(lo: float, hi: float, n: int) -> list[float]:
    step = (hi - lo) / (n - 1)
    return [lo + i * step for i in range(n - 1)] + [hi]


def log_gamma(x: Column) -> Column:
    """ln Γ(x), x > 0: shift by eight, then Stirling's series."""
    y = x + 8.0
    product = x
    for k in range(1, 8):
        product = product * (x + float(k))
    r2 = F.lit(1.0) / (y * y)
    series = F.lit(1 / 1188)
    for coefficient in (1 / 1680, 1 / 1260, 1 / 360, 1 / 12):
        series = F.lit(coefficient) - r2 * series
    series = series / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def normal_density(z: Column) -> Column:
    return F.exp(-z * z / 2.0) / math.sqrt(2 * math.pi)


# Coefficients of the error function's rational approximations (Cody 1969), highest power first.
_ERF = (
    (1.85777706184603153e-1, 3.16112374387056560, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
_ERFC = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594, 6.61191906371416295e1, 2.98635138197400131e2,
     8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
     3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
_ERFC_TAIL = (
    (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4),
    (1.0, 2.56852019228982242, 1.87295284992346725, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3),
)


def _ratio(terms: tuple[tuple[float, ...], tuple[float, ...]], x: Column) -> Column:
    parts = []
    for coefficients in terms:
        total = F.lit(coefficients[0])
        for c in coefficients[1:]:
            total = total * x + c
        parts.append(total)
    return parts[0] / parts[1]


def normal_upper(z: Column) -> Column:
    """P(Z > z) for z >= 0 from rational approximations of the error function (relative error below 1e-12); no loop runs per row.

    The approximations use z dozens of times, so it is bound as the element of an array and computed once.
    """
    def upper(z: Column) -> Column:
        x = z * math.sqrt(0.5)
        square = z * z / 2.0
        near = 0.5 - 0.5 * x * _ratio(_ERF, square)
        middle = 0.5 * F.exp(-square) * _ratio(_ERFC, x)
        inverse = 2.0 / F.when(z > 1.0, z * z)
        tail = 0.5 * F.exp(-square) / x * (1.0 / math.sqrt(math.pi) - inverse * _ratio(_ERFC_TAIL, inverse))
        return F.when(x <= 0.46875, near).when(x <= 4.0, middle).otherwise(tail)

    return F.transform(F.array(z), upper)[0]


def normal_two_sided(z: Column) -> Column:
    """Two-sided p-value; null and NaN pass through."""
    return F.least(F.lit(1.0), 2.0 * normal_upper(F.abs(z)))


def student_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > t) for integer degrees of freedom (finite trigonometric sums)."""
    angle = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    return 1.0 - _student_central(angle, df)


def _student_central(angle: Column, df: Column) -> Column:
    s, c2 = F.sin(angle), F.cos(angle) * F.cos(angle)
    odd = df % 2 == 1
    offset = F.when(odd, 0.0).otherwise(1.0)
    first = F.when(odd, F.cos(angle)).otherwise(1.0)
    terms = F.when(odd, F.floor((df - 1) / 2)).otherwise(F.floor(df / 2)).cast("int")

    def add_term(acc: Column, j: Column) -> Column:
        term = acc["term"] * c2 * (2 * j - offset) / (2 * j + 1 - offset)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.aggregate(
        F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("term"), first.alias("total")),
        add_term, lambda acc: acc["total"],
    )
    total = F.when(terms < 1, 0.0).otherwise(total)
    return F.when(odd, (angle + s * total) * (2 / math.pi)).otherwise(s * total)


def chi_square_upper(h: Column, df: int) -> Column:
    """Survival function for integer degrees of freedom (finite sums)."""
    h = F.greatest(h, F.lit(0.0))
    if df % 2 == 0:
        term, total = F.lit(1.0), F.lit(1.0)
        for i in range(1, df // 2):
            term = term * h / (2.0 * i)
            total = total + term
        return F.exp(-h / 2.0) * total
    root = F.sqrt(h)
    tail = 2.0 * normal_upper(root)
    term, total = root, F.lit(0.0)
    for i in range(1, (df - 1) // 2 + 1):
        total = total + term
        term = term * h / (2.0 * i + 1)
    return tail + 2.0 * normal_density(root) * total
