"""Tails of the t, binomial and chi-square distributions, and the normal quantile, as Column expressions.

Spark has no incomplete beta or gamma.  Their series and continued fractions
(modified Lentz) are folds over a sequence of term numbers: the state stops
changing once a term no longer matters, and a fold that ends before that raises.
The number of terms grows with the square root of the parameters, as the
fractions need.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY, PRECISION = 1e-300, 1e-15
#: Terms: this many, and so many for each unit of the square root of the largest parameter.
TERMS, TERMS_PER_ROOT = 400, 20

# Coefficients of Stirling's series for the logarithm of the gamma function in 1/z, 1/z^3, ...
STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156]
#: Arguments below this are shifted up by it.
SHIFT = 10


def polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    """Highest power first."""
    value = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        value = value * x + F.lit(float(c))
    return value


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function of a positive number."""
    small = x < SHIFT
    z = F.when(small, x + SHIFT).otherwise(x)
    below = sum((F.log(x + i) for i in range(1, SHIFT)), F.log(x))
    series = polynomial(1 / (z * z), STIRLING[::-1]) / z
    value = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    return F.when(small, value - below).otherwise(value)


def _apart(x: Column) -> Column:
    return F.when(F.abs(x) > TINY, x).otherwise(F.lit(TINY))


def _fold(name: str, largest: Column, first: int, zero: Column, step, value: str) -> Column:
    """Field ``value`` of the state after the term at which ``step`` sets ``done``."""
    terms = F.sequence(F.lit(first), (F.lit(first + TERMS) + TERMS_PER_ROOT * F.ceil(F.sqrt(largest))).cast("int"))
    end = F.aggregate(terms, zero, lambda acc, j: F.when(acc["done"], acc).otherwise(step(acc, j.cast("double"))))
    # the check is part of the fold's end, so the fold runs once
    return F.transform(F.array(end), lambda s: F.when(s["done"], s[value]).otherwise(
        F.raise_error(F.lit(f"{name} did not converge")).cast("double")))[0]


def _lentz(acc: Column, above: Column, beside: Column, last: Column) -> Column:
    """The fraction continued by ``above / (beside + ...)``; it may end at a ``last`` term."""
    d, c = 1 / _apart(beside + above * acc["d"]), _apart(beside + above / acc["c"])
    return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * c * d).alias("h"),
                    (last & (F.abs(c * d - 1) < PRECISION)).alias("done"))


def _start(d: Column, c: Column) -> Column:
    return F.struct(c.alias("c"), d.alias("d"), d.alias("h"), F.lit(False).alias("done"))


def beta_tail(a: Column, b: Column, x: Column, rest: Column | None = None) -> Column:
    """Regularised incomplete beta I_x(a, b); null if an argument is.  ``rest``: 1 - x where it is known more exactly."""
    a, b, x = a.cast("double"), b.cast("double"), x.cast("double")
    rest = 1 - x if rest is None else rest
    near = x < (a + 1) / (a + b + 2)  # where the fraction converges fast; else by symmetry
    p, q, y = F.when(near, a).otherwise(b), F.when(near, b).otherwise(a), F.when(near, x).otherwise(rest)
    inner = F.transform(F.array(F.struct(p.alias("p"), q.alias("q"), y.alias("y"))), lambda s: _beta_fraction(s["p"], s["q"], s["y"]))[0]
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(rest))
    part = front * inner / p
    return F.when(a.isNull() | b.isNull() | x.isNull(), F.lit(None).cast("double")).when(x <= 0, F.lit(0.0)) \
        .when(x >= 1, F.lit(1.0)).when(near, part).otherwise(1 - part)


def _beta_fraction(p: Column, q: Column, y: Column) -> Column:
    def step(acc: Column, j: Column) -> Column:
        m, odd = F.floor(j / 2).cast("double"), j % 2 == 1
        above = F.when(odd, -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 1 + 2 * m))) \
            .otherwise(m * (q - m) * y / ((p - 1 + 2 * m) * (p + 2 * m)))
        return _lentz(acc, above, F.lit(1.0), odd)
    return _fold("incomplete beta", F.greatest(p, q), 2, _start(1 / _apart(1 - (p + q) * y / (p + 1)), F.lit(1.0)), step, "h")


def gamma_tail(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x); null if an argument is."""
    a, x = a.cast("double"), x.cast("double")
    front = F.exp(-x + a * F.log(x) - log_gamma(a))

    def series(acc: Column, j: Column) -> Column:
        term = acc["term"] * x / (a + j)
        return F.struct(term.alias("term"), (acc["s"] + term).alias("s"),
                        (F.abs(term) < F.abs(acc["s"]) * 1e-16).alias("done"))
    zero = F.struct((1 / a).alias("term"), (1 / a).alias("s"), F.lit(False).alias("done"))
    lower = _fold("incomplete gamma", a, 1, zero, series, "s")
    upper = _fold("incomplete gamma", F.greatest(a, x), 1, _start(1 / _apart(x + 1 - a), F.lit(1 / TINY)),
                  lambda acc, i: _lentz(acc, -i * (i - a), x + 1 - a + 2 * i, F.lit(True)), "h")
    return F.when(a.isNull() | x.isNull(), F.lit(None).cast("double")).when(x <= 0, F.lit(1.0)) \
        .when(x < a + 1, 1 - front * lower).otherwise(front * upper)


def t_two_sided(t: Column, dof: Column) -> Column:
    """Two-sided p of a t statistic; null without degrees of freedom or statistic."""
    dof = dof.cast("double")
    return F.when((dof > 0) & ~F.isnan(t), beta_tail(dof / 2, F.lit(0.5), dof / (dof + t * t), t * t / (dof + t * t)))


def binomial_two_sided_half(b: Column, c: Column) -> Column:
    """Exact two-sided binomial test of b successes in b + c trials at p = 1/2; 1 without trials."""
    less, more = F.least(b, c), F.greatest(b, c)  # P(X <= less) = I_1/2(n - less, less + 1)
    return F.when(b + c == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * beta_tail(more, less + 1, F.lit(0.5))))


def chi_square_tail(x: Column, dof: Column) -> Column:
    """P(X >= x); null without degrees of freedom."""
    return F.when(dof > 0, gamma_tail(dof.cast("double") / 2, x / 2))


# Acklam's rational approximation of the normal quantile (relative error below 1.2e-9).
PROBIT_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
PROBIT_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01]
PROBIT_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
PROBIT_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
PROBIT_EDGE = 0.02425


def probit(p: Column) -> Column:
    """The standard normal quantile of a probability between 0 and 1."""
    side = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    edge = polynomial(side, PROBIT_C) / polynomial(side, [*PROBIT_D, 1.0])
    mid = p - 0.5
    inner = polynomial(mid * mid, PROBIT_A) * mid / polynomial(mid * mid, [*PROBIT_B, 1.0])
    return F.when(p < PROBIT_EDGE, edge).when(p > 1 - PROBIT_EDGE, -edge).otherwise(inner)
