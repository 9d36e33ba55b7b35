"""Distribution functions as column expressions, each with its SQL text for the oracle.

Critical values are driver constants (stdlib ``statistics.NormalDist``), so
verdicts such as "significant at alpha" stay plain column comparisons.
Everything else is a native expression: the complementary error function by
series and continued fraction, the normal quantile by Wichura's rational
approximations (AS 241), the Poisson quantile by its distribution function
below a mean of ``POISSON_EXACT`` and by Giles' expansion in the normal
quantile above.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.functions.columns import col_

_SERIES, _FRACTION, _SWITCH = 60, 90, 2.0


def z_critical(alpha: float = 0.05) -> float:
    """Two-sided normal critical value z_{1-alpha/2}."""
    return NormalDist().inv_cdf(1.0 - alpha / 2.0)


def chi2_1dof_critical(alpha: float) -> float:
    """Critical value of chi-square with one degree of freedom (= z_{1-alpha/2}^2)."""
    return z_critical(alpha) ** 2


# ------------------------------------------------------------ error function

def erfc(x) -> Column:
    """erfc(x) for x >= 0 (null stays null); relative error below 1e-12 down to the smallest double.

    Below 2: 1 - 2 x exp(-x^2) / sqrt(pi) * (1 + a/3 (1 + a/5 (1 + ...))), a = 2 x^2.
    From 2 on: exp(-x^2) / sqrt(pi) / (x + (1/2)/(x + (2/2)/(x + (3/2)/(x + ...)))).
    """
    x = col_(x).cast("double")
    a = 2 * x * x
    series = F.aggregate(F.sequence(F.lit(_SERIES), F.lit(1)), F.lit(1.0), lambda s, k: 1 + a / (2 * k + 1) * s)
    fraction = F.aggregate(F.sequence(F.lit(_FRACTION), F.lit(1)), x, lambda s, k: x + k / 2 / s)
    front = F.exp(-x * x) / F.lit(math.sqrt(math.pi))
    return F.when(x < _SWITCH, 1 - 2 * x * front * series).otherwise(front / fraction)


def erfc_sql(x: str) -> str:
    """SQL text of ``erfc``; ``x`` is an expression that is never negative."""
    def down(n: int, first: str, step: str) -> str:
        ks = ", ".join(f"{k}.0::DOUBLE" for k in range(n, 0, -1))
        return f"list_reduce([{first}, {ks}], lambda s, k: {step})"

    series = down(_SERIES, "1.0::DOUBLE", f"1 + 2 * ({x}) * ({x}) / (2 * k + 1) * s")
    fraction = down(_FRACTION, f"({x})", f"({x}) + k / 2 / s")
    front = f"exp(-({x}) * ({x})) / {math.sqrt(math.pi)!r}::DOUBLE"
    return f"(CASE WHEN ({x}) < {_SWITCH} THEN 1 - 2 * ({x}) * {front} * {series} ELSE {front} / {fraction} END)"


def normal_two_sided_p(z) -> Column:
    """erfc(|z|/sqrt 2): no underflow to 0 for large |z| (unlike 2*(1-cdf))."""
    return erfc(F.abs(col_(z)) / F.lit(math.sqrt(2.0)))


def normal_two_sided_p_sql(z: str) -> str:
    return erfc_sql(f"abs({z}) / {math.sqrt(2.0)!r}::DOUBLE")


def chi2_1dof_p(chi2) -> Column:
    return erfc(F.sqrt(F.greatest(col_(chi2), F.lit(0.0)) / 2.0))


def chi2_1dof_p_sql(chi2: str) -> str:
    return erfc_sql(f"sqrt(greatest({chi2}, 0.0::DOUBLE) / 2.0::DOUBLE)")


# ------------------------------------------------------------ normal quantile

# Wichura (1988), algorithm AS 241, PPND16; numerators and denominators, constant term first.
_CENTRE = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
            4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
           (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
            2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
_MIDDLE = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
            1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
           (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
            1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
_FAR = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def _ratio(r: str, parts) -> str:
    def horner(coefficients) -> str:
        text = repr(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            text = f"({text}) * {r} + {c!r}"
        return f"({text})"
    return f"{horner(parts[0])} / {horner(parts[1])}"


def normal_quantile_text(u: str) -> str:
    """Normal quantile of ``u`` in (0, 1), as text that Spark and DuckDB both read."""
    q, tail = f"({u} - 0.5)", f"sqrt(-ln(least({u}, 1.0 - {u})))"
    centre = f"{q} * " + _ratio(f"(0.180625 - {q} * {q})", _CENTRE)
    outer = (f"sign({q}) * CASE WHEN {tail} <= 5.0 THEN " + _ratio(f"({tail} - 1.6)", _MIDDLE)
             + " ELSE " + _ratio(f"({tail} - 5.0)", _FAR) + " END")
    return f"(CASE WHEN abs({q}) <= 0.425 THEN {centre} ELSE {outer} END)"


# ----------------------------------------------------------- Poisson quantile

#: Up to this mean the Poisson distribution function itself is inverted, term by term.
POISSON_EXACT = 64
_TERMS = 200


def _giles(n: str, z: str) -> str:
    """Giles (2016): the quantile's expansion in the normal quantile, to the order 1 / mean."""
    return (f"CAST(floor({n} + sqrt({n}) * {z} + ({z} * {z} + 2.0) / 6.0 - ({z} + {z} * {z} * {z} / 2.0) / (36.0 * sqrt({n}))"
            f" + (-8.0 / 405.0 + 7.0 * {z} * {z} / 810.0 + {z} * {z} * {z} * {z} / 270.0) / {n}) AS BIGINT)")


def _poisson_table() -> list[tuple[int, list[float]]]:
    """(n, distribution function at 0, 1, ...) for n up to ``POISSON_EXACT``, as far as it still grows."""
    rows = []
    for n in range(1, POISSON_EXACT + 1):
        p = c = math.exp(-n)
        steps = [c]
        for k in range(1, _TERMS):
            p *= n / k
            if k > n and c + p == c:
                break
            c += p
            steps.append(c)
        rows.append((n, steps))
    return rows


def with_poisson(df: DataFrame, n: str, u: str, name: str) -> DataFrame:
    """``df`` with column ``name``: the smallest k whose Poisson(n) distribution function exceeds u.

    ``n`` (1 or more) and ``u`` (in (0, 1)) name columns. The distribution
    functions of small means are a fixed table of ``POISSON_EXACT`` rows.
    """
    table = df.sparkSession.createDataFrame(_poisson_table(), "_mean long, _cdf array<double>")
    joined = df.join(F.broadcast(table), F.col(n) == F.col("_mean"), "left")
    exact = F.size(F.filter("_cdf", lambda c: c <= F.col(u))).cast("long")
    large = F.expr(_giles(f"CAST({n} AS DOUBLE)", normal_quantile_text(u)))
    return joined.withColumn(name, F.when(F.col(n) <= POISSON_EXACT, exact).otherwise(large)).drop("_mean", "_cdf")


def poisson_quantile_sql(n: str, u: str) -> str:
    """SQL text of the column that ``with_poisson`` adds."""
    ks = ", ".join(f"{{'p': {k}.0::DOUBLE, 'c': 0.0::DOUBLE, 'k': 0.0::DOUBLE}}" for k in range(1, _TERMS + 1))
    start = f"{{'p': exp(-({n})::DOUBLE), 'c': exp(-({n})::DOUBLE), 'k': 0.0::DOUBLE}}"
    step = (f"{{'p': s['p'] * (({n})::DOUBLE / t['p']), 'c': s['c'] + s['p'] * (({n})::DOUBLE / t['p']), "
            f"'k': s['k'] + CASE WHEN s['c'] <= {u} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END}}")
    small = f"CAST(list_reduce([{start}, {ks}], lambda s, t: {step})['k'] AS BIGINT)"
    return f"(CASE WHEN ({n}) <= {POISSON_EXACT} THEN {small} ELSE {_giles(f'({n})::DOUBLE', normal_quantile_text(u))} END)"
