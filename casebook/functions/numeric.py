"""Numeric helpers whose results do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def money(c) -> Column:
    """Monetary sums and values: DECIMAL(38,2)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,2)")


def _scaled(expr: str, scale: int, engine: str) -> str:
    """``expr * 10^scale`` as a 38-digit integer (exact for <= scale decimals)."""
    wide = "DECIMAL(38,0)" if engine == "spark" else "HUGEINT"
    return f"CAST(CAST(({expr}) AS DECIMAL(38,{scale})) * {10 ** scale} AS {wide})"


def _rounded_quotient(s: str, n: str, engine: str) -> str:
    """s / n rounded half away from zero, exactly, for integer s and n > 0.

    For x >= 0: round(x / n) = floor((2x + n) / 2n). Spark computes the floor
    as (a - a mod b) / b on 38-digit decimals (an exact division, so nothing
    is rounded and nothing wraps); the oracle uses HUGEINT ``//``.
    """
    def floor_div(x):
        a, b = f"(({x}) * 2 + {n})", f"({n} * 2)"
        return f"(({a} - MOD({a}, {b})) / {b})" if engine == "spark" else f"({a} // {b})"
    return (f"CASE WHEN {n} = 0 THEN NULL WHEN {s} < 0 THEN -{floor_div('-' + s)} "
            f"ELSE {floor_div(s)} END")


def _unscale(q: str, scale: int) -> str:
    """Integer ``q`` times 10^-scale, by exact decimal multiplication (a decimal
    division would go through DOUBLE in some engines)."""
    if scale == 0:
        return f"CAST({q} AS DECIMAL(38,0))"
    step = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({step} AS DECIMAL({scale + 1},{scale})) AS DECIMAL(38,{scale}))"


def avg_expr(expr: str, scale: int = 2, engine: str = "spark") -> str:
    """SQL text of an exactly rounded average of integers or decimals.

    The values are scaled to integers (exact for inputs with at most
    ``scale`` decimals) and summed as 38-digit integers (DECIMAL(38,0) in
    Spark, HUGEINT in the oracle), so sums over billions of rows cannot
    overflow; the quotient (the average, which fits in BIGINT) is rounded half
    away from zero with integer division. The result (DECIMAL(38,scale)) is
    the same for any order of partial sums, in Spark and in the oracle.
    """
    s = f"SUM({_scaled(expr, scale, engine)})"
    n = f"COUNT({expr})"
    return _unscale(_rounded_quotient(s, n, engine), scale)


def exact_avg(col: str, scale: int = 2) -> Column:
    """Aggregate column: exact average of ``col`` (see ``avg_expr``)."""
    return F.expr(avg_expr(f"`{col}`", scale, "spark"))


def pct(num, den, scale: int = 2) -> Column:
    """``round(100.0 * num / den, scale)`` as DOUBLE; NULL when ``den`` is 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.round(F.try_divide(F.lit(100.0) * num, den), scale)


def ratio_expr(num: str, den: str, scale: int = 2, engine: str = "spark") -> str:
    """SQL text: ``num / den`` rounded half away from zero to ``scale``.

    ``num`` is an exact number with at most ``scale`` decimals and ``den`` a
    positive integer; integer division keeps the result engine-independent.
    """
    s = _scaled(num, scale, engine)
    n = f"CAST(({den}) AS BIGINT)"
    return _unscale(_rounded_quotient(s, n, engine), scale)
