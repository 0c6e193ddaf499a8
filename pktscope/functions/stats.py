"""p-values of small per-feature result tables.

Spark SQL has no distribution functions, but Spark's class path holds Apache
Commons Math.  The tables here have a row per feature, so their rows are
brought to the driver and each value is one call of its special functions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def _beta(spark: SparkSession, x: float, a: float, b: float) -> float:
    return spark._jvm.org.apache.commons.math3.special.Beta.regularizedBeta(x, a, b)


def f_tail(spark: SparkSession, f: float | None, between: float, within: float) -> float | None:
    """P(F > f) with (between, within) degrees of freedom."""
    if f is None or math.isnan(f) or between <= 0 or within <= 0:
        return None
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    if within > 1e8:
        # (the limit for many rows, right to about 1 / within; the beta
        # function's own digits run out there)
        return spark._jvm.org.apache.commons.math3.special.Gamma.regularizedGammaQ(between / 2, between * f / 2)
    return _beta(spark, within / (within + between * f), within / 2, between / 2)


def t_tails(spark: SparkSession, t: float | None, dof: float) -> float | None:
    """P(|T| > |t|) with ``dof`` degrees of freedom."""
    return None if t is None else f_tail(spark, t * t, 1.0, dof)


def correlation_tails(spark: SparkSession, r: float | None, n: float) -> float | None:
    """Two-sided p-value of a rank correlation over ``n`` rows."""
    if r is None or n < 3:
        return None
    if abs(r) >= 1:
        return 0.0
    return t_tails(spark, r * math.sqrt((n - 2) / ((1 - r) * (1 + r))), n - 2)


def with_value(table: DataFrame, name: str, of) -> DataFrame:
    """``table`` (a row per feature) with the double ``name`` = of(row)."""
    rows = [(*r, of(r)) for r in table.collect()]
    return table.sparkSession.createDataFrame(rows, table.schema.add(name, "double"))
