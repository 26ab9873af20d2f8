"""Guarded numeric casts and price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Which texts count as numbers.
INT_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
DOUBLE_PATTERN = r"^-?[0-9]+\.?[0-9]*$"


def guarded_int(c: Column) -> Column:
    """Absolute integer value of a numeric text (truncated), else NULL.

    Goes through double so ``12.7`` gives 12, and ``try_cast`` so an
    out-of-range number gives NULL instead of failing the job.
    """
    text = F.trim(c)
    return F.when(text.rlike(INT_PATTERN), F.abs(text.try_cast("double")).try_cast("int"))


def guarded_double(c: Column) -> Column:
    """Absolute double value of a numeric text, else NULL."""
    text = F.trim(c)
    return F.when(text.rlike(DOUBLE_PATTERN), F.abs(text.try_cast("double")))


def money(c: Column) -> Column:
    """Two-decimal price as ``decimal(38,2)``.

    A mean of doubles depends in its last bits on the order of summation.
    Passing through nine decimals first keeps half-cent ties stable.
    """
    return F.round(c.cast("decimal(38,9)"), 2).cast("decimal(38,2)")


def price_fallback(*candidates: Column) -> Column:
    """First known price, 0 when none is known, in two decimals."""
    return money(F.coalesce(*candidates, F.lit(0.0)))


def fill_outlier_with_avg(price: Column, avg: Column, upper: float = 5, lower: float = 0.1) -> Column:
    """Replace a price outside ``[lower, upper]`` times the average by the average."""
    value = price.try_cast("double")
    outlier = (value > avg * F.lit(upper)) | (value < avg * F.lit(lower))
    return F.round(F.when(outlier, avg).otherwise(value), 2)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, so that the rows are valid JSON."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.nullif(F.col(c), F.lit(float("nan"))).alias(c) if c in floats else F.col(c) for c in df.columns])
