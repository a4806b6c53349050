"""The spectrum as an array column, and its wide and long forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = "wn_"


def spectral_columns(columns: list[str], prefix: str = PREFIX) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def widen(df: DataFrame, points: int, column: str = "spectrum", prefix: str = PREFIX) -> DataFrame:
    """``spectrum`` → ``wn_0 … wn_{points-1}``, NULL beyond the array's end.

    Wide rows turn whole-stage code generation off above 100 columns, so this belongs at the
    edge of a job; everything inside works on the array.
    """
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, *[F.get(column, F.lit(i)).alias(f"{prefix}{i}") for i in range(points)])


def narrow(df: DataFrame, prefix: str = PREFIX, column: str = "spectrum") -> DataFrame:
    """The inverse of :func:`widen`, ordered by position."""
    wide = sorted(spectral_columns(df.columns, prefix), key=lambda c: int(c[len(prefix):]))
    if not wide:
        raise ValueError(f"no column starts with {prefix!r}")
    kept = [c for c in df.columns if c not in set(wide)]
    return df.select(*kept, F.array(*[F.col(c).cast("double") for c in wide]).alias(column))


def lengthen(df: DataFrame, keys: list[str], column: str = "spectrum") -> DataFrame:
    """One row ``(keys…, i, x)`` for each spectral point."""
    return df.select(*keys, F.posexplode(column).alias("i", "x"))


def complete(spectrum: Column, points: int) -> Column:
    """Exactly ``points`` values, none of them NULL or NaN."""
    if points == 0:
        return F.lit(True)
    return (
        spectrum.isNotNull()
        & (F.size(spectrum) == points)
        & ~F.exists(spectrum, lambda x: x.isNull() | F.isnan(x))
    )
