"""Null-safe column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """A column name in SQL text. Wide tables are built from SQL text: one call per column."""
    return "`" + name.replace("`", "``") + "`"


def null_skipping_sum(cols: Iterable[str], fill: int | float = 0) -> str:
    """SQL of the row-wise sum in which a null counts as ``fill``."""
    return " + ".join(f"coalesce({quoted(c)}, {fill})" for c in cols)


def sums(cols: Iterable[str]) -> list[Column]:
    """Sum of each column under its own name."""
    return [F.expr(f"sum({quoted(c)}) AS {quoted(c)}") for c in cols]


def is_close(a: str | Column, b: str | Column, rtol: float, atol: float = 1e-8) -> Column:
    """``|a - b| <= atol + rtol * |b|``."""
    a, b = as_col(a), as_col(b)
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def round_to_long(c: str) -> str:
    """SQL that rounds half to even and returns a bigint; a null raises."""
    c = quoted(c)
    return (f"CASE WHEN {c} IS NULL THEN raise_error('cannot round a null') "
            f"ELSE CAST(rint({c}) AS BIGINT) END")


def ratio_sql(numerator: str, denominator: str) -> str:
    """SQL of the quotient as a double; null where the denominator is zero or a side missing."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def ratio(numerator: str, denominator: str) -> Column:
    return F.expr(ratio_sql(quoted(numerator), quoted(denominator)))


def replaced(df: DataFrame, new: dict[str, str]) -> list[str]:
    """SQL of all columns of ``df``, those in ``new`` replaced by their expression."""
    return [f"{new[c]} AS {quoted(c)}" if c in new else quoted(c) for c in df.columns]


def nan_to_null(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)
