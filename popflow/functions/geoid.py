"""Geographic identifiers: composition from parts and zero padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.functions.columns import as_col, quoted, replaced
from popflow.specs import GEOID_LEN, GEOID_STRUCTURE


def _part(name: str, digits: int) -> str:
    c = quoted(name)
    return (f"CASE WHEN {c} IS NULL THEN raise_error('geoid part {name} has missing values') "
            f"ELSE pmod(CAST({c} AS BIGINT), {10**digits}L) END")


def compose_geoids(
    df: DataFrame,
    lens: dict[str, int] = GEOID_LEN,
    structure: dict[str, list[str]] = GEOID_STRUCTURE,
) -> DataFrame:
    """Replace every identifier column by the integer made of its nested parts.

    Each part contributes its last ``lens[part]`` digits, so composing twice changes nothing.
    All identifiers are built in one projection from the incoming columns.
    """
    present = [c for c in lens if c in df.columns]
    if not present:
        raise ValueError("no geoid columns found")
    composed = {}
    for name in present:
        lacking = [p for p in structure[name] if p not in df.columns]
        if lacking:
            raise ValueError(f"{name} needs the columns {lacking}")
        value = "0L"
        for part in structure[name]:
            value = f"({value}) * {10 ** lens[part]}L + {_part(part, lens[part])}"
        composed[name] = value
    return df.selectExpr(*replaced(df, composed))


def zfill(c: str | Column, width: int) -> Column:
    """Left-pad with zeros; longer values keep all their characters."""
    text = as_col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def pad_concat(parts: dict[str, int]) -> Column:
    """Concatenate zero-padded columns, e.g. ``{'ST': 2, 'PUMA': 5}``."""
    return F.concat(*[zfill(F.col(c).cast("bigint"), width) for c, width in parts.items()])
