"""File names, links and expressions as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from popflow.functions.columns import as_col


def strip_extension(name: str | Column) -> Column:
    """The name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(as_col(name), r"(?<=[^/])\.[^./]*$", "")


def name_piece(name: str | Column, position: int, sep: str = "_") -> Column:
    """Piece ``position`` (1-based, negative from the end) of a separated name, or null."""
    return F.try_element_at(F.split(as_col(name), sep), F.lit(position))


def first_field(expression: str | Column) -> Column:
    """The attribute named first in a predicate such as ``persons.AGEP <= 4``, unquoted."""
    found = F.regexp_extract(as_col(expression), r"\.(.*?) ", 1)
    return F.nullif(F.regexp_replace(found, "^[\"']+|[\"']+$", ""), F.lit(""))


def hrefs(html: str | Column) -> Column:
    """Targets of all anchors of a page, in page order."""
    return F.regexp_extract_all(as_col(html), F.lit(r'(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"'), F.lit(1))


def summary_geography(path: str | Column) -> Column:
    """Geography key in the name of a summary file."""
    return F.regexp_extract(as_col(path), r"summary_(.*?)\.csv", 1)
