"""Zone boundaries from vertex tables or well-known text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.functions.columns import as_col


def strip_vintage(df: DataFrame) -> DataFrame:
    """Remove every ``10`` and ``20`` from column names."""
    return df.toDF(*[re.sub("10|20", "", c) for c in df.columns])


def rings_from_vertices(vertices: DataFrame, keep: Sequence[str] = ("GEOID",)) -> DataFrame:
    """Zones from one row per vertex with ``ring_no``, ``v``, ``lon`` and ``lat``."""
    ring = F.array_sort(F.collect_list(F.struct("v", "lon", "lat")))
    rings = vertices.groupBy(*keep, "ring_no").agg(
        F.transform(ring, lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
        .alias("ring"))
    in_order = F.array_sort(F.collect_list(F.struct("ring_no", "ring")))
    return rings.groupBy(*keep).agg(F.transform(in_order, lambda r: r["ring"]).alias("rings"))


def rings_from_wkt(wkt: str | Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text."""
    texts = F.regexp_extract_all(as_col(wkt), F.lit(r"\(([^()]+)\)"), F.lit(1))

    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(xy[0].cast("double").alias("lon"), xy[1].cast("double").alias("lat"))

    return F.transform(texts, lambda t: F.transform(F.split(t, ","), point))
