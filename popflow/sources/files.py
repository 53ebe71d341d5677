"""Named input and output files, summaries and the union of state folders."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.specs import INPUT_RENAMES

# File names of a prepared state folder (fixed values)
INPUT_FILES = {
    "seed_hh": "seed_households.csv",
    "seed_per": "seed_persons.csv",
    "BG": "control_totals_BG.csv",
    "TRACT": "control_totals_TRACT.csv",
    "STATE": "control_totals_STATE.csv",
    "REGION": "scaled_control_totals_meta.csv",
    "xwalk": "geo_cross_walk.csv",
}
TEXT_COLUMNS = {"SERIALNO", "NAME", "NAMELSAD"}


def read_csv(spark: SparkSession, path: str | list[str], types: Mapping[str, str] | None = None
             ) -> DataFrame:
    """CSV by header name. Columns are doubles or bigints by ``types``, text if named so, and
    bigint by default; no inference pass over the data."""
    raw = by_header(spark, path)
    kinds = types or {}
    return raw.select(*[
        F.col(c).cast(kinds.get(c, "string" if c in TEXT_COLUMNS else "bigint")).alias(c)
        for c in raw.columns
    ])


_FILE = "__file"


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The files by their first line, from one scan of their first blocks.

    One row per file reaches the driver.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"))
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        found.setdefault(row["header"], []).append(unquote(row["file"]))
    return found


def by_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files as text columns, bound by the names in their headers.

    Paths of a list may differ in the order and the set of their columns; what one lacks is null.
    Files of one path must agree: a file whose header differs stops the job. A list takes one scan
    for the headers and one read for each different header, however many files there are.
    """
    if isinstance(path, str):
        return spark.read.csv(path, header=True, enforceSchema=False)
    if len(path) == 1:
        return by_header(spark, path[0])
    return union_tables([spark.read.csv(files, header=True, enforceSchema=False)
                         for files in headers(spark, path).values()])


def read_inputs(
    spark: SparkSession, folder: str, types: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """All prepared tables of a folder; a missing file stops the read."""
    return {
        name: read_csv(spark, f"{folder}/{file}", types) for name, file in INPUT_FILES.items()
    }


def map_inputs(df: DataFrame, renames: Mapping[str, str] = INPUT_RENAMES) -> DataFrame:
    """Rename input columns to the names the synthesis uses."""
    return df.withColumnsRenamed(dict(renames))


def write_csv(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Write CSV with a header, one folder per ``partition`` value if given.

    Re-based tables go to a new path: a plan cannot overwrite what it reads.
    """
    writer = df.write.option("header", True).mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).csv(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, partition: str | None = None
                 ) -> None:
    """Write each table to ``folder/name``."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}", partition if partition in df.columns else None)


def read_summaries(
    spark: SparkSession, folder: str, geographies: Sequence[str], prefix: str = "final_summary_"
) -> dict[str, DataFrame]:
    """Summary tables by geography key; summaries with one header are read together."""
    names = {f"{prefix}{geo}.csv": geo for geo in geographies}
    found = headers(spark, [f"{folder}/{name}" for name in names])
    out = {}
    for files in found.values():
        df = spark.read.csv(files, header=True, enforceSchema=False).withColumn(
            _FILE, F.col("_metadata.file_path"))
        numbers = [F.col(c).cast("double").alias(c) for c in df.columns if c not in ("id", _FILE)]
        for name, geo in names.items():
            mine = rf"/{re.escape(name)}(/[^/]*)?$"
            if any(re.search(mine, f) for f in files):
                out[geo] = df.filter(F.url_decode(_FILE).rlike(mine)).select(
                    F.col("id").cast("bigint").alias("id"), *numbers)
    return out


def present_states(spark: SparkSession, root: str, file: str) -> DataFrame:
    """State folders that hold ``file``, as one file or as a folder Spark wrote; lists files
    without reading them."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        root).select("path")
    here = rf"/([^/]+)/{re.escape(file)}(/part-[^/]*)?$"
    return listing.filter(F.col("path").rlike(here)).select(
        F.regexp_extract("path", here, 1).alias("state")).distinct()


def missing_states(present: DataFrame, wanted: DataFrame, col: str = "state") -> DataFrame:
    """Wanted states without a file."""
    return wanted.select(col).distinct().join(present, col, "left_anti")


def combine_states(
    spark: SparkSession, root: str, file: str, states: Sequence[str],
    types: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of one file over all wanted state folders, and the states that lack it."""
    wanted = spark.createDataFrame([(s,) for s in states], "state string")
    missing = missing_states(present_states(spark, root, file), wanted)
    # At most one path per state; no other state is read.
    lacking = {r["state"] for r in missing.collect()}
    paths = [f"{root}/{s}/{file}" for s in states if s not in lacking]
    if not paths:
        raise ValueError(f"no state of {list(states)} has {file}")
    return read_csv(spark, paths, types), missing


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Concatenate tables, filling columns a table lacks with nulls."""
    first, *rest = tables
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first
