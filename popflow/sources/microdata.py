"""Microdata files and their cache by state."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.sources.files import by_header
from popflow.specs import SENTINEL


def fill_sentinel(
    df: DataFrame, fields: Mapping[str, str], sentinel: int = SENTINEL
) -> DataFrame:
    """The declared columns with every null replaced by the sentinel, then cast."""
    return df.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit(str(sentinel))).cast(kind).alias(c)
        if df.schema[c].dataType.typeName() == "string"
        else F.coalesce(F.col(c), F.lit(sentinel)).cast(kind).alias(c)
        for c, kind in fields.items()
    ])


def read_microdata(
    spark: SparkSession, path: str | list[str], fields: Mapping[str, str]
) -> DataFrame:
    """Read CSV files by column name, only the declared columns, nulls as sentinel."""
    raw = by_header(spark, path)
    lacking = [c for c in fields if c not in raw.columns]
    if lacking:
        raise ValueError(f"columns not found: {lacking}")
    return fill_sentinel(raw, fields)


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Wanted columns the table does not have; metadata only."""
    return [c for c in wanted if c not in df.columns]


def missing_keys(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Wanted keys without any row.

    Keys of both sides are made distinct where they are read, so a key of many rows is a few.
    """
    return wanted.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")


def coverage(df: DataFrame, wanted: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: missing keys, missing columns and whether the cache can be reused."""
    absent = missing_columns(df, columns)
    gaps = missing_keys(df, wanted, key)
    names = F.array(*[F.lit(c) for c in absent]).cast("array<string>")
    return gaps.agg(F.count(F.lit(1)).alias("n_missing_keys")).select(
        "n_missing_keys", names.alias("missing_columns"),
        ((F.col("n_missing_keys") == 0) & F.lit(not absent)).alias("complete"))


def new_rows(incoming: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """Incoming rows of keys the cache does not hold yet."""
    return incoming.join(cached.select(key).distinct(), key, "left_anti").select(
        *incoming.columns)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a cache whose list of parts was written to its end, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/*/_SUCCESS")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root)
    return sorted(int(f.getPath().getParent().getName()) for f in files or [])


def _parts(spark: SparkSession, path: str, version: int) -> list[str]:
    listed = spark.read.schema("part string").parquet(f"{path}/versions/{version}")
    return sorted(r["part"] for r in listed.collect())  # one row per addition


def read_cache(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The cache as its last version, or an earlier one, has it."""
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no cache at {path}")
    parts = _parts(spark, path, versions[-1] if version is None else version)
    return spark.read.option("basePath", f"{path}/parts").parquet(
        *[f"{path}/parts/part={p}" for p in parts]).drop("part")


def _add_part(rows: DataFrame, path: str, key: str, kept: Sequence[str], version: int) -> None:
    """Write rows as a part, then the version that lists it; until then readers see the last one."""
    spark, part = rows.sparkSession, uuid.uuid4().hex
    rows.write.partitionBy(key).parquet(f"{path}/parts/part={part}")
    listed = spark.createDataFrame([(p,) for p in [*kept, part]], "part string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/{version}")


def append_states(
    spark: SparkSession, incoming: DataFrame, path: str, key: str = "ST",
    cached: bool = True,
) -> DataFrame:
    """Add the states the cache lacks; rebuild it when the cache misses columns.

    Only new states are written, so a repeated run adds nothing. A rebuild replaces every state, so
    the incoming rows must hold all states of the cache; if they do not, the lacking ones are named
    and the cache stays as it is. ``cached=False`` starts the cache.

    A cache is a folder of parts, which are never changed, and of versions, each of which lists its
    parts. A version counts once its list is complete, so a job that stops half-way leaves the
    last version as it was, and what it wrote is not read. ``drop_versions`` frees what is old.
    """
    versions = _versions(spark, path)
    last = versions[-1] if versions else 0
    kept: list[str] = []
    if cached:
        present = read_cache(spark, path)
        if not missing_columns(present, incoming.columns):
            fresh = new_rows(incoming, present, key)
            if fresh.isEmpty():
                return present
            kept, incoming = _parts(spark, path, last), fresh
        else:
            lost = sorted(str(r[0]) for r in missing_keys(incoming, present, key).collect())
            if lost:  # one row per state
                raise ValueError(f"a rebuild would lose {key} {lost}")
    _add_part(incoming, path, key, kept, last + 1)
    return read_cache(spark, path)


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` versions and the parts that none of those lists.

    Nothing may be appending meanwhile: a part that no version lists yet would go.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = _versions(spark, path)
    old, kept = versions[:-keep], versions[-keep:]
    used = {p for v in kept for p in _parts(spark, path, v)}
    for version in old:
        fs.delete(fs_path(f"{path}/versions/{version}"), True)
    for found in fs.globStatus(fs_path(f"{path}/parts/*")) or []:
        if found.getPath().getName().removeprefix("part=") not in used:
            fs.delete(found.getPath(), True)
    return len(old)
