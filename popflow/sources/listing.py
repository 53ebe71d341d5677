"""Directory listings as tables: which files a page offers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.functions.text import hrefs, name_piece, strip_extension
from popflow.specs import STATES


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per anchor target of each page."""
    return pages.select(url, F.explode(hrefs(html)).alias("href"))


def state_lookup(spark) -> DataFrame:
    """Code, abbreviation and name of every state: a fixed table of 51 rows."""
    return spark.createDataFrame(STATES, "fips string, abbr string, name string")


def state_abbr(fips: str | Column) -> Column:
    """Abbreviation of a state code, ``Unknown`` for any other value."""
    table = F.create_map(*[F.lit(v) for code, abbr, _ in STATES for v in (code, abbr)])
    key = F.col(fips) if isinstance(fips, str) else fips
    return F.coalesce(F.try_element_at(table, key), F.lit("Unknown"))


def geography_files(
    found: DataFrame, fips: Sequence[str], cache_dir: str, suffix: str = ".zip"
) -> DataFrame:
    """Boundary files of the wanted states, named ``*_*_<fips>_<level><suffix>``.

    Names of another shape are dropped.
    """
    name = strip_extension("href")
    return (
        found.filter(F.col("href").endswith(suffix))
        .select(name_piece(name, 3).alias("fips"),
                F.concat(F.lit(f"{cache_dir}/"), "href").alias("path"),
                F.concat("url", F.lit("/"), "href").alias("file_url"),
                name_piece(name, 4).alias("level"))
        .filter(F.col("fips").isin(list(fips)) & F.col("level").isNotNull())
    )


def microdata_files(
    found: DataFrame, lookup: DataFrame, states: Sequence[str], cache_dir: str,
    suffix: str = ".zip",
) -> DataFrame:
    """Microdata files of the wanted states, named ``csv_<h|p><state><suffix>``.

    A wanted file that is neither a household nor a person file stops the job.
    """
    name = strip_extension("href")
    piece = name_piece(name, 2)
    unknown = F.raise_error(F.concat(F.lit("unknown level in file name "), "href")).cast("string")
    level = (
        F.when(F.substring(piece, 1, 1) == "h", "hh")
        .when(F.contains(name, F.lit("p")), "per").otherwise(unknown)
    )
    wanted = lookup.filter(F.col("abbr").isin(list(states))).select("fips", "abbr")
    return (
        found.filter(F.col("href").endswith(suffix))
        .withColumn("abbr", F.upper(F.right(name, F.lit(2))))
        .join(F.broadcast(wanted), "abbr")  # at most 51 rows
        .select("fips", F.concat(F.lit(f"{cache_dir}/"), "href").alias("path"),
                F.concat("url", F.lit("/"), "href").alias("file_url"), level.alias("level"))
    )
