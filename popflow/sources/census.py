"""Published tables in the array-of-arrays JSON layout, possibly split into column groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_cells(df: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per data row of each payload, as a map from header name to text value."""
    rows = F.from_json(F.col(payload), "array<array<string>>")
    return (
        df.select(*keep, rows.alias("__rows"))
        .select(*keep, F.col("__rows")[0].alias("__header"),
                F.explode(F.slice("__rows", F.lit(2), F.greatest(
                    F.size("__rows") - 1, F.lit(0)))).alias("__values"))
        .select(*keep, F.map_from_arrays("__header", "__values").alias("cells"))
    )


def json_table(
    df: DataFrame, payload: str, types: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Typed table from payloads whose first row is the header. A value that does not fit its
    type stops the job, and so does a declared column that a header lacks."""
    cells = json_cells(df, payload, keep)

    def value(name: str) -> Column:
        return F.when(F.map_contains_key("cells", name), F.element_at("cells", F.lit(name))
                      ).otherwise(F.raise_error(F.lit(f"column not found: {name}")))

    return cells.select(*keep, *[
        value(name).cast(kind).alias(name) for name, kind in types.items()])


def read_json_table(
    spark: SparkSession, path: str | list[str], types: Mapping[str, str]
) -> DataFrame:
    """Read payload files, one document per file."""
    return json_table(spark.read.text(path, wholetext=True), "value", types)


def natural_rejoin(chunks: Sequence[DataFrame]) -> DataFrame:
    """Join column groups on all the columns they share."""
    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        common = [c for c in a.columns if c in b.columns]
        if not common:
            raise ValueError(f"no columns in common between {a.columns} and {b.columns}")
        return a.join(b, common)
    return reduce(join, chunks)


def field_chunks(fields: Sequence[str], size: int, always: Sequence[str] = ()) -> list[list[str]]:
    """Column groups of at most ``size`` fields, each with the key columns added."""
    if size < 1:
        raise ValueError("size must be at least one")
    chunks = [list(fields[i:i + size]) for i in range(0, len(fields), size)]
    return [c + [k for k in always if k in fields and k not in c] for c in chunks]


def extras_first(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Undeclared columns in name order, then the declared ones in their order."""
    return df.select(*sorted(set(df.columns) - set(declared)), *declared)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the declared columns that exist; a value that does not fit stops the job."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def best_effort_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast a text column to bigint or double if every one of its values parses.

    The decision is per column and takes one aggregate row; the table is not collected.
    """
    texts = [f.name for f in df.schema.fields
             if f.dataType.typeName() == "string" and (cols is None or f.name in cols)]
    if not texts:
        return df

    def unparsed(c: str, kind: str) -> Column:
        return F.count_if(F.col(c).try_cast(kind).isNull() & F.col(c).isNotNull())

    row = df.agg(*[
        unparsed(c, kind).alias(f"{i}_{kind}")
        for i, c in enumerate(texts) for kind in ("bigint", "double")
    ]).first()
    casts = {}
    for i, c in enumerate(texts):
        kind = next((k for k in ("bigint", "double") if row[f"{i}_{k}"] == 0), None)
        if kind:
            casts[c] = F.col(c).cast(kind)
    return df.withColumns(casts) if casts else df
