"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """One row (doc_id, label) per labelled id; null ids or labels and contradictions are out."""
    return (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__max"))
        .filter(F.col("label") == F.col("__max")).drop("__max")
    )


_MARKS, _MAP = 1 << 26, 1 << 15  # bits of all marks, 8 MB, and of one row


def perhaps_in(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` whose key is among ``ids``, and a few others.

    Keys are told apart by 26 bits of a hash, marked in bit maps of 8 MB at most whatever the number
    of ids, so that rows of other keys need not cross the network; an exact join follows.
    """
    if rows.schema[key].dataType != ids.schema[key].dataType:  # equal values may differ in hash
        return rows
    mark = F.pmod(F.xxhash64(F.lit("mark"), key), F.lit(_MARKS))
    maps = ids.select(mark.alias("__mark")).groupBy(
        F.floor(F.col("__mark") / _MAP).alias("__map")).agg(
            F.bitmap_construct_agg(F.col("__mark") % _MAP).alias("__bits"))
    place = F.col("__mark") % _MAP
    byte = F.conv(F.hex(F.substring(
        F.col("__bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("__mark", mark).withColumn("__map", F.floor(F.col("__mark") / _MAP)).join(
        F.broadcast(maps), "__map").filter(
            F.getbit(byte, (place % 8).cast("int")) == 1).select(*rows.columns)


def share_below(doc_id: Column, share: Column, salt: str) -> Column:
    """True for about this share of ids, chosen by hash."""
    return F.pmod(F.xxhash64(F.lit(salt), doc_id), F.lit(1 << 30)) < share * (1 << 30)


def sample_ids(
    sized: DataFrame, by: str, max_docs: int, max_bytes: int, salt: str
) -> DataFrame:
    """Of (doc_id, bytes, ``by``): about ``max_docs`` rows and ``max_bytes`` bytes a class at most.

    The expected size is bounded by the two parameters whatever the size of the input. ``weight``
    says for how many rows of its class a row stands.
    """
    shares = sized.groupBy(by).agg(
        F.least(F.lit(1.0), F.lit(float(max_docs)) / F.count(F.lit(1)),
                F.lit(float(max_bytes)) / F.greatest(F.sum("bytes"), F.lit(1))).alias("__share"))
    # One row per class.
    return sized.join(F.broadcast(shares), by).filter(
        share_below(F.col("doc_id"), F.col("__share"), salt)).withColumn(
            "weight", 1 / F.col("__share")).drop("__share")
