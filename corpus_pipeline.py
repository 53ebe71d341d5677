"""From documents to pieces: classify, filter by rules, drop near copies, mix sources, encode.

Every stage takes nulls in any column, a null text counting as an empty one; whole texts of any
length; repeated rows, which are judged each; tables without rows, which stay so; and further
columns of any name, which all but the last stage return as they are. Ties do not matter: scores
are compared with fixed limits, and where one row of several is kept or taken, ids and then all
columns decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.llm import cascade, mixing, near_dup, pieces, pu_quality
from popflow.llm.common import bucket_of, n_words_of
from popflow.session import cut


def held(docs: DataFrame) -> DataFrame:
    """``docs`` with names that no operator uses for the columns they do not look at."""
    return docs.select(*[F.col(c).alias(n) for c, n in names(docs).items()])


def returned(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col(n).alias(c) for c, n in names(docs).items()])


def names(docs: DataFrame) -> dict[str, str]:
    return {c: c if c in ("doc_id", "text", "source") else f"column_{i}"
            for i, c in enumerate(docs.columns)}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the positive-unlabelled classifier scores at 0.7 or more; empty texts have a score."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = pu_quality.fit(docs, labels, bucket_of(F.col("doc_id"), 4) != 2)
    return returned(pu_quality.score(held(docs), network).filter("goodness >= 0.7"), docs)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule; empty texts are too short."""
    return returned(cascade.apply_rules(held(docs)).filter("broken_rule IS NULL"), docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or near equal texts: of the text that leads the group
    the row with the smallest id, null ids last."""
    return returned(near_dup.keep_one(
        held(docs), near_dup.near_duplicates(docs, idf="every")), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for, 0 to 3 times; texts without words
    are taken as often as others. A null source is a source of its own."""
    mixed = mixing.mix_sources(held(docs).withColumn("size", n_words_of(F.col("text"))), "size")
    return returned(mixed.withColumn("copy", F.explode(F.array_repeat(
        F.lit(0), F.col("copies").cast("int")))), docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every document, whose decoding is its text again; none for empty ones."""
    vocabulary = pieces.load(pieces.default_model())
    coded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return coded.select("doc_id", "lang", "source", "pieces", (
        F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_stage),
    ("quality rules", rules_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]
ORACLE_SQL = None  # trained and approximate stages; tested stage by stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
