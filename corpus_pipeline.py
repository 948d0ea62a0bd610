"""A corpus pipeline over ``documents``: quality, near-dedup, decontamination, ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next stage's
``docs``. All but the last stage return the columns of ``documents``.

The filters take out rows, not ids: a stage numbers its input's rows and
judges each row by its own text, so rows without a doc_id, and rows that
share one, are copies or contaminated like others. Of a group of near copies
the row with the smallest doc_id stays (a row without one only if no row of
the group has one), once. Texts without words are no copies of each other,
but of such rows that share a doc_id one stays.

ORACLE_SQL is None: the classifier and the lattice search are not SQL; the
tests hold the pipeline against a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.decontam import contamination
from quarry.llm.near_dedup import near_duplicates
from quarry.llm.quality_mil import keep_good
from quarry.llm.sp_viterbi import encode
from quarry.llm.tables import checked_broadcast, table, tokenizer_file, written

ORACLE_SQL = None


def numbered(docs: DataFrame) -> DataFrame:
    """(row, d): each row of ``docs`` as ``d``, with a number of its own that
    stands, as the table is written."""
    return written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("d")), "rows")


def texts(rows: DataFrame) -> DataFrame:
    """The row numbers as doc_id, with their texts."""
    return rows.select(F.col("row").alias("doc_id"), F.col("d.text").alias("text"))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents of ``rows`` whose ``row`` is not in ``gone``."""
    return rows.join(checked_broadcast(written(gone, "gone")), "row", "left_anti").select("d.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    rows = numbered(docs)
    found = near_duplicates(texts(rows)).select(F.col("doc_id").alias("row"), "n_shingles", "component_id")
    placed = written(found.join(rows.select("row", F.col("d.doc_id").alias("doc_id")), "row"), "placed")
    wordless = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    group = [F.when(~wordless, F.col("component_id")).alias("copies"), F.when(wordless, F.col("doc_id")).alias("repeats")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    stays = placed.groupBy(*group).agg(first.alias("first")).select("first.row")
    return without(rows, placed.select("row").join(stays, "row", "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    rows = numbered(docs)
    verdicts = contamination(texts(rows), table(spark, sf_dir, "benchmark"))
    return without(rows, verdicts.where("contaminated").select(F.col("doc_id").alias("row")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, exact) of each document that is left."""
    return encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
