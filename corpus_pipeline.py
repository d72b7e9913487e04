"""Corpus cleaning from documents to packed sequences: language ID, exact dedup, near dedup, best-fit packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import read, written
from cohortloom.llm.exact_dedup import exact_dedup
from cohortloom.llm.language_id import UNKNOWN, language_id
from cohortloom.llm.near_dedup import near_dedup
from cohortloom.llm.packing import pack_documents
from cohortloom.llm.queries import WORD_TOKENIZER

_ROW = "__pipeline_row"
#: Languages of the corpus that is made. Documents of any other language that the model has learned go.
LANGUAGES: tuple[str, ...] = ("en", "de", "fr", "es")
#: Least calibrated probability of another language at which a document goes; short clean texts may be hard to tell.
REJECT_AT = 0.5


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with an identity for each row that stays with it whatever is computed again: whole path of the file
    and place in it of a table that is read as it stands, else a number in a written copy."""
    try:
        return docs.select("*", F.concat_ws(":", "_metadata.file_path", "_metadata.row_index").alias(_ROW))
    except AnalysisException:
        return written(docs.withColumn(_ROW, F.monotonically_increasing_id()), "pipeline-rows")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] = LANGUAGES, reject_at: float = REJECT_AT) -> DataFrame:
    """Documents with a letter, but those that the classifier gives another language than ``languages`` with a probability
    of ``reject_at`` or more. Where no row has a language to learn from, all texts with a letter stay."""
    predicted = language_id(docs, keep=tuple(docs.columns))
    rejected = ~F.col("lang_pred").isin(UNKNOWN, *languages) & (F.col("score") >= reject_at)
    return predicted.where(F.col("has_letters") & ~rejected).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (after white space is normalised) the row with the smallest id."""
    rows = _numbered(docs)
    kept = exact_dedup(rows, row_col=_ROW).where("kept").select(F.col("row_uid").alias(_ROW))
    return rows.join(kept, _ROW, "left_semi").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id; of repeated ids the first."""
    rows = _numbered(docs)
    whole_id = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(_ROW).alias("row"))
    kept = near_dedup(rows.select(whole_id.alias("doc_id"), "text")).where("kept").select(F.col("doc_id.row").alias(_ROW))
    return rows.join(kept, _ROW, "left_semi").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of packed sequences of at most 2048 tokens."""
    return pack_documents(docs, WORD_TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the classifier of the first stage; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
