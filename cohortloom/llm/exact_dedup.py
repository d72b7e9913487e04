"""Exact deduplication by a tree merge of digest runs, in DataFrame functions only.

Every row gets a digest of its normalised text and one of ``runs`` run numbers. At the leaves each run is reduced to one
entry per digest; in every following round ``fan_in`` neighbouring runs meet (run number divided by ``fan_in``) and are
merged, keeping the smallest identifier and the summed size of each digest, until one run is left. The answers then go
down the same tree. A text with any number of copies therefore never meets in one task: a merge sees at most ``fan_in``
entries of a digest, and the leaves see ``copies / runs``.

An entry is only merged with another if SHA-256, a 64-bit xxHash and the byte length all agree (the verification: a
collision of one digest splits the group instead of losing a text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import SPACES, Scratch, shuffle_partitions, text_or_empty, written

_DIGEST = ["sha", "xx", "n_bytes"]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int | None = None, fan_in: int = 4, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, row_uid``.

    Texts are equal when identical after each run of ASCII white space is one space; null is the empty text. Of equal
    texts the smallest id stays; null ids come after all others. Of repeated rows with that id just one is ``kept``
    (the one that Spark reads first). ``row_uid`` numbers the input rows, or is ``row_col``, a number that no two rows share. Empty input gives an empty result. Other
    columns are ignored. ``runs``: at least 64, and a third of a hot digest's copies per shuffle partition otherwise.
    """
    runs = runs or max(64, shuffle_partitions(docs.sparkSession))
    scratch = Scratch(docs.sparkSession, "exact")
    text = F.regexp_replace(text_or_empty(text_col), SPACES, " ")
    leaf = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row_uid")).select(
        "doc_id",
        "row_uid",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
        F.xxhash64("text").alias("xx"),
        F.octet_length("text").alias("n_bytes"),
        F.pmod(F.xxhash64("row_uid"), F.lit(runs)).cast("int").alias("run"),
    )
    leaf = scratch.written(leaf, "leaf")
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_uid")
    levels = [scratch.written(leaf.groupBy("run", *_DIGEST).agg(F.min(first).alias("first"), F.count("*").alias("size")), "runs")]
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        levels.append(scratch.written(merged.groupBy("run", *_DIGEST).agg(F.min("first").alias("first"), F.sum("size").alias("size")), "runs"))
    answer = levels.pop()
    while levels:
        lower = levels.pop().select("run", *_DIGEST, F.floor(F.col("run") / fan_in).cast("int").alias("up"))
        answer = lower.join(answer.withColumnRenamed("run", "up"), ["up", *_DIGEST]).drop("up")
    result = leaf.join(answer, ["run", *_DIGEST]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row_uid") == F.col("first.row_uid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "row_uid",
    )
    result = written(result, "exact-result")
    scratch.drop()
    return result


EXACT_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
