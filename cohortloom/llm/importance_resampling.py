"""Target-distribution importance resampling over hashed n-gram features, with segment deduplication.

Texts are cut at newlines, which no word holds. Equal lines are one segment: Spark groups them with their number of
occurrences (partly before its shuffle, so a line that a third of all texts repeat is a row for each task), and the
features of a distinct line are counted once and multiplied by its occurrences. n-grams over line ends are in no segment;
they are counted in the texts themselves and added.

A bucket's gain compares the target's smoothed share of it with the source's. The gains, as many as there are buckets, are
all that reaches the tasks for the second pass, in which a text's weight is the mean gain of its features. Adding Gumbel
noise, a hash of the id, to the weights and taking the highest draws without replacement in proportion to exp(weight).
Ranks come from range partitions and their sizes, never from one sorted task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Scratch, map_arrow, text_or_empty, texts_of, written

#: Features that a task remembers the buckets of; a full memory is emptied, results don't depend on it.
MEMORY_ENTRIES = 500_000
#: Bytes of segments whose words are taken together.
TOGETHER = 1 << 20

#: A-Z lower-cased, and every byte that can't be in a word turned into a space; bytes from 0x80 on are letters.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters (lower-cased), digits and other than ASCII characters, in UTF-8."""
    return text.translate(_WORD_BYTES).split()


def ngrams(words: list[bytes], n: int) -> list[bytes]:
    """All runs of 1 to ``n`` consecutive words, joined by one space."""
    return words + [b" ".join(words[i : i + k]) for k in range(2, n + 1) for i in range(len(words) - k + 1)]


def crossing_ngrams(lines: list[list[bytes]], n: int) -> list[bytes]:
    """The n-grams of a text that no single line has: those whose first and last word are of different lines."""
    words = [w for line in lines for w in line]
    line_of = [i for i, line in enumerate(lines) for _ in line]
    return [b" ".join(words[i : i + k]) for k in range(2, n + 1) for i in range(len(words) - k + 1) if line_of[i] != line_of[i + k - 1]]


class Buckets(dict):
    """feature -> bucket, the unsigned crc32 of its UTF-8 bytes modulo ``buckets``; remembers a bounded number."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMORY_ENTRIES:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket

    def of(self, features: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, features), np.int64, len(features))


def _sums(rows: DataFrame, buckets: int, counted: Callable[[Buckets, pa.RecordBatch], Iterator[tuple[np.ndarray, int]]]) -> DataFrame:
    """``bucket, n``: the sums over all rows; a task sends one row for each bucket that it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, memory = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for found, times in counted(memory, batch):
                total += np.bincount(found, minlength=buckets) * times
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], names=["bucket", "n"])

    return rows.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def segment_counts(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """``bucket, n``: how often the features of all ``text`` fall into each bucket, by distinct lines and crossings."""
    lines = texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    lines = lines.select(F.col("line").cast("binary").alias("line"), "times")

    def of_lines(memory: Buckets, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        once: list[bytes] = []
        size = 0
        for line, times in zip(texts_of(batch, "line"), batch.column("times").to_pylist(), strict=True):
            if times > 1 or n > 1:
                yield memory.of(ngrams(words_of(line), n)), times
                continue
            once.append(line)
            size += len(line)
            if size >= TOGETHER:
                yield memory.of(words_of(b" ".join(once))), 1
                once, size = [], 0
        if once:
            yield memory.of(words_of(b" ".join(once))), 1

    found = _sums(lines, buckets, of_lines)
    if n == 1:
        return found

    def of_crossings(memory: Buckets, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        for text in texts_of(batch):
            yield memory.of(crossing_ngrams([words_of(line) for line in text.split(b"\n")], n)), 1

    return found.union(_sums(texts.select(F.col("text").cast("binary").alias("text")), buckets, of_crossings)).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: list[tuple[int, int]], target: list[tuple[int, int]], buckets: int) -> np.ndarray:
    """floor(1000 ln) of the target's smoothed share over the source's, for every bucket."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, rows in ((s, source), (t, target)):
        for bucket, n in rows:
            counts[bucket] = n
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def _gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 x Gumbel noise) of the id; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null for what isn't drawn.

    Drawn are ``percent`` of the rows with at least ``min_words`` words, rounded down, of the highest scores, ties to the
    smaller id (null ids after all others), then by a hash of the text. Null and empty texts have no features and weight
    0; repeated rows count and are drawn each for itself; an empty table of documents gives an empty result, an empty
    target weighs all features by their rareness alone. Other columns are ignored whatever their names. ``buckets`` bounds
    what is sent to the driver and to the tasks.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resampling")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    wanted = target.select(text_or_empty(target_text_col).alias("text"))
    gains = bucket_gains(segment_counts(rows, n, buckets).collect(), segment_counts(wanted, n, buckets).collect(), buckets)  # a row for each bucket at most

    def task():
        memory = Buckets(buckets)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made, weights, words = [], [], []
            for text in texts_of(batch):
                found = words_of(text)
                words.append(len(found))
                features = ngrams(found, n)
                made.append(len(features))
                weights.append(int(gains[memory.of(features)].sum()) // len(features) if features else 0)
            kept = [batch.column(c) for c in ("doc_id", "noise", "text_hash")]
            return pa.RecordBatch.from_arrays([*kept, pa.array(words, pa.int64()), pa.array(made, pa.int64()), pa.array(weights, pa.int64())], names=["doc_id", "noise", "text_hash", "words", "n_features", "weight"])

        return step

    kind = dict(rows.dtypes)["doc_id"]
    weighed = map_arrow(rows.select("doc_id", F.col("text").cast("binary").alias("text"), _gumbel(F.col("doc_id"), seed).alias("noise"), F.xxhash64("text").alias("text_hash")), task, f"doc_id {kind}, noise long, text_hash long, words long, n_features long, weight long")
    scored = scratch.written(weighed.select("doc_id", "text_hash", "words", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score")), "scored")

    able = F.col("words") >= min_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    # the number of a row is made of that of its range partition and its place in it
    number = F.monotonically_increasing_id()
    ranged = scratch.written(
        scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", number).select("*", F.shiftright("number", 33).alias("range"), F.col("number").bitwiseAND((1 << 33) - 1).alias("place")).drop("number"),
        "ranged",
    )
    sizes = sorted(ranged.groupBy("range").count().collect())  # one row for each range partition
    draw = percent * sum(size for _, size in sizes) // 100
    before, offsets = 0, []
    for range_, size in sizes:
        offsets.append((range_, before))
        before += size
    starts = F.create_map(*[F.lit(x) for pair in offsets for x in pair])[F.col("range")] if offsets else F.lit(0)
    rank = (starts + F.col("place") + 1).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranged.select(*columns, F.when(rank <= draw, rank).alias("rank"))
    result = written(drawn.unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))), "resampling-result")
    scratch.drop()
    return result


def resampling_sql(buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: int = 2024) -> str:
    """DuckDB SQL of ``importance_resample`` with single words as features over ``documents`` and ``benchmark``. The crc32
    of each distinct word is made bit by bit."""
    return rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
b AS (SELECT list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
all_words AS (SELECT unnest(words) AS word, 1 AS s, 0 AS t FROM d UNION ALL SELECT unnest(words), 0, 1 FROM b),
counted AS (SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM all_words GROUP BY word),
bytes AS (SELECT word, s, t, list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT) AS bytes FROM counted),
crc AS (SELECT word, s, t, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % {buckets} AS bucket FROM bytes),
sums AS (SELECT sum(s)::BIGINT AS all_s, sum(t)::BIGINT AS all_t FROM crc),
gains AS (SELECT bucket, floor(1000 * ln((sum(t)::BIGINT + 1) * (any_value(all_s) + {buckets}) / ((sum(s)::BIGINT + 1) * (any_value(all_t) + {buckets}))))::BIGINT AS gain FROM crc, sums GROUP BY bucket),
word_gains AS (SELECT word, gain FROM crc JOIN gains USING (bucket)),
spread AS (SELECT row_number() OVER () AS row_no, doc_id, words FROM d),
long_form AS (SELECT row_no, unnest(words) AS word FROM spread),
weights AS (SELECT row_no, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM long_form JOIN word_gains USING (word) GROUP BY row_no),
scored AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
           FROM spread LEFT JOIN weights USING (row_no)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {min_words} ORDER BY score DESC, doc_id) AS place, sum((n_features >= {min_words})::INT) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {min_words} AND place <= {percent} * able // 100 THEN place END AS rank FROM ranked
"""
