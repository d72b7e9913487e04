"""Audit of how filters interact: what each removes first, together with others, or alone, in every order.

Equal texts are found by an existential self-join: a row fails filter E if a row with the same hash, the same exact text
and a smaller id exists (left semi-join). Both sides are only rows whose hash occurs more than once. The right side is
reduced to the smallest id of each text before its shuffle, and rows of a hash with many copies are spread over as many
salts as keep ``SALTED`` of them together, so copies in any number never meet in one task.

The rows that fail E are united with the rows that carry the other failures; adding up the failures of a row gives its
combination, one of 2^5, and what the report needs are the numbers of rows of each combination in each part of the table.
All orders, steps and Shapley sums follow from these.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import SPACES, Scratch, text_or_empty, written

FILTERS = "ABCDE"
#: Rows of one hash that meet at a time.
SALTED = 1024
_E = 1 << FILTERS.index("E")


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: A under 50 words, B under 65 distinct words in 100, C over 5 capital
    letters A-Z in 100 characters, D one of ``#$%&*|``."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    n = F.size(words)
    fails = {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 65 * n.cast("long"),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }
    return sum((F.when(fail, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0)) for name, fail in fails.items()), F.lit(0))


def repeats_of_smaller(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows (``doc_id, part, hash, text``) whose whole text a row with a smaller id has; a null id is larger than all others."""
    repeated = scratch.written(rows.groupBy("hash").agg(F.count("*").alias("copies")).where("copies > 1"), "repeated")
    salts = F.ceil(F.col("copies") / SALTED).cast("int")
    rows = rows.join(repeated, "hash")
    firsts = rows.groupBy("hash", "text").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id")).alias("first"), F.max(salts).alias("salts"))
    firsts = firsts.select("hash", "text", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("hash", "salt", "text")]
    smaller = F.col("r.first") < F.struct(F.col("l.doc_id").isNull().alias("missing"), F.col("l.doc_id").alias("doc_id"))
    return spread.alias("l").join(firsts.alias("r"), [*same, smaller], "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, fails, n, good, toxic``: rows of each part that fail just these filters (a number of bits), and those of
    them that are labelled of good quality or toxic.

    Rows with the same id, part and text are alike in all of this and travel as one with their number. A null text is
    empty, a null part the empty string; rows with null ids have no label; ids that are labelled more than once have
    quality and toxic if any of the labels says so.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_or_empty(text_col).alias("text")).withColumn("hash", F.xxhash64("text"))
    others = scratch.written(rows.select("doc_id", "part", "hash", failures(F.col("text")).alias("fails")), "fails")
    key = ["doc_id", "part", "hash"]
    repeats = repeats_of_smaller(rows, scratch).select(*key, F.lit(_E).alias("fails"), F.lit(0).alias("n"))
    marked = others.select(*key, "fails", F.lit(1).alias("n")).unionByName(repeats).groupBy(*key).agg(F.bit_or("fails").alias("fails"), F.sum("n").alias("n"))
    known = scratch.written(
        labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")),
        "labels",
    )
    counted = marked.join(known, "doc_id", "left").groupBy("part", "fails").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")]
    )
    result = written(counted, "audit-result")
    scratch.drop()
    return result


def _orders() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before it) of all orders."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append((order, step, bit, before))
            before |= bit
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of each part,
    order of the five filters and step in it.

    ``kept`` and ``removed`` are counts after and at the step, ``redundant`` of rows that fail its filter but went before,
    ``unique_fails`` of rows that fail no other; ``good_lost`` and ``toxic_lost`` of labelled rows that go here.
    ``shapley`` is what the filter removes summed over all orders: of a row that fails k filters, each is first in one
    order of k. An empty table has no parts and gives no rows. Other columns are ignored whatever their names.
    """
    parts = combinations(docs, labels, id_col, text_col, part_col).groupBy("part").agg(
        F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("combos")  # 32 at most
    )
    names = ("filter_order", "step", "bit", "before")
    orders = F.from_json(F.lit(json.dumps([dict(zip(names, row, strict=True)) for row in _orders()])), "array<struct<filter_order:string,step:int,bit:int,before:int>>")  # one constant, not 600 expressions
    steps = parts.select("part", "combos", F.explode(orders).alias("at")).select("part", "combos", "at.*")
    fails = lambda c: c["fails"].bitwiseAND(F.col("bit")) != 0
    gone = lambda c: c["fails"].bitwiseAND(F.col("before")) != 0

    def total(of, value="n", weight=None) -> Column:
        """Sum over the combinations that ``of`` accepts."""
        return F.aggregate("combos", F.lit(0).cast("long"), lambda sum_, c: sum_ + F.when(of(c), c[value] * (weight(c) if weight else F.lit(1))).otherwise(F.lit(0)))

    shares = lambda c: F.lit(len(_orders()) // len(FILTERS)) / F.bit_count(c["fails"])
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: c["fails"].bitwiseAND(F.col("before").bitwiseOR(F.col("bit"))) == 0).alias("kept"),
        total(lambda c: fails(c) & ~gone(c)).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"),
        total(lambda c: c["fails"] == F.col("bit")).alias("unique_fails"),
        total(lambda c: fails(c) & ~gone(c), "good").alias("good_lost"),
        total(lambda c: fails(c) & ~gone(c), "toxic").alias("toxic_lost"),
        total(fails, weight=lambda c: shares(c).cast("long")).alias("shapley"),
    )


FILTER_AUDIT_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
bad AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
f AS (
  SELECT part, (doc_id IN (SELECT doc_id FROM good))::INT AS good, (doc_id IN (SELECT doc_id FROM bad))::INT AS toxic,
    {'A': len(words) < 50,
     'B': 100 * len(list_distinct(words)) < 65 * len(words),
     'C': 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text),
     'D': regexp_matches(text, '[#$%&*|]'),
     'E': doc_id > min(doc_id) OVER (PARTITION BY text)} AS m
  FROM w),
c AS (SELECT part, m.A AS a, m.B AS b, m.C AS c, m.D AS d, m.E AS e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic,
        (CASE WHEN m.A THEN 'A' ELSE '' END) || (CASE WHEN m.B THEN 'B' ELSE '' END) || (CASE WHEN m.C THEN 'C' ELSE '' END) || (CASE WHEN m.D THEN 'D' ELSE '' END) || (CASE WHEN m.E THEN 'E' ELSE '' END) AS failed
      FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (SELECT v.l || x.l || y.l || z.l || u.l AS filter_order FROM l v, l x, l y, l z, l u
      WHERE x.l <> v.l AND y.l NOT IN (v.l, x.l) AND z.l NOT IN (v.l, x.l, y.l) AND u.l NOT IN (v.l, x.l, y.l, z.l)),
s AS (SELECT filter_order, step, filter_order[step] AS name, substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) r(step)),
j AS (SELECT part, filter_order, step, name, failed, n, good, toxic,
        contains(failed, name) AS fails,
        len(list_intersect(string_split(before, ''), string_split(failed, ''))) > 0 AND failed <> '' AND before <> '' AS gone
      FROM s, c),
p AS (SELECT part, filter_order, step, name,
        sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN failed = name THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, name)::BIGINT AS shapley
FROM p
"""
