"""Peer references work out only groups that rows are compared with, and don't shuffle the rows again."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import peers
from cohortloom.sources.staging import staged


def test_values_go_to_groups_that_are_used_alone(spark, monkeypatch):
    lists = []

    def kept(df, label):
        out = staged(df, label)
        if label == "peer-entries":
            lists.extend(out.select(F.size("groups").alias("n"), "cell").collect())
        return out

    monkeypatch.setattr(peers, "staged", kept)
    k = F.col("id")
    long = spark.range(500).select(
        k.cast("string").alias("mono_id"), F.lit("2025-01-31").cast("date").alias("cohort_dt"), F.when(k < 480, "A").otherwise("B").alias("peer_segment"), F.when(k % 2 == 0, "1").otherwise("2").alias("peer_sector"),
        F.when(k % 3 == 0, "S1").otherwise("S2").alias("peer_size"), F.lit("f").alias("feature"), F.exp(k / 100).alias("value"),
    )
    long = staged(long, "long")
    found = peers.peer_references(long)
    # cells of A have 80 values or more, those of B fewer than 50: all of the month's values are compared with by B alone
    assert lists and max(r["n"] for r in lists) == 3
    assert {(r["peer_segment"], r["peer_level"]) for r in found.collect()} == {("A", "AY_SEGMENT_SEKTOR_SIZE"), ("B", "AY")}
    levels = {(r["feature"], r["level"], r["group_key"]): r for r in peers.level_statistics(long).collect()}
    month = next(r for (_, level, _), r in levels.items() if level == "AY")
    assert {(r["peer_median"], r["peer_support"]) for r in found.where("peer_level = 'AY'").collect()} == {(month["median"], month["support"])}
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_matrix_keeps_rows_where_they_are(spark):
    k = F.col("id")
    wide = spark.range(400).select(
        k.cast("string").alias("mono_id"), F.lit("2025-01-31").cast("date").alias("cohort_dt"), F.when(k < 380, "A").otherwise("B").alias("peer_segment"), F.lit("1").alias("peer_sector"),
        F.when(k % 3 == 0, "S1").otherwise("S2").alias("peer_size"), F.when(k % 7 != 0, F.exp(k / 50)).alias("f"), (k % 11).cast("double").alias("g"), F.lit(None).cast("double").alias("h"),
    )
    wide, features = staged(wide, "wide"), ["f", "g", "h"]
    long = peers.long_form(wide, features, [c for c in wide.columns if c not in features])
    for part in (None, "peer_segment"):
        lookup = peers.peer_lookup(long, part=part)
        matrix = peers.peer_matrix(wide, lookup, features, ["mono_id", "cohort_dt"])
        assert "Exchange hashpartitioning(mono_id" not in matrix._jdf.queryExecution().executedPlan().toString()
        got = {(r["mono_id"], f): r[f"{f}__peer_z"] for r in matrix.collect() for f in features}
        assert got == {(r["mono_id"], r["feature"]): r["peer_z"] for r in peers.compared(long, lookup).collect()}
        assert sum(z is not None for z in got.values()) > 700
