"""Exact quantiles by ranks against the built-in percentile, and percentiles against a plain count, with few rows a task."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cohortloom.operators import quantiles
from cohortloom.operators.quantiles import grouped_quantiles, interpolated
from cohortloom.sources.staging import staged


def test_quantiles_are_those_of_percentile(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1.0, 2.5, rnd.gauss(0, 100)])) for _ in range(700)] + [("one", 7.0), ("none", None), ("two", -1.0), ("two", 4.0)] + [("hot", float(i % 90)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    asked = {"low": 0.01, "a": 0.25, "m": 0.5, "top": 1.0}
    got = {r["k"]: tuple(r)[1:] for r in grouped_quantiles(df, ["k"], F.col("v"), asked).select("k", "n", *(interpolated(F.col(q)).alias(q) for q in asked)).collect()}
    want = {r["k"]: (r["n"], *r["q"]) for r in df.where("v IS NOT NULL").groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, asked.values()))).alias("q")).collect()}
    assert got == want and "none" not in got
    one = grouped_quantiles(df, [], F.col("v"), {"m": 0.5}).select("n", interpolated(F.col("m")).alias("m"), interpolated(F.col("m"), lambda x: x * 2).alias("twice")).collect()
    assert [(r["n"], r["m"], r["twice"]) for r in one] == [(r["n"], r["m"], 2 * r["m"]) for r in df.agg(F.count("v").alias("n"), F.median("v").alias("m")).collect()]
    assert grouped_quantiles(df.limit(0), ["k"], F.col("v"), {"m": 0.5}).count() == 0


def test_only_values_near_the_asked_ranks_are_dealt(spark, monkeypatch):
    sizes = {}

    def counted(df, label):
        out = staged(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(quantiles, "staged", counted)
    df = spark.range(6000).select((F.col("id") % 3).alias("k"), F.exp(F.col("id") / 1000).alias("v"))
    got = {r["k"]: r["m"] for r in grouped_quantiles(df, ["k"], F.col("v"), {"m": 0.5}).select("k", interpolated(F.col("m")).alias("m")).collect()}
    assert got == {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert sizes["quantiles"] < 6000 / 50


def test_bands_never_fall_as_values_rise(spark):
    values = [float("-inf"), -1.7e308, -3.0, -1.0, -0.02, -5e-324, 0.0, 5e-324, 1e-300, 0.02, 0.021, 1.0, 1.5, 3.0, 1e9, 1.7e308, float("inf"), float("nan")]
    bands = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(quantiles.band_of(F.col("v"))).collect()]
    assert bands == sorted(bands) and len(set(bands)) == len(values)
