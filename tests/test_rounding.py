"""Numbers next to a tie are rounded and written as SQL does it, not by their shortest decimal text."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from cohortloom.functions.numeric import half_even, rounded
from cohortloom.operators import reasons
from cohortloom.operators.assessments import six_digits
from cohortloom.plans import oracles

TIES = [4.739949999999999, 1.005, 65.85, 2.675, 0.285, 33.445, 123.455, 0.5, 1.5, 4.73995, -65.85, 57.65, 0.15]


def test_rounding_is_that_of_sql(spark):
    df = spark.createDataFrame([(x,) for x in TIES], "x double")
    for d in (1, 2, 4):
        got = df.select("x", rounded(F.col("x"), d), half_even(F.col("x"), d)).collect()
        want = duckdb.sql(f"SELECT x, round(x, {d}), round_even(x, {d}) FROM (SELECT unnest([{', '.join(f'{x!r}::DOUBLE' for x in TIES)}]) AS x)").fetchall()
        assert sorted(map(tuple, got)) == sorted(want)
    assert df.select(rounded(F.lit(1.005), 2), half_even(F.lit(65.85), 1)).first() == (1.0, 65.8)


def test_contributions_of_reason_rows_are_rounded_twice_as_in_sql(spark):
    share = 33.345  # half to even gives 33.34 and then 33.3
    columns = "mono_id string, feature string, severity double, value double, previous double, train_reference double, peer_median double, peer_z double, peer_support long, peer_level string, peer_score double, peer_quality string"
    other = ("UNKNOWN", 70.0, "ZAYIF")
    rows = spark.createDataFrame([("1", "bank_risk", share, 2.0, None, None, 1.0, 3.0, 9, *other), ("1", "other", 100 - share, 2.0, None, None, 1.0, 3.0, 9, *other)], columns)
    got = {r["feature"]: r["pct"] for r in reasons.build_reasons(rows, ["mono_id"], 2, share_rounding=rounded).select(F.inline("reasons")).select("feature", rounded(F.col("contribution_pct"), 1).alias("pct")).collect()}
    want = duckdb.sql(f"SELECT round(round({share}::DOUBLE / 100 * 100, 2), 1)").fetchall()[0][0]
    assert got["bank_risk"] == want == 33.4


def test_six_digits_are_those_of_printf(spark):
    values = [123456.5, 123457.5, 1.000005, 123.4565, 12.34565, 0.1234565, 2.000015, 1234567.0, -3.14159265, 0.000123456789, 0.0, 100.5, 31250.25]
    got = [tuple(r) for r in spark.createDataFrame([(x,) for x in values], "x double").select("x", six_digits(F.col("x"))).collect()]
    want = duckdb.sql(f"SELECT x, {oracles._sig('x')} FROM (SELECT unnest([{', '.join(f'{x!r}::DOUBLE' for x in values)}]) AS x)").fetchall()
    assert sorted(got) == sorted(want)
