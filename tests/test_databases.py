"""Database scans on the Derby that comes with Spark: ranges of a column, pushed filters and columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortloom.sources import readers

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture(scope="module")
def settings(spark):
    """A database in memory with a table of 1000 rows."""
    url = "jdbc:derby:memory:cohortloom;create=true"
    rows = spark.range(1000).select(F.col("id").cast("int").alias("MONO_ID"), F.to_date(F.lit("2025-01-31")).alias("COHORT_DT"), (F.col("id") * 1.5).alias("BANK_TOTAL_RISK"), F.when(F.col("id") % 4 != 0, F.col("id") % 3).alias("GRP"))
    rows.write.mode("overwrite").jdbc(url, "PANEL", properties={"user": "app", "password": "app", "driver": DRIVER})
    return {"url": url, "user": "app", "password": "app", "driver": DRIVER}


def scan_of(df):
    return next(line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan" in line)


def test_whole_table(spark, settings):
    df = readers.read_jdbc(spark, settings, "PANEL")
    assert df.columns == ["mono_id", "cohort_dt", "bank_total_risk", "grp"] and df.count() == 1000 and df.rdd.getNumPartitions() == 1


def test_ranges_of_a_column_are_read_by_tasks(spark, settings):
    df = readers.read_jdbc(spark, settings, "PANEL", "APP", {"column": "MONO_ID", "lower": 0, "upper": 1000, "partitions": 4})
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert df.rdd.getNumPartitions() == 4 and sorted(r["count"] for r in sizes) == [250] * 4
    wide = readers.read_jdbc(spark, settings, "PANEL", split={"column": "MONO_ID", "lower": 400, "upper": 600, "partitions": 4})
    assert wide.count() == 1000  # rows outside the bounds belong to the first and the last range


def test_filters_and_columns_reach_the_database(spark, settings):
    df = readers.read_jdbc(spark, settings, "PANEL", split={"column": "MONO_ID", "lower": 0, "upper": 1000, "partitions": 4}).where("bank_total_risk > 1200 AND grp = 1").select("mono_id")
    scan = scan_of(df)
    assert "GreaterThan(BANK_TOTAL_RISK,1200.0)" in scan.replace(" ", "") or "*GreaterThan" in scan, scan
    assert "EqualTo" in scan and "ReadSchema: struct<MONO_ID:int>" in scan
    assert sorted(r.mono_id for r in df.collect()) == [i for i in range(1000) if i * 1.5 > 1200 and i % 4 and i % 3 == 1]


def test_settings_and_names_are_checked(spark, settings):
    with pytest.raises(ValueError, match="password"):
        readers.read_jdbc(spark, {k: v for k, v in settings.items() if k != "password"}, "PANEL")
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, settings, "PANEL; DROP TABLE PANEL")
    assert readers.jdbc_options(settings)["fetchsize"] == str(readers.FETCH_ROWS)
