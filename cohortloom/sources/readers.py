"""Where panels come from: CSV, Excel, JSON lines, tables, databases."""

from __future__ import annotations

from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.text import valid_identifier
from cohortloom.operators.panel import kept_columns, normalized_names

FETCH_ROWS = 250_000


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ",") -> DataFrame:
    """A CSV file as text columns: numbers are read later, by the rules of their locale. A byte-order mark is dropped from the first name."""
    df = normalized_names(spark.read.csv(path, header=True, inferSchema=False, sep=sep, encoding="UTF-8", multiLine=False, ignoreTrailingWhiteSpace=True))
    return kept_columns(df, columns) if columns else df


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """A sheet, read on the driver; an Excel file holds a million rows at most. Needs a local path and an Excel reader for pandas."""
    import pandas as pd

    try:
        frame = pd.read_excel(path, dtype=str)
    except ImportError as error:
        raise RuntimeError("reading Excel files needs openpyxl") from error
    return normalized_names(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"`{c}` string" for c in frame.columns)))


def read_input(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """By suffix: Excel, Parquet, JSON lines, else CSV."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix in (".xlsx", ".xls"):
        df = read_excel(spark, path)
    elif suffix == ".parquet":
        df = normalized_names(spark.read.parquet(path))
    elif suffix in (".jsonl", ".ndjson"):
        return read_jsonl(spark, path)
    else:
        return read_csv(spark, path, columns)
    return kept_columns(df, columns) if columns else df


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON object a line; blank lines are skipped."""
    if schema is None:
        return spark.read.json(path)
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def jdbc_options(settings: dict[str, Any]) -> dict[str, str]:
    """Connection options from a configuration section; raises for what is missing."""
    given = {k.lower(): v for k, v in settings.items() if v not in (None, "")}
    missing = [k for k in ("url", "user", "password") if k not in given]
    if missing:
        raise ValueError(f"connection settings are missing: {', '.join(missing)}")
    return {"url": str(given["url"]), "user": str(given["user"]), "password": str(given["password"]), "fetchsize": str(given.get("fetchsize", FETCH_ROWS)), **({"driver": str(given["driver"])} if "driver" in given else {})}


def read_jdbc(spark: SparkSession, settings: dict[str, Any], table: str, schema: str | None = None, split: dict[str, Any] | None = None) -> DataFrame:
    """A database table. With ``split`` (column, lower, upper, partitions) tasks read ranges of it; filters and columns are pushed to the database."""
    name = ".".join(valid_identifier(x) for x in ([schema] if schema else []) + [table])
    reader = spark.read.format("jdbc").options(**jdbc_options(settings)).option("dbtable", name)
    if split:
        reader = reader.option("partitionColumn", split["column"]).option("lowerBound", split["lower"]).option("upperBound", split["upper"]).option("numPartitions", split["partitions"])
    return normalized_names(reader.load())


def read_query(spark: SparkSession, text: str, **parameters: Any) -> DataFrame:
    """A parametrised SQL query over the session's tables."""
    return normalized_names(spark.sql(text, args=parameters))


def sample(df: DataFrame, n: int = 100_000) -> DataFrame:
    """The first rows that a source gives: for looking at columns, not for statistics."""
    return df.limit(n)


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Lower-case column names of a table, none for a table that is not there."""
    return [c.name.lower() for c in spark.catalog.listColumns(table)] if spark.catalog.tableExists(table) else []
