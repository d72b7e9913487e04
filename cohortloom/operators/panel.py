"""Panels of entities by month: intake, profiles, windows, latest rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import finite, locale_number
from cohortloom.functions.text import mixed_date

# The columns of the panel contract that are never model features, and those that describe an entity.
ID, TIME = "mono_id", "cohort_dt"
CONTEXT = ("musteri_segment", "rating_group", "cst_sector", "cst_nace_code", "cst_nace_code_id", "financial_term_l1y", "financial_term_q", "annualization_q", "ref_donem_id", "yukleme_zmn")
TECHNICAL = ("ref_donem_id", "yukleme_zmn", "data_time", "created_at")


@dataclass(frozen=True)
class PanelColumns:
    """Names of a panel's columns by role."""

    id: str = ID
    time: str = TIME
    context: tuple[str, ...] = CONTEXT
    reserved: tuple[str, ...] = field(default=(ID, TIME, *CONTEXT, *TECHNICAL))


def normalized_names(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case, without a byte-order mark."""
    return df.toDF(*(c.replace("﻿", "").strip().lower() for c in df.columns))


def kept_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns among ``names``, whatever their case, in the order of ``df``."""
    wanted = {n.strip().lower() for n in names}
    return df.select(*(c for c in df.columns if c.strip().lower() in wanted))


def intake(df: DataFrame, columns: PanelColumns = PanelColumns(), numeric: list[str] | None = None, locale_text: bool = True, undated: bool = False) -> DataFrame:
    """A raw frame as a panel: names normalised, ids as text, days parsed, numbers read, rows without a day dropped unless
    ``undated`` ones are wanted.

    Text numbers are read by locale rules; NaN and infinities become NULL. Ids are text so that keys agree everywhere.
    """
    df = normalized_names(df)
    out: list[Column] = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if name == columns.id:
            out.append(F.trim(c.cast("string")).alias(name))
        elif name == columns.time:
            out.append((mixed_date(c) if kind == "string" else c.cast("date")).alias(name))
        elif numeric and name in numeric:
            out.append((locale_number(c) if kind == "string" and locale_text else finite(c)).alias(name))
        elif kind in ("double", "float"):
            out.append(finite(c).alias(name))
        else:
            out.append(c)
    made = df.select(*out)
    return made if undated else made.where(F.col(columns.time).isNotNull())


def month_profile(df: DataFrame, columns: PanelColumns = PanelColumns()) -> DataFrame:
    """``month, n_rows`` per day of the panel."""
    return df.where(F.col(columns.time).isNotNull()).groupBy(F.col(columns.time).cast("date").alias("month")).agg(F.count("*").alias("n_rows"))


def scoring_month(df: DataFrame, explicit: str | None = None, columns: PanelColumns = PanelColumns()) -> date:
    """The latest month of a panel, or the explicit one if the panel has it and earlier ones."""
    months = sorted(r["month"] for r in month_profile(df, columns).collect())  # a row a month
    if not months:
        raise ValueError("the panel has no month")
    if explicit is None:
        return months[-1]
    wanted = df.sparkSession.range(1).select(mixed_date(F.lit(explicit))).first()[0]
    if wanted not in months:
        raise ValueError(f"the panel has no month {explicit}")
    return wanted


def month_tail(df: DataFrame, n: int = 6, columns: PanelColumns = PanelColumns()) -> DataFrame:
    return month_profile(df, columns).orderBy(F.col("month").desc()).limit(n)


def split(df: DataFrame, month: date | Column, columns: PanelColumns = PanelColumns()) -> tuple[DataFrame, DataFrame]:
    """Rows before the month, and of it. Both stay lazy filters on the panel, so that partitions are pruned."""
    month = month if isinstance(month, Column) else F.lit(month)
    return df.where(F.col(columns.time) < month), df.where(F.col(columns.time) == month)


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; ``order`` must tell rows apart where that matters."""
    w = Window.partitionBy(*keys).orderBy(*(c.desc_nulls_last() for c in order))
    return df.withColumn("__latest", F.row_number().over(w)).where("__latest = 1").drop("__latest")


def latest_before(df: DataFrame, month: date | Column, columns: PanelColumns = PanelColumns(), ties: tuple[str, ...] = ()) -> DataFrame:
    """As-of lookup: each entity's last row before the month."""
    before, _ = split(df, month, columns)
    return latest_by_key(before, [columns.id], [F.col(columns.time), *map(F.col, ties)])


def of_entities(df: DataFrame, ids: DataFrame, columns: PanelColumns = PanelColumns()) -> DataFrame:
    """Rows of the entities in ``ids``; Spark broadcasts them where its size limit allows."""
    return df.join(ids.select(F.col(columns.id).cast("string")).distinct(), columns.id, "left_semi")


def missing_entities(requested: DataFrame, df: DataFrame, columns: PanelColumns = PanelColumns()) -> DataFrame:
    return requested.select(columns.id).distinct().join(df.select(columns.id).distinct(), columns.id, "left_anti")


def in_requested_order(df: DataFrame, ids: list[str], columns: PanelColumns = PanelColumns()) -> DataFrame:
    """The first row of each requested id, in the order of the request."""
    order = df.sparkSession.createDataFrame([(i, str(x)) for i, x in enumerate(dict.fromkeys(ids))], f"__ordinal int, {columns.id} string")
    return df.join(order, columns.id).dropDuplicates([columns.id]).orderBy("__ordinal").drop("__ordinal")


def hash_sample(df: DataFrame, n: int, seed: int = 42, keys: tuple[str, ...] = (ID, TIME)) -> DataFrame:
    """At most ``n`` rows: those whose keys hash lowest, the same ones whatever the partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def union_latest(*frames: DataFrame, keys: tuple[str, ...] = (ID, TIME)) -> DataFrame:
    """Frames one after the other; of rows with the same keys that of the last frame stays."""
    both = None
    for i, frame in enumerate(frames):
        marked = frame.withColumn("__source", F.lit(i))
        both = marked if both is None else both.unionByName(marked, allowMissingColumns=True)
    return latest_by_key(both.where(F.col(keys[-1]).isNotNull()), list(keys), [F.col("__source")]).drop("__source")
