"""Where results go: tables by month, JSON lines, CSV, with casts, counts and guards."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortloom.functions.numeric import finite
from cohortloom.functions.text import text_or_null, valid_identifier
from cohortloom.operators.reasons import REASON_SCHEMA

# Names of the write modes and their other names.
MODES = {"replace": "replace", "delete_insert": "replace", "overwrite": "replace", "append": "append", "insert": "append"}
INTERNAL_KEYS = ("raw_response", "prompt", "features", "error")


@dataclass(frozen=True)
class TableSpec:
    """A table's columns with their types and the widths of its texts; partitioned by month."""

    columns: dict[str, str]
    widths: dict[str, int]
    keys: tuple[str, ...]
    partition: str = "cohort_dt"

    def ddl(self, name: str) -> str:
        rest = ", ".join(f"{c} {t}" for c, t in self.columns.items())
        return f"CREATE TABLE IF NOT EXISTS {name} ({rest}) USING parquet PARTITIONED BY ({self.partition})"


def _spec(keys: str, numbers: str, texts: str, widths: dict[str, int], other: dict[str, str] | None = None) -> TableSpec:
    columns = dict.fromkeys(keys.split(), "string") | {"cohort_dt": "date"} | dict.fromkeys(numbers.split(), "double") | (other or {}) | dict.fromkeys(texts.split(), "string")
    return TableSpec(columns, widths, tuple(keys.split()))


# The result tables.
RESULTS = _spec(
    "cohort_dt mono_id", "anomaly_score ensemble_score if_score residual_score autoencoder_score confidence coverage_ratio data_gap_score",
    "alert_band alert_type review_queue reason_1 reason_2 reason_3 reason_details musteri_segment rating_group cst_sector cst_nace_code cst_nace_code_id financial_term_l1y financial_term_q",
    {"reason_1": 2000, "reason_2": 2000, "reason_3": 2000, "alert_band": 32, "alert_type": 64, "review_queue": 64}, {"rank_in_run": "bigint", "missing_feature_count": "bigint"},
)
REASON_DETAILS = _spec(
    "cohort_dt mono_id", "actual customer_previous_reference peer_reference peer_z peer_representativeness_score train_reference contribution_pct raw_pct peer_pct missing_pct",
    "feature label peer_level peer_quality reference_used direction_comment previous_comment financial_term_detail", {"feature": 128, "label": 256},
    {"feature_rank": "bigint", "is_missing_reason": "int", "peer_support": "bigint"},
)
DECISIONS = _spec(
    "run_id cohort_dt mono_id", "anomaly_score llm_confidence ml_ensemble_score ml_if_score ml_residual_score ml_autoencoder_score reason_1_weight reason_2_weight reason_3_weight",
    "anomaly_type risk_level seasonality_assessment trend_assessment peer_assessment caveat ml_alert_band reason_summary reason_1 reason_2 reason_3 recommended_action llm_model evidence_source raw_response",
    {"run_id": 64, "mono_id": 128, "anomaly_type": 64, "risk_level": 32, "seasonality_assessment": 2000, "trend_assessment": 2000, "peer_assessment": 2000, "caveat": 2000, "ml_alert_band": 32, "reason_summary": 4000,
     "reason_1": 2000, "reason_2": 2000, "reason_3": 2000, "recommended_action": 128, "llm_model": 128, "evidence_source": 64}, {"is_anomaly": "int", "ml_is_anomaly": "int"},
)
DECISION_REASONS = _spec("run_id cohort_dt mono_id", "", "feature_name evidence_text interpretation", {"feature_name": 128, "evidence_text": 2000, "interpretation": 2000}, {"reason_rank": "bigint"})
DECISION_FEATURES = _spec(
    "run_id cohort_dt mono_id",
    "current_value previous_value change_pct history_median history_p25 history_p75 history_robust_scale history_z rolling_3m_median rolling_6m_median rolling_12m_median trend_slope_6m trend_slope_12m "
    "same_month_last_year_value yoy_change_pct same_month_customer_median same_month_customer_z seasonal_peer_median seasonal_peer_z peer_median peer_z",
    "feature_name feature_label feature_category formula source_columns risk_direction trend_note peer_definition_level peer_quality snapshot_series_json feature_json",
    {"run_id": 64, "mono_id": 128, "feature_name": 128, "feature_label": 256, "feature_category": 64, "formula": 1000, "source_columns": 1000, "risk_direction": 32, "trend_note": 1000, "peer_definition_level": 64, "peer_quality": 32},
    {"feature_rank": "bigint", "history_period_count": "bigint", "month_of_year": "bigint", "peer_support": "bigint", "trend_break_flag": "int", "data_missing_flag": "int"},
)
#: What columns of evidence are called in the table of features.
FEATURE_NAMES = {
    "feature": "feature_name", "label": "feature_label", "category": "feature_category", "value": "current_value", "period_count": "history_period_count", "median": "history_median", "p25": "history_p25", "p75": "history_p75",
    "robust_scale": "history_robust_scale", "slope_6m": "trend_slope_6m", "slope_12m": "trend_slope_12m", "peer_level": "peer_definition_level", "missing_flag": "data_missing_flag",
}
NO_TREND_NOTE, BREAK_NOTE, STEADY_NOTE = "Yeterli tarihsel veri yok.", "Cari deger tarihsel robust banda gore kirilim gosteriyor.", "Belirgin trend kirilimi yok."


def write_mode(name: str | None) -> str:
    mode = MODES.get((name or "replace").strip().lower())
    if mode is None:
        raise ValueError(f"write mode {name!r} is none of {', '.join(MODES)}")
    return mode


def shaped(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the columns of the table: read as their types, texts cut, what is missing or can't be read NULL."""
    have = {c.lower(): c for c in df.columns}

    def column(name: str, kind: str) -> Column:
        if name not in have:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(f"`{have[name]}`")
        if kind == "string":
            return text_or_null(c, spec.widths.get(name)).alias(name)
        return (finite(c.try_cast("double")) if kind == "double" else c.try_cast(kind)).alias(name)

    return df.select(*(column(c, t) for c, t in spec.columns.items()))


def ensure_table(spark: SparkSession, name: str, spec: TableSpec) -> list[str]:
    """Create the table, or add columns that it doesn't have yet; returns those added."""
    for part in name.split("."):
        valid_identifier(part)
    spark.sql(spec.ddl(name))
    have = {c.name.lower() for c in spark.catalog.listColumns(name)}
    added = [c for c in spec.columns if c not in have]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{c} {spec.columns[c]}' for c in added)})")
    return added


def write_table(df: DataFrame, name: str, spec: TableSpec, mode: str = "replace") -> None:
    """Replace the months that ``df`` has, or add to them. Other months stay as they are in either mode."""
    spark = df.sparkSession
    ensure_table(spark, name, spec)
    out = shaped(df, spec).select(*(F.col(c.name) for c in spark.catalog.listColumns(name)))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        out.write.insertInto(name, overwrite=write_mode(mode) == "replace")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def load_table(df: DataFrame, name: str, replace: bool = True, partition: str = "cohort_dt", source: str | Path | None = None, delete_source: bool = False, source_rows: int | None = None) -> dict[str, Any]:
    """Write a table by month and count it afterwards; returns ``table, inserted_rows, table_rows, deleted_source``.

    ``source``, one local file, is deleted on request only, and only if it had ``source_rows``, at least one, and the table
    has gained just as many: what got lost between the file and ``df`` keeps the file.
    """
    spark = df.sparkSession
    before = 0 if replace or not spark.catalog.tableExists(name) else spark.table(name).count()
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite" if replace else "append").partitionBy(partition).format("parquet").saveAsTable(name)
    inserted, total = int(rows.get["n"]), spark.table(name).count()
    local = Path(str(source).removeprefix("file://").removeprefix("file:")) if source else None
    deleted = bool(delete_source and local and local.is_file() and source_rows is not None and 0 < source_rows == inserted == total - before)
    if deleted:
        local.unlink()
    return {"table": name, "inserted_rows": inserted, "table_rows": total, "deleted_source": deleted}


def audit(spark: SparkSession, tables: list[str], month: str | None = None, run_id: str | None = None) -> DataFrame:
    """``table_name, total_rows, month_rows, run_rows`` in one pass over each table."""
    out = None
    for name in tables:
        df = spark.table(name)
        in_run = F.count_if(F.col("run_id") == run_id) if run_id and "run_id" in df.columns else F.lit(None).cast("long")
        one = df.agg(F.count("*").alias("total_rows"), (F.count_if(F.col("cohort_dt") == F.lit(month).cast("date")) if month else F.lit(None).cast("long")).alias("month_rows"), in_run.alias("run_rows"))
        one = one.select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def exploded_reasons(results: DataFrame, keys: tuple[str, ...] = ("cohort_dt", "mono_id"), column: str = "reason_details") -> DataFrame:
    """One row per reason with ``feature_rank`` from 1; the column is JSON text or already an array. Anything but a list of objects has no rows."""
    c = F.col(column)
    if dict(results.dtypes)[column] == "string":
        c = F.from_json(c, f"array<{REASON_SCHEMA}>")
    rows = results.select(*keys, F.posexplode(F.filter(c, lambda r: r.isNotNull())).alias("at", "r"))
    return rows.select(
        *keys, (F.col("at") + 1).cast("long").alias("feature_rank"), *(F.col(f"r.{f}") for f in ("feature", "label", "is_missing_reason", "actual", "customer_previous_reference", "peer_reference", "peer_z", "peer_support", "peer_level", "peer_representativeness_score", "peer_quality", "train_reference", "reference_used", "contribution_pct")),
        "r.component_contributions.*", *(F.col(f"r.{f}") for f in ("direction_comment", "previous_comment", "financial_term_detail")),
    )


def decision_rows(decisions: DataFrame, run_id: str, model: str | None = None, source: str | None = None, assessments: DataFrame | None = None) -> DataFrame:
    """Decisions in the columns of ``DECISIONS``. What an answer doesn't say about season, trend, peers and caveats is what
    ``assessments`` (by entity and month) say; ``raw_response`` is the decision as JSON, without the message that it came in."""
    notes = ("seasonality_assessment", "trend_assessment", "peer_assessment", "caveat")
    payload = F.to_json(F.struct(*(c for c in decisions.columns if c not in INTERNAL_KEYS)), {"ignoreNullFields": "false"})
    out = decisions.withColumn("raw_response", payload)
    if assessments is not None:
        keys = ["mono_id", "cohort_dt"]
        said = assessments.select(*(F.col(c).cast("string").alias(c) for c in keys), *(F.col(c).alias(f"__{c}") for c in notes))
        out = out.withColumn("cohort_dt", F.col("cohort_dt").cast("string")).join(said, keys, "left").withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) if c in decisions.columns else F.col(f"__{c}") for c in notes})
    return out.withColumns({"run_id": F.lit(run_id), "llm_model": F.lit(model).cast("string"), "evidence_source": F.lit(source).cast("string")})


def decision_reason_rows(decisions: DataFrame, run_id: str) -> DataFrame:
    rows = decisions.select(F.lit(run_id).alias("run_id"), "cohort_dt", "mono_id", F.posexplode("main_reasons").alias("at", "r"))
    return rows.select("run_id", "cohort_dt", "mono_id", (F.col("at") + 1).cast("long").alias("reason_rank"), F.col("r.feature").alias("feature_name"), F.col("r.evidence").alias("evidence_text"), "r.interpretation")


def decision_feature_rows(evidence: DataFrame, run_id: str) -> DataFrame:
    """Evidence rows in the columns of ``DECISION_FEATURES``, each with its months and all of itself as JSON."""
    have = set(evidence.columns)
    whole = F.to_json(F.struct(*(c for c in evidence.columns)), {"ignoreNullFields": "false"})
    out = evidence.withColumns({"run_id": F.lit(run_id), "feature_rank": F.col("evidence_rank").cast("long"), "feature_json": whole, "month_of_year": F.month(F.col("cohort_dt").cast("date"))})
    if {"value", "median", "robust_scale"} <= have:
        out = out.withColumn("history_z", F.when(F.col("robust_scale") > 0, (F.col("value") - F.col("median")) / F.col("robust_scale")))
    if "trend_note" not in have and {"trend_break_flag", "period_count"} <= have:
        note = F.when(F.col("value").isNull() | (F.coalesce("period_count", F.lit(0)) < 3), NO_TREND_NOTE).when(F.col("trend_break_flag"), BREAK_NOTE).otherwise(STEADY_NOTE)
        out = out.withColumn("trend_note", note)
    series = F.to_json("series", {"ignoreNullFields": "false"}) if "series" in have else F.lit("{}")
    return out.withColumn("snapshot_series_json", series).withColumnsRenamed(FEATURE_NAMES)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls and non-ASCII characters kept."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    flat = df.select(*(F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes if not c.startswith("_")))
    flat.write.mode("overwrite").csv(path, header=True)


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    """One JSON object, in one line of a text folder."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def append_answers(decisions: DataFrame, run_id: str, path: str) -> None:
    """A line per request is added to the answer log: what came back as it came, and why it couldn't be used if so."""
    line = F.struct(F.lit(run_id).alias("run_id"), "mono_id", "cohort_dt", F.col("error").alias("parsing_error"), "raw_response")
    decisions.select(F.to_json(line, {"ignoreNullFields": "false"}).alias("value")).write.mode("append").text(path)


def top_rows(results: DataFrame, n: int = 500) -> DataFrame:
    return results.orderBy(F.col("ensemble_score").desc(), "mono_id").limit(n)


def merged_schema(have: StructType, want: StructType) -> StructType:
    """The fields of ``have`` and those of ``want`` that it lacks."""
    names = {f.name.lower() for f in have}
    return StructType([*have.fields, *(f for f in want.fields if f.name.lower() not in names)])
