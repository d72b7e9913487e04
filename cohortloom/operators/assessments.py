"""One-line assessments of an entity from its evidence rows, and evidence from result rows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import pct_change, rounded
from cohortloom.operators.panel import ID, TIME
from cohortloom.sources.sinks import exploded_reasons

# What an assessment says without evidence.
NO_SEASON = "Sezon: yeterli sezon metrigi yok; karar sezon kanitina dayanmiyor."
NO_TREND = "Trend: yeterli trend metrigi yok; karar trend kanitina dayanmiyor."
NO_PEER = "Peer: yeterli peer metrigi yok; karar peer kanitina dayanmiyor."
NO_CAVEAT = "Caveat: belirgin veri kisiti yok; yorum mevcut evidence kapsami icin gecerlidir."

_BREAK_WEIGHT = 10.0


def six_digits(x: Column) -> Column:
    """Six significant digits, without trailing zeros; NULL for a missing number. A tie goes by the number's exact binary value, as ``printf`` does; ``format_string`` goes by its shortest decimal text."""
    digits = F.least(F.greatest(F.lit(0), 5 - F.floor(F.log10(F.abs(x)))), F.lit(15)).cast("int")
    fixed = F.replace(F.call_function("format_number", x, digits), F.lit(","), F.lit(""))
    return F.when(x == 0, "0").when(x.isNotNull(), F.when(F.contains(fixed, F.lit(".")), F.regexp_replace(fixed, r"\.?0+$", "")).otherwise(fixed))


def six_decimals(x: Column) -> Column:
    """At most six decimals, without trailing zeros; NULL for a missing number."""
    return F.when(x.isNotNull(), F.regexp_replace(F.format_string("%.6f", rounded(x, 6) + 0.0), r"\.?0+$", ""))


def _strongest(*values: Column) -> Column:
    sizes = F.filter(F.array(*(F.abs(v.cast("double")) for v in values)), lambda v: v.isNotNull())
    return F.array_max(sizes)


def top_by_metric(rows: DataFrame, metric: Column, keys: list[str], fields: list[str]) -> DataFrame:
    """Per entity the row with the greatest metric (of equal ones the first feature by name); entities without any are left out."""
    scored = rows.withColumn("__metric", metric).where("__metric IS NOT NULL")
    order = F.struct((-F.col("__metric")).alias("m"), F.col("feature"))
    return scored.groupBy(*keys).agg(F.min_by(F.struct("feature", *fields), order).alias("top"))


def _line(prefix: str, top: Column, numbers: dict[str, str], texts: dict[str, str]) -> Column:
    parts = [F.concat(F.lit(f"{name}="), six_digits(top[c].cast("double"))) for name, c in numbers.items()]
    parts += [F.concat(F.lit(f"{name}="), F.substring(top[c], 1, 500)) for name, c in texts.items()]
    return F.concat(F.lit(f"{prefix}: "), F.concat_ws("; ", F.concat(F.lit("feature="), top["feature"]), *parts))


def assessments(evidence: DataFrame, quality: DataFrame | None = None, keys: tuple[str, ...] = (ID, TIME)) -> DataFrame:
    """``keys, seasonality_assessment, trend_assessment, peer_assessment, caveat`` of each entity of the evidence rows.

    Each names the feature with the strongest metric of its kind. ``quality``: rows of ``entity_quality`` for the caveat.
    """
    ks = list(keys)
    season = top_by_metric(
        evidence, _strongest(F.col("same_month_customer_z"), F.col("seasonal_peer_z"), F.col("yoy_change_pct") / 100), ks, ["same_month_last_year_value", "yoy_change_pct", "same_month_customer_z", "seasonal_peer_median", "seasonal_peer_z"]
    ).withColumnRenamed("top", "season")
    broken = F.when(F.col("trend_break_flag"), F.lit(_BREAK_WEIGHT))
    trend = top_by_metric(evidence, _strongest(F.col("slope_6m"), F.col("slope_12m"), broken), ks, ["slope_6m", "slope_12m", "trend_break_flag"]).withColumnRenamed("top", "trend")
    peer = top_by_metric(evidence, F.abs("peer_z"), ks, ["peer_median", "peer_z", "peer_support", "peer_quality", "peer_level"]).withColumnRenamed("top", "peer")
    weak = evidence.groupBy(*ks).agg(F.count_if(F.col("peer_quality") == "ZAYIF").alias("weak"))
    out = weak.join(season, ks, "left").join(trend, ks, "left").join(peer, ks, "left")
    caveat = [F.when(F.col("weak") > 0, F.concat(F.lit("weak_peer_features="), F.col("weak").cast("string")))]
    if quality is not None:
        names = ["coverage_ratio", "missing_feature_count", "customer_history_periods"]
        out = out.join(quality.select(ID, *names), ID, "left")
        caveat = [F.concat(F.lit(f"{c}="), six_digits(F.col(c).cast("double"))) for c in names] + caveat
    joined = F.concat_ws("; ", *caveat)
    return out.select(
        *ks,
        F.when(F.col("season").isNull(), NO_SEASON)
        .otherwise(_line("Sezon", F.col("season"), {"same_month_last_year": "same_month_last_year_value", "yoy_change_pct": "yoy_change_pct", "same_month_z": "same_month_customer_z", "seasonal_peer_median": "seasonal_peer_median", "seasonal_peer_z": "seasonal_peer_z"}, {}))
        .alias("seasonality_assessment"),
        F.when(F.col("trend").isNull(), NO_TREND).otherwise(_line("Trend", F.col("trend"), {"slope_6m": "slope_6m", "slope_12m": "slope_12m", "trend_break": "trend_break_flag"}, {})).alias("trend_assessment"),
        F.when(F.col("peer").isNull(), NO_PEER)
        .otherwise(_line("Peer", F.col("peer"), {"peer_median": "peer_median", "peer_z": "peer_z", "peer_support": "peer_support"}, {"peer_quality": "peer_quality", "peer_level": "peer_level"}))
        .alias("peer_assessment"),
        F.when(joined == "", NO_CAVEAT).otherwise(F.concat(F.lit("Caveat: "), joined)).alias("caveat"),
    )


def evidence_from_results(results: DataFrame) -> DataFrame:
    """Evidence rows from the reasons of result rows, without their scores: what a stored result can still tell without the panel."""
    r = exploded_reasons(results)
    return r.select(
        *(c for c in (ID, TIME) if c in r.columns),
        "feature",
        F.col("actual").alias("value"),
        F.col("customer_previous_reference").alias("previous_value"),
        pct_change(F.col("actual"), F.col("customer_previous_reference")).alias("change_pct"),
        F.col("train_reference").alias("median"),
        F.col("peer_reference").alias("peer_median"),
        "peer_z",
        "peer_support",
        "peer_level",
        "peer_quality",
        F.coalesce("is_missing_reason", F.lit(False)).alias("missing_flag"),
        "direction_comment",
        "previous_comment",
        "financial_term_detail",
        F.col("feature_rank").cast("int").alias("evidence_rank"),
    )
