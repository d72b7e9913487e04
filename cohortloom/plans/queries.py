"""The library's queries over the driver's tables, by name. Each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import numeric as num
from cohortloom.functions import text as txt
from cohortloom.functions.formula import compile_formulas
from cohortloom.functions.jsontext import reason_list, repair_json
from cohortloom.operators import decisions, evidence, panel, peers, reasons, scoring, selection
from cohortloom.operators.assessments import assessments
from cohortloom.operators.decisions import companion_scores, prompt_text
from cohortloom.operators.models import fit_isolation_forest
from cohortloom.operators.reasons import severity_shares
from cohortloom.plans import anomaly, evidence_flow
from cohortloom.plans.panels import FORMULAS, MEASURES, customer_months, customer_years, table, user_days
from cohortloom.sources import sinks
from cohortloom.sources.staging import staged

YEAR, MONTH = date(2000, 12, 31), date(2001, 6, 30)
PEER_FEATURES = ["bank_total_risk", "memzuc_total_limit", "returned_amount"]
CONTEXT = ["peer_segment", "peer_sector", "peer_size"]
KEYS = ["mono_id", "cohort_dt"]
SCORES = ("if_score", "residual_score", "autoencoder_score")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _day(c: str = "cohort_dt") -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _r(c: Column | str, name: str | None = None, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return num.rounded(c, digits).alias(name) if name else num.rounded(c, digits)


@query
def month_profile(spark, sf_dir):
    return panel.month_profile(customer_months(spark, sf_dir)).select(_day("month"), "n_rows")


@query
def month_tail(spark, sf_dir):
    return panel.month_tail(customer_months(spark, sf_dir)).select(_day("month"), "n_rows")


@query
def numeric_coverage(spark, sf_dir):
    out = selection.column_statistics(customer_years(spark, sf_dir), list(MEASURES))
    return out.select("column", _r("coverage", "coverage"), "n_distinct", _r("missing_rate", "missing_rate"))


@query
def locale_numeric_parse(spark, sf_dir):
    k = F.col("o_orderkey")
    part = lambda x, n: F.lpad((x % 10**n).cast("string"), n, "0")
    text = (
        F.when(k % 5 == 0, F.concat((k % 900 + 1).cast("string"), F.lit("."), part(k, 3), F.lit(","), part(k, 2)))
        .when(k % 5 == 1, F.concat((k % 10000).cast("string"), F.lit("."), part(k, 2)))
        .when(k % 5 == 2, F.concat(F.lit(" "), (k % 90).cast("string"), F.lit(" "), part(k, 3), F.lit(",5 ")))
        .when(k % 5 == 3, "nan")
        .otherwise(F.concat(F.lit("x"), k.cast("string")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", _r(num.locale_number(text), "number"))


@query
def mixed_date_parse(spark, sf_dir):
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    text = (
        F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 1, F.date_format(d, "dd.MM.yyyy")).when(k % 5 == 2, F.date_format(d, "dd/MM/yyyy")).when(k % 5 == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise("no day")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(txt.mixed_date(text), "yyyy-MM-dd").alias("day"))


@query
def window_split_counts(spark, sf_dir):
    before, at = panel.split(customer_years(spark, sf_dir), YEAR)
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n_rows"), F.count_distinct("mono_id").alias("n_ids"))
    return count(before, "train").unionByName(count(at, "score"))


@query
def latest_prior_by_id(spark, sf_dir):
    return panel.latest_before(customer_years(spark, sf_dir), YEAR).select("mono_id", _day(), _r("bank_total_risk", "bank_total_risk"))


@query
def asof_previous_value(spark, sf_dir):
    df = customer_years(spark, sf_dir)
    _, at = panel.split(df, YEAR)
    before = panel.latest_before(df, YEAR).select("mono_id", F.col("bank_total_risk").alias("previous"))
    return at.join(before, "mono_id", "left").select("mono_id", _r("bank_total_risk", "value"), _r("previous", "previous"), _r(num.pct_change(F.col("bank_total_risk"), F.col("previous")), "change_pct", 4))


@query
def new_entities(spark, sf_dir):
    before, at = panel.split(customer_years(spark, sf_dir), YEAR)
    return panel.missing_entities(at, before).select("mono_id")


@query
def union_latest(spark, sf_dir):
    df = customer_years(spark, sf_dir).select(*KEYS, "n_orders")
    revised = df.where("n_orders > 1").withColumn("n_orders", F.col("n_orders") * 10)
    return panel.union_latest(df, revised).select("mono_id", _day(), "n_orders")


@query
def safe_ratio(spark, sf_dir):
    df = staged(customer_years(spark, sf_dir), "panel")
    return df.select("mono_id", _day(), _r(compile_formulas(df, FORMULAS)["bank_risk_to_assets"], "ratio"))


@query
def formula_nested(spark, sf_dir):
    df = staged(customer_years(spark, sf_dir), "panel")
    text = {"a": "bank_total_risk / toplam_varlik_ttr", "b": "a / (memzuc_total_risk / memzuc_total_limit) - 2 * n_orders", "c": "unknown_column + 1"}
    made = compile_formulas(df, text)
    return df.select("mono_id", _day(), _r(made["b"], "b"), made["c"].alias("c"))


@query
def signed_log1p(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", _r(num.signed_log1p(F.col("c_acctbal")), "t"))


@query
def feature_coverage_select(spark, sf_dir):
    before, at = panel.split(customer_years(spark, sf_dir), YEAR)
    return spark.createDataFrame([(f,) for f in selection.model_features(before, at, list(MEASURES))], "feature string")


@query
def features_with_gaps(spark, sf_dir):
    before, at = panel.split(customer_years(spark, sf_dir), YEAR)
    return spark.createDataFrame([(f,) for f in selection.features_with_gaps(before, at, list(MEASURES))], "feature string")


@query
def size_bucket_quartiles(spark, sf_dir):
    df = staged(customer_years(spark, sf_dir), "panel")
    return peers.size_buckets(df, F.col("bank_total_risk")).select("mono_id", _day(), "peer_size")


def _long(spark, sf_dir) -> DataFrame:
    return staged(peers.long_form(peers.with_peer_context(staged(customer_years(spark, sf_dir), "panel")), PEER_FEATURES, [*KEYS, *CONTEXT]), "long")


@query
def peer_stats_by_level(spark, sf_dir):
    return peers.level_statistics(_long(spark, sf_dir)).select("feature", "level", "support", _r("median", "median"), _r("t_median", "t_median"), _r("mad", "mad"))


def _peers(spark, sf_dir) -> DataFrame:
    return peers.peer_references(_long(spark, sf_dir))


@query
def peer_hierarchy_z(spark, sf_dir):
    return _peers(spark, sf_dir).select("mono_id", _day(), "feature", "peer_level", "peer_support", _r("peer_median", "peer_median"), _r("peer_z", "peer_z", 5), "peer_score", "peer_quality")


@query
def peer_quality(spark, sf_dir):
    return peers.level_counts(_peers(spark, sf_dir))


@query
def peer_diagnostics(spark, sf_dir):
    return peers.peer_diagnostics(_peers(spark, sf_dir)).select("total", "strong_pct", "acceptable_pct", "weak_pct", "narrow_pct", "support_p10", "support_p50", "support_p90", "good_pct", "result", "assessment")


@query
def robust_scale_ladder(spark, sf_dir):
    rows = customer_years(spark, sf_dir).select("musteri_segment", "cohort_dt", num.signed_log1p(F.col("returned_amount")).alias("t"))
    keys = ["musteri_segment", "cohort_dt"]
    one = rows.groupBy(*keys).agg(F.median("t").alias("m"), F.percentile("t", F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.stddev_samp("t").alias("std"), F.count("t").alias("n"))
    mad = rows.join(one.select(*keys, "m"), keys).groupBy(*keys).agg(F.median(F.abs(F.col("t") - F.col("m"))).alias("mad"))
    return one.join(mad, keys).select("musteri_segment", _day(), _r(num.scale_ladder(F.col("mad"), F.col("q")[1] - F.col("q")[0], F.col("std"), F.col("n")), "scale"))


def _prepared(spark, sf_dir) -> tuple[DataFrame, scoring.Preprocessor, list[str]]:
    df = staged(customer_years(spark, sf_dir), "panel")
    names = ["bank_total_risk", "toplam_varlik_ttr", "returned_amount"]
    return df, scoring.fit_preprocessor(panel.split(df, YEAR)[0], names), names


@query
def preprocessor_stats(spark, sf_dir):
    _, p, names = _prepared(spark, sf_dir)
    rows = [(c, *(float(x[c]) for x in (p.fill, p.low, p.high, p.center, p.scale))) for c in names]
    out = spark.createDataFrame(rows, "feature string, fill double, low double, high double, center double, scale double")
    return out.select("feature", *(_r(c, c, 5) for c in ("fill", "low", "high", "center", "scale")))


@query
def winsor_robust_transform(spark, sf_dir):
    df, p, names = _prepared(spark, sf_dir)
    x = df.select(*KEYS, *p.expressions())
    return x.select("mono_id", _day(), *(_r(c, c, 5) for c in names))


@query
def row_top3_mean(spark, sf_dir):
    df, p, names = _prepared(spark, sf_dir)
    x = df.select(*KEYS, *p.expressions())
    return x.select("mono_id", _day(), _r(num.top_mean(F.array(*(F.abs(F.col(c)) for c in names)), 2), "residual", 5))


def _scores(spark, sf_dir) -> DataFrame:
    before, at = panel.split(staged(customer_years(spark, sf_dir), "panel"), YEAR)
    at = staged(at.select(*KEYS, "musteri_segment", "bank_total_risk"), "scored")
    return scoring.percentiles(at, before.where("bank_total_risk IS NOT NULL"), {"bank_total_risk": "ensemble_score"}).drop("bank_total_risk")


@query
def empirical_percentile(spark, sf_dir):
    return _scores(spark, sf_dir).select("mono_id", _r("ensemble_score", "ensemble_score"))


@query
def band_thresholds(spark, sf_dir):
    t = scoring.band_thresholds(_scores(spark, sf_dir), "ensemble_score")
    return spark.createDataFrame([(k, round(v, 6)) for k, v in t.items()], "band string, threshold double")


def _banded(spark, sf_dir) -> DataFrame:
    s = _scores(spark, sf_dir)
    return s.withColumn("alert_band", scoring.band(F.col("ensemble_score"), scoring.band_thresholds(s, "ensemble_score")))


@query
def band_assign(spark, sf_dir):
    return _banded(spark, sf_dir).select("mono_id", "alert_band")


@query
def balanced_selection(spark, sf_dir):
    return selection.balanced_selection(_banded(spark, sf_dir), 10).select("mono_id", "alert_band", _r("selection_score", "selection_score"), "selection_group")


@query
def companion_join(spark, sf_dir):
    scores = _banded(spark, sf_dir)
    decided = customer_years(spark, sf_dir).where(F.year("cohort_dt") >= 2000).select("mono_id", _day())
    return companion_scores(decided, scores).select("mono_id", "cohort_dt", _r("ml_ensemble_score", "ml_ensemble_score"), "ml_alert_band", "ml_is_anomaly")


@query
def confidence_coverage(spark, sf_dir):
    df = customer_years(spark, sf_dir)
    names = ["returned_amount", "bank_total_risk", "toplam_varlik_ttr", "quantity"]
    c = num.coverage(*names)
    a, b = F.col("n_orders") * 7 % 100, F.col("quantity") % 100
    return df.select("mono_id", _day(), _r(c, "coverage"), _r(num.data_gap(c), "data_gap"), num.missing_count(*names).cast("long").alias("n_missing"), _r(num.confidence(c, a, b), "confidence", 4))


@query
def family_severity_top_reasons(spark, sf_dir):
    df, p, names = _prepared(spark, sf_dir)
    x = df.select(*KEYS, *p.expressions())
    severity = peers.long_form(x.select(*KEYS, *(F.abs(F.col(c)).alias(c) for c in names)), names, KEYS).withColumnRenamed("value", "severity")
    out = severity_shares(severity.withColumn("severity", num.rounded(F.col("severity"), 5)), KEYS).where("rank <= 2")
    return out.select("mono_id", _day(), "feature", F.col("rank").cast("long").alias("rank"), _r(F.col("severity") / F.col("total") * 100, "contribution", 3))


@query
def alert_type_queue(spark, sf_dir):
    b = _banded(spark, sf_dir)
    gap = (F.length("mono_id") * 13 % 50).cast("double")
    features = F.when(F.col("ensemble_score") > 50, F.array(F.lit("bank_risk_to_assets"))).when(F.col("ensemble_score") > 20, F.array(F.lit("net_margin"))).otherwise(F.array().cast("array<string>"))
    kind = txt.alert_type(F.col("alert_band"), gap, 1 - gap / 100, features)
    return b.select("mono_id", kind.alias("alert_type"), txt.review_queue(F.col("alert_band"), kind, gap).alias("review_queue"))


@query
def alert_counts_grouping_sets(spark, sf_dir):
    b = _banded(spark, sf_dir)
    return b.groupingSets([["alert_band"], ["musteri_segment"]], "alert_band", "musteri_segment").agg(F.count("*").alias("n"))


def _history(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    df = customer_months(spark, sf_dir).select(*KEYS, F.lit("bank_total_risk").alias("feature"), F.col("bank_total_risk").alias("value"))
    before, at = panel.split(df, MONTH)
    return before, at.select("mono_id", "feature", "value")


@query
def history_metrics(spark, sf_dir):
    m = evidence.history_metrics(_history(spark, sf_dir)[0])
    return m.select("mono_id", "period_count", *(_r(c, c, 4) for c in ("median", "p25", "p75")), _r("robust_scale", "robust_scale", 8))


@query
def rolling_medians(spark, sf_dir):
    m = evidence.history_metrics(_history(spark, sf_dir)[0])
    return m.select("mono_id", *(_r(c, c, 4) for c in ("rolling_3m_median", "rolling_6m_median", "rolling_12m_median", "previous_value")))


@query
def trend_slope_break(spark, sf_dir):
    before, now = _history(spark, sf_dir)
    return evidence.trend_metrics(before, now).select("mono_id", _r("slope_6m", "slope_6m", 3), _r("slope_12m", "slope_12m", 3), "trend_break_flag")


@query
def same_month_value(spark, sf_dir):
    before, now = _history(spark, sf_dir)
    m = evidence.same_month_metrics(before, now, MONTH)
    return m.select("mono_id", *(_r(c, c, 3) for c in ("same_month_last_year_value", "yoy_change_pct", "same_month_customer_median", "same_month_customer_z")))


@query
def seasonal_peer_median(spark, sf_dir):
    df = peers.with_peer_context(staged(customer_months(spark, sf_dir), "panel"))
    long = peers.long_form(df, ["bank_total_risk"], [*KEYS, *CONTEXT])
    before, at = panel.split(long, MONTH)
    return evidence.seasonal_peer_lookup(at, evidence.seasonal_peer_medians(before, MONTH)).select("mono_id", _r("seasonal_peer_median", "seasonal_peer_median", 4))


@query
def snapshot_series_window(spark, sf_dir):
    before, now = _history(spark, sf_dir)
    s = evidence.snapshot_series(before, now, MONTH)
    return s.select("mono_id", F.posexplode("series").alias("position", "x")).select("mono_id", F.col("position").cast("long").alias("position"), "x.cohort_dt", _r("x.value", "value", 4), "x.is_current_snapshot")


@query
def reference_scales(spark, sf_dir):
    return evidence.reference_scales(_long(spark, sf_dir)).select("feature", _r("reference_scale", "reference_scale", 4))


@query
def entity_quality(spark, sf_dir):
    out = evidence_flow.entity_quality(customer_years(spark, sf_dir), list(MEASURES), evidence_flow.EvidenceSettings(month="2000-12-31"))
    return out.select("mono_id", "musteri_segment", _r("coverage_ratio", "coverage_ratio"), F.col("missing_feature_count").cast("long").alias("missing_feature_count"), "customer_history_periods", "insufficient_history_flag")


@query
def category_normalize(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, "  ").when(k % 4 == 1, "nan").when(k % 4 == 2, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
    return table(spark, sf_dir, "customer").select("c_custkey", txt.category(raw, "SEG_NA").alias("segment"))


@query
def risk_directions(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.concat(F.lit("l1y_"), F.element_at(F.array(*map(F.lit, ("equity", "debt", "margin_pd", "sales"))), (F.col("p_partkey") % 4 + 1).cast("int"))).alias("feature"), "p_partkey")
    return names.select("p_partkey", txt.risk_direction(F.col("feature")).alias("ml"), txt.risk_direction(F.col("feature"), falls_first=True).alias("evidence"))


@query
def text_token_match(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(txt.tokens(F.concat_ws("-", "c_name", "c_mktsegment", F.lit("of it"))), " ").alias("tokens"))


@query
def json_extract_repair(spark, sf_dir):
    k = F.col("event_id")
    text = F.when(k % 3 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(k % 3 == 1, F.concat(F.lit("Answer: "), F.col("props"), F.lit(" (done)"))).otherwise("nothing")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(repair_json(text), "$.k").cast("double").alias("k"))


@query
def event_daily_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n")).select(_day("day"), "event_type", "n")


@query
def user_day_panel(spark, sf_dir):
    return user_days(spark, sf_dir).select("mono_id", _day(), "n_events", _r("total_value", "total_value", 3), _r("mean_k", "mean_k", 4))


@query
def customer_year_panel(spark, sf_dir):
    return customer_years(spark, sf_dir).select("mono_id", _day(), "musteri_segment", "cst_nace_code_id", *(_r(c, c, 4) for c in MEASURES))


@query
def rank_in_run(spark, sf_dir):
    return anomaly.with_rank(_scores(spark, sf_dir)).select("mono_id", _r("ensemble_score", "ensemble_score"), "rank_in_run")


@query
def top_scores(spark, sf_dir):
    return _scores(spark, sf_dir).orderBy(F.col("ensemble_score").desc(), "mono_id").limit(500).select("mono_id", _r("ensemble_score", "ensemble_score"))


@query
def peer_ratio_outliers(spark, sf_dir):
    """Which customers' risk-to-assets ratio of the year deviates most from their peers."""
    df = peers.with_peer_context(staged(customer_years(spark, sf_dir), "panel"))
    at = panel.split(df, YEAR)[1]
    at = at.withColumns(compile_formulas(at, {"bank_risk_to_assets": FORMULAS["bank_risk_to_assets"]}))
    z = peers.peer_references(staged(peers.long_form(at, ["bank_risk_to_assets"], [*KEYS, *CONTEXT]), "long")).where("peer_z IS NOT NULL")
    return z.select("mono_id", _r("value", "value"), "peer_level", "peer_support", _r("peer_z", "peer_z", 5)).orderBy(F.abs(F.col("peer_z")).desc(), "mono_id").limit(100)


def _reason_facts(spark, sf_dir) -> DataFrame:
    """Scored rows with values, references and terms, some of each missing."""
    df = customer_years(spark, sf_dir)
    before = panel.latest_before(df, YEAR).select("mono_id", F.col("bank_total_risk").alias("previous"))
    k = F.col("mono_id").cast("long")
    rows = panel.split(df, YEAR)[1].join(before, "mono_id", "left")
    return rows.select(
        "mono_id",
        F.when(k % 7 != 0, F.col("bank_total_risk")).alias("actual"),
        "previous",
        F.when(k % 5 != 0, F.col("memzuc_total_limit")).alias("peer"),
        F.when(k % 3 != 0, F.lit(150000.0)).alias("train"),
        F.when(k % 4 != 0, (k % 9 - 4).cast("double")).alias("peer_z"),
        (k % 100).cast("double").alias("peer_pct"),
        F.element_at(F.array(F.lit("HIGHER_IS_RISKY"), F.lit("LOWER_IS_RISKY"), F.lit("UNKNOWN")), (k % 3 + 1).cast("int")).alias("direction"),
        F.when(k % 6 < 4, "financial_term_q").alias("term_column"),
        F.when(k % 6 < 3, "30.09.2024").alias("term"),
        F.when(k % 2 == 0, "30.09.2024").when(k % 3 == 0, "30.06.2024").alias("previous_term"),
    )


@query
def reason_references(spark, sf_dir):
    ref = reasons.choose_reference(F.col("actual"), F.col("previous"), F.col("peer"), F.col("train"), F.col("peer_z"), F.col("peer_pct"), F.lit(50.0))
    return _reason_facts(spark, sf_dir).select("mono_id", ref.alias("ref")).select("mono_id", "ref.label", _r("ref.value", "value", 4))


@query
def reason_comments(spark, sf_dir):
    rows = _reason_facts(spark, sf_dir).withColumn("term_detail", reasons.term_detail(F.col("term_column"), F.col("term"), F.col("previous_term")))
    rows = rows.withColumn("comment", txt.direction_comment(F.col("direction"), F.col("actual"), F.lit("peer medyan"), F.col("peer")))
    said = reasons.previous_comment(F.col("actual"), F.col("previous"), F.col("peer"), F.col("direction"), F.col("term_detail"))
    bucket = reasons.review_bucket(F.col("actual").isNull(), F.col("comment")).cast("long")
    return rows.select("mono_id", "term_detail", "comment", said.alias("previous_comment"), bucket.alias("review_bucket"))


def _reasons(spark, sf_dir) -> DataFrame:
    """Reasons of the scored year's rows from the bounded and scaled measures."""
    df, p, names = _prepared(spark, sf_dir)
    before, at = panel.split(df, YEAR)
    z = peers.long_form(at.select(*KEYS, *p.expressions()), names, KEYS).withColumn("severity", num.rounded(F.abs("value"), 5)).drop("value")
    value = peers.long_form(at, names, KEYS)
    previous = peers.long_form(panel.latest_before(df, YEAR), names, ["mono_id"]).withColumnRenamed("value", "previous")
    train = peers.long_form(before.agg(*(F.median(c).alias(c) for c in names)), names, []).withColumnRenamed("value", "train_reference")
    rows = z.join(value, [*KEYS, "feature"]).join(previous, ["mono_id", "feature"], "left").join(F.broadcast(train), "feature")  # the latter a row a feature
    half = num.rounded(F.col("value") / 2, 4)
    rows = rows.withColumns({"peer_median": F.when(F.col("mono_id").cast("long") % 4 != 0, half), "peer_z": F.col("severity"), "peer_support": F.lit(120), "peer_level": F.lit("AY_SEGMENT"), "peer_score": F.lit(70.0), "peer_quality": F.lit("KABUL_EDILEBILIR")})
    return reasons.build_reasons(staged(rows, "reason-rows"), KEYS, 1, share_rounding=num.rounded)


@query
def reason_rows(spark, sf_dir):
    """Of each row's two most severe features the one that a review reads first."""
    out = _reasons(spark, sf_dir).select("mono_id", _day(), F.explode("reasons").alias("r"))
    return out.select("mono_id", "cohort_dt", "r.feature", "r.is_missing_reason", _r("r.actual", "actual", 4), _r("r.contribution_pct", "contribution_pct", 1), "r.reference_used", "r.direction_comment", "r.previous_comment")


@query
def reason_detail_rows(spark, sf_dir):
    """Reason JSON of result rows, one row per reason again; what isn't a list of objects has none."""
    k = F.col("c_custkey")
    one = lambda rank: F.struct(F.concat(F.lit("f"), (k % 5 + rank).cast("string")).alias("feature"), (F.col("c_acctbal") * rank).alias("actual"), (k * rank).alias("peer_support"), F.struct((k % 50 * 1.0).alias("peer_pct")).alias("component_contributions"))
    text = F.when(k % 4 == 0, F.to_json(F.array(one(1), one(2)))).when(k % 4 == 1, F.to_json(F.array(one(3)))).when(k % 4 == 2, "not json")
    rows = sinks.exploded_reasons(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("mono_id"), F.lit("2000-12-31").alias("cohort_dt"), text.alias("reason_details")))
    return rows.select("mono_id", "cohort_dt", "feature_rank", "feature", _r("actual", "actual", 4), "peer_support", "peer_pct", "label")


@query
def shaped_results(spark, sf_dir):
    """Rows in the form of the results table: numbers read from text, texts cut to their widths, missing columns NULL."""
    k = F.col("c_custkey")
    score = F.when(k % 5 == 0, "nan").when(k % 5 == 1, "unknown").otherwise(F.concat((k % 100).cast("string"), F.lit(".25")))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("MONO_ID"), F.lit("2000-12-31").alias("cohort_dt"), score.alias("anomaly_score"), F.repeat("c_mktsegment", 20).alias("alert_band"),
        F.when(k % 3 == 0, " None ").otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("reason_1"), (k % 7).cast("string").alias("rank_in_run"),
    )
    return sinks.shaped(rows, sinks.RESULTS).select("mono_id", _day(), "anomaly_score", "ensemble_score", "alert_band", "reason_1", "rank_in_run")


@query
def decision_reason_rows(spark, sf_dir):
    """Reasons of decisions, numbered, in the form of their table."""
    k = F.col("c_custkey")
    one = lambda name: F.struct(F.lit(name).alias("feature"), F.concat(F.lit("z="), (k % 10).cast("string")).alias("evidence"), F.repeat("c_mktsegment", 300).alias("interpretation"))
    given = F.slice(F.array(one("a"), one("b"), one("c")), 1, (k % 4).cast("int"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("mono_id"), F.lit("2000-12-31").alias("cohort_dt"), given.alias("main_reasons"))
    out = sinks.shaped(sinks.decision_reason_rows(rows, "run-1"), sinks.DECISION_REASONS)
    return out.select("run_id", "mono_id", _day(), "reason_rank", F.col("feature_name").alias("feature"), F.col("evidence_text").alias("evidence"), F.length("interpretation").cast("long").alias("n_interpretation"))


def _customers(spark, sf_dir) -> DataFrame:
    """Customers dealt by their id: what is made of each takes far longer than reading it, and a small file is read by one task.
    They are written, since filters on what is made of them would else be worked out before they are dealt."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("mono_id"), "c_custkey", "c_mktsegment", "c_acctbal")
    return staged(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "mono_id"), "customers")


def _answers(spark, sf_dir) -> DataFrame:
    """An answer of each customer as a model might write it: some lack a field, have another position or nothing readable."""
    k, text = F.col("c_custkey"), lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    field = lambda name, value, unless=None: F.concat(F.lit(f'"{name}": '), value) if unless is None else F.when(~unless, F.concat(F.lit(f'"{name}": '), value))
    parts = F.concat_ws(
        ", ",
        field("period_position", F.when(k % 11 == 0, "1").otherwise("0")),
        field("is_anomaly", F.when(k % 3 == 0, "true").when(k % 3 == 1, '"evet"').otherwise("false")),
        field("anomaly_type", F.when(k % 4 == 0, '" "').when(k % 4 == 1, '"PD_RISKI"').otherwise('"PEER_UYUMSUZLUGU"')),
        field("anomaly_score", F.when(k % 5 == 0, "7").when(k % 5 == 1, '"x"').otherwise((k % 100 / 100).cast("string"))),
        field("reason_summary", text(F.concat("c_mktsegment", F.lit(" ozet "))), k % 13 == 0),
        field("reason_1", F.when(k % 7 == 0, '""').otherwise(text(F.concat(F.lit("account balance of "), F.lower("c_mktsegment"))))),
        field("reason_1_weight", (k % 10 / 10).cast("string"), k % 17 == 0),
        field("reason_2", text(F.lit("order total: current=1; previous=2; peer_z=3")), k % 2 == 0),
        field("reason_3", text(F.lit("nothing like it")), k % 3 != 0),
        field("reason_3_weight", F.lit("-2"), k % 3 != 0),
        field("risk_level", F.when(k % 6 == 0, "null").otherwise('"YUKSEK"')),
    )
    answer = F.when(k % 19 == 0, "no object").otherwise(F.concat(F.lit("{"), parts, F.lit("}")))
    return _customers(spark, sf_dir).select("mono_id", F.lit("2000-12-31").alias("cohort_dt"), answer.alias("raw_response"), answer.alias("answer"), F.lit(None).cast("string").alias("error"))


def _customer_features(spark, sf_dir) -> DataFrame:
    """Three features of each customer as evidence rows."""
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    one = lambda rank, name, label, value, median: F.struct(F.lit(rank).alias("evidence_rank"), F.lit(name).alias("feature"), F.lit(label).alias("label"), value.alias("value"), median.alias("median"), (k % 4).cast("double").alias("robust_scale"), F.lit("HIGHER_IS_RISKY").alias("risk_direction"))
    rows = F.array(
        one(1, "order_total", "Order total", F.when(k % 5 != 0, (k % 50).cast("double")), F.lit(10.0)),
        one(2, "account_balance", "Account balance", F.round(balance / 1000), F.lit(0.0)),
        one(3, "segment_share", "Share of the segment", (k % 9).cast("double"), F.lit(None).cast("double")),
    )
    return _customers(spark, sf_dir).select("mono_id", F.inline(rows))


@query
def decision_contract(spark, sf_dir):
    """Answers by the contract: decisions, or what is wrong with them."""
    out = decisions.validated(_answers(spark, sf_dir))
    weights = [f"reason_{i}_weight" for i in decisions.REASONS]
    first = F.col("main_reasons")[0]
    return out.select("mono_id", "is_anomaly", "anomaly_type", "risk_level", _r("anomaly_score", "anomaly_score"), "reason_summary", "reason_1", "reason_2", *(_r(c, c) for c in weights), "recommended_action",
                      F.size("main_reasons").cast("long").alias("n_reasons"), first["feature"].alias("first_reason"), first["evidence"].alias("first_evidence"), "error")


@query
def reasons_with_numbers(spark, sf_dir):
    """The feature that each reason speaks of, and reasons and summary with its numbers."""
    out = decisions.enrich_reasons(decisions.validated(_answers(spark, sf_dir)).where("error IS NULL"), _customer_features(spark, sf_dir))
    return out.select("mono_id", "reason_summary", "reason_1", "reason_2", "reason_3", F.to_json("main_reasons").alias("main_reasons"))


@query
def decision_result_rows(spark, sf_dir):
    """Decisions with the scores beside them in the columns of their table."""
    made = decisions.validated(_answers(spark, sf_dir)).where("error IS NULL")
    scores = table(spark, sf_dir, "customer").where("c_custkey % 8 <> 0").select(F.col("c_custkey").cast("string").alias("mono_id"), F.lit("2000-12-31").alias("cohort_dt"), num.rounded(F.col("c_acctbal") / 100, 2).alias("ensemble_score"), F.when(F.col("c_acctbal") > 5000, "KIRMIZI").otherwise("NORMAL").alias("alert_band"))
    out = sinks.shaped(sinks.decision_rows(companion_scores(made, scores), "run-1", "rules", "customers"), sinks.DECISIONS)
    return out.select("run_id", "mono_id", _day(), "is_anomaly", "anomaly_type", "risk_level", _r("anomaly_score", "anomaly_score"), _r("llm_confidence", "llm_confidence"), _r("ml_ensemble_score", "ml_ensemble_score", 2), "ml_is_anomaly", "ml_alert_band",
                      "ml_if_score", "reason_summary", "reason_1", _r("reason_1_weight", "reason_1_weight"), "reason_2", "reason_3", "recommended_action", "llm_model", "evidence_source", "caveat")


def _evidence(spark, sf_dir) -> DataFrame:
    return evidence_flow.build_evidence(staged(customer_years(spark, sf_dir), "panel"), FORMULAS, settings=evidence_flow.EvidenceSettings(month="2000-12-31"))


@query
def evidence_ranked(spark, sf_dir):
    """All evidence of the scored year but the series, ranked within each customer."""
    e = staged(_evidence(spark, sf_dir), "evidence")
    return e.select("mono_id", "feature", *((_r(c, digits=4) + 0.0).alias(c) for c in ("value", "previous_value", "peer_z", "history_z", "slope_6m", "same_month_customer_z", "seasonal_peer_z", "evidence_strength")), "trend_break_flag", F.col("evidence_rank").cast("long").alias("evidence_rank"))


@query
def decision_feature_rows(spark, sf_dir):
    """Evidence in the form of the features table."""
    out = sinks.shaped(sinks.decision_feature_rows(staged(_evidence(spark, sf_dir), "evidence"), "run-1"), sinks.DECISION_FEATURES)
    old = {"feature_name": "feature", "history_period_count": "period_count", "peer_definition_level": "peer_level", "trend_break_flag": "trend_break", "data_missing_flag": "missing_flag"}
    return out.select("run_id", "mono_id", _day(), "feature_rank", _r("current_value", "value", 4), "peer_support", *(F.col(c).alias(name) for c, name in old.items()))


def _inputs(spark, sf_dir):
    return anomaly.model_inputs(staged(customer_years(spark, sf_dir), "panel"), FORMULAS, "2000-12-31")


@query
def residual_scores(spark, sf_dir):
    """The part of the ensemble that needs no fitted model: deviations from peers, and their percentile among all earlier rows."""
    out = anomaly.residual_scores(_inputs(spark, sf_dir))
    return out.select("mono_id", _r("residual", "residual", 5), _r("residual_score", "residual_score", 2))


@query
def isolation_forest_nodes(spark, sf_dir):
    """The forest that is fitted on all earlier rows, as a table."""
    inputs = _inputs(spark, sf_dir)
    nodes, _ = fit_isolation_forest(staged(inputs.x_train, "train"), inputs.names, tuple(KEYS))
    return nodes.select("tree", "node", "feature", _r("threshold", "threshold"), (F.col("length") / 1000).cast("long").alias("length"))


@query
def ensemble_scores(spark, sf_dir):
    """Percentiles of forest, deviations and autoencoder among all earlier rows, their ensemble and its band."""
    inputs = _inputs(spark, sf_dir)
    scored = anomaly.ensemble_scores(inputs)
    limits = scoring.band_thresholds(scored, "ensemble_score")
    confidence = num.confidence(F.lit(1.0), *(F.col(c) for c in SCORES))
    return scored.select("mono_id", *(_r(c, c, 4) for c in (*SCORES, "ensemble_score")), _r(confidence, "agreement", 4), scoring.band(F.col("ensemble_score"), limits).alias("alert_band"))


@query
def ensemble_flagship(spark, sf_dir):
    """The whole run of a month: scores, bands, alerts and queues, and the reasons as texts and, read back from their JSON, by their parts."""
    run = anomaly.run_anomaly(staged(customer_years(spark, sf_dir), "panel"), FORMULAS, month="2000-12-31")
    four = lambda c: F.when(c.isNull(), "").otherwise(F.format_string("%.4f", F.round(c, 4) + 0.0))
    numbers = ("actual", "customer_previous_reference", "peer_reference", "peer_z", "train_reference")
    texts = ("peer_support", "peer_level", "peer_quality", "reference_used", "direction_comment", "previous_comment", "financial_term_detail")
    part = lambda x: F.concat_ws(":", x["feature"], x["is_missing_reason"].cast("string"), *(four(x[c]) for c in numbers), F.format_string("%.1f", F.round(x["contribution_pct"], 1)), *(F.coalesce(x[c].cast("string"), F.lit("")) for c in texts))
    details = F.array_join(F.transform(reason_list(F.col("reason_details"), reasons.REASON_SCHEMA), part), " | ").alias("reason_details")
    return run.results.select("mono_id", _day(), *(_r(c, c, 4) for c in ("ensemble_score", *SCORES, "confidence", "coverage_ratio")), "alert_band", "alert_type", "review_queue", "reason_1", "reason_2", "reason_3", details)


@query
def evidence_packages(spark, sf_dir):
    """Everything that is known of each customer and feature of the scored year, with the series of its last months beside their peers."""
    e = staged(_evidence(spark, sf_dir), "evidence")
    four = lambda c: F.coalesce(F.format_string("%.4f", num.rounded(c, 4) + 0.0), F.lit(""))
    month = lambda x: F.concat_ws(":", x["cohort_dt"], F.when(x["value"].isNull(), "").otherwise(four(x["value"])), x["is_current_snapshot"].cast("string"), x["peer_available"].cast("string"),
                                  *(F.when(x[c].isNull(), "").otherwise(four(x[c])) for c in ("peer_median", "peer_z")), *(F.coalesce(x[c].cast("string"), F.lit("")) for c in ("peer_support", "peer_quality", "peer_level")))
    return e.select("mono_id", _day(), "feature", *((_r(c, digits=4) + 0.0).alias(c) for c in ("value", "peer_z", "history_z", "slope_6m", "seasonal_peer_z", "evidence_strength")), "trend_break_flag", F.col("evidence_rank").cast("long").alias("evidence_rank"),
                    "label", "category", "formula", "source_columns", "risk_direction", F.array_join(F.transform("series", month), " | ").alias("series"))


@query
def entity_assessments(spark, sf_dir):
    """What the evidence of each customer of the scored year says of season, trend and peers in a line, and what limits it."""
    years = staged(customer_years(spark, sf_dir), "panel")
    settings = evidence_flow.EvidenceSettings(month="2000-12-31")
    found = staged(evidence_flow.build_evidence(years, FORMULAS, settings=settings), "evidence")
    out = assessments(found, evidence_flow.entity_quality(years, list(MEASURES), settings))
    return out.select("mono_id", _day(), "seasonality_assessment", "trend_assessment", "peer_assessment", "caveat")


@query
def variable_names(spark, sf_dir):
    """What variables of many names are about and what they are used for."""
    k = F.col("p_partkey")
    heads = ("mono_id", "data_time", "cst_sector", "memzuc_", "fs_", "irb_", "x_tkn_", "kkb_", "bank_", "my_external_", "x_rating_", "alacak_", "rating_group", "irb_model_pd", "yukleme_zmn", "")
    head = F.element_at(F.array(*map(F.lit, heads)), (k % len(heads) + 1).cast("int"))
    whole = (k % len(heads)).isin(*(i for i, h in enumerate(heads) if h and not h.endswith("_")))
    name = F.when(whole, head).otherwise(F.concat(head, F.replace("p_name", F.lit(" "), F.lit("_"))))
    about = txt.variable_category(name, F.when(k % 10 == 0, " made ").when(k % 10 == 1, "nan"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), about.alias("category"), txt.column_role(name, about).alias("role"))


@query
def prompt_dry_run(spark, sf_dir):
    e = _evidence(spark, sf_dir)
    return prompt_text(e, "Karar ver.").select("mono_id", _day(), "prompt")
