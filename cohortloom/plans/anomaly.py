"""The anomaly run: panel to features, peers, scores, bands and reasons of one month."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.formula import compile_formulas
from cohortloom.functions.numeric import confidence, coverage, data_gap, ensemble, half_even, missing_count, top_mean
from cohortloom.functions.text import alert_type, review_queue, term_column
from cohortloom.operators.models import PASSES, TREES, fit_autoencoder, fit_isolation_forest, forest_of, model_score
from cohortloom.operators.panel import ID, TIME, intake, latest_before, month_profile, scoring_month, split
from cohortloom.operators.peers import PeerColumns, compared, long_form, peer_diagnostics, peer_lookup, peer_matrix, size_base, with_peer_context
from cohortloom.operators.quantiles import grouped_quantiles, interpolated
from cohortloom.operators.reasons import build_reasons
from cohortloom.operators.scoring import band, band_thresholds, fit_preprocessor, percentiles
from cohortloom.operators.selection import DERIVED_PREFIXES, model_features
from cohortloom.sources import sinks
from cohortloom.sources.config import Dictionary
from cohortloom.sources.staging import staged

DIRECT_FEATURES = ("rating_group",)
#: 0 for rows of the earlier months, 1 for those of the scored one.
PART = "__part"
#: Columns of a raw panel that stay text.
TEXT_COLUMNS = (ID, TIME, "musteri_segment", "cst_sector", "cst_nace_code", "cst_nace_code_id", "financial_term_l1y", "financial_term_q", "ref_donem_id", "yukleme_zmn", "data_time", "created_at")


@dataclass
class AnomalyRun:
    """What a run leaves: all lazy but the fitted parts."""

    month: date
    features: list[str]
    results: DataFrame
    reasons: DataFrame
    peers: DataFrame
    thresholds: dict[str, float]
    summary: dict[str, Any] = field(default_factory=dict)


def with_features(df: DataFrame, formulas: dict[str, str]) -> DataFrame:
    """The frame with its generated features; denominator floors are those of this frame."""
    return df.withColumns(compile_formulas(df, formulas)) if formulas else df


def candidate_features(df: DataFrame, formulas: dict[str, str], exclude: tuple[str, ...] = (), direct: tuple[str, ...] = DIRECT_FEATURES) -> list[str]:
    made = [f.lower() for f in formulas if f.lower() not in exclude]
    named = [c for c in df.columns if c not in made and c.startswith(DERIVED_PREFIXES) and "_to_" in c and c not in exclude]
    return made + named + [c for c in direct if c in df.columns and c not in exclude]


@dataclass
class ModelInputs:
    """A panel's split with its features, the peers of the scored month, and both parts as the models take them."""

    month: date
    panel: DataFrame
    formulas: dict[str, str]
    train: DataFrame
    score: DataFrame
    features: list[str]
    peers: DataFrame
    names: list[str]  # columns of x_train and x_score
    x_train: DataFrame
    x_score: DataFrame
    train_long: DataFrame  # feature and value of the earlier months


def model_inputs(panel: DataFrame, formulas: dict[str, str], month: str | None = None, dictionary: Dictionary = Dictionary(), peer_columns: PeerColumns = PeerColumns()) -> ModelInputs:
    """Features of all rows, deviations of each month from its peers, bounded and scaled by those of the earlier months."""
    panel = intake(panel)
    at = scoring_month(panel, month)
    train, score = (staged(with_features(df, formulas), "features") for df in split(panel, at))
    features = model_features(train, score, candidate_features(train, formulas, dictionary.exclude))
    if not features:
        raise ValueError("no usable feature is left after coverage and variance checks")
    keys = [ID, TIME]
    # one pass over both parts: all levels are within a month, so a part's groups are its own
    both = reduce(DataFrame.unionByName, (df.withColumns({PART: F.lit(i), "__base": size_base_or_null(df, peer_columns)}) for i, df in enumerate((train, score))))
    context = with_peer_context(both, peer_columns, base=F.col("__base"))
    shown = [*keys, PART, "peer_segment", "peer_sector", "peer_size"]
    wide = staged(context.select(*shown, *(F.col(f"`{f}`").cast("double").alias(f) for f in features)), "context")
    long = long_form(wide, features, shown)
    lookup = peer_lookup(long, part=PART)
    names = [f"{f}__peer_z" for f in features]
    matrix = staged(peer_matrix(wide, lookup, features, [*keys, PART]), "matrix")
    train_matrix, score_matrix = (matrix.where(F.col(PART) == i).drop(PART) for i in (0, 1))
    score_matrix = score_matrix.dropDuplicates(keys)  # results have a row for each entity
    prepared = fit_preprocessor(train_matrix, names)
    x_train = train_matrix.select(*keys, *prepared.expressions())
    x_score = score_matrix.select(*keys, *prepared.expressions())
    train_long = long.where(F.col(PART) == 0).select("feature", "value")
    return ModelInputs(at, panel, formulas, train, score, features, compared(long.where(F.col(PART) == 1), lookup).drop(PART), names, x_train, x_score, train_long)


def size_base_or_null(df: DataFrame, columns: PeerColumns) -> Column:
    base = size_base(df, columns)
    return F.lit(None).cast("double") if base is None else base.cast("double")


def residual_scores(inputs: ModelInputs) -> DataFrame:
    """``mono_id, cohort_dt, residual, residual_score``: mean of the three largest deviations, and its percentile among all earlier rows."""
    residual = top_mean(F.array(*(F.abs(F.col(f"`{n}`")) for n in inputs.names))).alias("residual")
    keys = [ID, TIME]
    return percentiles(staged(inputs.x_score.select(*keys, residual), "residual"), inputs.x_train.select(residual), {"residual": "residual_score"})


def ensemble_scores(inputs: ModelInputs, trees: int = TREES, passes: int = PASSES, seed: int = 42) -> DataFrame:
    """Rows of the scored month with their prepared deviations, the percentiles of the three models' scores among all
    earlier rows, and ``ensemble_score``. Both models are fitted on all earlier rows."""
    names, keys = inputs.names, (ID, TIME)
    x_train = staged(inputs.x_train, "train")
    if not x_train.take(1):
        raise ValueError("there are no rows before the scoring month")
    forest = forest_of(*fit_isolation_forest(x_train, names, keys, trees, seed=seed))
    coder = fit_autoencoder(x_train, names, keys, passes, seed=seed)
    absolute = F.array(*(F.abs(F.col(f"`{n}`")) for n in names))
    scores = {"if_score": model_score(forest, names), "residual_score": top_mean(absolute), "autoencoder_score": model_score(coder, names)}
    reference = staged(x_train.select(*(c.alias(f"__{k}") for k, c in scores.items())), "reference")
    raw = inputs.x_score.select(*keys, *(F.col(f"`{n}`") for n in names), *(c.alias(f"__{k}") for k, c in scores.items()))
    scored = percentiles(staged(raw, "raw"), reference, {f"__{k}": k for k in scores}).drop(*(f"__{k}" for k in scores))
    return staged(scored.withColumn("ensemble_score", ensemble({c: F.col(c) for c in scores})), "scores")


def run_anomaly(
    panel: DataFrame,
    formulas: dict[str, str] | None = None,
    month: str | None = None,
    dictionary: Dictionary = Dictionary(),
    ids: DataFrame | None = None,
    peer_columns: PeerColumns = PeerColumns(),
    top_reasons: int = 3,
    seed: int = 42,
    trees: int = TREES,
) -> AnomalyRun:
    """Score the rows of ``month`` (default: the latest) against all earlier rows, on which the models are fitted too.

    ``ids`` limits the result, not what it is measured against. The panel should be a table that is cheap to read several times.
    """
    inputs = model_inputs(panel, dictionary.formulas() if formulas is None else formulas, month, dictionary, peer_columns)
    at, panel, score, features, names = inputs.month, inputs.panel, inputs.score, inputs.features, inputs.names
    peers = staged(inputs.peers, "peers")
    formulas, keys = inputs.formulas, [ID, TIME]
    scored = ensemble_scores(inputs, trees, seed=seed)
    thresholds = band_thresholds(scored, "ensemble_score")
    shown = scored if ids is None else scored.join(ids.select(F.col(ID).cast("string")).distinct(), ID, "left_semi")
    if ids is not None and shown.limit(1).count() == 0:
        raise ValueError("none of the requested ids has a row in the scoring month")

    values = score.select(*keys, *features)
    covered = coverage(*features)
    gap = data_gap(covered)
    about = values.select(*keys, covered.alias("coverage_ratio"), gap.alias("data_gap_score"), missing_count(*features).alias("missing_feature_count"))
    earlier = staged(with_features(latest_before(panel, at), formulas), "earlier")
    previous = long_form(earlier, features, [ID]).withColumnRenamed("value", "previous")
    medians = grouped_quantiles(inputs.train_long, ["feature"], F.col("value"), {"m": 0.5}).select("feature", interpolated(F.col("m")).alias("train_reference"))
    severity = long_form(shown.select(*keys, *(F.abs(F.col(f"`{n}`")).alias(f) for n, f in zip(names, features, strict=True))), features, keys).withColumnRenamed("value", "severity")
    rows = severity.join(peers, [*keys, "feature"]).join(previous, [ID, "feature"], "left").join(F.broadcast(medians), "feature", "left")  # a row a feature
    if directions := dictionary.directions():
        rows = rows.withColumn("configured_direction", F.element_at(F.create_map(*(F.lit(x) for kv in directions.items() for x in kv)), F.col("feature")))
    terms = {f: t for f in features if (t := term_column(f)) and t in panel.columns}
    if terms:
        both = score.select(*keys, *(F.col(t).cast("string").alias(f"{t}__now") for t in sorted(set(terms.values())))).join(earlier.select(ID, *(F.col(t).cast("string").alias(f"{t}__then") for t in sorted(set(terms.values())))), ID, "left")
        rows = rows.join(both, keys, "left")
        pick = lambda end: F.coalesce(*(F.when(F.col("feature") == f, F.col(f"{t}__{end}")) for f, t in terms.items()))
        rows = rows.withColumns({"term_column": F.coalesce(*(F.when(F.col("feature") == f, F.lit(t)) for f, t in terms.items())), "term": pick("now"), "previous_term": pick("then")})
    reasons = staged(build_reasons(staged(rows, "reason-rows"), keys, top_reasons, dictionary.labels() or None), "reasons")

    out = shown.drop(*names).join(about, keys).join(reasons, keys, "left")
    out = out.withColumns({"alert_band": band(F.col("ensemble_score"), thresholds), "reasons": F.coalesce("reasons", F.array().cast(reasons.schema["reasons"].dataType)), "anomaly_score": F.col("ensemble_score")})
    out = out.withColumn("confidence", confidence(F.col("coverage_ratio"), F.col("if_score"), F.col("residual_score"), F.col("autoencoder_score")))
    out = out.withColumn("alert_type", alert_type(F.col("alert_band"), F.col("data_gap_score"), F.col("coverage_ratio"), F.transform("reasons", lambda r: r["feature"])))
    out = out.withColumn("review_queue", review_queue(F.col("alert_band"), F.col("alert_type"), F.col("data_gap_score")))
    digits = {"anomaly_score": 1, "if_score": 1, "residual_score": 1, "autoencoder_score": 1, "confidence": 1, "coverage_ratio": 4, "data_gap_score": 1}
    out = out.withColumns({c: half_even(F.col(c), d) for c, d in digits.items()})
    out = out.withColumns({"reason_details": F.to_json("reasons", {"ignoreNullFields": "false"}), **{f"reason_{i + 1}": F.get("reason_texts", F.lit(i)) for i in range(top_reasons)}})
    return AnomalyRun(at, features, out, reasons, peers, thresholds)


def ranked(results: DataFrame, n: int | None = None) -> DataFrame:
    """Results by falling score, ties by id; with ``rank_in_run`` where a number of rows is asked for."""
    ordered = results.orderBy(F.col("ensemble_score").desc(), ID)
    return ordered.limit(n).withColumn("rank_in_run", F.row_number().over(_by_score())) if n else ordered


def with_rank(results: DataFrame) -> DataFrame:
    """All results with ``rank_in_run`` from 1 by falling score, ties by id, missing scores last.

    Rows are dealt by ranges of score and id and numbered within a range, on from the rows of the ranges before (a row a range).
    """
    dealt = staged(results.repartitionByRange(F.col("ensemble_score").desc(), ID).withColumn("__range", F.spark_partition_id()), "ranks")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(F.col("ensemble_score").desc(), ID))
    return dealt.withColumn("__at", place).join(before, "__range").select(*results.columns, (F.col("__before") + F.col("__at")).alias("rank_in_run"))


def _by_score():
    return Window.orderBy(F.col("ensemble_score").desc(), ID)  # after a limit: a few rows


def summarize(run: AnomalyRun) -> dict[str, Any]:
    """Counts by band, type and queue in one pass, the peers' test, and the thresholds."""
    counts = run.results.groupingSets([["alert_band"], ["alert_type"], ["review_queue"]], "alert_band", "alert_type", "review_queue").agg(F.count("*").alias("n")).collect()  # a row a label
    out: dict[str, Any] = {"scoring_month": str(run.month), "features": run.features, "thresholds": {k: round(v, 4) for k, v in run.thresholds.items()}}
    for r in counts:
        kind = next((k for k in ("alert_band", "alert_type", "review_queue") if r[k] is not None), "alert_band")
        out.setdefault(f"{kind}_counts", {})[r[kind]] = r["n"]
    out["peer_diagnostics"] = peer_diagnostics(run.peers).first().asDict()
    out["rows"] = sum(out.get("alert_band_counts", {}).values())
    return {k: (None if isinstance(v, float) and math.isnan(v) else v) for k, v in out.items()}


def write_run(run: AnomalyRun, panel: DataFrame, folder: str, dictionary: Dictionary = Dictionary(), top: int = 500) -> str:
    """Scores and top rows as CSV, summary and profile as JSON, in a new folder named by month and time, which is returned."""
    spark = run.results.sparkSession
    summary = summarize(run)
    months = {r["month"].isoformat(): r["n_rows"] for r in month_profile(intake(panel)).orderBy("month").collect()}  # a row a month
    labels = dictionary.labels()
    profile = {
        "scoring_month": str(run.month), "month_counts": months, "total_rows": sum(months.values()),
        "train_rows": sum(n for month, n in months.items() if month < str(run.month)), "selected_features": run.features,
        "selected_feature_labels": {f: labels.get(f, f) for f in run.features}, "excluded_feature_columns": sorted(dictionary.exclude),
        "operational_band_thresholds": summary["thresholds"], "peer_representativeness_diagnostics": summary["peer_diagnostics"],
    }
    out = f"{folder.rstrip('/')}/{run.month:%Y%m%d}_{datetime.now():%Y%m%d_%H%M%S}"
    results = with_rank(run.results)
    sinks.write_csv(results, f"{out}/scores")
    sinks.write_csv(results.where(F.col("rank_in_run") <= top).coalesce(1).sortWithinPartitions("rank_in_run"), f"{out}/top")
    sinks.write_json(spark, f"{out}/summary", summary)
    sinks.write_json(spark, f"{out}/profile", profile)
    return out
