"""The evidence and decision run: ranked evidence of selected entities, prompts, decisions, tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import coverage
from cohortloom.functions.text import DIRECT_SIGNALS, column_role, risk_direction, variable_category
from cohortloom.operators.assessments import assessments
from cohortloom.operators.decisions import Decider, companion_scores, decide, enrich_reasons, prompt_text
from cohortloom.operators.evidence import evidence_rows, last_values, ranked_evidence
from cohortloom.operators.panel import CONTEXT, ID, TIME, intake, latest_by_key, scoring_month, split
from cohortloom.operators.peers import PeerColumns, long_form, peer_references, with_peer_context
from cohortloom.operators.selection import allowed_features, model_features
from cohortloom.plans.anomaly import candidate_features, with_features
from cohortloom.sources import sinks
from cohortloom.sources.config import Dictionary
from cohortloom.sources.staging import staged

_CONTEXT = ["peer_segment", "peer_sector", "peer_size"]


@dataclass(frozen=True)
class EvidenceSettings:
    month: str | None = None
    top_features: int | None = 12  # of an entity in its prompt
    min_history_periods: int = 3
    series_periods: int = 6


def build_evidence(panel: DataFrame, formulas: dict[str, str], ids: DataFrame | None = None, settings: EvidenceSettings = EvidenceSettings(), dictionary: Dictionary = Dictionary(), peer_columns: PeerColumns = PeerColumns()) -> DataFrame:
    """Ranked evidence rows, one per entity and feature of the month, none left out. Peers are those of the full month; ``ids`` limits what is shown."""
    panel = intake(panel)
    at = scoring_month(panel, settings.month)
    train, score = (staged(with_features(df, formulas), "features") for df in split(panel, at))
    names = allowed_features(candidate_features(train, formulas, dictionary.exclude), set(dictionary.include) or None, set(dictionary.exclude))
    features = model_features(train, score, names)
    if not features:
        raise ValueError("no usable feature is left")
    keys = [ID, TIME]
    shown = staged(long_form(with_peer_context(score, peer_columns), features, [*keys, *_CONTEXT]), "long")
    past = staged(long_form(with_peer_context(train, peer_columns), features, [*keys, *_CONTEXT]), "long")
    if ids is not None:
        wanted = ids.select(F.col(ID).cast("string")).distinct()
    else:
        wanted = shown.select(ID).distinct()
    history = staged(past.join(wanted, ID, "left_semi"), "history")
    peers = staged(_peers(shown, history, past, settings.series_periods), "peers")
    now = peers.where(F.col(TIME) == F.lit(at))
    if ids is not None:
        now = now.join(wanted, ID, "left_semi")
    series_peers = _series_peers(peers.join(wanted, ID, "left_semi"))
    ranked = ranked_evidence(evidence_rows(now, history, past, at, settings.series_periods, series_peers), None).withColumn("cohort_dt", F.lit(at))
    return with_dictionary(ranked, features, formulas, dictionary, panel.columns)


def with_dictionary(evidence: DataFrame, features: list[str], formulas: dict[str, str], dictionary: Dictionary, columns: list[str]) -> DataFrame:
    """Evidence with ``label, category, formula, source_columns`` (JSON) and ``risk_direction`` of each feature. Without an entry
    the label is the feature, category and direction are told by its name, and the source columns are the formula's ``columns``."""
    rows, known = [], {c.lower() for c in columns} | set(features)
    for name in features:
        about = dictionary.about(name)
        formula = formulas.get(name) or about.get("formula")
        inputs = json.dumps(dictionary.source_columns(name, formula, known), ensure_ascii=False)
        rows.append((name, about.get("label") or name, dictionary.category(name), formula, inputs, about.get("risk_direction")))
    named = evidence.sparkSession.createDataFrame(rows, "feature string, label string, category string, formula string, source_columns string, risk_direction string")
    given = F.coalesce("risk_direction", F.when(F.col("feature").isin(*DIRECT_SIGNALS), "HIGHER_IS_RISKY"))  # a rating gets worse upwards
    named = named.withColumns({"category": variable_category(F.col("feature"), F.col("category")), "risk_direction": risk_direction(F.col("feature"), given, falls_first=True)})
    return evidence.join(F.broadcast(named), "feature", "left")  # a row a feature


def column_dictionary(panel: DataFrame, dictionary: Dictionary = Dictionary(), used: list[str] | None = None) -> DataFrame:
    """A row for each column of a raw panel: ``column, position, label, category, definition, source (JSON), source_column, role, used``.

    What the dictionary doesn't say is told by the name but for labels, which are NULL: those columns lack an entry.
    ``used``: the columns that a run reads (default: all)."""
    rows = []
    for i, column in enumerate(panel.columns):
        about = dictionary.about(column)
        source = json.dumps(about["source"], ensure_ascii=False) if about.get("source") else None
        rows.append((column, i, about.get("label"), dictionary.category(column), about.get("definition"), source, about.get("source_column"), used is None or column in used))
    named = panel.sparkSession.createDataFrame(rows, "column string, position int, label string, category string, definition string, source string, source_column string, used boolean")
    about = variable_category(F.col("column"), F.col("category"))
    role = column_role(F.col("column"), about, dictionary.direct, dictionary.exclude)
    return named.select("column", "position", "label", about.alias("category"), "definition", "source", "source_column", role.alias("role"), "used")


def _peers(shown: DataFrame, history: DataFrame, past: DataFrame, periods: int) -> DataFrame:
    """Peers of the scored month and of the months in the series of ``history``'s entities, in one pass: each month's among all its entities and by itself."""
    months = last_values(latest_by_key(history.where("value IS NOT NULL"), [ID, "feature", TIME], [F.col("value")]), max(1, periods)).select(TIME).distinct()
    rows = shown.unionByName(past.join(F.broadcast(months), TIME, "left_semi"))  # months of a panel
    return peer_references(staged(rows, "series-long"), part=TIME)


def _series_peers(peers: DataFrame) -> DataFrame:
    """One row per entity, feature and month; of a month that repeats the greatest value counts."""
    fields = ["peer_median", "peer_z", "peer_support", "peer_quality", "peer_level"]
    return latest_by_key(peers.select(ID, "feature", TIME, "value", *fields), [ID, "feature", TIME], [F.col("value")]).drop("value")


def entity_quality(panel: DataFrame, features: list[str], settings: EvidenceSettings = EvidenceSettings()) -> DataFrame:
    """Per entity of the month: coverage, missing features, months of history, whether those are too few, and its context."""
    at = scoring_month(panel, settings.month)
    train, score = split(panel, at)
    periods = train.groupBy(ID).agg(F.count_distinct(TIME).alias("customer_history_periods"))
    context = [F.col(c).cast("string").alias(c) for c in CONTEXT if c in panel.columns]
    missing = sum((F.col(f).isNull().cast("int") for f in features), F.lit(0))
    out = score.select(ID, *context, coverage(*features).alias("coverage_ratio"), missing.alias("missing_feature_count")).join(periods, ID, "left")
    n = F.coalesce("customer_history_periods", F.lit(0))
    return out.withColumn("customer_history_periods", n).withColumn("insufficient_history_flag", n < settings.min_history_periods)


def run_decisions(evidence: DataFrame, decider: Callable[[], Decider], template: str = "", scores: DataFrame | None = None, top_features: int | None = EvidenceSettings.top_features) -> DataFrame:
    """Prompts without scores, one answer per entity, reasons with numbers, and the model's scores beside them if given."""
    prompts = prompt_text(evidence, template, top_features=top_features)
    decisions = enrich_reasons(decide(prompts, decider), evidence)
    return companion_scores(decisions, scores) if scores is not None else decisions


def write_decisions(decisions: DataFrame, evidence: DataFrame, run_id: str, tables: dict[str, str], mode: str = "replace", model: str | None = None, source: str | None = None, quality: DataFrame | None = None) -> dict[str, Any]:
    """Reasons and features first, decisions last, so that a decision never stands without them; returns the row counts.

    ``model`` and ``source`` say who decided on what; ``quality`` (``entity_quality``) is for the caveats."""
    done = decisions.where("error IS NULL")
    sinks.write_table(sinks.decision_feature_rows(evidence, run_id), tables["features"], sinks.DECISION_FEATURES, mode)
    sinks.write_table(sinks.decision_reason_rows(done, run_id), tables["reasons"], sinks.DECISION_REASONS, mode)
    sinks.write_table(sinks.decision_rows(done, run_id, model, source, assessments(evidence, quality)), tables["decisions"], sinks.DECISIONS, mode)
    counts = sinks.audit(decisions.sparkSession, list(tables.values()), run_id=run_id)
    return {r["table_name"]: r["run_rows"] for r in counts.collect()}  # a row a table
