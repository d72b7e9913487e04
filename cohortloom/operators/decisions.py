"""Structured decisions about entities: prompt text, a pluggable decider, the contract of its answers, and enrichment with evidence."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.jsontext import json_like, message_candidates
from cohortloom.functions.numeric import finite, rounded, unit_float
from cohortloom.functions.text import truth
from cohortloom.operators.assessments import six_decimals, six_digits

# Fixed values of the decision contract: names of types, levels and fields, default texts, and the most that a text may have.
TYPES = ("ANI_RISK_ARTISI", "FINANSAL_BOZULMA", "PD_RISKI", "KKB_RISKI", "PEER_UYUMSUZLUGU", "DATA_GAP", "TREND_KIRILMASI", "SEZON_DISI_SAPMA", "NORMAL")
LEVELS = ("DUSUK", "ORTA", "YUKSEK", "KRITIK")
REASONS = (1, 2, 3)
REQUIRED = ("period_position", "is_anomaly", "anomaly_type", "anomaly_score", "reason_summary", "reason_1", "reason_1_weight", "risk_level")
OPTIONAL = ("reason_2", "reason_2_weight", "reason_3", "reason_3_weight", "recommended_action", "llm_confidence", "confidence")
ASSESSMENTS = ("seasonality_assessment", "trend_assessment", "peer_assessment", "caveat")
MISSPELLED = {"seasonality_assessment": "seasonality_assesment", "trend_assessment": "trend_assesment", "peer_assessment": "peer_assesment"}
ACTION_IF_ANOMALY, ACTION_IF_NORMAL = "Manuel incele", "Izle"
GENERAL_REASON, NO_SUMMARY, EVIDENCE_CAP = "GENEL_DEGERLENDIRME", "LLM structured karar aciklamasi bos dondu.", 1200
EVIDENCE_PREFIX, SUMMARY_PREFIX = "Sayisal kanit", "Sayisal ozet"
EVIDENCE_KEYS = r"\b(current|cari|previous|onceki|change_pct|degisim|history_z|hist_z|peer_z|peer_median|history_median)\s*[=:]"
DENIED_PREFIX = "ml_"
DENIED_FIELDS = (
    "anomaly_score", "ensemble_score", "if_score", "residual_score", "autoencoder_score", "confidence", "alert_band", "alert_type", "review_queue", "rank_in_run", "selection_bucket", "selection_score", "selection_score_column", "selection_model", "is_anomaly",
    "data_gap_score", "reason_details", "reason_1", "reason_2", "reason_3",
)
#: What is said for a contained name and, less, for a feature that an earlier reason has had.
CONTAINED, USED = 8, 2

REASONS_TYPE = "array<struct<feature:string,evidence:string,interpretation:string>>"
ANSWER_SCHEMA = ", ".join(f"{c} string" for c in (*REQUIRED, *OPTIONAL, *ASSESSMENTS, *MISSPELLED.values()))


class Decider(Protocol):
    """Answers one prompt with a message: text, or a mapping as chat models give it."""

    def __call__(self, prompt: str) -> Any: ...


def denied(name: str) -> bool:
    return name.lower().startswith(DENIED_PREFIX) or name.lower() in DENIED_FIELDS


def without_scores(value: Any) -> Any:
    """A copy of nested evidence without anything that tells model scores."""
    if isinstance(value, dict):
        return {k: without_scores(v) for k, v in value.items() if not denied(k)}
    return [without_scores(v) for v in value] if isinstance(value, list) else value


def drop_score_columns(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if denied(c)))


def feature_line(f: Column, types: dict[str, str]) -> Column:
    """One feature's evidence as a line of key=value parts, numbers with six decimals; missing ones are left out. ``types``: of the fields of ``f``."""
    keys = ("value", "previous_value", "change_pct", "median", "p25", "p75", "history_z", "slope_6m", "slope_12m", "trend_break_flag", "yoy_change_pct", "same_month_customer_z", "seasonal_peer_median", "seasonal_peer_z", "peer_median", "peer_z", "peer_support", "peer_level", "peer_quality")
    text = lambda k: six_decimals(f[k]) if types[k] in ("double", "float") else F.substring(f[k].cast("string"), 1, 24)
    parts = [F.concat(F.lit(f"{k}="), text(k)) for k in keys if k in types]
    return F.concat_ws(" | ", F.concat(F.lit("- "), f["feature"]), *parts)


def prompt_text(evidence: DataFrame, template: str = "", keys: tuple[str, ...] = ("mono_id", "cohort_dt"), top_features: int | None = 12) -> DataFrame:
    """``keys, prompt``: one prompt per entity from its ``top_features`` first ranked evidence rows (None: all); scores never get into it."""
    rows = drop_score_columns(evidence if top_features is None else evidence.where(F.col("evidence_rank") <= top_features))
    every = F.struct(*(F.col(c) for c in rows.columns if c not in keys and c != "series"))
    lines = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("evidence_rank", every.alias("f")))).alias("features"))  # at most the ranked features of an entity
    types = dict(rows.dtypes)
    head = F.concat(F.lit(template), F.lit("\nmusteri="), F.col(keys[0]), F.lit(" donem="), F.col(keys[1]).cast("string"), F.lit("\n"))
    return lines.select(*keys, F.concat(head, F.array_join(F.transform("features", lambda x: feature_line(x["f"], types)), "\n")).alias("prompt"))


def decoded(message: Any) -> dict[str, Any] | None:
    """The answer in a message: its parsed part, its content, or its tool-call arguments. A list of results is no answer to one prompt."""
    if isinstance(message, dict) and isinstance(message.get("parsed"), dict):
        return message["parsed"]
    if isinstance(message, dict) and any(k in message for k in REQUIRED):
        return message
    for text in message_candidates(message):
        if isinstance(found := json_like(text), dict):
            if isinstance(found.get("results"), list):
                raise ValueError("a list of results for one prompt")
            return found
    return None


def decide(prompts: DataFrame, decider: Callable[[], Decider]) -> DataFrame:
    """One request per prompt, on the executors, then ``validated``; ``decider`` makes the client once per task. A failed one has ``error`` and no decision."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = decider()
        for batch in batches:
            rows = []
            for key, month, prompt in zip(batch["mono_id"], batch["cohort_dt"], batch["prompt"], strict=True):
                raw = answer = error = None
                try:
                    message = ask(prompt)
                    raw = message if isinstance(message, str) else json.dumps(message, ensure_ascii=False, default=str)
                    found = decoded(message)
                    answer, error = (None, "no answer could be decoded") if found is None else (json.dumps(found, ensure_ascii=False, default=str), None)
                except Exception as failed:  # noqa: BLE001  a client may raise anything; the row tells
                    error = f"{type(failed).__name__}: {failed}"
                rows.append((key, month, raw, answer, error))
            yield pd.DataFrame(rows, columns=["mono_id", "cohort_dt", "raw_response", "answer", "error"], dtype=object)

    asked = prompts.select(F.col("mono_id").cast("string"), F.col("cohort_dt").cast("string"), "prompt")
    return validated(asked.mapInPandas(run, "mono_id string, cohort_dt string, raw_response string, answer string, error string"))


def validated(answers: DataFrame) -> DataFrame:
    """Decisions from ``answer``, the JSON text of one object each; what is wrong with an answer is its ``error``, and it has no decision.

    All required fields must have a value and ``period_position`` must be 0. Scores and weights are bounded by 0 and 1, what
    can't be read as one is 0; texts are trimmed; an empty type is NORMAL, an empty level DUSUK. Without a recommended action
    there is one by ``is_anomaly``.
    """
    a = answers.withColumn("__a", F.from_json("answer", f"{ANSWER_SCHEMA}, __unread string", {"columnNameOfCorruptRecord": "__unread"}))
    given = lambda c: F.col(f"__a.{c}")
    missing = F.concat_ws(",", *(F.when(given(c).isNull(), c) for c in REQUIRED))
    position = given("period_position").try_cast("double").cast("int")
    wrong = F.when(missing != "", F.concat(F.lit("missing required fields: "), missing)).when(
        F.coalesce(position != 0, F.lit(True)), F.concat(F.lit("period_position must be 0: "), given("period_position"))
    )
    a = a.withColumn("error", F.coalesce(F.col("error"), F.when(F.col("__a").isNull() | given("__unread").isNotNull(), "no answer could be decoded"), wrong))
    good = F.col("error").isNull()
    anomalous = F.coalesce(truth(given("is_anomaly")), F.lit(False))
    score = unit_float(given("anomaly_score"))
    or_text = lambda c, default: F.coalesce(F.nullif(F.trim(given(c)), F.lit("")), F.lit(default))
    fields: dict[str, Column] = {"is_anomaly": anomalous, "anomaly_type": or_text("anomaly_type", "NORMAL"), "risk_level": or_text("risk_level", "DUSUK"), "anomaly_score": score}
    fields["llm_confidence"] = F.coalesce(given("llm_confidence").try_cast("double"), given("confidence").try_cast("double"), score)
    fields["reason_summary"] = F.trim(given("reason_summary"))
    for i in REASONS:
        fields |= {f"reason_{i}": F.trim(given(f"reason_{i}")), f"reason_{i}_weight": unit_float(given(f"reason_{i}_weight"))}
    fields["recommended_action"] = F.coalesce(given("recommended_action"), F.when(anomalous, ACTION_IF_ANOMALY).otherwise(ACTION_IF_NORMAL))
    fields |= {c: F.nullif(F.trim(F.coalesce(given(c), given(MISSPELLED[c])) if c in MISSPELLED else given(c)), F.lit("")) for c in ASSESSMENTS}
    out = a.select("mono_id", "cohort_dt", *(F.when(good, c).alias(name) for name, c in fields.items()), "raw_response", "error")
    return out.withColumn("main_reasons", F.when(F.col("error").isNull(), reason_records()))


def reason_records(numbers: dict[int, Column] | None = None) -> Column:
    """One to three records of a decision's reasons: its weight and the ``numbers`` found for it; a general one without any reason."""
    records = []
    for i in REASONS:
        evidence = F.concat_ws("; ", F.format_string("weight=%.4f", F.coalesce(F.col(f"reason_{i}_weight"), F.lit(0.0))), *([numbers[i]] if numbers else []))
        one = F.struct(F.lit(f"REASON_{i}").alias("feature"), evidence.alias("evidence"), F.col(f"reason_{i}").alias("interpretation"))
        records.append(F.when(F.coalesce(F.col(f"reason_{i}"), F.lit("")) != "", one))
    found = F.filter(F.array(*records), lambda r: r.isNotNull())
    summary = F.coalesce(F.nullif(F.col("reason_summary"), F.lit("")), F.lit(NO_SUMMARY))
    general = F.array(F.struct(F.lit(GENERAL_REASON).alias("feature"), F.lit("").alias("evidence"), summary.alias("interpretation")))
    return F.when(F.size(found) > 0, found).otherwise(general).cast(REASONS_TYPE)


def rule_decider(threshold: float = 3.0) -> Decider:
    """A decider without a model: anomalous where a peer or history deviation in the prompt reaches the threshold."""

    def ask(prompt: str) -> dict[str, Any]:
        found = []
        for line in prompt.splitlines():
            name = re.match(r"- (\S+)", line)
            z = [abs(float(x)) for x in re.findall(r"(?<![a-z_])(?:peer_z|history_z)=(-?[0-9.]+(?:E-?\d+)?)", line)]
            if name and z:
                found.append((max(z), name[1]))
        found.sort(reverse=True)
        top = found[0][0] if found else 0.0
        anomalous = top >= threshold
        total = sum(z for z, _ in found[: len(REASONS)]) or 1.0
        out = {
            "period_position": 0,
            "is_anomaly": anomalous,
            "anomaly_type": "ANI_RISK_ARTISI" if anomalous else "NORMAL",
            "risk_level": "YUKSEK" if top >= 2 * threshold else "ORTA" if anomalous else "DUSUK",
            "anomaly_score": min(1.0, top / 10),
            "reason_summary": f"{len(found)} degisken, en yuksek sapma {top:.3f}",
            "reason_1": "",
            "reason_1_weight": 0.0,
        }
        for i, (z, name) in enumerate(found[: len(REASONS)], 1):
            out |= {f"reason_{i}": f"{name} sapma", f"reason_{i}_weight": round(z / total, 4)}
        return out

    return ask


def companion_scores(decisions: DataFrame, scores: DataFrame) -> DataFrame:
    """Decisions with the model scores of the same entity and month, or else of the entity's first row; ``ml_is_anomaly`` unless the band is NORMAL."""
    names = [c for c in ("ensemble_score", "if_score", "residual_score", "autoencoder_score", "alert_band", "alert_type", "review_queue") if c in scores.columns]
    ml = F.struct(*(F.col(c) for c in names))
    s = scores.select(F.col("mono_id").cast("string").alias("mono_id"), F.col("cohort_dt").cast("string").alias("cohort_dt"), ml.alias("__exact"))
    exact = s.groupBy("mono_id", "cohort_dt").agg(F.first("__exact").alias("__exact"))
    by_id = s.groupBy("mono_id").agg(F.min_by("__exact", "cohort_dt").alias("__by_id"))
    out = decisions.join(exact, ["mono_id", "cohort_dt"], "left").join(by_id, "mono_id", "left").withColumn("__ml", F.coalesce("__exact", "__by_id"))
    named = [F.col(f"__ml.{c}").alias(f"ml_{c}") for c in names]
    return out.select(*decisions.columns, *named, (F.upper(F.coalesce(F.col("__ml.alert_band"), F.lit(""))) != "NORMAL").alias("ml_is_anomaly"))


def match_words(x: Column) -> Column:
    """Distinct words of three characters or more."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(x, F.lit(""))), "[^0-9a-z]+"), lambda w: F.length(w) >= 3))


def numeric_evidence(have: list[str]) -> Column:
    """A feature's numbers as ``key=value`` parts; missing ones are left out."""
    scale = F.col("robust_scale") if "robust_scale" in have else F.lit(None).cast("double")
    z = rounded(F.when(scale > 0, (F.col("value") - F.col("median")) / scale), 6) if {"value", "median", "robust_scale"} <= set(have) else F.col("history_z") if "history_z" in have else None
    numbers = {"current": "value", "previous": "previous_value", "change_pct": "change_pct", "history_median": "median", "history_z": None, "peer_median": "peer_median", "peer_z": "peer_z", "slope_6m": "slope_6m", "slope_12m": "slope_12m", "yoy_change_pct": "yoy_change_pct", "same_month_z": "same_month_customer_z"}
    name = F.coalesce(F.nullif(F.col("label"), F.lit("")), F.col("feature")) if "label" in have else F.col("feature")
    parts = [F.concat(F.lit("feature="), F.coalesce(name, F.lit("degisken")))]
    for key, column in numbers.items():
        x = z if column is None else F.col(column) if column in have else None
        if x is not None:
            parts.append(F.concat(F.lit(f"{key}="), six_digits(finite(x)), F.lit("%" if key.endswith("_pct") else "")))
    if "risk_direction" in have:
        parts.append(F.concat(F.lit("risk_direction="), F.nullif(F.col("risk_direction"), F.lit(""))))
    return F.concat_ws("; ", *parts)


def _has_numbers(text: Column) -> Column:
    said = F.lower(text)
    keys = F.array_distinct(F.regexp_extract_all(said, F.lit(EVIDENCE_KEYS), 1))
    return F.contains(said, F.lit(f"{EVIDENCE_PREFIX.lower()}:")) | F.contains(said, F.lit(f"{SUMMARY_PREFIX.lower()}:")) | (F.size(keys) >= 3)


def _with_numbers(text: Column, numbers: Column, prefix: str) -> Column:
    """The text with the numbers behind it, unless it names enough itself or there are none."""
    longer = F.substring(F.concat(F.regexp_replace(text, "[. ]+$", ""), F.lit(f". {prefix}: "), numbers, F.lit(".")), 1, EVIDENCE_CAP)
    return F.when((text == "") | text.isNull() | numbers.isNull() | _has_numbers(text), text).otherwise(longer)


def matched_features(rows: DataFrame, reasons: list[str], features: str) -> DataFrame:
    """``rows`` with ``__at_1, ...``: for each reason column the place, from 0, in the array ``features`` of what it speaks of.

    ``features`` has structs with ``said``, an array of ``words`` of each of its names. A name whose words, sorted, stand in
    the reason's counts 8, a common word 1, a feature that an earlier reason has had 2 less; of equal ones the first wins.
    Without any likeness it is the one at the reason's own place, else the first. Reasons are taken in turn: the places
    found so far are what the fold carries from one to the next. An empty reason has none.
    """
    for i, reason in enumerate(reasons):
        earlier = [F.col(f"__at_{k + 1}") for k in range(i)]

        def score(f: Column, at: Column, reason: Column, earlier: list[Column] = earlier) -> Column:
            likeness = F.aggregate(
                f["said"], F.lit(0),
                lambda sum_, said: sum_ + F.when((F.size(said) > 0) & F.contains(reason["text"], F.array_join(said, " ")), CONTAINED).otherwise(0) + F.size(F.array_intersect(said, reason["words"])),
            )
            had = [F.coalesce(e == at, F.lit(False)) for e in earlier]
            return likeness - F.when(F.array_contains(F.array(F.lit(False), *had), True), USED).otherwise(0)

        # a reason's words and its best feature are elements of arrays of one, so that each is worked out once a row, not wherever it is named
        spoken = F.transform(F.array(match_words(F.col(reason))), lambda w: F.struct(w.alias("words"), F.array_join(F.array_sort(w), " ").alias("text")))
        best = F.transform(spoken, lambda s: F.array_max(F.transform(features, lambda f, at: F.struct(score(f, at, s).alias("score"), (-at).alias("at")))))  # noqa: B023
        found = F.get(F.transform(best, lambda b: F.when(b["score"] > 0, -b["at"]).when(F.size(features) > i, i).otherwise(0)), F.lit(0))  # noqa: B023
        rows = rows.withColumn(f"__at_{i + 1}", F.when((F.coalesce(F.col(reason), F.lit("")) != "") & (F.coalesce(F.size(features), F.lit(0)) > 0), found))
    return rows


def enrich_reasons(decisions: DataFrame, evidence: DataFrame) -> DataFrame:
    """Decisions whose reasons and summary name too few numbers get those of the feature they speak of behind them.

    ``evidence``: ``mono_id, feature, evidence_rank``, numbers, what the dictionary says of the feature and, where it has
    more than one month, ``cohort_dt``. An entity's features are few; they meet its decision in one row.
    """
    keys = ["mono_id", "cohort_dt"] if "cohort_dt" in evidence.columns else ["mono_id"]
    listed = evidence.withColumn("cohort_dt", F.col("cohort_dt").cast("string")) if "cohort_dt" in keys else evidence
    names = [F.array_sort(match_words(F.col(c))) for c in ("feature", "label", "category", "formula") if c in evidence.columns]
    one = F.struct("evidence_rank", "feature", F.array(*names).alias("said"), numeric_evidence(evidence.columns).alias("numbers"))
    listed = listed.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("__features"))
    texts = [f"reason_{i}" for i in REASONS]
    rows = matched_features(decisions.join(listed, keys, "left"), texts, "__features")
    numbers = {i: F.get("__features", F.col(f"__at_{i}"))["numbers"] for i in REASONS}
    rows = rows.withColumns({f"__numbers_{i}": n for i, n in numbers.items()})
    summary = F.coalesce(F.col("__numbers_1"), F.get("__features", F.lit(0))["numbers"])
    changed = {f"reason_{i}": _with_numbers(F.col(f"reason_{i}"), F.col(f"__numbers_{i}"), EVIDENCE_PREFIX) for i in REASONS}
    rows = rows.withColumns({**changed, "reason_summary": _with_numbers(F.col("reason_summary"), summary, SUMMARY_PREFIX)})
    rows = rows.withColumn("main_reasons", F.when(F.col("main_reasons").isNotNull(), reason_records({i: F.col(f"__numbers_{i}") for i in REASONS})))
    return rows.select(*decisions.columns)


def selected_flag(column: Column) -> Column:
    return F.coalesce(truth(column), F.lit(False))
