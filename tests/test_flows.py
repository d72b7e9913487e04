"""Whole runs on a small panel, decisions, sinks, configuration, streams, and the registered queries."""

from __future__ import annotations

import datetime as dt
import json
import random
import re
import shutil
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortloom.__main__ import arguments, main
from cohortloom.operators import assessments, decisions
from cohortloom.plans import anomaly, evidence_flow
from cohortloom.plans.oracles import ORACLES
from cohortloom.plans.queries import QUERIES
from cohortloom.sources import config, readers, sinks
from cohortloom.streaming import panel_streams

ROOT = Path(__file__).resolve().parents[1]
FORMULAS = {"bank_risk_to_assets": "bank_total_risk / toplam_varlik_ttr", "memzuc_limit_utilization": "memzuc_total_risk / memzuc_total_limit", "l1y_debt_to_sales": "bank_total_risk / fs_net_sales_cumulative_l1y"}


def fresh(spark, *tables):
    """Nothing of these tables, nor of an earlier session's files."""
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        shutil.rmtree(Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"), t), ignore_errors=True)


def panel_rows():
    rows = []
    for m, day in enumerate(("31.01.2025", "28.02.2025", "31.03.2025")):
        for i in range(12):
            k = 8 if i == 0 and m == 2 else 1
            rows.append((day, f"C_{i:03d}", 4001, 1000, "sektor", float(100 * k + i), float(900 * k + 3 * i), 3000.0 + 7 * i, 10000.0 - 11 * i, 5000.0 + i, 3, "31.12.2024"))
    return rows


@pytest.fixture(scope="module")
def panel(spark):
    names = "COHORT_DT string, MONO_ID string, MUSTERI_SEGMENT int, CST_NACE_CODE_ID int, CST_SECTOR string, BANK_TOTAL_RISK double, MEMZUC_TOTAL_RISK double, MEMZUC_TOTAL_LIMIT double, TOPLAM_VARLIK_TTR double, FS_NET_SALES_CUMULATIVE_L1Y double, RATING_GROUP int, FINANCIAL_TERM_L1Y string"
    return spark.createDataFrame(panel_rows(), names)


@pytest.fixture(scope="module")
def run(panel):
    return anomaly.run_anomaly(panel, FORMULAS, trees=40)


def test_run_scores_the_latest_month(run):
    assert run.month == dt.date(2025, 3, 31) and set(run.features) == set(FORMULAS)
    got = anomaly.ranked(run.results, 20).collect()
    assert len(got) == 12 and [r.rank_in_run for r in got] == list(range(1, 13)) and {"bank_risk_to_assets", "memzuc_limit_utilization"} <= {x.feature for r in got if r.mono_id == "C_000" for x in r.reasons}
    assert all(a.ensemble_score >= b.ensemble_score for a, b in zip(got, got[1:], strict=False))
    assert got[0].reason_1.count("peer") and json.loads(got[0].reason_details)[0]["feature"] in FORMULAS
    assert all(0 <= r.ensemble_score <= 100 and 0 <= r.confidence <= 100 and r.coverage_ratio == 1 for r in got)
    s = anomaly.summarize(run)
    assert s["rows"] == 12 and sum(s["alert_type_counts"].values()) == 12 and s["peer_diagnostics"]["result"] == "FAIL"


def test_run_for_some_ids(spark, panel, run):
    ids = spark.createDataFrame([("C_000",), ("C_001",), ("C_999",)], "mono_id string")
    some = anomaly.run_anomaly(panel, FORMULAS, ids=ids, trees=40).results
    whole = {r.mono_id: r.ensemble_score for r in run.results.collect()}
    assert {r.mono_id: r.ensemble_score for r in some.collect()} == {k: whole[k] for k in ("C_000", "C_001")}
    with pytest.raises(ValueError):
        anomaly.run_anomaly(panel, FORMULAS, ids=ids.where("mono_id = 'C_999'"), trees=5)
    with pytest.raises(ValueError):
        anomaly.run_anomaly(panel, FORMULAS, month="31.01.2025", trees=5)


@pytest.fixture(scope="module")
def evidence(spark, panel):
    ids = spark.createDataFrame([("C_000",), ("C_001",)], "mono_id string")
    return evidence_flow.build_evidence(panel, FORMULAS, ids).persist()


def test_evidence(evidence):
    rows = {(r.mono_id, r.feature): r for r in evidence.collect()}
    assert len(rows) == 6
    r = rows["C_000", "bank_risk_to_assets"]
    assert r.value == pytest.approx(0.08) and r.period_count == 2 and r.previous_value == pytest.approx(0.01) and r.change_pct == pytest.approx(700)
    assert [x.cohort_dt for x in r.series] == ["2025-01-31", "2025-02-28", "2025-03-31"] and r.series[2].is_current_snapshot
    assert r.peer_support == 0 and r.peer_level == "GLOBAL_FEATURE" and not r.missing_flag


def test_prompts_hold_no_scores(evidence):
    marked = evidence.withColumns({"ml_x": F.lit(98765.5), "ensemble_score": F.lit(87654.5)})
    prompts = decisions.prompt_text(marked, "Karar").collect()
    assert len(prompts) == 2 and all(p.prompt.count("\n- ") == 3 for p in prompts)
    assert not any("98765" in p.prompt or "87654" in p.prompt for p in prompts)
    assert decisions.without_scores({"a": [{"ml_y": 1, "b": 2, "selection_bucket": 1}], "alert_band": 3, "is_anomaly": 1, "selection_score_column": "x"}) == {"a": [{"b": 2}]}


def test_decisions_with_rules_and_replays(spark, evidence, run):
    got = {r.mono_id: r for r in evidence_flow.run_decisions(evidence, decisions.rule_decider, scores=run.results).collect()}
    assert got["C_000"].is_anomaly and got["C_000"].error is None and got["C_000"].ml_ensemble_score > 90
    assert got["C_000"].main_reasons[0].evidence.count("=") >= 3
    whole = {
        "period_position": 0, "is_anomaly": "evet", "anomaly_type": "PD_RISKI", "anomaly_score": 7, "reason_summary": " Borc artmis ", "reason_1": "bank risk to assets yuksek", "reason_1_weight": 0.6,
        "reason_2": "diger", "reason_2_weight": "x", "risk_level": "YUKSEK", "trend_assesment": "artiyor",
    }
    answers = {"C_000": {"content": f"```json\n{json.dumps(whole)}\n```"}, "C_001": "no answer"}

    def decider():
        def ask(prompt):
            return next(v for k, v in answers.items() if k in prompt)

        return ask

    got = {r.mono_id: r for r in decisions.decide(decisions.prompt_text(evidence), decider).collect()}
    a, b = got["C_000"], got["C_001"]
    assert (a.is_anomaly, a.anomaly_type, a.risk_level, a.anomaly_score, a.llm_confidence, a.reason_summary) == (True, "PD_RISKI", "YUKSEK", 1, 1, "Borc artmis")
    assert (a.reason_1_weight, a.reason_2_weight, a.reason_3, a.recommended_action, a.trend_assessment, a.caveat) == (0.6, 0, None, "Manuel incele", "artiyor", None)
    assert [tuple(r) for r in a.main_reasons] == [("REASON_1", "weight=0.6000", "bank risk to assets yuksek"), ("REASON_2", "weight=0.0000", "diger")]
    assert b.error and b.is_anomaly is None and b.main_reasons is None and b.raw_response == "no answer"
    rich = {r.mono_id: r for r in decisions.enrich_reasons(decisions.decide(decisions.prompt_text(evidence), decider), evidence).collect()}
    first = rich["C_000"].reason_1
    assert first.startswith("bank risk to assets yuksek. Sayisal kanit: feature=bank_risk_to_assets; current=0.08; previous=0.01; change_pct=700%; ") and first.endswith("risk_direction=HIGHER_IS_RISKY.")
    assert "Sayisal ozet: feature=bank_risk_to_assets" in rich["C_000"].reason_summary and rich["C_000"].main_reasons[0].evidence.startswith("weight=0.6000; feature=bank_risk_to_assets; current=0.08")
    assert rich["C_001"].main_reasons is None

    def failing():
        def ask(prompt):
            raise ConnectionError("down")

        return ask

    assert {r.error for r in decisions.decide(decisions.prompt_text(evidence), failing).collect()} == {"ConnectionError: down"}
    with pytest.raises(ValueError):
        decisions.decoded('{"results": []}')


def brute_matches(reasons, names):
    """The features that reasons speak of, one after another."""
    words = lambda t: {w for w in re.split("[^0-9a-z]+", t.lower()) if len(w) >= 3}
    used, out = set(), []
    for i, reason in enumerate(reasons):
        if not reason or not names:
            out.append(None)
            continue
        scored = []
        for k, said in enumerate(names):
            score = sum(8 * bool(words(n) and " ".join(sorted(words(n))) in " ".join(sorted(words(reason)))) + len(words(n) & words(reason)) for n in said)
            scored.append((score - 2 * (k in used), -k))
        best = max(scored)
        out.append(-best[1] if best[0] > 0 else i if i < len(names) else 0)
        used.add(out[-1])
    return out


def test_matching_of_reasons(spark):
    rnd = random.Random(7)
    pool = "debt sales equity net total ratio bank risk assets order share x1 ab".split()
    phrase = lambda n: "_".join(rnd.choice(pool) for _ in range(n))
    cases = [([" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 4))) for _ in range(3)], [[phrase(rnd.randint(1, 3)) for _ in range(2)] for _ in range(rnd.randint(0, 4))]) for _ in range(200)]
    cases += [(["debt to sales is high", "other", "debt"], [["net sales"], ["debt_to_sales"], ["equity"]]), (["xyz", "q", "r"], [["a1b"]])]
    rows = spark.createDataFrame([(i, *reasons, names) for i, (reasons, names) in enumerate(cases)], "i int, reason_1 string, reason_2 string, reason_3 string, names array<array<string>>")
    rows = rows.withColumn("features", F.transform("names", lambda said: F.struct(F.transform(said, lambda n: F.array_sort(decisions.match_words(n))).alias("said"))))
    got = {r["i"]: [r[f"__at_{k}"] for k in decisions.REASONS] for r in decisions.matched_features(rows, ["reason_1", "reason_2", "reason_3"], "features").collect()}
    assert got == {i: brute_matches(*case) for i, case in enumerate(cases)}


def test_answers_that_break_the_contract(spark):
    good = {"period_position": 0, "is_anomaly": False, "anomaly_type": "", "anomaly_score": "0.25", "reason_summary": "", "reason_1": "", "reason_1_weight": 1, "risk_level": " "}
    answers = [good, good | {"period_position": 1}, good | {"period_position": "0"}, {k: v for k, v in good.items() if k not in ("reason_1", "risk_level")}, good | {"reason_1": None}, good | {"llm_confidence": 0.9, "recommended_action": "Ara"}]
    rows = [(str(i), "2025-01-31", None, json.dumps(a), None) for i, a in enumerate(answers)] + [("6", "2025-01-31", None, "not json", None), ("7", "2025-01-31", None, None, "ConnectionError: down"), ("8", "2025-01-31", None, None, None)]
    got = {r.mono_id: r for r in decisions.validated(spark.createDataFrame(rows, "mono_id string, cohort_dt string, raw_response string, answer string, error string")).collect()}
    assert {k: r.error for k, r in got.items()} == {
        "0": None, "1": "period_position must be 0: 1", "2": None, "3": "missing required fields: reason_1,risk_level", "4": "missing required fields: reason_1", "5": None, "6": "no answer could be decoded", "7": "ConnectionError: down", "8": "no answer could be decoded",
    }
    a = got["0"]
    assert (a.is_anomaly, a.anomaly_type, a.risk_level, a.anomaly_score, a.recommended_action) == (False, "NORMAL", "DUSUK", 0.25, "Izle")
    assert [tuple(r) for r in a.main_reasons] == [(decisions.GENERAL_REASON, "", decisions.NO_SUMMARY)]
    assert got["5"].llm_confidence == 0.9 and got["5"].recommended_action == "Ara" and got["1"].anomaly_type is None and got["1"].main_reasons is None


def test_replace_append_and_evolution(spark, run):
    fresh(spark, "flow_results")
    assert sinks.ensure_table(spark, "flow_results", sinks.TableSpec({"mono_id": "string", "cohort_dt": "date"}, {}, ())) == []
    sinks.write_table(run.results, "flow_results", sinks.RESULTS)
    sinks.write_table(run.results, "flow_results", sinks.RESULTS)
    other = run.results.limit(3).withColumn("cohort_dt", F.lit(dt.date(2025, 2, 28)))
    sinks.write_table(other, "flow_results", sinks.RESULTS)
    count = lambda: sinks.audit(spark, ["flow_results"], "2025-03-31").first()
    assert (count().total_rows, count().month_rows, count().run_rows) == (15, 12, None)
    sinks.write_table(run.results, "flow_results", sinks.RESULTS, "insert")
    assert count().month_rows == 24
    assert "review_queue" in readers.table_columns(spark, "flow_results") and readers.table_columns(spark, "nowhere") == []
    with pytest.raises(ValueError):
        sinks.write_mode("upsert")
    details = sinks.exploded_reasons(run.results)
    assert details.agg(F.min("feature_rank"), F.max("feature_rank")).first() == (1, 3) and details.columns.count("peer_pct") == 1
    assert sinks.exploded_reasons(run.results.withColumn("reason_details", F.lit("not a list"))).count() == 0
    spark.sql("DROP TABLE flow_results")


def test_decision_tables(spark, panel, evidence):
    fresh(spark, "t_d", "t_r", "t_f")
    made = evidence_flow.run_decisions(evidence, decisions.rule_decider)
    names = {"features": "t_f", "reasons": "t_r", "decisions": "t_d"}
    quality = evidence_flow.entity_quality(anomaly.intake(panel), ["bank_total_risk"])
    counts = evidence_flow.write_decisions(made, evidence, "r1", names, model="rules", source="panel", quality=quality)
    assert counts["t_d"] == 2 and counts["t_f"] == 6 and counts["t_r"] >= 2
    assert len(spark.table("t_f").columns) == 41 and len(spark.table("t_d").columns) == 29 and len(spark.table("t_r").columns) == 7
    row = spark.table("t_f").where("mono_id = 'C_000' AND feature_name = 'bank_risk_to_assets'").first()
    assert row.run_id == "r1" and json.loads(row.snapshot_series_json)[-1]["is_current_snapshot"] and row.trend_break_flag in (0, 1) and json.loads(row.feature_json)["feature"] == "bank_risk_to_assets"
    assert (row.feature_category, row.formula, json.loads(row.source_columns), row.risk_direction, row.month_of_year) == ("bank_risk", FORMULAS["bank_risk_to_assets"], ["bank_total_risk", "toplam_varlik_ttr"], "HIGHER_IS_RISKY", 3)
    row = spark.table("t_d").where("mono_id = 'C_000'").first()
    assert (row.llm_model, row.evidence_source, row.recommended_action) == ("rules", "panel", "Manuel incele") and row.peer_assessment.startswith("Peer: feature=") and row.caveat.startswith("Caveat: coverage_ratio=1; ")
    assert "prompt" not in json.loads(row.raw_response) and json.loads(row.raw_response)["reason_1"] == row.reason_1
    for t in names.values():
        spark.sql(f"DROP TABLE {t}")


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿ MONO_ID,Amount,Skip\n1,"1.234,5",x\n'.encode())
    df = readers.read_input(spark, f"{tmp_path}/a.csv", ["mono_id", "AMOUNT"])
    assert df.columns == ["mono_id", "amount"] and df.first().amount == "1.234,5"
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert readers.read_jsonl(spark, f"{tmp_path}/b.jsonl", "a int").count() == 2
    sinks.write_jsonl(spark.createDataFrame([("é", None)], "a string, b int"), f"{tmp_path}/c")
    assert spark.read.text(f"{tmp_path}/c").first()[0] == '{"a":"é","b":null}'
    with pytest.raises(ValueError):
        readers.jdbc_options({"url": "jdbc:x"})
    assert readers.read_query(spark, "SELECT :x AS A", x=3).first().a == 3


def test_configuration(tmp_path, monkeypatch):
    assert config.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}) == {"a": {"b": 3, "c": 2}, "d": 4}
    with pytest.raises(ValueError):
        config.config_path(str(tmp_path / "none.yaml"))
    bad, good = tmp_path / "bad.yaml", tmp_path / "good.yaml"
    bad.write_text("model: {}\n")
    good.write_text("pipeline:\n  top_reasons: 2\n")
    monkeypatch.setenv(config.CONFIG_VARIABLE, str(bad))
    assert config.config_path(folders=[tmp_path]) is None
    monkeypatch.setenv(config.CONFIG_VARIABLE, str(good))
    assert config.config_path(folders=[tmp_path]) == good and config.load_config()["pipeline"] == {"write_mode": "replace", "top_reasons": 2}
    assert [config.optional_limit(x) for x in ("all", "-", "None", "0", "", "7")] == [None] * 5 + [7]
    (tmp_path / "list.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        config.load_mapping(tmp_path / "list.yaml")


DICTIONARY = """
raw_variables:
  default_source: {backend: parquet}
  groups:
    risk:
      category: bank_risk
      source: {table_key: input}
      variables:
        Bank_Total_Risk: {label: Bank risk, risk_direction: HIGHER_IS_RISKY}
generated_variables:
  variables:
    x_to_y: {label: X to Y, formula: x / y, inputs: [X, y], risk_direction: higher_is_risky}
    hidden: {formula: x_to_y * 2, inputs: [x]}
final_llm_features:
  include: [x_to_y, rating_group]
  exclude: [hidden]
"""


def test_dictionary(tmp_path):
    path = tmp_path / "d.yaml"
    path.write_text(DICTIONARY)
    found = config.load_dictionary(str(path))
    assert found.formulas() == {"x_to_y": "x / y"} and found.inputs() == ["x", "y"] and found.direct == ("rating_group",)
    assert found.about("bank_total_risk")["source"] == {"backend": "parquet", "table_key": "input"} and found.category("bank_total_risk") == "bank_risk"
    assert found.directions() == {"bank_total_risk": "HIGHER_IS_RISKY", "x_to_y": "HIGHER_IS_RISKY"} and found.labels()["x_to_y"] == "X to Y"
    assert config.load_dictionary(str(tmp_path / "none.yaml")).formulas() == {}


def test_command_line(spark, panel, tmp_path, capsys):
    source = tmp_path / "panel.csv"
    panel.toPandas().to_csv(source, index=False)
    dictionary = tmp_path / "d.yaml"
    dictionary.write_text("generated_variables:\n  variables:\n" + "".join(f"    {k}: {{formula: {v}}}\n" for k, v in FORMULAS.items()))
    assert main(["run-anomaly", str(source), "--dictionary", str(dictionary)], spark) == 0
    assert json.loads(capsys.readouterr().out)["rows"] == 12
    assert main(["build-evidence", str(source), "--dictionary", str(dictionary), "--entities", "all", "--dry-run", "--out", str(tmp_path / "prompts")], spark) == 0
    assert spark.read.json(str(tmp_path / "prompts")).count() == 12
    with pytest.raises(SystemExit):
        arguments(["nothing"])


def test_run_files(spark, panel, run, tmp_path):
    out = anomaly.write_run(run, panel, str(tmp_path), top=5)
    assert Path(out).name.startswith("20250331_")
    scores = spark.read.csv(f"{out}/scores", header=True)
    assert scores.count() == 12 and "reasons" in scores.columns
    assert [r.rank_in_run for r in spark.read.csv(f"{out}/top", header=True).collect()] == list("12345")
    profile, summary = (json.loads(spark.read.text(f"{out}/{name}").first()[0]) for name in ("profile", "summary"))
    assert profile["month_counts"] == {"2025-01-31": 12, "2025-02-28": 12, "2025-03-31": 12} and (profile["total_rows"], profile["train_rows"]) == (36, 24)
    assert profile["selected_features"] == run.features and summary["rows"] == 12 and profile["operational_band_thresholds"] == summary["thresholds"]


def test_load_counts_before_it_deletes(spark, panel, tmp_path):
    fresh(spark, "loaded")
    source = tmp_path / "panel.csv"
    panel.toPandas().to_csv(source, index=False)
    df = anomaly.intake(readers.read_input(spark, str(source)))
    assert sinks.load_table(df, "loaded", source=source) == {"table": "loaded", "inserted_rows": 36, "table_rows": 36, "deleted_source": False}
    none = sinks.load_table(df.where("false"), "loaded", replace=False, source=source, delete_source=True)
    assert none == {"table": "loaded", "inserted_rows": 0, "table_rows": 36, "deleted_source": False} and source.exists()
    assert main(["load-panel", str(source), "--out", "loaded", "--mode", "append", "--delete-source"], spark) == 0
    assert not source.exists() and spark.table("loaded").count() == 72
    assert not sinks.load_table(spark.table("loaded").limit(3), "loaded_too", source=tmp_path, delete_source=True)["deleted_source"]
    fresh(spark, "loaded", "loaded_too")


def test_rows_without_a_day_are_loaded_and_keep_no_file_from_being_counted(spark, panel, tmp_path):
    """Undated rows go into the table; a file goes only if the table has gained all its rows."""
    fresh(spark, "loaded")
    source = tmp_path / "panel.csv"
    rows = panel.limit(4).toPandas()
    rows.loc[1:2, "COHORT_DT" if "COHORT_DT" in rows else "cohort_dt"] = ["no day", None]
    rows.to_csv(source, index=False)
    raw = readers.read_input(spark, str(source))
    dated = sinks.load_table(anomaly.intake(raw), "loaded", source=source, delete_source=True, source_rows=raw.count())
    assert (dated["inserted_rows"], dated["deleted_source"]) == (2, False) and source.exists()
    assert not sinks.load_table(anomaly.intake(raw, undated=True), "loaded", source=source, delete_source=True)["deleted_source"]  # nobody has counted it
    assert main(["load-panel", str(source), "--out", "loaded", "--delete-source"], spark) == 0
    assert not source.exists() and spark.table("loaded").count() == 4 and spark.table("loaded").where("cohort_dt IS NULL").count() == 2
    fresh(spark, "loaded")


def test_answer_log_and_selection(spark, evidence, run, tmp_path):
    answers = decisions.decide(decisions.prompt_text(evidence), lambda: lambda prompt: "no JSON" if "C_001" in prompt else {"period_position": 0, "is_anomaly": False, "anomaly_type": "NORMAL", "anomaly_score": 0, "reason_summary": "-", "reason_1": "-", "reason_1_weight": 1, "risk_level": "DUSUK"})
    for run_id in ("r1", "r2"):
        sinks.append_answers(answers, run_id, str(tmp_path / "answers"))
    log = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "answers")).collect()]
    assert len(log) == 2 * evidence.select("mono_id").distinct().count() and {r["run_id"] for r in log} == {"r1", "r2"}
    failed = [r for r in log if r["parsing_error"]]
    assert {r["mono_id"] for r in failed} == {"C_001"} and {r["raw_response"] for r in failed} == {"no JSON"}
    sinks.write_csv(run.results.limit(2).withColumn("_internal", F.lit(1)), str(tmp_path / "selection"))
    kept = spark.read.csv(str(tmp_path / "selection"), header=True)
    assert kept.count() == 2 and "_internal" not in kept.columns


def test_ranks_over_ranges(spark):
    rows = [(f"c{i:03d}", None if i % 50 == 0 else float(i % 7)) for i in range(300)] + [("c001", 1.0), ("c001", 1.0)]
    got = anomaly.with_rank(spark.createDataFrame(rows, "mono_id string, ensemble_score double").repartition(5)).orderBy("rank_in_run").collect()
    assert [r.rank_in_run for r in got] == list(range(1, len(rows) + 1))
    assert [(r.mono_id, r.ensemble_score) for r in got] == sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert anomaly.with_rank(spark.createDataFrame([], "mono_id string, ensemble_score double")).count() == 0


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(f"u{i % 3}", dt.datetime(2024, 1, 1 + i % 5, 12), float(i), "click") for i in range(30)]
    spark.createDataFrame(rows, "mono_id string, ts timestamp, value double, event_type string").repartition(2).write.parquet(source)
    stream = spark.readStream.schema("mono_id string, ts timestamp, value double, event_type string").parquet(source)
    q = panel_streams.daily_counts(stream).writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.n for r in spark.table("daily").collect()} == {6} and spark.table("daily").count() == 5
    latest = panel_streams.latest_rows(stream.select("mono_id", F.to_date("ts").alias("cohort_dt"), "value"))
    q = latest.writeStream.outputMode("update").format("memory").queryName("latest").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.mono_id: r.cohort_dt for r in spark.table("latest").groupBy("mono_id").agg(F.max("cohort_dt").alias("cohort_dt")).collect()}
    assert got == {f"u{i}": dt.date(2024, 1, 5) for i in range(3)}
    fresh(spark, "streamed")
    spec = sinks.TableSpec({"mono_id": "string", "cohort_dt": "date", "value": "double"}, {}, ())
    for _ in range(2):
        panel_streams.replace_months(stream.select("mono_id", F.to_date("ts").alias("cohort_dt"), "value"), "streamed", spec, str(tmp_path / f"c{_}")).awaitTermination(120)
    assert spark.table("streamed").count() == 30
    spark.sql("DROP TABLE streamed")


def test_numbers_of_prompts_have_six_decimals(spark):
    given = [1234567.5, 0.1234567, -0.0000001, 0.0, 100.0, -2.5, None, 1e-7, 12345678901234.0]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x double").select("i", assessments.six_decimals(F.col("x")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == ["1234567.5", "0.123457", "0", "0", "100", "-2.5", None, "0", "12345678901234"]
    rows = spark.createDataFrame([("a", "2025-01-31", 1, "f", 1 / 3, None, 7, True, 99.0)], "mono_id string, cohort_dt string, evidence_rank int, feature string, value double, peer_z double, peer_support bigint, trend_break_flag boolean, ensemble_score double")
    assert decisions.prompt_text(rows, "T").first().prompt == "T\nmusteri=a donem=2025-01-31\n- f | value=0.333333 | trend_break_flag=true | peer_support=7"


def test_column_dictionary_tells_what_a_panel_has(spark, panel):
    known = config.Dictionary(raw={"bank_total_risk": {"label": "Bank risk", "category": "loans", "source": {"table_key": "input"}, "source_column": "TOTAL"}}, direct=("toplam_varlik_ttr",), exclude=("rating_group",))
    rows = {r.column: r for r in evidence_flow.column_dictionary(panel, known, used=["BANK_TOTAL_RISK"]).collect()}
    assert list(rows) == panel.columns and [rows[c].position for c in panel.columns] == list(range(len(panel.columns)))
    assert (rows["BANK_TOTAL_RISK"].label, rows["BANK_TOTAL_RISK"].category, json.loads(rows["BANK_TOTAL_RISK"].source), rows["BANK_TOTAL_RISK"].source_column) == ("Bank risk", "loans", {"table_key": "input"}, "TOTAL")
    assert {c: r.role for c, r in rows.items()} == {
        "COHORT_DT": "time", "MONO_ID": "id", "MUSTERI_SEGMENT": "context_or_peer", "CST_NACE_CODE_ID": "context_or_peer", "CST_SECTOR": "context_or_peer", "BANK_TOTAL_RISK": "numeric_source_candidate",
        "MEMZUC_TOTAL_RISK": "numeric_source_candidate", "MEMZUC_TOTAL_LIMIT": "numeric_source_candidate", "TOPLAM_VARLIK_TTR": "direct_rating_signal_allowed", "FS_NET_SALES_CUMULATIVE_L1Y": "numeric_source_candidate",
        "RATING_GROUP": "pd_value_excluded_from_llm_features", "FINANCIAL_TERM_L1Y": "context_or_peer",
    }
    assert [c for c, r in rows.items() if r.label is None] == [c for c in panel.columns if c != "BANK_TOTAL_RISK"] and [c for c, r in rows.items() if r.used] == ["BANK_TOTAL_RISK"]
    plain = {r.column: (r.category, r.role, r.used) for r in evidence_flow.column_dictionary(panel).collect()}
    assert plain["RATING_GROUP"] == ("pd_rating", "direct_rating_signal_allowed", True) and plain["MEMZUC_TOTAL_RISK"][0] == "memzuc" and plain["FS_NET_SALES_CUMULATIVE_L1Y"][0] == "financial"


def test_features_without_an_entry_are_told_by_their_names(spark):
    features = ["rating_group", "equity_risk", "x", "max_share", "known"]
    about = config.Dictionary(generated={"known": {"label": "Known one", "inputs": ["A", "b"], "formula": "a / c", "risk_direction": "lower_is_risky", "category": "own"}})
    made = evidence_flow.with_dictionary(spark.createDataFrame([(f,) for f in [*features, "other"]], "feature string"), features, {"max_share": "MAX(bank_x, y) / bank_x", "x": "1"}, about, ["Bank_X", "z"])
    got = {r.feature: (r.label, r.category, r.formula, r.source_columns, r.risk_direction) for r in made.collect()}
    assert got["known"] == ("Known one", "own", "a / c", '["A", "b"]', "LOWER_IS_RISKY")
    assert got["max_share"] == ("max_share", "other", "MAX(bank_x, y) / bank_x", '["bank_x"]', "UNKNOWN")  # neither the function nor what no table has
    assert got["rating_group"][1:] == ("pd_rating", None, "[]", "HIGHER_IS_RISKY") and got["x"][1:4] == ("other", "1", "[]")
    assert got["equity_risk"][4] == "LOWER_IS_RISKY"  # in evidence what falls with risk comes first
    assert got["other"] == (None, None, None, None, None)


def test_all_oracles_belong_to_queries():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", ["peer_hierarchy_z", "peer_diagnostics", "trend_slope_break", "preprocessor_stats", "band_assign", "seasonal_peer_median", "formula_nested", "isolation_forest_nodes", "ensemble_scores", "decision_contract", "reasons_with_numbers", "decision_result_rows", "variable_names", "evidence_packages", "ensemble_flagship", "prompt_dry_run", "entity_assessments"])
def test_queries_agree_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf = Path("/root/testdata/sf0.001")
    if not sf.is_dir():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for f in sf.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    result = QUERIES[name](spark, str(sf))
    got = [tuple(r) for r in result.collect()]
    rel = con.execute(f"SELECT {', '.join(result.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(got, key=repr) == sorted(rel, key=repr)


def test_staged_tables_go_when_the_driver_ends(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from cohortloom.sources.staging import staged
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}").getOrCreate()
assert staged(spark.range(5), "kept").count() == 5
import os
assert [n for n in os.listdir("{tmp_path}") if n.startswith("kept-")]
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
    for _ in range(60):  # Spark ends a little after Python
        if not (left := [p for p in tmp_path.iterdir() if p.name.startswith("kept-")]):
            break
        time.sleep(0.5)
    assert not left


def test_library_stands_without_the_training_data_operators():
    code = "import sys; sys.modules['cohortloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) > 40 and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_assessments(spark, panel, evidence):
    quality = evidence_flow.entity_quality(anomaly.intake(panel), ["bank_total_risk"])
    got = {r.mono_id: r for r in assessments.assessments(evidence, quality).collect()}
    rows = {(r.mono_id, r.feature): r for r in evidence.collect()}
    a = got["C_000"]
    top = max((r for k, r in rows.items() if k[0] == "C_000"), key=lambda r: (abs(r.peer_z), [-ord(c) for c in r.feature]))
    assert a.peer_assessment.startswith(f"Peer: feature={top.feature}; peer_median={top.peer_median:.6g}; peer_z={top.peer_z:.6g}; peer_support=0; peer_quality=ZAYIF; peer_level=GLOBAL_FEATURE")
    assert a.seasonality_assessment == assessments.NO_SEASON and a.caveat == "Caveat: coverage_ratio=1; missing_feature_count=0; customer_history_periods=2; weak_peer_features=3"
    assert a.trend_assessment == assessments.NO_TREND
    digits = spark.createDataFrame([(x,) for x in (0.0, 12.0, 1234567.0, 0.000123456789, -3.14159265, 100.5)], "x double").select(assessments.six_digits(F.col("x"))).collect()
    assert [r[0] for r in digits] == ["0", "12", "1234567", "0.000123457", "-3.14159", "100.5"]


def test_evidence_from_results(run):
    e = assessments.evidence_from_results(run.results)
    assert not [c for c in e.columns if decisions.denied(c)] and e.count() == 36
    assert decisions.prompt_text(e).count() == 12


def test_scores_are_shares_of_all_earlier_rows(panel):
    scores = [r.residual_score for r in anomaly.run_anomaly(panel, FORMULAS, trees=5).results.collect()]
    assert len(scores) == 12 and all(abs(s - round(s * 24 / 100) * 100 / 24) < 0.051 for s in scores)


def test_evidence_keeps_features_beyond_the_prompt(spark, panel):
    ids = spark.createDataFrame([("C_000",)], "mono_id string")
    many = {f"bank_risk_{i}": f"bank_total_risk / (toplam_varlik_ttr + {i})" for i in range(14)}
    e = evidence_flow.build_evidence(panel, many, ids).persist()
    assert sorted(r.evidence_rank for r in e.collect()) == list(range(1, e.count() + 1)) and e.count() >= 14
    assert decisions.prompt_text(e).first().prompt.count("bank_risk_") == 12


def test_series_has_the_peers_of_each_month(evidence):
    series = next(r.series for r in evidence.where("mono_id = 'C_001' AND feature = 'bank_risk_to_assets'").collect())
    assert len(series) == 3 and all(x.peer_available for x in series)
    row = evidence.where("mono_id = 'C_001' AND feature = 'bank_risk_to_assets'").first()
    assert (series[-1].peer_median, series[-1].peer_z, series[-1].peer_level) == (row.peer_median, row.peer_z, row.peer_level)
    for x in series[:2]:
        values = sorted((100.0 + i) / (10000.0 - 11 * i) for i in range(12))
        assert x.peer_median == pytest.approx((values[5] + values[6]) / 2) and x.peer_support == 0
