"""Command line: load-panel, run-anomaly, build-evidence, run (decisions), ensure-tables."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from cohortloom.operators.decisions import prompt_text, rule_decider
from cohortloom.operators.selection import balanced_selection
from cohortloom.plans import anomaly, evidence_flow
from cohortloom.sources import sinks
from cohortloom.sources.config import load_config, load_dictionary, optional_limit
from cohortloom.sources.readers import read_input
from cohortloom.sources.staging import staged

#: Exit codes: what failed.
DECISIONS_FAILED, SINK_FAILED = 2, 3
log = logging.getLogger("cohortloom")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cohortloom")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name in ("load-panel", "run-anomaly", "build-evidence", "run", "ensure-tables"):
        p = verbs.add_parser(name)
        p.add_argument("--config")
        if name == "ensure-tables":
            continue
        p.add_argument("source", help="a file or folder, or table:<name>")
        p.add_argument("--dictionary", default="")
        p.add_argument("--month")
        p.add_argument("--out", help="folder or table for results")
        p.add_argument("--mode", default="replace")
        if name == "load-panel":
            p.add_argument("--delete-source", action="store_true", help="delete the local source file once the table has all its rows")
        if name == "run-anomaly":
            p.add_argument("--files", help="folder for scores, top rows, summary and profile as files")
        if name in ("build-evidence", "run"):
            p.add_argument("--entities", type=optional_limit, default=10, help="size of the balanced selection, or all")
            p.add_argument("--dry-run", action="store_true", help="prompts only")
            p.add_argument("--run-id", default="run")
            p.add_argument("--audit", help="folder for the selection and the log of answers")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    config = load_config(args.config)
    logging.basicConfig(level=config["logging"]["level"], format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = spark or SparkSession.builder.appName("cohortloom").getOrCreate()
    tables = config["tables"]
    names = {k: tables.get(k, f"decision_{k}") for k in ("decisions", "reasons", "features")}
    if args.verb == "ensure-tables":
        for key, spec in (("features", sinks.DECISION_FEATURES), ("reasons", sinks.DECISION_REASONS), ("decisions", sinks.DECISIONS)):
            log.info("%s: added columns %s", names[key], sinks.ensure_table(spark, names[key], spec))
        sinks.audit(spark, list(names.values())).show(truncate=False)
        return 0
    panel = spark.table(args.source.removeprefix("table:")) if args.source.startswith("table:") else read_input(spark, args.source)
    dictionary = load_dictionary(args.dictionary)
    if args.verb == "load-panel":
        replace = sinks.write_mode(args.mode) == "replace"
        print(json.dumps(sinks.load_table(anomaly.intake(panel, undated=True), args.out or "panel", replace, source=args.source, delete_source=args.delete_source, source_rows=panel.count()), ensure_ascii=False))
        return 0
    numeric = [c.strip().lower() for c in panel.columns if c.strip().lower() not in anomaly.TEXT_COLUMNS]
    panel = anomaly.intake(panel, numeric=numeric)
    run = anomaly.run_anomaly(panel, month=args.month, dictionary=dictionary, top_reasons=config["pipeline"]["top_reasons"])
    if args.verb == "run-anomaly":
        print(json.dumps(anomaly.summarize(run), ensure_ascii=False, indent=2, default=str))
        if args.files:
            log.info("files in %s", anomaly.write_run(run, panel, args.files, dictionary))
        if args.out:
            sinks.write_table(sinks.exploded_reasons(run.results), tables["details"], sinks.REASON_DETAILS, args.mode)
            sinks.write_table(anomaly.with_rank(run.results), args.out, sinks.RESULTS, args.mode)
        return 0
    selected = balanced_selection(run.results, args.entities) if args.entities else None
    if selected is not None and args.audit:
        sinks.write_csv(selected, f"{args.audit}/selection")
    ids = selected.select("mono_id") if selected is not None else None
    evidence = evidence_flow.build_evidence(panel, dictionary.formulas(), ids, evidence_flow.EvidenceSettings(month=args.month), dictionary)
    if args.verb == "build-evidence" or args.dry_run:
        sinks.write_jsonl(prompt_text(evidence) if args.dry_run else evidence, args.out or "evidence.jsonl")
        return 0
    decisions = staged(evidence_flow.run_decisions(evidence, rule_decider, scores=run.results), "decisions")  # asked once, lost executors or not
    if args.audit:
        sinks.append_answers(decisions, args.run_id, f"{args.audit}/answers")
    failed = decisions.where("error IS NOT NULL").count()
    if failed:
        log.error("%s decisions failed; nothing is written", failed)
        return DECISIONS_FAILED
    try:
        print(json.dumps(evidence_flow.write_decisions(decisions, evidence, args.run_id, names, args.mode, "rules", args.source, evidence_flow.entity_quality(panel, run.features, evidence_flow.EvidenceSettings(month=args.month)))))
    except Exception:
        log.exception("writing failed")
        return SINK_FAILED
    return 0


if __name__ == "__main__":
    sys.exit(main())
