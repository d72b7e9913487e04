"""Why a row stands out: its features by severity, each with a reference, a direction and a text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import contribution_pct, half_even, optional_round
from cohortloom.functions.text import direction_comment, is_riskier, plain_number, risk_direction
from cohortloom.operators.panel import ID

REASONS, CANDIDATES_PER_REASON = 3, 2

#: The form of one reason, also as JSON in result tables.
REASON_SCHEMA = (
    "struct<mono_id:string,feature:string,label:string,is_missing_reason:boolean,actual:double,customer_previous_reference:double,peer_reference:double,"
    "peer_z:double,peer_support:bigint,peer_level:string,peer_representativeness_score:double,peer_quality:string,train_reference:double,reference_used:string,"
    "contribution_pct:double,component_contributions:struct<raw_pct:double,peer_pct:double,missing_pct:double>,direction_comment:string,previous_comment:string,financial_term_detail:string>"
)


def choose_reference(actual: Column, previous: Column, peer: Column, train: Column, peer_z: Column, peer_pct: Column, raw_pct: Column) -> Column:
    """struct(label, value): what a value is compared with."""
    pair = lambda label, value: F.struct(F.lit(label).alias("label"), value.cast("double").alias("value"))
    by_peer, by_train, by_previous = pair("peer medyan", peer), pair("train medyan", train), pair("musteri onceki ay", previous)
    none = F.struct(F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("value"))
    strong = F.coalesce(F.abs(peer_z) >= 2, F.lit(False)) | (peer_pct >= raw_pct * 0.75)
    return (
        F.when(actual.isNull() & peer.isNotNull(), by_peer)
        .when(actual.isNull() & train.isNotNull(), by_train)
        .when(actual.isNull(), none)
        .when(peer.isNotNull() & strong, by_peer)
        .when(previous.isNotNull(), by_previous)
        .when(peer.isNotNull(), by_peer)
        .when(train.isNotNull(), by_train)
        .otherwise(none)
    )


def previous_comment(actual: Column, previous: Column, peer: Column, direction: Column, term_detail: Column) -> Column:
    risky_by_peer = is_riskier(direction, actual, peer)
    improving = ~is_riskier(direction, actual, previous)
    return (
        F.when(actual.isNull() | previous.isNull(), F.lit(None).cast("string"))
        .when(F.coalesce(F.contains(term_detail, F.lit("ayni finansal term")), F.lit(False)), "onceki ay ayni finansal term oldugu icin trend kaniti zayif")
        .when(improving & risky_by_peer, "onceki finansal veriye gore iyilesme var ama peer'e gore halen riskli")
        .when(risky_by_peer, "peer'e gore risk sinyali onceki ay bilgisinden daha belirgin")
    )


def term_detail(column: Column, current: Column, previous: Column) -> Column:
    head = F.concat(column, F.lit("="), current)
    return F.when(column.isNull() | current.isNull(), F.lit(None).cast("string")).when(current == previous, F.concat(head, F.lit("; onceki ayla ayni finansal term tasiniyor"))).when(previous.isNotNull(), F.concat(head, F.lit("; onceki term="), previous)).otherwise(head)


def review_bucket(is_missing: Column, comment: Column) -> Column:
    rising = F.contains(comment, F.lit("risk artisi"))
    return F.when(is_missing | rising, 0).when(F.contains(comment, F.lit("risk azalisi")), 2).otherwise(1)


def reason_text(r: Column) -> Column:
    share = F.format_string("%.1f", r["contribution_pct"])
    missing = F.concat(r["label"], F.lit(": deger missing; katki %"), share, F.lit("; referans="), F.coalesce(r["reference_used"], F.lit("NA")))
    by_peer = F.concat_ws(
        "; ",
        F.concat(r["label"], F.lit(": peer'e gore sapma yuksek")),
        F.concat(F.lit("gerceklesen="), plain_number(r["actual"])),
        F.concat(F.lit("peer="), plain_number(r["peer_reference"])),
        F.concat(F.lit("peer_z="), plain_number(r["peer_z"])),
        F.concat(F.lit("peer_support="), r["peer_support"].cast("string")),
        F.concat(F.lit("peer_temsil="), F.coalesce(r["peer_quality"], F.lit("ZAYIF"))),
        F.concat(F.lit("katki=%"), share),
        r["direction_comment"],
        r["previous_comment"],
        r["financial_term_detail"],
    )
    other = F.concat(
        r["label"], F.lit(": gerceklesen="), plain_number(r["actual"]), F.lit(", onceki="), plain_number(r["customer_previous_reference"]), F.lit(", peer="), plain_number(r["peer_reference"]), F.lit(", katki=%"), share, F.lit("; "), r["direction_comment"]
    )
    return F.when(r["is_missing_reason"], missing).when(r["reference_used"] == "peer medyan", by_peer).otherwise(other)


def severity_shares(severity: DataFrame, keys: list[str]) -> DataFrame:
    """``severity(keys, feature, severity)`` with each row's ``total`` and the feature's ``rank`` among those above 0."""
    totals = severity.groupBy(*keys).agg(F.sum("severity").alias("total"))
    w = Window.partitionBy(*keys).orderBy(F.col("severity").desc(), "feature")
    ranked = severity.where("severity > 0").withColumn("rank", F.row_number().over(w))
    return ranked.join(totals, keys).withColumn("total", F.when(F.col("total") == 0, 1.0).otherwise(F.col("total")))


def build_reasons(rows: DataFrame, keys: list[str], n: int = REASONS, labels: dict[str, str] | None = None, share_rounding: Callable[[Column, int], Column] = half_even) -> DataFrame:
    """``reasons`` (array of REASON_SCHEMA) and ``reason_texts`` per row.

    ``rows``: one per row and feature with ``severity, value, previous, train_reference``, the peer columns, and optionally
    ``configured_direction``, ``term_column``, ``term``, ``previous_term``. Of the ``2 n`` most severe features the ``n``
    that a review reads first stay: missing ones and rising risks, then others, then falling risks. ``share_rounding`` gives
    contributions their two decimals.
    """
    have = set(rows.columns)
    optional = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    shares = severity_shares(rows.select(*keys, "feature", "severity"), keys).where(F.col("rank") <= n * CANDIDATES_PER_REASON)
    rows = rows.drop("severity").join(shares, [*keys, "feature"])
    share = F.col("severity") / F.col("total") * 100
    peer_pct = contribution_pct(F.col("severity"), F.col("total"))
    direction = risk_direction(F.col("feature"), optional("configured_direction"))
    label = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)), F.col("feature")), F.replace(F.col("feature"), F.lit("_"), F.lit(" "))) if labels else F.replace(F.col("feature"), F.lit("_"), F.lit(" "))
    rows = rows.withColumn("__ref", choose_reference(F.col("value"), F.col("previous"), F.col("peer_median"), F.col("train_reference"), F.col("peer_z"), peer_pct, F.lit(0.0)))
    rows = rows.withColumns({"__comment": direction_comment(direction, F.col("value"), F.col("__ref.label"), F.col("__ref.value")), "__term": term_detail(optional("term_column"), optional("term"), optional("previous_term"))})
    missing = F.col("value").isNull()
    reason = F.struct(
        F.col(ID).cast("string").alias("mono_id") if ID in have else F.lit(None).cast("string").alias("mono_id"),
        F.col("feature"),
        label.alias("label"),
        missing.alias("is_missing_reason"),
        optional_round(F.col("value"), 6).alias("actual"),
        optional_round(F.col("previous"), 6).alias("customer_previous_reference"),
        optional_round(F.col("peer_median"), 6).alias("peer_reference"),
        optional_round(F.col("peer_z"), 4).alias("peer_z"),
        F.col("peer_support").cast("long").alias("peer_support"),
        F.coalesce("peer_level", F.lit("UNKNOWN")).alias("peer_level"),
        optional_round(F.col("peer_score"), 2).alias("peer_representativeness_score"),
        F.coalesce("peer_quality", F.lit("ZAYIF")).alias("peer_quality"),
        optional_round(F.col("train_reference"), 6).alias("train_reference"),
        F.col("__ref.label").alias("reference_used"),
        share_rounding(share, 2).alias("contribution_pct"),
        F.struct(F.lit(0.0).alias("raw_pct"), peer_pct.alias("peer_pct"), F.lit(0.0).alias("missing_pct")).alias("component_contributions"),
        F.col("__comment").alias("direction_comment"),
        previous_comment(F.col("value"), F.col("previous"), F.col("peer_median"), direction, F.col("__term")).alias("previous_comment"),
        F.col("__term").alias("financial_term_detail"),
    )
    ordered = F.struct(review_bucket(missing, F.col("__comment")).alias("bucket"), (-share).alias("share"), F.col("rank").alias("rank"), reason.alias("reason"))
    grouped = rows.groupBy(*keys).agg(F.slice(F.transform(F.array_sort(F.collect_list(ordered)), lambda x: x["reason"]), 1, n).alias("reasons"))  # at most 2 n entries
    return grouped.withColumn("reason_texts", F.transform("reasons", reason_text))
