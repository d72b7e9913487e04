"""From peer deviations to scores, bands and confidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import clip, signed_log1p
from cohortloom.operators.quantiles import grouped_quantiles, interpolated
from cohortloom.sources.staging import staged

# Fixed values of the band policy.
BANDS = (("sari", 0.95, 90.0), ("turuncu", 0.98, 95.0), ("kirmizi", 0.99, 97.5))


@dataclass(frozen=True)
class Preprocessor:
    """Per column: what missing values become, bounds, and center and scale after the signed logarithm."""

    fill: dict[str, float]
    low: dict[str, float]
    high: dict[str, float]
    center: dict[str, float]
    scale: dict[str, float]

    def columns(self) -> list[str]:
        return list(self.fill)

    def bounded(self, name: str) -> Column:
        return signed_log1p(clip(F.coalesce(F.col(f"`{name}`"), F.lit(self.fill[name])), self.low[name], self.high[name]))

    def expressions(self) -> list[Column]:
        return [F.coalesce((self.bounded(c) - self.center[c]) / self.scale[c], F.lit(0.0)).alias(c) for c in self.columns()]


def fit_preprocessor(train: DataFrame, names: list[str]) -> Preprocessor:
    """Medians and 1 % tails of each column with its gaps filled, then center and quartiles of what they bound; exact, by ranks of all rows."""
    number = {str(i): c for i, c in enumerate(names)}

    def of(values: list[Column], quantiles: dict[str, float]) -> dict[str, dict[str, float]]:
        rows = train.select(F.explode(F.array(*(F.struct(F.lit(i).alias("column"), v.alias("value")) for i, v in zip(number, values, strict=True)))).alias("x")).select("x.*")
        found = grouped_quantiles(rows, ["column"], F.col("value"), quantiles)
        return {number[r["column"]]: r.asDict() for r in found.select("column", *(interpolated(F.col(q)).alias(q) for q in quantiles)).collect()}  # a row a column

    medians = of([F.col(f"`{c}`").cast("double") for c in names], {"m": 0.5})
    fill = {c: medians.get(c, {}).get("m", 0.0) for c in names}
    tails = of([F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(fill[c])) for c in names], {"low": 0.01, "high": 0.99})
    low, high = ({c: tails.get(c, {}).get(k, 0.0) for c in names} for k in ("low", "high"))
    draft = Preprocessor(fill, low, high, dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0))
    bounded = of([draft.bounded(c) for c in names], {"a": 0.25, "b": 0.5, "c": 0.75})
    deviations = train.agg(*(F.stddev_pop(draft.bounded(c)).alias(f"s{i}") for i, c in enumerate(names))).first()
    center, scale = {}, {}
    for i, c in enumerate(names):
        q, std = [bounded.get(c, {}).get(k, 0.0) for k in "abc"], deviations[i] or 0.0
        center[c] = q[1]
        scale[c] = q[2] - q[0] if q[2] - q[0] > 1e-9 else std if std > 1e-9 else 1.0
    return Preprocessor(fill, low, high, center, scale)


def percentiles(scored: DataFrame, reference: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``scored`` with the share, in percent, of all reference rows that are not greater: ``columns`` are value columns of both frames and what to call their percentiles.

    All columns at once: rows are counted per distinct value, values are range-partitioned, and running sums within partitions are moved up by
    the sums of those before; only a row a partition is in one place. Missing values are above all others; without a
    reference all percentiles are 0. ``scored`` should be cheap to read twice.
    """
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))

    def long(df: DataFrame, n: int) -> DataFrame:
        return df.select(F.lit(n).alias("n"), F.inline(F.array(*(F.struct(F.lit(i).alias("column"), value(c).alias("value")) for i, c in enumerate(columns)))))

    counts = long(reference, 1).unionByName(long(scored, 0)).groupBy("column", "value").agg(F.sum("n").alias("n"))
    counts = staged(counts.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()), "counts")
    sums = counts.groupBy("column", "part").agg(F.sum("n").alias("sum"))
    of_column = Window.partitionBy("column")
    before = sums.select("column", "part", (F.sum("sum").over(of_column.orderBy("part")) - F.col("sum")).alias("before"), F.sum("sum").over(of_column).alias("total"))  # a row a column and partition
    running = counts.withColumn("n", F.sum("n").over(Window.partitionBy("column", "part").orderBy("value"))).join(F.broadcast(before), ["column", "part"])
    share = F.coalesce(F.try_divide((F.col("before") + F.col("n")).cast("double"), F.col("total")) * 100.0, F.lit(0.0))
    for i, (column, name) in enumerate(columns.items()):
        ranks = running.where(F.col("column") == i).select(F.col("value").alias("__value"), share.alias(name))
        scored = scored.withColumn("__value", value(column)).join(ranks, "__value").drop("__value")
    return scored


def band_thresholds(scores: DataFrame, score: str) -> dict[str, float]:
    """Quantiles of the scores, each at least its floor and the band below."""
    found = grouped_quantiles(scores, [], F.col(score), {name: q for name, q, _ in BANDS}).select(*(interpolated(F.col(name)) for name, _, _ in BANDS)).first()
    row = found or [0.0] * len(BANDS)
    out, least = {}, 0.0
    for (name, _, floor), value in zip(BANDS, row, strict=True):
        least = out[name] = max(value, floor, least)
    return out


def band(score: Column, thresholds: dict[str, float]) -> Column:
    return F.when(score >= thresholds["kirmizi"], "KIRMIZI").when(score >= thresholds["turuncu"], "TURUNCU").when(score >= thresholds["sari"], "SARI").otherwise("NORMAL")
