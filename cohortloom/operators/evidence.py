"""Evidence about one entity and feature: history, trend, season, series.

History statistics are aggregations over (entity, feature); what needs the order of months uses at most the last
``LAST`` values of each, which Spark limits before it shuffles (a row number filter in the window).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import evidence_strength, history_scale, pct_change, population_scale, z_against_scale
from cohortloom.operators.panel import ID, TIME, latest_by_key
from cohortloom.operators.peers import LEVELS
from cohortloom.operators.quantiles import grouped_quantiles, interpolated
from cohortloom.sources.staging import staged

LAST = 12
SEASON_SUPPORT = 50


def last_values(history: DataFrame, n: int = LAST, time: str = TIME, keys: tuple[str, ...] = (ID, "feature")) -> DataFrame:
    """The last ``n`` values that are not missing, with ``ago`` 1 for the latest."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc(), F.col("value").desc())
    return history.where("value IS NOT NULL").withColumn("ago", F.row_number().over(w)).where(F.col("ago") <= n)


def _deviation(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """``median, mad, std, n, p25, p75`` of the values of each key."""
    rows = df.where(F.col(value).isNotNull())
    one = rows.groupBy(*keys).agg(F.median(value).alias("median"), F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.stddev_samp(value).alias("std"), F.count("*").alias("n"))
    mad = rows.join(one.select(*keys, "median"), keys).groupBy(*keys).agg(F.median(F.abs(F.col(value) - F.col("median"))).alias("mad"))
    return one.join(mad, keys).select(*keys, "median", "mad", "std", "n", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p75"))


def history_metrics(history: DataFrame, keys: tuple[str, ...] = (ID, "feature"), time: str = TIME, stats: DataFrame | None = None, tail: DataFrame | None = None) -> DataFrame:
    """``period_count, median, p25, p75, robust_scale, rolling_3m/6m/12m_median, previous_value`` per key.

    ``stats`` and ``tail``: the deviations and last values of ``history`` where the caller has them."""
    keys_ = list(keys)
    stats = (_deviation(history, keys_) if stats is None else stats).withColumn("robust_scale", history_scale(F.col("mad"), F.col("std"), F.col("n"), 0.0))
    tail = last_values(history, LAST, time, keys) if tail is None else tail
    rolling = tail.groupBy(*keys_).agg(
        *(F.median(F.when(F.col("ago") <= k, F.col("value"))).alias(f"rolling_{k}m_median") for k in (3, 6, 12)), F.max(F.when(F.col("ago") == 1, F.col("value"))).alias("previous_value")
    )
    return stats.join(rolling, keys_).select(*keys_, F.col("n").alias("period_count"), "median", "p25", "p75", "robust_scale", "mad", "std", "rolling_3m_median", "rolling_6m_median", "rolling_12m_median", "previous_value")


def trend_metrics(history: DataFrame, current: DataFrame, keys: tuple[str, ...] = (ID, "feature"), time: str = TIME, stats: DataFrame | None = None, tail: DataFrame | None = None) -> DataFrame:
    """``slope_6m, slope_12m, trend_break_flag`` of the ``current`` values after their histories.

    Slopes are least squares over the last 6 or 12 values with the current one; a break is a current value three robust
    deviations from the history's median. Both need a current value and three values of history. ``stats`` and ``tail`` are
    as in ``history_metrics``.
    """
    keys_ = list(keys)
    now = current.where("value IS NOT NULL").select(*keys_, "value", F.lit(0).alias("ago"))
    tail = (last_values(history, LAST, time, keys) if tail is None else tail).select(*keys_, "value", "ago").unionByName(now)
    x = -F.col("ago").cast("double")
    slope = lambda k: F.when(F.count_if(F.col("ago") < k) >= 3, F.regr_slope(F.when(F.col("ago") < k, F.col("value")), x))
    slopes = tail.groupBy(*keys_).agg(slope(6).alias("slope_6m"), slope(12).alias("slope_12m"))
    stats = _deviation(history, keys_) if stats is None else stats
    scale = history_scale(F.col("mad"), F.col("std"), F.col("n"), 1.0)
    z = F.abs(F.col("value") - F.col("median")) / scale
    out = current.select(*keys_, "value").join(stats, keys_, "left").join(slopes, keys_, "left")
    enough = F.col("value").isNotNull() & (F.coalesce("n", F.lit(0)) >= 3)
    return out.select(
        *keys_, F.when(enough, F.col("slope_6m")).alias("slope_6m"), F.when(enough, F.col("slope_12m")).alias("slope_12m"), F.coalesce(enough & (z >= 3), F.lit(False)).alias("trend_break_flag")
    )


def same_month_metrics(history: DataFrame, current: DataFrame, month: date, keys: tuple[str, ...] = (ID, "feature"), time: str = TIME) -> DataFrame:
    """``same_month_last_year_value`` (the latest earlier value of the same calendar month), ``yoy_change_pct``, and median and z of those months."""
    keys_ = list(keys)
    same = history.where((F.month(time) == month.month) & F.col("value").isNotNull())
    stats = _deviation(same, keys_)
    latest = same.groupBy(*keys_).agg(F.max_by("value", time).alias("same_month_last_year_value"))
    out = current.select(*keys_, "value").join(stats, keys_, "left").join(latest, keys_, "left")
    scale = history_scale(F.col("mad"), F.col("std"), F.col("n"), 1.0)
    return out.select(
        *keys_,
        "same_month_last_year_value",
        pct_change(F.col("value"), F.col("same_month_last_year_value")).alias("yoy_change_pct"),
        F.col("median").alias("same_month_customer_median"),
        F.when(F.col("n") >= 2, z_against_scale(F.col("value"), F.col("median"), scale)).alias("same_month_customer_z"),
    )


def seasonal_peer_medians(train: DataFrame, month: date, min_support: int = SEASON_SUPPORT, time: str = TIME) -> DataFrame:
    """``feature, level, peer_segment, peer_sector, peer_size, seasonal_median`` of all earlier rows of the calendar month, exact by ranks.

    Levels are those of the peers without the month; a group needs enough values, the overall median (level null) none.
    """
    rows = train.where((F.month(time) == month.month) & F.col("value").isNotNull())
    dims = ["peer_segment", "peer_sector", "peer_size"]
    levels = F.array(*(F.struct(F.lit(name).alias("level"), *((F.col(d) if d in keys else F.lit(None).cast("string")).alias(d) for d in dims)) for name, keys in LEVELS.items()))
    grouped = grouped_quantiles(rows.select("feature", "value", F.inline(levels)), ["feature", "level", *dims], F.col("value"), {"q": 0.5})
    return grouped.select("feature", "level", *dims, "n", interpolated(F.col("q")).alias("seasonal_median")).where((F.col("n") >= min_support) | (F.col("level") == "AY"))


def seasonal_peer_lookup(current: DataFrame, medians: DataFrame, keys: tuple[str, ...] = (ID, "feature")) -> DataFrame:
    """``current`` with the ``seasonal_peer_median`` of the finest level that has one; the month's overall median else."""
    out, found = current, []
    for i, (level, level_keys) in enumerate(LEVELS.items()):
        dims = [k for k in level_keys if k.startswith("peer_")]
        side = medians.where(F.col("level") == level).select("feature", *dims, F.col("seasonal_median").alias(f"__m{i}"))
        out = out.join(side, ["feature", *dims], "left")
        found.append(f"__m{i}")
    return out.withColumn("seasonal_peer_median", F.coalesce(*found)).drop(*found)


def reference_scales(train: DataFrame) -> DataFrame:
    """``feature, reference_scale``: a row a feature. Medians are exact by ranks: no task holds a feature's values."""
    rows = train.where("value IS NOT NULL").select("feature", "value")
    middle = staged(grouped_quantiles(rows, ["feature"], F.col("value"), {"q": 0.5}).select("feature", interpolated(F.col("q")).alias("median")), "reference-medians")
    apart = rows.join(F.broadcast(middle), "feature")  # a row a feature
    mad = grouped_quantiles(apart, ["feature"], F.abs(F.col("value") - F.col("median")), {"q": 0.5}).select("feature", interpolated(F.col("q")).alias("mad"))
    one = rows.groupBy("feature").agg(F.stddev_samp("value").alias("std"), F.count("*").alias("n")).join(mad, "feature")
    return one.select("feature", population_scale(F.col("mad"), F.col("std"), F.col("n")).alias("reference_scale"))


def snapshot_series(history: DataFrame, current: DataFrame, month: date, periods: int = 6, keys: tuple[str, ...] = (ID, "feature"), time: str = TIME, peers: DataFrame | None = None) -> DataFrame:
    """``series`` per key of ``current``: its last ``periods`` months with the current one, oldest first; of a month that repeats the last row counts.

    ``peers(keys, time, peer_median, peer_z, peer_support, peer_quality, peer_level)`` adds what the peers of each month say.
    """
    keys_ = list(keys)
    past = history.where("value IS NOT NULL").select(*keys_, time, "value", F.lit(False).alias("is_current_snapshot"))
    now = current.select(*keys_, F.lit(month).alias(time), "value", F.lit(True).alias("is_current_snapshot"))
    rows = latest_by_key(past.unionByName(now), [*keys_, time], [F.col("is_current_snapshot"), F.col("value")])
    w = Window.partitionBy(*keys_).orderBy(F.col(time).desc())
    rows = rows.join(current.select(*keys_), keys_, "left_semi").withColumn("__ago", F.row_number().over(w)).where(F.col("__ago") <= max(1, periods))
    fields: list[Column] = [F.date_format(time, "yyyy-MM-dd").alias(time), F.col("value"), F.col("is_current_snapshot")]
    if peers is not None:
        rows = rows.join(peers, [*keys_, time], "left")
        fields += [F.col("peer_median").isNotNull().alias("peer_available"), *(F.col(c) for c in ("peer_median", "peer_z", "peer_support", "peer_quality", "peer_level"))]
    return rows.groupBy(*keys_).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("series"))


def evidence_rows(current: DataFrame, history: DataFrame, train: DataFrame, month: date, periods: int = 6, series_peers: DataFrame | None = None) -> DataFrame:
    """One row per entity and feature of ``current`` (long form with peer columns) with all evidence and its strength.

    ``history``: earlier values of these entities in long form; ``train``: earlier values of all entities with peer groups.
    """
    keys = [ID, "feature"]
    now = current.select(*keys, "value")
    stats, tail = staged(_deviation(history, keys), "deviations"), staged(last_values(history).select(*keys, "value", "ago"), "last-values")
    out = (
        current.join(history_metrics(history, stats=stats, tail=tail), keys, "left")
        .join(trend_metrics(history, now, stats=stats, tail=tail), keys, "left")
        .join(staged(same_month_metrics(history, now, month), "season"), keys, "left")
        .join(staged(snapshot_series(history, now, month, periods, peers=series_peers), "series"), keys, "left")
        .join(F.broadcast(reference_scales(train)), "feature", "left")  # a row a feature
    )
    out = seasonal_peer_lookup(out, staged(seasonal_peer_medians(train, month), "seasonal-peers"))
    x = F.col("value")
    out = out.withColumns(
        {
            "period_count": F.coalesce("period_count", F.lit(0)),
            "change_pct": pct_change(x, F.col("previous_value")),
            "history_z": F.when(F.col("robust_scale") != 0, (x - F.col("median")) / F.col("robust_scale")),
            "seasonal_peer_z": z_against_scale(x, F.col("seasonal_peer_median"), F.col("reference_scale")),
            "missing_flag": x.isNull(),
        }
    )
    return out.withColumn("evidence_strength", evidence_strength(F.col("peer_z"), F.col("history_z"), F.col("same_month_customer_z"), F.col("trend_break_flag"), F.col("missing_flag")))


def ranked_evidence(evidence: DataFrame, top: int | None = 12) -> DataFrame:
    w = Window.partitionBy(ID).orderBy(F.col("evidence_strength").desc(), "feature")
    ranked = evidence.withColumn("evidence_rank", F.row_number().over(w))
    return ranked.where(F.col("evidence_rank") <= top) if top else ranked
