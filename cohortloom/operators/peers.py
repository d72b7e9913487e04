"""Robust statistics of hierarchical peer groups.

Values are in long form: one row per entity, month and feature. A row belongs to one group of each level, from the
finest to the whole month; the first level whose group has enough values gives its reference. The sizes of cells (a
feature and all keys of all levels), rolled up, tell which groups have enough values, and only for those are values passed
on, under a number for each group; they are counted in bands before they are shuffled. What is joined back to the rows is
an entry per cell. A month that holds a third of all rows is still aggregated on all machines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import LEVEL_SCORES, PEER_MIN_SUPPORT, half_even, peer_z, representativeness, scale_ladder, signed_log1p
from cohortloom.functions.text import assessment, category, quality_label
from cohortloom.operators.panel import ID, TIME
from cohortloom.operators.quantiles import grouped_quantiles, interpolated
from cohortloom.sources.staging import staged

#: Levels from fine to coarse with their keys.
LEVELS: dict[str, tuple[str, ...]] = {
    "AY_SEGMENT_SEKTOR_SIZE": (TIME, "peer_segment", "peer_sector", "peer_size"),
    "AY_SEGMENT_SEKTOR": (TIME, "peer_segment", "peer_sector"),
    "AY_SEGMENT_SIZE": (TIME, "peer_segment", "peer_size"),
    "AY_SEGMENT": (TIME, "peer_segment"),
    "AY": (TIME,),
}
GLOBAL = "GLOBAL_FEATURE"
NARROW = tuple(LEVELS)[:3]
# Fixed values of the meaningfulness test.
LEAST_GOOD_PCT, MOST_WEAK_PCT, LEAST_P10, LEAST_MEDIAN, LEAST_NARROW_PCT = 95.0, 5.0, 50.0, 100.0, 75.0
WARN_WEAK_PCT, WARN_GOOD_PCT = 15.0, 85.0


@dataclass(frozen=True)
class PeerColumns:
    """Where a panel keeps the segment, the sector (first one that exists) and the sizes."""

    segment: str = "musteri_segment"
    sectors: tuple[str, ...] = ("cst_nace_code_id", "cst_nace_code", "cst_sector")
    assets: str = "toplam_varlik_ttr"
    risks: tuple[str, ...] = ("bank_total_risk", "memzuc_total_risk")


def size_base(df: DataFrame, columns: PeerColumns = PeerColumns()) -> Column | None:
    """Assets where half of the rows have them, else the sum of risks; NULL expression without either."""
    names = set(df.columns)
    if columns.assets in names and (df.agg(F.avg(F.col(columns.assets).isNotNull().cast("double"))).first()[0] or 0.0) >= 0.5:
        return F.col(columns.assets)
    risks = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns.risks if c in names]
    if risks:
        return sum(risks[1:], risks[0])
    return F.col(columns.assets) if columns.assets in names else None


def size_buckets(df: DataFrame, base: Column | None, time: str = TIME, out: str = "peer_size") -> DataFrame:
    """S1 to S4 by the quartiles of each month; SIZE_NA for a missing base and for months whose quartiles fall together."""
    if base is None:
        return df.withColumn(out, F.lit("SIZE_NA"))
    x = F.log1p(F.when(base.isNotNull(), F.greatest(base, F.lit(0.0))))
    found = grouped_quantiles(df.select(F.col(time).alias("__month"), x.alias("__x")), ["__month"], F.col("__x"), {f"q{i}": i / 4 for i in range(5)})
    edges = found.select("__month", F.array(*(interpolated(F.col(f"q{i}")) for i in range(5))).alias("__edges"), F.col("n").alias("__n"))
    e = lambda i: F.col("__edges")[i]
    usable = (F.col("__n") >= 4) & (e(0) < e(1)) & (e(1) < e(2)) & (e(2) < e(3)) & (e(3) < e(4))
    bucket = F.when(~F.coalesce(usable, F.lit(False)) | x.isNull(), "SIZE_NA").when(x <= e(1), "S1").when(x <= e(2), "S2").when(x <= e(3), "S3").otherwise("S4")
    sized = df.join(F.broadcast(edges), F.col(time).eqNullSafe(F.col("__month")), "left")  # the latter a row a month
    return sized.withColumn(out, bucket).drop("__month", "__edges", "__n")


def with_peer_context(df: DataFrame, columns: PeerColumns = PeerColumns(), time: str = TIME, base: Column | None = None) -> DataFrame:
    """With ``peer_segment, peer_sector, peer_size, peer_key``; sizes are of ``base`` where it is given."""
    names = set(df.columns)
    sector = next((c for c in columns.sectors if c in names), None)
    out = size_buckets(df, size_base(df, columns) if base is None else base, time)
    out = out.withColumns(
        {
            "peer_segment": category(F.col(columns.segment), "SEG_NA") if columns.segment in names else F.lit("SEG_NA"),
            "peer_sector": category(F.col(sector), "SECTOR_NA") if sector else F.lit("SECTOR_NA"),
        }
    )
    return out.withColumn("peer_key", F.concat_ws("|", "peer_segment", "peer_sector", "peer_size"))


def long_form(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """One row per row and feature: the ``keep`` columns, ``feature`` and ``value``."""
    return df.unpivot([F.col(c) for c in keep], [F.col(f"`{c}`").cast("double").alias(c) for c in features], "feature", "value")


def _group_key(level: str, keys: tuple[str, ...]) -> Column:
    return F.concat_ws("\x1f", F.lit(level), *(F.coalesce(F.col(k).cast("string"), F.lit("\x1e")) for k in keys))


@dataclass(frozen=True)
class _Statistics:
    cells: DataFrame  # feature, cell, rank, gid: the groups with enough values of each cell
    groups: DataFrame  # gid, feature, level, group_key, support, median, t_median, t_low, t_high, mad


def _cell(levels: dict[str, tuple[str, ...]]) -> Column:
    return _group_key("cell", tuple(dict.fromkeys(k for keys in levels.values() for k in keys)))


def _group_statistics(long: DataFrame, levels: dict[str, tuple[str, ...]], min_support: int, nearest: bool = False) -> _Statistics:
    """Statistics of the groups with enough values, and of all values of a feature; with ``nearest`` only of groups that are the finest of some cell."""
    dims = dict.fromkeys(k for keys in levels.values() for k in keys)
    groups = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(level).alias("level"), _group_key(level, keys).alias("group_key")) for i, (level, keys) in enumerate(levels.items())))
    sizes = long.groupBy("feature", *dims).agg(F.count("value").alias("size")).withColumn("cell", _cell(levels))
    members = staged(sizes.select("feature", "cell", "size", F.inline(groups)), "peer-members")
    enough = (F.col("support") >= min_support) | (F.col("level") == GLOBAL) & (F.col("support") > 0)
    known = members.groupBy("feature", "rank", "level", "group_key").agg(F.sum("size").alias("support")).where(enough)
    known = staged(known.withColumn("gid", F.monotonically_increasing_id()), "peer-groups")
    cells = staged(members.join(known, ["feature", "rank", "group_key"]).select("feature", "cell", "rank", "gid"), "peer-cells")
    if nearest:
        everywhere = F.col("level") == GLOBAL
        finest = cells.join(known.where(~everywhere), "gid", "left_semi").groupBy("feature", "cell").agg(F.min_by("gid", "rank").alias("gid"))
        used = staged(finest.select("gid").union(known.where(everywhere).select("gid")).distinct(), "peer-used")
        cells, known = cells.join(used, "gid", "left_semi"), known.join(used, "gid", "left_semi")
    values = long.where("value IS NOT NULL").select("feature", _cell(levels).alias("cell"), "value")

    def passed_on(entries: DataFrame, *fields: str) -> DataFrame:
        """Each value once for each of its cell's groups. The entries are written, so that Spark knows how small they are and doesn't shuffle the values."""
        lists = staged(entries.groupBy("feature", "cell").agg(F.collect_list(F.struct("gid", *fields)).alias("groups")), "peer-entries")
        return values.join(lists, ["feature", "cell"]).select("value", F.inline("groups"))

    found = grouped_quantiles(passed_on(cells), ["gid"], F.col("value"), {"a": 0.25, "b": 0.5, "c": 0.75})
    t = {"t_low": "a", "t_median": "b", "t_high": "c"}
    first = staged(found.select("gid", interpolated(F.col("b")).alias("median"), *(interpolated(F.col(q), signed_log1p).alias(name) for name, q in t.items())), "medians")
    apart = passed_on(cells.join(first, "gid"), "t_median")
    spread = grouped_quantiles(apart, ["gid"], F.abs(signed_log1p(F.col("value")) - F.col("t_median")), {"q": 0.5})
    stats = known.drop("rank").join(first, "gid").join(spread.select("gid", interpolated(F.col("q")).alias("mad")), "gid")
    return _Statistics(cells, stats)


def level_statistics(long: DataFrame, levels: dict[str, tuple[str, ...]] = LEVELS, min_support: int = PEER_MIN_SUPPORT) -> DataFrame:
    """``feature, level, group_key, support, median, t_median, mad`` of all groups with enough values."""
    return _group_statistics(long, levels, min_support).groups.drop("gid", "t_low", "t_high")


def _global_statistics(long: DataFrame, stats: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """``feature, g_median, g_t_median, g_scale`` over all values of each feature, in each part."""
    every = long.groupBy("feature", *parts).agg(F.stddev_samp(signed_log1p(F.col("value"))).alias("std"), F.count("value").alias("n")).withColumn("group_key", _group_key(GLOBAL, parts))
    one = every.join(stats.where(F.col("level") == GLOBAL), ["feature", "group_key"], "left")
    return one.select(
        "feature",
        *parts,
        F.coalesce("median", F.lit(0.0)).alias("g_median"),
        F.coalesce("t_median", F.lit(0.0)).alias("g_t_median"),
        scale_ladder(F.col("mad"), F.col("t_high") - F.col("t_low"), F.col("std"), F.col("n")).alias("g_scale"),
    )


@dataclass(frozen=True)
class PeerLookup:
    """What values are compared with: a few entries, however many values there are."""

    levels: dict[str, tuple[str, ...]]
    parts: tuple[str, ...]
    chosen: DataFrame  # feature, cell, peer: the statistics of the finest group with enough values
    overall: DataFrame  # feature, parts, g_median, g_t_median, g_scale: those of all values


def peer_lookup(long: DataFrame, levels: dict[str, tuple[str, ...]] = LEVELS, min_support: int = PEER_MIN_SUPPORT, part: str | None = None) -> PeerLookup:
    """``long`` has the columns of all level keys. Values below every level are compared with all of their feature, those with
    the same ``part`` where that column is named. Parts have no month in common."""
    parts = (part,) if part else ()
    every = {**levels, GLOBAL: parts}
    found = _group_statistics(long, every, min_support, nearest=True)
    stats = staged(found.groups, "peer-statistics")
    chosen = (
        found.cells.join(stats.where(F.col("level") != GLOBAL), ["feature", "gid"])
        .groupBy("feature", "cell")
        .agg(F.min_by(F.struct("level", "support", "median", "t_median", "mad"), "rank").alias("peer"))
    )
    # written, so that Spark knows how small they are and doesn't shuffle the rows
    return PeerLookup(every, parts, staged(chosen, "peer-chosen"), staged(_global_statistics(long, stats, parts), "peer-overall"))


def _own_scale(mad: Column) -> Column:
    return F.when(mad * 1.4826 != 0, mad * 1.4826)


def compared(long: DataFrame, lookup: PeerLookup) -> DataFrame:
    """``long`` with ``peer_median, peer_support, peer_level, peer_scale, peer_z, peer_score, peer_quality``; values below every level have support 0."""
    rows = long.withColumn("cell", _cell(lookup.levels)).join(lookup.chosen, ["feature", "cell"], "left").join(F.broadcast(lookup.overall), ["feature", *lookup.parts], "left")  # the latter a row a feature and part
    rows = rows.select(
        *long.columns,
        F.coalesce("peer.median", "g_median").alias("peer_median"),
        F.coalesce("peer.support", F.lit(0)).cast("long").alias("peer_support"),
        F.coalesce("peer.level", F.lit(GLOBAL)).alias("peer_level"),
        F.coalesce("peer.t_median", "g_t_median").alias("__center"),
        F.coalesce(_own_scale(F.col("peer.mad")), F.col("g_scale")).alias("peer_scale"),
    )
    return rows.select(
        *long.columns,
        "peer_median",
        "peer_support",
        "peer_level",
        "peer_scale",
        peer_z(signed_log1p(F.col("value")), F.col("__center"), F.col("peer_scale")).alias("peer_z"),
        representativeness(F.col("peer_level"), F.col("peer_support")).alias("peer_score"),
    ).withColumn("peer_quality", quality_label(F.col("peer_support"), F.col("peer_score"), F.col("peer_level")))


def peer_references(long: DataFrame, levels: dict[str, tuple[str, ...]] = LEVELS, min_support: int = PEER_MIN_SUPPORT, part: str | None = None) -> DataFrame:
    """``long`` compared with its own values."""
    return compared(long, peer_lookup(long, levels, min_support, part))


def peer_matrix(wide: DataFrame, lookup: PeerLookup, features: list[str], keep: list[str]) -> DataFrame:
    """The ``keep`` columns of each row of ``wide`` and a ``<feature>__peer_z`` for each of its features.

    Rows stay as they are: a cell's statistics of all features are one entry, which is joined to them, so that nothing is
    shuffled by row and feature and gathered again.
    """
    by_feature = lambda *fields: F.map_from_entries(F.collect_list(F.struct("feature", F.struct(*fields))))
    cells = staged(lookup.chosen.groupBy("cell").agg(by_feature("peer.t_median", "peer.mad").alias("__peers")), "peer-rows")
    overall = lookup.overall.groupBy(*lookup.parts).agg(by_feature("g_t_median", "g_scale").alias("__overall"))
    rows = wide.withColumn("cell", _cell(lookup.levels)).join(cells, "cell", "left").join(F.broadcast(overall), list(lookup.parts) or F.lit(True), "left")  # the latter a row a part

    def z(feature: str) -> Column:
        peer, every = (F.try_element_at(c, F.lit(feature)) for c in ("__peers", "__overall"))
        scale = F.coalesce(_own_scale(peer["mad"]), every["g_scale"])
        return peer_z(signed_log1p(F.col(f"`{feature}`").cast("double")), F.coalesce(peer["t_median"], every["g_t_median"]), scale)

    return rows.select(*keep, *(z(f).alias(f"{f}__peer_z") for f in features))


def peer_diagnostics(peers: DataFrame) -> DataFrame:
    """One row about all comparisons: shares of quality and narrow levels, quantiles of support, and the test of their meaning."""
    quality = lambda name: half_even(F.coalesce(F.try_divide(F.count_if(F.col("peer_quality") == name), F.count("*")), F.lit(0.0)) * 100, 2)
    quantiles = F.percentile("peer_support", F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9))))
    one = peers.agg(
        F.count("*").alias("total"),
        quality("GUCLU").alias("strong_pct"),
        quality("KABUL_EDILEBILIR").alias("acceptable_pct"),
        quality("ZAYIF").alias("weak_pct"),
        half_even(F.coalesce(F.try_divide(F.count_if(F.col("peer_level").isin(*NARROW)), F.count("*")), F.lit(0.0)) * 100, 2).alias("narrow_pct"),
        quantiles.alias("q"),
        F.min("peer_support").alias("support_min"),
        F.max("peer_support").alias("support_max"),
    )
    one = one.select("*", *(half_even(F.col("q")[i], 2).alias(f"support_p{p}") for i, p in enumerate((10, 25, 50, 75, 90)))).drop("q")
    good = half_even(F.col("strong_pct") + F.col("acceptable_pct"), 2)
    p10, p50 = F.coalesce("support_p10", F.lit(0.0)), F.coalesce("support_p50", F.lit(0.0))
    passed = (good >= LEAST_GOOD_PCT) & (F.col("weak_pct") <= MOST_WEAK_PCT) & (p10 >= LEAST_P10) & (p50 >= LEAST_MEDIAN) & (F.col("narrow_pct") >= LEAST_NARROW_PCT)
    warned = (F.col("weak_pct") <= WARN_WEAK_PCT) & (good >= WARN_GOOD_PCT) & (p10 >= PEER_MIN_SUPPORT)
    result = F.when(passed, "PASS").when(warned, "WARN").otherwise("FAIL")
    return one.withColumn("good_pct", good).withColumn("result", result).withColumn("assessment", assessment(result))


def level_counts(peers: DataFrame) -> DataFrame:
    """``kind, name, n``: comparisons by quality and by level, in one pass."""
    return peers.groupingSets([["peer_quality"], ["peer_level"]], "peer_quality", "peer_level").agg(F.count("*").alias("n")).select(
        F.when(F.col("peer_level").isNull(), "quality").otherwise("level").alias("kind"), F.coalesce("peer_quality", "peer_level").alias("name"), "n"
    )


assert set(LEVELS) | {GLOBAL} == set(LEVEL_SCORES)
