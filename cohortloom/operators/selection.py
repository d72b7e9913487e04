"""Which columns, features and entities are worked on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import finite

# What may be a model feature, and the order in which scores are preferred.
DERIVED_PREFIXES = ("l1y_", "q_", "memzuc_", "bank_", "pd_", "rating_", "kkb_", "internal_")
SCORE_PRIORITY = ("ensemble_score", "anomaly_score", "autoencoder_score", "residual_score", "if_score")
NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")
ML_COVERAGE, EVIDENCE_COVERAGE, MODEL_COVERAGE, MISSING_RATE = 0.20, 0.05, 0.50, 0.005


def column_statistics(df: DataFrame, names: list[str]) -> DataFrame:
    """``column, coverage, n_distinct, missing_rate`` of the columns.

    Values in long form are counted once for each column and value, partly before the shuffle, then counted up for each
    column: a row of ``df`` is never copied for each column whose values are told apart.
    """
    if not names:
        return df.sparkSession.createDataFrame([], "column string, coverage double, n_distinct long, missing_rate double")
    kinds = dict(df.dtypes)
    text = lambda c: F.when(F.col(f"`{c}`") == 0, "0").otherwise(F.col(f"`{c}`").cast("string")) if kinds[c] in NUMERIC_TYPES else F.col(f"`{c}`").cast("string")  # noqa: E731  zeros of either sign are equal
    long = df.select(F.inline(F.array(*(F.struct(F.lit(i).alias("at"), text(c).alias("value")) for i, c in enumerate(names)))))
    counted = long.groupBy("at", "value").agg(F.count("*").alias("n"))
    found = counted.groupBy("at").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("present"), F.count("value").alias("n_distinct"))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "at int, column string").join(found, "at", "left")
    coverage = F.coalesce(F.coalesce("present", F.lit(0)) / F.col("rows"), F.lit(0.0))
    return every.select("column", coverage.alias("coverage"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), (1 - coverage).alias("missing_rate"))


def _covered_and_varied(df: DataFrame, names: list[str]) -> dict[str, tuple[float, object, object]]:
    """Of each column the share of rows with a value, the least and the greatest: one aggregation, without telling values apart."""
    if not names:
        return {}
    row = df.agg(*(f(F.col(f"`{c}`")).alias(f"{kind}_{i}") for i, c in enumerate(names) for kind, f in (("share", lambda x: F.avg(x.isNotNull().cast("double"))), ("low", F.min), ("high", F.max)))).first()
    return {c: (row[f"share_{i}"] or 0.0, row[f"low_{i}"], row[f"high_{i}"]) for i, c in enumerate(names)}


def numeric_columns(df: DataFrame, reserved: tuple[str, ...], least_coverage: float = ML_COVERAGE, least_distinct: int = 2, always: tuple[str, ...] = ()) -> list[str]:
    """Columns with enough numeric values, and those of ``always`` that there are. Text counts where it reads as a number."""
    names = [c for c, kind in df.dtypes if c not in reserved and (kind in NUMERIC_TYPES or kind.startswith("decimal") or kind == "string")]
    read = df.select(*(finite(F.col(f"`{c}`").try_cast("double")).alias(c) for c in names)) if names else df
    if least_distinct <= 2:
        found = [c for c, (share, low, high) in _covered_and_varied(read, names).items() if share >= least_coverage and (low is not None) + (low != high) >= least_distinct]
    else:
        found = [r["column"] for r in column_statistics(read, names).collect() if r["coverage"] >= least_coverage and r["n_distinct"] >= least_distinct]  # a row a column
    return found + [c for c in always if c in df.columns and c not in found]


def model_features(train: DataFrame, score: DataFrame, candidates: list[str], least_coverage: float = MODEL_COVERAGE) -> list[str]:
    """Candidates with enough values in training and more than one value overall."""
    names = [c for c in candidates if c in train.columns and c in score.columns]
    past, now = _covered_and_varied(train, names), _covered_and_varied(score, names)
    values = {c: {v for v in (*past[c][1:], *now[c][1:]) if v is not None} for c in names}
    return [c for c in names if past[c][0] >= least_coverage and len(values[c]) > 1]


def features_with_gaps(train: DataFrame, score: DataFrame, names: list[str], least_rate: float = MISSING_RATE) -> list[str]:
    rates = [{r["column"]: r["missing_rate"] for r in column_statistics(df, names).collect()} for df in (train, score)]
    return [c for c in names if max(r[c] for r in rates) >= least_rate]


def missing_flags(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({f"{c}__missing_flag": F.col(c).isNull().cast("double") for c in names})


def allowed_features(names: list[str], include: set[str] | None, exclude: set[str]) -> list[str]:
    return [n for n in names if n not in exclude and (not include or n in include)]


def score_column(df: DataFrame) -> str:
    for name in SCORE_PRIORITY:
        if name in df.columns:
            return name
    raise ValueError(f"none of the score columns {', '.join(SCORE_PRIORITY)}")


def balanced_selection(scores: DataFrame, n: int, id_col: str = "mono_id", band_col: str = "alert_band", score_col: str | None = None) -> DataFrame:
    """``n`` entities: half of them the highest scores outside the NORMAL band, the rest the lowest of it.

    Each entity counts once, by its highest score; ties go by id. Raises if either side has too few.
    """
    score_col = score_col or score_column(scores)
    top = scores.select(F.col(id_col).cast("string").alias(id_col), F.col(score_col).cast("double").alias("selection_score"), F.upper(F.trim(band_col)).alias(band_col)).where("selection_score IS NOT NULL")
    w = Window.partitionBy(id_col).orderBy(F.col("selection_score").desc(), band_col)
    top = top.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    normal = F.coalesce(F.col(band_col) == "NORMAL", F.lit(False))
    half = n // 2
    high = top.where(~normal).orderBy(F.col("selection_score").desc(), id_col).limit(half).withColumn("selection_group", F.lit("ANOMALY"))
    low = top.where(normal).join(high.select(id_col), id_col, "left_anti").orderBy("selection_score", id_col).limit(n - half).withColumn("selection_group", F.lit("NORMAL"))
    chosen = high.unionByName(low)
    counts = {r["selection_group"]: r["count"] for r in chosen.groupBy("selection_group").count().collect()}  # two rows
    if counts.get("ANOMALY", 0) < half or counts.get("NORMAL", 0) < n - half:
        raise ValueError(f"not enough entities for a balanced selection of {n}: {counts}")
    return chosen
