"""Exact quantiles of groups of any size, by ranks over range partitions.

``percentile`` keeps all distinct values of a group in one task's memory. Here values are first counted by group and band, a
32nd of an octave; the counts tell in which bands the asked ranks are, and only values of those are dealt on, by ranges of
group and value. The sums of each band in each range tell in which ranges the asked ranks are; running sums are made in those
ranges alone, moved up by what comes before, and only the values at the asked ranks are kept. A group that has a third of all
values is therefore counted by all tasks before anything is shuffled, and a band that has them is spread over a third of the
ranges.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.sources.staging import staged

#: Bands an octave, and the octaves below 1 that a double can have.
BANDS, LEAST_OCTAVE = 32, 1075


def interpolated(q: Column, of: Callable[[Column], Column] = lambda x: x) -> Column:
    """The quantile from the two values around it, or that of an increasing function of the values."""
    return F.when(q["low"] == q["high"], of(q["low"])).otherwise(q["low_part"] * of(q["low"]) + q["high_part"] * of(q["high"]))


def band_of(value: Column) -> Column:
    """A whole number that never falls as the value rises; infinities and NaN have the outermost ones."""
    finite = F.floor((F.log2(F.abs(value)) + LEAST_OCTAVE) * BANDS) + 1
    far = F.lit(2 * LEAST_OCTAVE * BANDS)
    size = F.when(value == 0, F.lit(0).cast("long")).when(F.isnan(value) | (F.abs(value) == float("inf")), far + F.isnan(value).cast("long")).otherwise(finite)
    return (F.when(value < 0, -size).otherwise(size)).cast("int")


def grouped_quantiles(df: DataFrame, keys: list[str], value: Column, quantiles: dict[str, float], weight: Column | None = None) -> DataFrame:
    """``keys, n`` and for each quantile a struct that ``interpolated`` reads; groups without a value have no row.

    Missing values are left out, keys may be missing. ``keys`` may be empty: then all rows are one group. ``weight`` is how
    many rows a row stands for, where that isn't one. ``df`` is read twice, so it should be a table.
    """
    rows = df.select(*keys, value.cast("double").alias("__v"), (F.lit(1) if weight is None else weight).cast("long").alias("__c")).where("__v IS NOT NULL").withColumn("__band", band_of(F.col("__v")))
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    place = {name: (F.col("n") - 1) * F.lit(q) for name, q in quantiles.items()}
    any_rank = lambda at: reduce(lambda a, b: a | b, (at(f(p)) for p in place.values() for f in (F.floor, F.ceil)))
    from_to = lambda rank: (F.col("__before") <= rank) & (rank < F.col("__before") + F.col("__sum"))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]

    bands = rows.groupBy(*keys, "__band").agg(F.sum("__c").alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy(*keys).orderBy("__band")) - F.col("__sum")
    bands = bands.select(*named, F.col("__band").alias("__b"), "__sum", before.alias("__before"), F.sum("__sum").over(Window.partitionBy(*keys)).alias("n"))
    asked = staged(bands.where(any_rank(from_to)).drop("__sum"), "quantile-bands")
    near = rows.join(asked, reduce(lambda a, b: a & b, same, F.col("__band") == F.col("__b"))).groupBy(*keys, "__band", "__before", "n", "__v").agg(F.sum("__c").alias("__c"))
    dealt = staged(near.repartitionByRange(*keys, "__v").withColumn("__part", F.spark_partition_id()), "quantiles")

    of_band = [*keys, "__band"]
    sums = dealt.groupBy(*of_band, "__before", "n", "__part").agg(F.sum("__c").alias("__sum"))
    in_turn = F.col("__before") + F.sum("__sum").over(Window.partitionBy(*of_band).orderBy("__part")) - F.col("__sum")
    parts = sums.select(*named, F.col("__band").alias("__b"), F.col("__part").alias("__p"), "__sum", in_turn.alias("__before"), "n")
    parts = parts.where(any_rank(from_to)).drop("__sum", "n")
    here = reduce(lambda a, b: a & b, same, (F.col("__part") == F.col("__p")) & (F.col("__band") == F.col("__b")))
    within = Window.partitionBy("__part", *of_band).orderBy("__v")
    ranked = dealt.drop("__before").join(parts, here).withColumn("__end", F.sum("__c").over(within) + F.col("__before")).withColumn("__start", F.col("__end") - F.col("__c"))
    at = lambda rank: (F.col("__start") <= rank) & (rank < F.col("__end"))
    found = ranked.where(any_rank(at)).groupBy(*keys, "n").agg(*(F.max(F.when(at(f(p)), F.col("__v"))).alias(f"__{name}_{end}") for name, p in place.items() for end, f in (("low", F.floor), ("high", F.ceil))))
    made = lambda name, p: F.struct(F.col(f"__{name}_low").alias("low"), F.col(f"__{name}_high").alias("high"), (F.ceil(p) - p).alias("low_part"), (p - F.floor(p)).alias("high_part")).alias(name)
    return found.select(*keys, "n", *(made(name, p) for name, p in place.items()))
