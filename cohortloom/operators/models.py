"""Isolation forest and autoencoder: fitted on all rows by Spark jobs, kept as tables, applied in vectorised batches.

Every random choice is a keyed hash of what it is about (a row's keys, a tree, a node, a weight), so a model depends on the
rows and the seed alone, neither on the partitioning nor on the order of rows, and SQL can make the same choices.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.sources.staging import staged

TREES, SUBSAMPLE = 150, 256
PASSES, PATIENCE, LEAST_GAIN = 40, 8, 1e-4
#: Steps of the weights: the first, the largest, and what they are multiplied with.
FIRST_STEP, MOST_STEP, GROWS, SHRINKS = 0.1, 1.0, 1.2, 0.5
MOST_HIDDEN, HELD_FROM, HELD_PART = 16, 50, 10
#: Hashes are taken modulo this prime.
PRIME = 2_147_483_647
#: Path lengths are whole numbers of this part of a split, so that their sums are exact in any order.
LENGTH_UNIT = 1e-9


def keyed(*key: object) -> int:
    """A number below ``PRIME`` for a key: the first eight hex digits of its md5."""
    return int(hashlib.md5(":".join(map(str, key)).encode()).hexdigest()[:8], 16) % PRIME


def row_hashes(keys: tuple[str, ...]) -> tuple[Column, Column]:
    """Two independent numbers below ``PRIME`` of a row's keys; missing ones count as empty text."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)))
    one, two = (F.pmod(F.conv(F.substring(digest, at, 8), 16, 10).cast("long"), F.lit(PRIME)) for at in (1, 9))
    return one, two


def _vector(names: list[str]) -> Column:
    return F.array(*(F.col(f"`{c}`").cast("double") for c in names))


def average_path(n: float) -> float:
    return 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else float(n == 2)


@dataclass(frozen=True)
class IsolationForest:
    """Trees by number of tree and node (root 1, children of node i are 2i and 2i + 1): split feature, -1 at a leaf, its threshold, and a leaf's path length."""

    feature: np.ndarray
    threshold: np.ndarray
    length: np.ndarray
    size: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher for rows that few splits isolate."""
        total = np.zeros(len(x), np.int64)
        for feature, threshold, length in zip(self.feature, self.threshold, self.length, strict=True):
            at = np.ones(len(x), np.int64)
            active = np.flatnonzero(feature[at] >= 0)
            while len(active):
                node = at[active]
                at[active] = 2 * node + (x[active, feature[node]] >= threshold[node])
                active = active[feature[at[active]] >= 0]
            total += length[at]
        return np.exp2(-(total * LENGTH_UNIT) / len(self.feature) / max(average_path(self.size), 1e-12))


FOREST_SCHEMA = "tree int, node int, feature int, threshold double, length long"


def grow_tree(x: np.ndarray, tree: int, seed: int) -> list[tuple[int, int, int, float, int]]:
    """Rows of ``FOREST_SCHEMA``. A node's feature is one of those that vary in it, its threshold lies between their extremes."""
    deepest = math.ceil(math.log2(max(len(x), 2)))
    out = []

    def grow(rows: np.ndarray, depth: int, node: int) -> None:
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        open_ = np.flatnonzero(high > low)
        if depth >= deepest or len(rows) <= 1 or not len(open_):
            out.append((tree, node, -1, 0.0, round((depth + average_path(len(rows))) / LENGTH_UNIT)))
            return
        k = int(open_[keyed(seed, tree, node, "feature") % len(open_)])
        cut = float(low[k] + keyed(seed, tree, node, "cut") / PRIME * (high[k] - low[k]))
        out.append((tree, node, k, cut, 0))
        above = rows[:, k] >= cut
        grow(rows[~above], depth + 1, 2 * node)
        grow(rows[above], depth + 1, 2 * node + 1)

    grow(x, 0, 1)
    return out


def tree_draws(df: DataFrame, names: list[str], keys: tuple[str, ...], trees: int = TREES, size: int = SUBSAMPLE, seed: int = 42) -> tuple[DataFrame, int]:
    """``tree, draw, row_key, x`` with for each tree the ``size`` rows of the smallest draws and a few more, and that size.

    A row's draw in a tree is a linear function of its two hashes, uniform and independent between rows. Each task sends
    only draws below a bound that leaves a few more than ``size`` a tree, however many rows there are; should a tree get
    fewer, the bound is doubled. Nothing is shuffled but these.
    """
    n = df.count()
    wanted = min(size, n)
    one, two = row_hashes(keys)
    numbers = F.array(*(F.struct(F.lit(t).alias("tree"), F.lit(keyed(seed, t, "a")).cast("long").alias("a"), F.lit(keyed(seed, t, "b")).cast("long").alias("b")) for t in range(trees)))
    rows = df.select(one.alias("h1"), two.alias("h2"), F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)).alias("row_key"), _vector(names).alias("x"))
    draws = F.transform(numbers, lambda s: F.struct(s["tree"].alias("tree"), ((F.col("h1") * s["a"] + F.col("h2") + s["b"]) % PRIME).alias("draw")))
    bound = math.ceil(PRIME * (wanted + 6 * math.sqrt(wanted) + 16) / max(n, 1))
    while True:
        drawn = staged(rows.select("row_key", "x", F.inline(F.filter(draws, lambda s: s["draw"] < min(bound, PRIME)))), "draws")
        least = drawn.groupBy("tree").count().agg(F.min("count"), F.count("*")).first()
        if bound >= PRIME or (least[1] == trees and least[0] >= wanted):
            return drawn, wanted
        bound *= 2


def fit_isolation_forest(df: DataFrame, names: list[str], keys: tuple[str, ...], trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 42) -> tuple[DataFrame, int]:
    """The forest as a table of ``FOREST_SCHEMA``, and the rows of each tree. Trees are grown on the executors, each of its own draws among all rows."""
    drawn, size = tree_draws(df, names, keys, trees, subsample, seed)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        order = sorted(range(len(rows)), key=lambda i: (rows["draw"].iloc[i], rows["row_key"].iloc[i], tuple(rows["x"].iloc[i])))[:size]
        return pd.DataFrame(grow_tree(np.array([rows["x"].iloc[i] for i in order], np.float64), tree, seed), columns=["tree", "node", "feature", "threshold", "length"])

    return staged(drawn.groupBy("tree").applyInPandas(fit, FOREST_SCHEMA), "forest"), size


def forest_of(table: DataFrame, size: int) -> IsolationForest:
    """The forest of a table, of which there are at most twice ``size`` rows a tree."""
    nodes = table.toPandas()
    shape = (int(nodes["tree"].max()) + 1, int(nodes["node"].max()) + 1)
    feature, threshold, length = np.full(shape, -1, np.int64), np.zeros(shape), np.zeros(shape, np.int64)
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    feature[at], threshold[at], length[at] = nodes["feature"], nodes["threshold"], nodes["length"]
    return IsolationForest(feature, threshold, length, size)


@dataclass(frozen=True)
class Autoencoder:
    """One hidden layer of rectified units; all weights as one vector: into the layer, its biases, out of it, their biases."""

    weights: np.ndarray
    d: int
    hidden: int

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        d, h = self.d, self.hidden
        ends = np.cumsum([d * h, h, h * d, d])
        a, b, c, e = np.split(self.weights, ends[:-1])
        return a.reshape(d, h), b, c.reshape(h, d), e

    def errors(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.parts()
        return ((np.maximum(x @ w1 + b1, 0) @ w2 + b2 - x) ** 2).mean(axis=1)

    def gradient(self, x: np.ndarray) -> np.ndarray:
        """Of the sum of squared errors of all rows and columns; then that sum."""
        w1, b1, w2, b2 = self.parts()
        raw = x @ w1 + b1
        active = np.maximum(raw, 0)
        off = active @ w2 + b2 - x
        delta = 2 * off
        back = (delta @ w2.T) * (raw > 0)
        return np.concatenate([(x.T @ back).ravel(), back.sum(axis=0), (active.T @ delta).ravel(), delta.sum(axis=0), [(off * off).sum()]])


def autoencoder_start(d: int, seed: int = 42) -> Autoencoder:
    """Weights before the first step, uniform within a bound that the layers' sizes give."""
    hidden = max(1, min(MOST_HIDDEN, d // 2))
    bound = math.sqrt(6 / (d + hidden))
    return Autoencoder(np.array([(2 * keyed(seed, i, "weight") / PRIME - 1) * bound for i in range(2 * d * hidden + hidden + d)]), d, hidden)


def descend(start: Autoencoder, sums: Callable[[Autoencoder], np.ndarray], n: int, n_held: int, passes: int, patience: int) -> Autoencoder:
    """Resilient propagation: each weight has a step of its own, which grows while its gradient keeps its sign and shrinks
    where that turns. A pass over all rows is a step; 40 get as far as three times as many of plain adaptive descent.

    ``sums`` gives the gradient of the summed errors, these, and those of the rows that are held out. Where there are any,
    the weights of the least held-out loss are kept, and ``patience`` passes without a gain end the descent.
    """
    model, best, best_loss, waited = start, start, math.inf, 0
    step, before = np.full_like(start.weights, FIRST_STEP), np.zeros_like(start.weights)
    for _ in range(passes):
        found = sums(model)
        if n_held:
            loss = found[-1] / (n_held * start.d)
            if loss < best_loss - LEAST_GAIN:
                best, best_loss, waited = model, loss, 0
            else:
                waited += 1
                if waited >= patience:
                    break
        g = found[:-2] / max(n * start.d, 1)
        turned = np.sign(g * before)
        step = np.where(turned > 0, np.minimum(step * GROWS, MOST_STEP), np.where(turned < 0, step * SHRINKS, step))
        before = np.where(turned < 0, 0.0, g)
        model = Autoencoder(model.weights - np.sign(before) * step, start.d, start.hidden)
    return best if n_held else model


def _pass(batches: Iterator[pa.RecordBatch], model: Autoencoder) -> Iterator[pa.RecordBatch]:
    """A task's sums, by their place."""
    total = np.zeros(len(model.weights) + 2)
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, model.d)
        held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
        total[:-1] += model.gradient(x[~held])
        total[-1] += model.errors(x[held]).sum() * model.d
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["place", "value"])


def fit_autoencoder(df: DataFrame, names: list[str], keys: tuple[str, ...], passes: int = PASSES, patience: int = PATIENCE, seed: int = 42) -> Autoencoder:
    """Fitted on all rows, but a tenth by their hash that is held out where there are 50 or more.

    A pass is one Spark job: tasks add up the gradients of their rows, the partial sums are added by place, and only as
    many numbers as the model has weights reach the driver.
    """
    held = (row_hashes(keys)[1] % HELD_PART) == 0
    rows = staged(df.select(_vector(names).alias("x"), held.alias("held")), "vectors")
    n, n_held = rows.agg(F.count("*"), F.count_if("held")).first()
    if n < HELD_FROM:
        n_held, rows = 0, rows.withColumn("held", F.lit(False))

    def sums(model: Autoencoder) -> np.ndarray:
        found = rows.mapInArrow(partial(_pass, model=model), "place int, value double").groupBy("place").agg(F.sum("value")).collect()  # a row a weight
        out = np.zeros(len(model.weights) + 2)
        for place, value in found:
            out[place] = value
        return out

    return descend(autoencoder_start(len(names), seed), sums, n - n_held, n_held, passes, patience)


def model_score(model: IsolationForest | Autoencoder, names: list[str]) -> Column:
    """The model's raw score of a row's columns."""
    apply = model.scores if isinstance(model, IsolationForest) else model.errors

    @F.pandas_udf("double")
    def scored(*columns: pd.Series) -> pd.Series:
        return pd.Series(apply(np.column_stack([c.to_numpy(np.float64) for c in columns])))

    return scored(*(F.col(f"`{c}`") for c in names))
