"""Panels, peers, scoring, selection and evidence on small frames."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.functions.text import assessment
from cohortloom.operators import evidence, models, panel, peers, reasons, scoring, selection


def d(text):
    return dt.date.fromisoformat(text)


def test_intake(spark):
    raw = spark.createDataFrame([(" 1 ", "31.01.2025", "1.234,5", float("nan")), ("2", "bad", "7", 1.0)], "` MONO_ID ` string, COHORT_DT string, Amount string, Other double")
    got = panel.intake(raw, numeric=["amount"]).collect()
    assert [tuple(r) for r in got] == [("1", d("2025-01-31"), 1234.5, None)]


def test_months_and_windows(spark):
    df = spark.createDataFrame([("a", d("2025-01-31"), 1.0), ("a", d("2025-02-28"), 2.0), ("b", d("2025-02-28"), 3.0), ("a", d("2025-03-31"), 4.0)], "mono_id string, cohort_dt date, v double")
    assert panel.scoring_month(df) == d("2025-03-31") and panel.scoring_month(df, "28.02.2025") == d("2025-02-28")
    with pytest.raises(ValueError):
        panel.scoring_month(df, "2024-01-31")
    with pytest.raises(ValueError):
        panel.scoring_month(df.limit(0))
    before, at = panel.split(df, d("2025-03-31"))
    assert before.count() == 3 and at.count() == 1
    assert sorted((r.mono_id, r.v) for r in panel.latest_before(df, d("2025-03-31")).collect()) == [("a", 2.0), ("b", 3.0)]
    assert [r.mono_id for r in panel.in_requested_order(df, ["b", "a", "zz", "b"]).collect()] == ["b", "a"]
    assert panel.hash_sample(df, 2).collect() == panel.hash_sample(df.repartition(3), 2).collect()


def test_selection_of_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5.0, "1"), (2.0, None, 5.0, "x"), (3.0, 1.0, 5.0, None)], "a double, b double, c double, t string")
    assert selection.numeric_columns(df, ()) == ["a"] and selection.numeric_columns(df, (), 0.05, 1, always=("t",)) == ["a", "b", "c", "t"]
    assert selection.model_features(df, df, ["a", "b", "c", "zz"]) == ["a"]
    assert selection.features_with_gaps(df, df, ["a", "b"]) == ["b"]
    assert selection.allowed_features(["a", "b", "c"], {"a", "b"}, {"b"}) == ["a"]


def test_size_buckets(spark):
    rows = [(f"m{i}", d("2025-01-31"), float(i)) for i in range(8)] + [("x", d("2025-02-28"), 1.0), ("y", d("2025-02-28"), None)] + [(f"s{i}", d("2025-03-31"), 3.0) for i in range(9)]
    df = spark.createDataFrame(rows, "mono_id string, cohort_dt date, v double")
    got = {r.mono_id: r.peer_size for r in peers.size_buckets(df, F.col("v")).collect()}
    assert [got[f"m{i}"] for i in range(8)] == ["S1", "S1", "S2", "S2", "S3", "S3", "S4", "S4"]
    assert {got["x"], got["y"], got["s0"]} == {"SIZE_NA"}


def test_peer_hierarchy_falls_back(spark):
    rnd = random.Random(1)
    rows = [(f"a{i}", d("2025-01-31"), "s1", "k1", "S1", "f", rnd.gauss(100, 5)) for i in range(60)]
    rows += [(f"b{i}", d("2025-01-31"), "s1", "k2", "S1", "f", rnd.gauss(100, 5)) for i in range(10)]
    rows += [(f"c{i}", d("2025-01-31"), "s2", "k1", "S2", "f", rnd.gauss(100, 5)) for i in range(10)] + [("n", d("2025-01-31"), "s1", "k1", "S1", "f", None)]
    rows += [("lone", d("2025-02-28"), "s1", "k1", "S1", "f", 1000.0)]
    long = spark.createDataFrame(rows, "mono_id string, cohort_dt date, peer_segment string, peer_sector string, peer_size string, feature string, value double")
    got = {r.mono_id: r for r in peers.peer_references(long).collect()}
    assert len(got) == len(rows)
    assert got["a0"].peer_level == "AY_SEGMENT_SEKTOR_SIZE" and got["a0"].peer_support == 60
    assert got["b0"].peer_level == "AY_SEGMENT_SIZE" and got["b0"].peer_support == 70
    assert got["c0"].peer_level == "AY" and got["c0"].peer_support == 80 and got["c0"].peer_quality == "ZAYIF"
    assert got["lone"].peer_level == "GLOBAL_FEATURE" and got["lone"].peer_support == 0 and got["lone"].peer_z == 10
    assert got["n"].peer_z is None and got["n"].peer_median is not None
    a = np.array([r[6] for r in rows if r[0].startswith("a")])
    t = np.log1p(a)
    z = (t - np.median(t)) / (1.4826 * np.median(np.abs(t - np.median(t))))
    assert all(abs(got[f"a{i}"].peer_z - np.clip(z[i], -10, 10)) < 1e-9 for i in range(60))
    assert all(r.peer_z is None or -10 <= r.peer_z <= 10 for r in got.values())


def test_peer_diagnostics_fail(spark):
    rows = [("GUCLU", "AY", 20)] * 30 + [("KABUL_EDILEBILIR", "AY_SEGMENT", 60)] * 40 + [("ZAYIF", "AY_SEGMENT_SIZE", 60)] * 30
    r = peers.peer_diagnostics(spark.createDataFrame(rows, "peer_quality string, peer_level string, peer_support long")).first()
    assert (r.total, r.strong_pct, r.weak_pct, r.narrow_pct, r.result) == (100, 30, 30, 30, "FAIL")
    assert [x[0] for x in spark.createDataFrame([("PASS",), ("WARN",)], "r string").select(assessment(F.col("r"))).collect()] == ["PEER_SET_KURUMSAL_OLARAK_GUCLU", "PEER_SET_KABUL_EDILEBILIR_EK_KONTROL_GEREKIR"]


def test_bands(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "s double")
    t = scoring.band_thresholds(df, "s")
    assert t["kirmizi"] >= 97.5 and t["turuncu"] >= 95 and t["sari"] >= 90 and t["sari"] <= t["turuncu"] <= t["kirmizi"]
    n = {r[0]: r[1] for r in df.groupBy(scoring.band(F.col("s"), t).alias("b")).count().collect()}
    assert n["KIRMIZI"] == 1 and n.get("TURUNCU", 0) <= 2
    assert scoring.band_thresholds(df.limit(0), "s") == {"sari": 90.0, "turuncu": 95.0, "kirmizi": 97.5}


def test_percentile_and_preprocessor(spark):
    df = spark.createDataFrame([(float(i), None if i % 10 == 0 else float(i * i)) for i in range(100)], "a double, b double")
    got = {r.a: (r.p, r.q) for r in scoring.percentiles(df, df.where("a < 50"), {"a": "p", "b": "q"}).collect()}
    assert got[0][0] == 2 and got[49][0] == 100 and got[99][0] == 100 and got[0][1] == 100 and got[1][1] == pytest.approx(2)
    p = scoring.fit_preprocessor(df, ["a", "b"])
    x = df.select(*p.expressions()).toPandas()
    assert x.notna().all().all() and abs(x["a"].median()) < 1e-6
    raw = np.arange(100.0)
    bounded = np.log1p(np.clip(raw, *np.quantile(raw, [0.01, 0.99])))
    want = (bounded - np.median(bounded)) / np.subtract(*np.quantile(bounded, [0.75, 0.25]))
    assert np.allclose(sorted(x["a"]), want)


NAMES = list("abcd")


@pytest.fixture(scope="module")
def vectors():
    x = np.random.default_rng(0).normal(size=(500, 4))
    x[:, 1] = x[:, 0] * 2
    return x


def vector_table(spark, x):
    return spark.createDataFrame([(f"k{i}", *map(float, r)) for i, r in enumerate(x)], "k string, a double, b double, c double, d double")


def test_isolation_forest_and_autoencoder(spark, vectors):
    df, odd = vector_table(spark, vectors), np.array([[8.0, -8.0, 8.0, -8.0]])
    forest = models.forest_of(*models.fit_isolation_forest(df, NAMES, ("k",)))
    coder = models.fit_autoencoder(df, NAMES, ("k",))
    assert forest.scores(odd)[0] > np.quantile(forest.scores(vectors), 0.99) and coder.errors(odd)[0] > np.quantile(coder.errors(vectors), 0.99)
    got = [r[0] for r in df.select(models.model_score(forest, NAMES)).collect()]
    assert np.allclose(sorted(got), sorted(forest.scores(vectors)))


def draws_by_hand(tree, seed, n):
    """The order of all rows in a tree's draw."""
    def draw(i):
        digest = hashlib.md5(f"k{i}".encode()).hexdigest()
        one, two = (int(digest[at : at + 8], 16) % models.PRIME for at in (0, 8))
        return (one * models.keyed(seed, tree, "a") + two + models.keyed(seed, tree, "b")) % models.PRIME, f"k{i}"

    return sorted(range(n), key=draw)


def test_trees_draw_among_all_rows_however_they_lie(spark, vectors):
    """Each tree is grown of the smallest draws of the whole table, whatever the partitioning; so no cap on rows can change it."""
    df = vector_table(spark, vectors)
    for size in (64, 256, 1000):
        table, n = models.fit_isolation_forest(df.repartition(7, "a"), NAMES, ("k",), trees=5, subsample=size, seed=3)
        assert n == min(size, 500)
        want = [node for tree in range(5) for node in models.grow_tree(vectors[draws_by_hand(tree, 3, 500)[:n]], tree, 3)]
        assert sorted(map(tuple, table.collect())) == sorted(want)
    drawn, _ = models.tree_draws(df, NAMES, ("k",), trees=20, size=16)
    assert drawn.count() < 20 * 120  # what leaves the tasks is bounded by trees and size


def test_draws_are_repeated_when_the_bound_was_too_low(spark, vectors, monkeypatch):
    monkeypatch.setattr(models.math, "sqrt", lambda _: -2.6)  # a bound for fewer rows than are wanted
    drawn, size = models.tree_draws(vector_table(spark, vectors), NAMES, ("k",), trees=4, size=64)
    assert size == 64 and min(r["count"] for r in drawn.groupBy("tree").count().collect()) >= 64


def test_forest_of_few_and_of_equal_rows(spark):
    one = vector_table(spark, np.ones((1, 4)))
    same = vector_table(spark, np.ones((30, 4)))
    for df in (one, same):
        forest = models.forest_of(*models.fit_isolation_forest(df, NAMES, ("k",), trees=3))
        assert len(set(forest.scores(np.ones((3, 4))))) == 1


def test_autoencoder_is_the_same_as_on_the_driver(spark, vectors):
    """Partial gradients of any partitioning add up to those of one matrix."""
    held = np.array([int(hashlib.md5(f"k{i}".encode()).hexdigest()[8:16], 16) % models.PRIME % 10 == 0 for i in range(len(vectors))])

    def sums(model):
        return np.concatenate([model.gradient(vectors[~held]), [model.errors(vectors[held]).sum() * 4]])

    want = models.descend(models.autoencoder_start(4), sums, (~held).sum(), held.sum(), 15, models.PATIENCE)
    for parts in (1, 6):
        got = models.fit_autoencoder(vector_table(spark, vectors).repartition(parts), NAMES, ("k",), passes=15)
        assert np.abs(got.weights - want.weights).max() < 1e-6
    few = models.fit_autoencoder(vector_table(spark, vectors[:20]), NAMES, ("k",), passes=5)  # too few to hold any out
    assert few.errors(vectors[:20]).mean() < models.autoencoder_start(4).errors(vectors[:20]).mean()


def test_gradient_is_that_of_the_loss(vectors):
    start, x = models.autoencoder_start(4), vectors[:40]
    found = start.gradient(x)
    assert found[-1] == pytest.approx(start.errors(x).sum() * 4)
    for i in range(len(start.weights)):
        ends = []
        for step in (1e-6, -1e-6):
            moved = start.weights.copy()
            moved[i] += step
            ends.append(models.Autoencoder(moved, 4, start.hidden).errors(x).sum() * 4)
        assert found[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-3)


def test_balanced_selection(spark):
    rows = [(f"A{i}", 99.0 - i, "KIRMIZI") for i in range(8)] + [(f"N{i}", 1.0 + i, "NORMAL") for i in range(8)]
    df = spark.createDataFrame(rows, "mono_id string, ensemble_score double, alert_band string")
    got = [r.mono_id for r in selection.balanced_selection(df, 12).collect()]
    assert sorted(got) == [f"A{i}" for i in range(6)] + [f"N{i}" for i in range(6)]
    with pytest.raises(ValueError):
        selection.balanced_selection(df, 20)
    assert selection.score_column(df.withColumnRenamed("ensemble_score", "autoencoder_score")) == "autoencoder_score"


def test_reasons_are_ranked_for_review(spark):
    rows = [("e", "net_profit", 40.0, 5.0, 2.0), ("e", "debt", 10.0, 5.0, 2.0), ("e", "sales", 30.0, 5.0, 2.0), ("e", "gone", 5.0, None, 2.0), ("e", "zero", 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "mono_id string, feature string, severity double, value double, peer_median double")
    df = df.withColumns({"previous": F.lit(None).cast("double"), "train_reference": F.lit(1.0), "peer_z": F.lit(3.0), "peer_support": F.lit(60), "peer_level": F.lit("AY_SEGMENT"), "peer_score": F.lit(70.0), "peer_quality": F.lit("KABUL_EDILEBILIR")})
    r = reasons.build_reasons(df, ["mono_id"], 3, {"debt": "Debt!"}).first()
    assert [x.feature for x in r.reasons] == ["debt", "gone", "sales"] and r.reasons[0].label == "Debt!"
    assert r.reasons[0].contribution_pct == round(10 / 85 * 100, 2) and r.reason_texts[0].startswith("Debt!: peer'e gore sapma yuksek; gerceklesen=5; peer=2; peer_z=3;")
    assert r.reason_texts[1].startswith("gone: deger missing; katki %5.9; referans=peer medyan")


@pytest.mark.parametrize(
    ("args", "want"),
    [((1.0, 2.0, 3.0, 4.0, 2.5, 0.0, 9.0), "peer medyan"), ((1.0, 2.0, 3.0, 4.0, 1.0, 1.0, 9.0), "musteri onceki ay"), ((1.0, None, 3.0, 4.0, 1.0, 1.0, 9.0), "peer medyan"), ((1.0, None, None, 4.0, None, 0.0, 0.0), "train medyan"), ((None, 2.0, None, 4.0, None, 0.0, 0.0), "train medyan"), ((None, 2.0, None, None, None, 0.0, 0.0), None), ((1.0, 2.0, 3.0, 4.0, 0.0, 5.0, 5.0), "peer medyan")],
)
def test_reference_choice(spark, args, want):
    got = spark.range(1).select(reasons.choose_reference(*(F.lit(a).cast("double") for a in args)).alias("r")).first().r
    assert got.label == want


def _history(spark, values, start=2024):
    rows = [("e", "f", dt.date(start + i // 12, i % 12 + 1, 28), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "mono_id string, feature string, cohort_dt date, value double")


def test_history_and_trend(spark):
    values = [10.0, 12.0, None, 11.0, 13.0, 12.0, 14.0]
    h = _history(spark, values)
    known = np.array([v for v in values if v is not None])
    r = evidence.history_metrics(h).first()
    assert r.period_count == 6 and r.median == np.median(known) and r.rolling_3m_median == np.median(known[-3:]) and r.previous_value == 14
    assert r.robust_scale == pytest.approx(1.4826 * np.median(np.abs(known - np.median(known))))
    now = spark.createDataFrame([("e", "f", 40.0)], "mono_id string, feature string, value double")
    t = evidence.trend_metrics(h, now).first()
    tail = np.append(known, 40.0)
    assert t.trend_break_flag and t.slope_6m == pytest.approx(np.polyfit(range(6), tail[-6:], 1)[0]) and t.slope_12m == pytest.approx(np.polyfit(range(7), tail, 1)[0])
    short = evidence.trend_metrics(_history(spark, [1.0, 2.0]), now).first()
    assert short.slope_6m is None and not short.trend_break_flag
    single = evidence.history_metrics(_history(spark, [5.0])).first()
    assert single.robust_scale is None and single.median == 5


def test_same_month(spark):
    h = _history(spark, [float(i) for i in range(24)], 2022)
    now = spark.createDataFrame([("e", "f", 30.0)], "mono_id string, feature string, value double")
    r = evidence.same_month_metrics(h, now, d("2024-03-28")).first()
    assert r.same_month_last_year_value == 14 and r.same_month_customer_median == 8 and r.yoy_change_pct == pytest.approx(16 / 14 * 100) and r.same_month_customer_z == pytest.approx(22 / (6 * 1.4826))


@pytest.mark.parametrize("values", [[], [None, None]])
def test_series_of_nothing_but_now(spark, values):
    h = _history(spark, values)
    now = spark.createDataFrame([("e", "f", 123.0)], "mono_id string, feature string, value double")
    s = evidence.snapshot_series(h, now, d("2026-05-31")).first().series
    assert [tuple(x) for x in s] == [("2026-05-31", 123.0, True)]


def test_series_keeps_the_last_months(spark):
    h = _history(spark, [float(i) for i in range(12)]).unionByName(spark.createDataFrame([("e", "f", d("2025-01-31"), 7.0)], "mono_id string, feature string, cohort_dt date, value double"))
    now = spark.createDataFrame([("e", "f", 8.0)], "mono_id string, feature string, value double")
    s = evidence.snapshot_series(h, now, d("2025-01-31"), 3).first().series
    assert [tuple(x) for x in s] == [("2024-11-28", 10.0, False), ("2024-12-28", 11.0, False), ("2025-01-31", 8.0, True)]


def test_percentiles_count_all_rows(spark):
    rnd = np.random.default_rng(4)
    reference, x = np.round(rnd.normal(size=3000), 2), np.round(rnd.normal(size=200), 2)
    x[:3] = (-9.0, 9.0, 0.0)
    frame = lambda values: spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {(r.v, r.p) for r in scoring.percentiles(frame(x), frame(reference), {"v": "p"}).collect()}
    assert got == {(v, np.searchsorted(np.sort(reference), v, side="right") / 3000 * 100.0) for v in x}
    assert {r.p for r in scoring.percentiles(frame(x), frame([]), {"v": "p"}).collect()} == {0.0}
    assert scoring.percentiles(spark.createDataFrame([(None,)], "v double"), frame(reference), {"v": "p"}).first().p == 100.0


def test_column_statistics_count_values_without_copying_rows_by_columns(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (-0.0, 2, "a"), (0.0, 2, None), (None, 3, "")], "x double, `y.z` int, t string")
    got = selection.column_statistics(df, ["x", "y.z", "t"])
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.column: (r.coverage, r.n_distinct, r.missing_rate) for r in got.collect()} == {"x": (0.75, 2, 0.25), "y.z": (0.75, 2, 0.25), "t": (0.75, 2, 0.25)}
    empty = selection.column_statistics(df.limit(0), ["x", "t"]).collect()
    assert {(r.column, r.coverage, r.n_distinct, r.missing_rate) for r in empty} == {("x", 0.0, 0, 1.0), ("t", 0.0, 0, 1.0)}
    assert selection.numeric_columns(df, ()) == ["x", "y.z"] and selection.numeric_columns(df, (), least_distinct=3) == []


def test_medians_of_seasons_and_scales_are_counted_by_ranks(spark):
    """No plan of theirs keeps all values of a group in one buffer, and they are the exact ones."""
    rnd = random.Random(4)
    rows = [(f"m{i}", d(f"20{20 + i % 4}-05-31"), "f", rnd.choice([None, rnd.gauss(0, 9)]), f"s{i % 2}", f"t{i % 3}", f"z{i % 2}") for i in range(900)]
    train = spark.createDataFrame(rows, "mono_id string, cohort_dt date, feature string, value double, peer_segment string, peer_sector string, peer_size string")
    medians = evidence.seasonal_peer_medians(train, d("2024-05-31"))
    scales = evidence.reference_scales(train)
    for df in (medians, scales):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan and "median(" not in plan
    got = {(r.level, r.peer_segment, r.peer_sector, r.peer_size): (r.n, r.seasonal_median) for r in medians.collect()}
    want = {}
    for level, keys in peers.LEVELS.items():
        groups = {}
        for *_, v, s, t, z in rows:
            if v is not None:
                groups.setdefault((level, *(x if k in keys else None for k, x in (("peer_segment", s), ("peer_sector", t), ("peer_size", z)))), []).append(v)
        want |= {k: (len(v), pytest.approx(float(np.median(v)))) for k, v in groups.items() if len(v) >= 50 or level == "AY"}
    assert got == want
    values = np.array([r[3] for r in rows if r[3] is not None])
    assert scales.first().reference_scale == pytest.approx(np.median(np.abs(values - np.median(values))) * 1.4826)
