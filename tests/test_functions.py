"""Expressions and formulas on small frames with known values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import jsontext, numeric, text
from cohortloom.functions.formula import FormulaError, compile_formulas, parse_formula


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


def test_safe_ratio_values(spark):
    df = spark.createDataFrame([(1000.0, 0.01), (1000.0, 0.5), (1000.0, 10000.0)], "n double, d double")
    got = [r[0] for r in df.select(compile_formulas(df, {"r": "n / d"})["r"]).collect()]
    assert got[:2] == [None, None] and math.isclose(got[2], 0.1)


def test_bad_denominators_by_row(spark):
    df = spark.createDataFrame([(1000.0, 0.01, 0.01), (1000.0, 10000.0, 5000.0)], "risk double, assets double, sales double")
    made = compile_formulas(df, {"a": "risk / assets", "s": "risk / sales"})
    got = [tuple(r) for r in df.select(made["a"], made["s"]).collect()]
    assert got[0] == (None, None) and math.isclose(got[1][0], 0.1) and math.isclose(got[1][1], 0.2)


def test_formula_precedence(spark):
    df = spark.createDataFrame([(10.0, 2.0, 3.0)], "a double, b double, c double")
    made = compile_formulas(df, {"x": "(a / b) * c + 1", "y": "a * b / c", "z": "a + b * a + c / c", "w": "-a + +b", "v": "x + 1"})
    r = df.select(*(c.alias(k) for k, c in made.items())).first()
    assert r.x == 16 and math.isclose(r.y, 20 / 3) and r.z == 31 and r.w == -8 and r.v == 17


def test_formula_rejects_everything_else(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    for bad in ("a ** 2", "f(a)", "a if a else 1", "a[0]", "a.b", "a +", "'x'", "True", "a // 2"):
        with pytest.raises(FormulaError):
            parse_formula(bad)
        assert df.select(compile_formulas(df, {"x": bad})["x"]).first()[0] is None
    assert df.select(compile_formulas(df, {"x": "nowhere / a"})["x"]).first()[0] is None


def test_formula_on_empty_and_null_frames(spark):
    df = spark.createDataFrame([(None, None)], "n double, d double")
    assert df.select(compile_formulas(df, {"r": "n / d"})["r"]).first()[0] is None
    assert df.limit(0).select(compile_formulas(df.limit(0), {"r": "n / (n / d)"})["r"]).count() == 0


@pytest.mark.parametrize(
    ("given", "want"),
    [("1.234,56", 1234.56), ("1.234", 1.234), (" 12 345,5 ", 12345.5), ("1 000", 1000.0), ("", None), ("nan", None), ("None", None), ("x", None), ("-3,5", -3.5), ("1e3", 1000.0), ("Infinity", None), ("1,2,3", None)],
)
def test_locale_number(spark, given, want):
    assert one(spark, numeric.locale_number(F.lit(given))) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("2025-01-31", "2025-01-31"), ("2025-01-31 09:00:00", "2025-01-31"), ("31.01.2025", "2025-01-31"), ("01.04.2025 09:00:00", "2025-04-01"), ("31/01/2025", "2025-01-31"), ("20250131", "2025-01-31"), ("2025-02-30", None), ("", None), ("soon", None)],
)
def test_mixed_date(spark, given, want):
    assert one(spark, F.date_format(text.mixed_date(F.lit(given)), "yyyy-MM-dd")) == want


def test_finite_and_clip(spark):
    for bad in ("NaN", "Infinity", "-Infinity"):
        assert one(spark, numeric.finite(F.lit(bad).cast("double"))) is None
    assert one(spark, numeric.clip(F.lit(None).cast("double"), -1, 1)) is None
    assert one(spark, numeric.clip(F.lit(5.0), -1, 1)) == 1
    assert one(spark, numeric.peer_z(F.lit(3.0), F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, numeric.peer_z(F.lit(300.0), F.lit(1.0), F.lit(1.0))) == 10


@pytest.mark.parametrize(("n", "want"), [(10, 0.2), (50, 0.6), (100, 0.75), (200, 0.9), (500, 1.0)])
def test_support_score(spark, n, want):
    assert one(spark, numeric.support_score(F.lit(n))) == want


def test_peer_quality(spark):
    levels, support = ["AY_SEGMENT_SEKTOR_SIZE", "AY_SEGMENT", "AY", "GLOBAL_FEATURE"], [250, 80, 1000, 1000]
    df = spark.createDataFrame(list(zip(levels, support, strict=True)), "level string, support long")
    got = df.select(text.quality_label(F.col("support"), numeric.representativeness(F.col("level"), F.col("support")), F.col("level"))).collect()
    assert [r[0] for r in got] == ["GUCLU", "KABUL_EDILEBILIR", "ZAYIF", "ZAYIF"]
    assert one(spark, numeric.representativeness(F.lit("GLOBAL_FEATURE"), F.lit(0))) == pytest.approx(23.2, abs=0.06)


def test_direction(spark):
    say = lambda name, x, ref: one(spark, text.direction_comment(text.risk_direction(F.lit(name)), F.lit(x).cast("double"), F.lit("peer medyan"), F.lit(ref).cast("double")))
    assert say("bank_risk", 2.0, 1.0) == "peer medyan gore artmis; risk artisi"
    assert say("bank_risk", 1.0, 2.0) == "peer medyan gore azalmis; risk azalisi"
    assert say("equity", 1.0, 2.0) == "peer medyan gore azalmis; risk artisi"
    assert say("sales", 1.0, 2.0) == "peer medyan gore azalmis; yon etkisi tanimsiz"
    assert say("equity", 1.0, 1.0) == "peer medyan ile ayni seviyede"
    assert say("equity", None, 1.0) == "deger missing oldugu icin yon yorumu yok"
    assert say("equity", 1.0, None) == "referans olmadigi icin yon yorumu yok"
    assert one(spark, text.risk_direction(F.lit("margin_pd"))) == "HIGHER_IS_RISKY"
    assert one(spark, text.risk_direction(F.lit("margin_pd"), falls_first=True)) == "LOWER_IS_RISKY"
    assert one(spark, text.risk_direction(F.lit("margin_pd"), F.lit(" lower_is_risky "))) == "LOWER_IS_RISKY"


@pytest.mark.parametrize(("x", "want"), [(None, "NA"), (0.0, "0"), (1234.5, "1234"), (12.5, "12.5"), (12.0, "12"), (1.2344, "1.234"), (0.05, "0.05"), (0.00012, "0.00012"), (0.000012, "1.20e-05"), (-2500.0, "-2500")])
def test_plain_number(spark, x, want):
    assert one(spark, text.plain_number(F.lit(x).cast("double"))) == want


def test_alert_type_and_queue(spark):
    kind = lambda band, gap, cov, names: one(spark, text.alert_type(F.lit(band), F.lit(gap), F.lit(cov), F.array(*map(F.lit, names)).cast("array<string>")))
    assert kind("NORMAL", 30.0, 0.9, ["x"]) == "DATA_GAP" and kind("SARI", 30.0, 0.5, ["bank_x"]) == "CREDIT_RISK" and kind("SARI", 0.0, 1.0, ["l1y_sales"]) == "FINANCIAL_SIGNAL" and kind("SARI", 0.0, 1.0, []) == "UNKNOWN"
    queue = lambda band, k, gap: one(spark, text.review_queue(F.lit(band), F.lit(k), F.lit(gap)))
    assert [queue("KIRMIZI", "x", 0.0), queue("TURUNCU", "x", 0.0), queue("SARI", "x", 0.0), queue("NORMAL", "x", 0.0), queue("NORMAL", "DATA_GAP", 0.0), queue("NORMAL", "x", 31.0)] == [
        "URGENT_FINANCIAL_REVIEW", "FINANCIAL_REVIEW", "WATCHLIST", "NO_ACTION", "DATA_QUALITY_REVIEW", "DATA_QUALITY_REVIEW",
    ]


def test_truth_tokens_and_helpers(spark):
    assert [one(spark, text.truth(F.lit(x))) for x in ("Evet", "hayir", "1", "FALSE", "?")] == [True, False, True, False, None]
    assert one(spark, text.tokens(F.lit("Bank-Risk to  BANK x1 yz"))) == ["bank", "risk"]
    assert one(spark, text.has_numeric_evidence(F.lit("a=1; b: 2, c =3"))) and not one(spark, text.has_numeric_evidence(F.lit("a=1 a=2 b=3")))
    assert one(spark, text.base_feature(F.lit("bank__peer_z"))) == "bank" and text.escaped_braces("{x}") == "{{x}}"
    assert text.masked_url("https://user:secret@host.example/path?key=1") == "https://host.example/***"
    assert [text.term_column(x) for x in ("q_x", "x_q", "l1y_x", "x")] == ["financial_term_q", "financial_term_q", "financial_term_l1y", None]
    with pytest.raises(ValueError):
        text.valid_identifier("a; drop")


def test_unit_float_and_change(spark):
    assert [one(spark, numeric.unit_float(F.lit(x))) for x in ("0.4", "7", "-1", "x", "NaN")] == [0.4, 1, 0, 0, 0]
    assert one(spark, numeric.pct_change(F.lit(3.0), F.lit(-2.0))) == 250 and one(spark, numeric.pct_change(F.lit(3.0), F.lit(0.0))) is None
    assert one(spark, numeric.evidence_strength(F.lit(-2.0), F.lit(None).cast("double"), F.lit(1.0), F.lit(True), F.lit(True))) == 4
    assert one(spark, numeric.top_mean(F.array(*map(F.lit, (1.0, 5.0, 3.0, 2.0))))) == pytest.approx(10 / 3)
    assert one(spark, numeric.top_mean(F.array().cast("array<double>"))) == 0


def test_scale_ladder_random(spark):
    rnd = random.Random(3)
    for _ in range(20):
        mad, iqr, std, n = rnd.choice([0.0, 2.0]), rnd.choice([0.0, 3.0]), rnd.choice([0.0, 0.5, 4.0]), rnd.choice([0, 5])
        want = 1.0 if n == 0 else mad * 1.4826 if mad else iqr / 1.349 if iqr else max(std, 1.0)
        assert one(spark, numeric.scale_ladder(F.lit(mad), F.lit(iqr), F.lit(std), F.lit(n))) == pytest.approx(want)


@pytest.mark.parametrize(
    ("given", "want"),
    [('{"a":1}', '{"a":1}'), ('```json\n{"a": 1}\n```', '{"a":1}'), ('Answer: {"a": [1]} done', '{"a":[1]}'), ('"{\\"a\\": 1}"', '{"a":1}'), ("nothing", None), ("", None), ('{"parsed": {"b": 2}, "raw": "x"}', '{"b":2}'), ('{"content": "", "tool_calls": [{"args": {"c": 3}}]}', '{"c":3}'), ("[1, 2]", "[1,2]"), ("{bad {\"a\": 1}", '{"a":1}'), ("7", None)],
)
def test_repair_json(spark, given, want):
    assert jsontext.repaired(given) == want
    assert one(spark, jsontext.repair_json(F.lit(given))) == want


def test_reason_list(spark):
    schema = "struct<feature:string,x:double>"
    assert [len(one(spark, jsontext.reason_list(F.lit(t), schema))) for t in ('[{"feature":"a","x":1}]', "[]", "no", '{"feature":"a"}')][:3] == [1, 0, 0]


def test_signed_logarithm_rounds_as_the_sql_does(spark):
    rows = spark.range(2000).select((F.col("id") / 397 - 2).alias("x"))
    assert rows.where(numeric.signed_log1p(F.col("x")) != F.expr("sign(x) * ln(1 + abs(x))")).count() == 0
