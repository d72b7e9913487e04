"""DuckDB SQL that gives the same rows as the queries of the same name."""

from __future__ import annotations

import re

MEASURES = ("bank_total_risk", "toplam_varlik_ttr", "fs_net_sales_cumulative_l1y", "memzuc_total_limit", "memzuc_total_risk", "returned_amount", "quantity", "n_orders", "rating_group")


def _panel(period: str) -> str:
    return f"""
lines AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS net, sum(l_extendedprice) AS gross, sum(l_extendedprice * l_tax) AS tax, sum(l_quantity) AS quantity,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS returned FROM lineitem GROUP BY l_orderkey),
panel AS (SELECT CAST(o_custkey AS VARCHAR) AS mono_id, CAST({period} AS DATE) AS cohort_dt, max(c_mktsegment) AS musteri_segment, max(CAST(n_regionkey AS VARCHAR)) AS cst_nace_code_id,
    round(sum(o_totalprice), 4) AS bank_total_risk, max(c_acctbal) AS toplam_varlik_ttr, round(sum(net), 4) AS fs_net_sales_cumulative_l1y, round(sum(gross), 4) AS memzuc_total_limit,
    round(sum(tax), 4) AS memzuc_total_risk, round(sum(returned), 4) AS returned_amount, round(sum(lines.quantity), 4) AS quantity, CAST(count(*) AS DOUBLE) AS n_orders,
    max(CAST(substring(o_orderpriority, 1, 1) AS DOUBLE)) AS rating_group
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN lines ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


YEARS = _panel("make_date(year(o_orderdate), 12, 31)")
MONTHS = _panel("last_day(o_orderdate)")
AT, MONTH = "DATE '2000-12-31'", "DATE '2001-06-30'"
DAY = "strftime(cohort_dt, '%Y-%m-%d') AS cohort_dt"
LOG = "sign({0}) * ln(1 + abs({0}))"

_unpivot = lambda names, keep, source: " UNION ALL ".join(f"SELECT {keep}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in names)


def _sized(source: str, base: str, out: str) -> str:
    """``out``: the source with peer_size by the quartiles of each month."""
    x = f"ln(1 + CASE WHEN {base} IS NOT NULL THEN greatest({base}, 0) END)"
    return f"""
{out}_e AS (SELECT cohort_dt AS m, quantile_cont({x}, 0.0) AS e0, quantile_cont({x}, 0.25) AS e1, quantile_cont({x}, 0.5) AS e2, quantile_cont({x}, 0.75) AS e3, quantile_cont({x}, 1.0) AS e4, count({x}) AS n FROM {source} GROUP BY 1),
{out} AS (SELECT p.*, CASE WHEN NOT (n >= 4 AND e0 < e1 AND e1 < e2 AND e2 < e3 AND e3 < e4) OR {base} IS NULL THEN 'SIZE_NA' WHEN {x} <= e1 THEN 'S1' WHEN {x} <= e2 THEN 'S2' WHEN {x} <= e3 THEN 'S3' ELSE 'S4' END AS peer_size,
    musteri_segment AS peer_segment, cst_nace_code_id AS peer_sector FROM {source} p JOIN {out}_e ON cohort_dt = m)"""


PEER_FEATURES = ("bank_total_risk", "memzuc_total_limit", "returned_amount")
_LEVELS = {
    "AY_SEGMENT_SEKTOR_SIZE": "cohort_dt, peer_segment, peer_sector, peer_size",
    "AY_SEGMENT_SEKTOR": "cohort_dt, peer_segment, peer_sector",
    "AY_SEGMENT_SIZE": "cohort_dt, peer_segment, peer_size",
    "AY_SEGMENT": "cohort_dt, peer_segment",
    "AY": "cohort_dt",
}
_keep = "mono_id, cohort_dt, peer_segment, peer_sector, peer_size"
LONG = f"{YEARS}, {_sized('panel', 'toplam_varlik_ttr', 'ctx')}, long AS (SELECT *, {LOG.format('value')} AS t FROM ({_unpivot(PEER_FEATURES, _keep, 'ctx')}))"


def _peers(long: str, part: str = "") -> str:
    """Peer references by windows over each level's keys; without enough values in any, those of the feature (and ``part``)."""
    by = f"feature, {part}" if part else "feature"
    first = ", ".join(f"median(value) OVER w{i} AS m{i}, median(t) OVER w{i} AS tm{i}, count(value) OVER w{i} AS n{i}" for i in range(5))
    windows = ", ".join(f"w{i} AS (PARTITION BY feature, {keys})" for i, keys in enumerate(_LEVELS.values()))
    second = ", ".join(f"median(abs(t - tm{i})) OVER w{i} AS d{i}" for i in range(5))
    pick = lambda what, other: "CASE " + " ".join(f"WHEN n{i} >= 50 THEN {what(i, name)}" for i, name in enumerate(_LEVELS)) + f" ELSE {other} END"
    own = pick(lambda i, _: f"CASE WHEN d{i} * 1.4826 <> 0 THEN d{i} * 1.4826 END", "NULL")
    score = "CASE peer_level WHEN 'AY_SEGMENT_SEKTOR_SIZE' THEN 1.0 WHEN 'AY_SEGMENT_SEKTOR' THEN 0.84 WHEN 'AY_SEGMENT_SIZE' THEN 0.78 WHEN 'AY_SEGMENT' THEN 0.68 WHEN 'AY' THEN 0.48 ELSE 0.25 END"
    support = "CASE WHEN peer_support >= 500 THEN 1.0 WHEN peer_support >= 200 THEN 0.9 WHEN peer_support >= 100 THEN 0.75 WHEN peer_support >= 50 THEN 0.6 ELSE 0.2 END"
    return f"""
g1 AS (SELECT {by}, median(value) AS gm, median(t) AS gt, quantile_cont(t, 0.75) - quantile_cont(t, 0.25) AS iqr, stddev_samp(t) AS sd, count(value) AS gn FROM {long} GROUP BY ALL),
g2 AS (SELECT {by}, any_value(gm) AS gm, any_value(gt) AS gt, any_value(iqr) AS iqr, any_value(sd) AS sd, any_value(gn) AS gn, median(abs(t - gt)) AS mad FROM {long} JOIN g1 USING ({by}) GROUP BY ALL),
overall AS (SELECT {by}, gm, gt, CASE WHEN gn = 0 THEN 1.0 WHEN mad > 1e-9 THEN greatest(mad * 1.4826, 1e-6) WHEN iqr > 1e-9 THEN greatest(iqr / 1.349, 1e-6) WHEN gn < 2 THEN NULL ELSE greatest(sd, 1.0) END AS gs FROM g2),
p1 AS (SELECT *, {first} FROM {long} WINDOW {windows}),
p2 AS (SELECT *, {second} FROM p1 WINDOW {windows}),
p3 AS (SELECT p2.*, {pick(lambda i, _: f'm{i}', 'gm')} AS peer_median, {pick(lambda i, _: f'tm{i}', 'gt')} AS center, {pick(lambda i, _: f'n{i}', '0')} AS peer_support,
    {pick(lambda i, name: f"'{name}'", "'GLOBAL_FEATURE'")} AS peer_level, coalesce({own}, gs) AS scale FROM p2 JOIN overall USING ({by})),
p4 AS (SELECT *, CASE WHEN t IS NOT NULL AND scale <> 0 THEN greatest(-10.0, least(10.0, (t - center) / scale)) END AS peer_z, round_even((({score}) * 0.65 + ({support}) * 0.35) * 100, 1) AS peer_score FROM p3),
peers AS (SELECT *, CASE WHEN peer_support >= 100 AND peer_score >= 80 AND peer_level NOT IN ('AY', 'GLOBAL_FEATURE', 'AY_SEGMENT') THEN 'GUCLU' WHEN peer_support < 50 OR peer_score < 60 OR peer_level IN ('AY', 'GLOBAL_FEATURE') THEN 'ZAYIF' ELSE 'KABUL_EDILEBILIR' END AS peer_quality FROM p4)"""


def _floor(den: str, source: str = "panel") -> str:
    return f"(SELECT coalesce(greatest(median(CASE WHEN {den} > 0 THEN {den} END) * 1e-4, 1e-9), 1e-9) FROM {source})"


def _ratio(n: str, d: str, source: str = "panel") -> str:
    return f"CASE WHEN {d} > {_floor(d, source)} AND abs({n} / {d}) <= 1000 THEN {n} / {d} END"


_PREP = ("bank_total_risk", "toplam_varlik_ttr", "returned_amount")
_train = "(SELECT * FROM panel WHERE cohort_dt < DATE '2000-12-31')"
_bounded = "sign({0}) * ln(1 + abs({0}))"
PREPARED = f"""{YEARS},
f AS (SELECT {', '.join(f'coalesce(median({c}), 0) AS {c}' for c in _PREP)} FROM {_train}),
b AS (SELECT {', '.join(f'quantile_cont(coalesce(t.{c}, f.{c}), 0.01) AS {c}_low, quantile_cont(coalesce(t.{c}, f.{c}), 0.99) AS {c}_high' for c in _PREP)} FROM {_train} t, f),
x AS (SELECT t.mono_id, t.cohort_dt, {', '.join(_bounded.format(f'greatest({c}_low, least({c}_high, coalesce(t.{c}, f.{c})))') + f' AS {c}' for c in _PREP)} FROM panel t, f, b),
s AS (SELECT {', '.join(f'median({c}) AS {c}_c, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) > 1e-9 THEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) WHEN stddev_pop({c}) > 1e-9 THEN stddev_pop({c}) ELSE 1.0 END AS {c}_s' for c in _PREP)} FROM x WHERE cohort_dt < {AT}),
z AS (SELECT mono_id, cohort_dt, {', '.join(f'({c} - {c}_c) / {c}_s AS {c}' for c in _PREP)} FROM x, s)"""

SCORES = f"""{YEARS},
ref AS (SELECT bank_total_risk AS v FROM panel WHERE cohort_dt < {AT}), cur AS (SELECT * FROM panel WHERE cohort_dt = {AT}),
scores AS (SELECT mono_id, cohort_dt, musteri_segment, (SELECT count(*) FROM ref WHERE v <= bank_total_risk) / (SELECT CAST(count(*) AS DOUBLE) FROM ref) * 100 AS ensemble_score FROM cur),
q AS (SELECT greatest(quantile_cont(ensemble_score, 0.95), 90.0) AS sari, quantile_cont(ensemble_score, 0.98) AS q2, quantile_cont(ensemble_score, 0.99) AS q3 FROM scores),
th AS (SELECT sari, greatest(q2, 95.0, sari) AS turuncu, greatest(q3, 97.5, q2, 95.0, sari) AS kirmizi FROM q),
banded AS (SELECT scores.*, CASE WHEN ensemble_score >= kirmizi THEN 'KIRMIZI' WHEN ensemble_score >= turuncu THEN 'TURUNCU' WHEN ensemble_score >= sari THEN 'SARI' ELSE 'NORMAL' END AS alert_band FROM scores, th)"""

HISTORY = f"""{MONTHS},
h AS (SELECT mono_id, cohort_dt, bank_total_risk AS value FROM panel WHERE cohort_dt < {MONTH}), now AS (SELECT mono_id, bank_total_risk AS value FROM panel WHERE cohort_dt = {MONTH}),
m1 AS (SELECT mono_id, median(value) AS median, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.75) AS p75, stddev_samp(value) AS sd, count(*) AS n FROM h GROUP BY 1),
m AS (SELECT mono_id, any_value(m1.median) AS median, any_value(p25) AS p25, any_value(p75) AS p75, any_value(sd) AS sd, any_value(n) AS n, median(abs(value - m1.median)) AS mad FROM h JOIN m1 USING (mono_id) GROUP BY 1),
tail AS (SELECT *, row_number() OVER (PARTITION BY mono_id ORDER BY cohort_dt DESC) AS ago FROM h)"""

_scale = lambda fallback: f"CASE WHEN mad > 1e-9 THEN greatest(mad * 1.4826, 1e-6) WHEN n >= 2 THEN greatest(CASE WHEN sd = 0 THEN {fallback} ELSE sd END, 1e-6) END"

_features = "['', " + ", ".join(f"'{c}'" for c in MEASURES) + "]"
_union_features = lambda condition: " UNION ALL ".join(f"SELECT '{c}' AS feature FROM panel HAVING {condition.format(c=c)}" for c in MEASURES)

FACTS = f"""{YEARS}, earlier AS (SELECT mono_id, arg_max(bank_total_risk, cohort_dt) AS previous FROM panel WHERE cohort_dt < {AT} GROUP BY 1),
facts AS (SELECT mono_id, CASE WHEN k % 7 <> 0 THEN bank_total_risk END AS actual, previous, CASE WHEN k % 5 <> 0 THEN memzuc_total_limit END AS peer, CASE WHEN k % 3 <> 0 THEN 150000.0::DOUBLE END AS train,
    CASE WHEN k % 4 <> 0 THEN (k % 9 - 4)::DOUBLE END AS peer_z, (k % 100)::DOUBLE AS peer_pct, ['HIGHER_IS_RISKY', 'LOWER_IS_RISKY', 'UNKNOWN'][k % 3 + 1] AS direction,
    CASE WHEN k % 6 < 4 THEN 'financial_term_q' END AS term_column, CASE WHEN k % 6 < 3 THEN '30.09.2024' END AS term, CASE WHEN k % 2 = 0 THEN '30.09.2024' WHEN k % 3 = 0 THEN '30.06.2024' END AS previous_term
    FROM (SELECT *, mono_id::BIGINT AS k FROM panel WHERE cohort_dt = {AT}) LEFT JOIN earlier USING (mono_id))"""


def _comment(direction: str, x: str, label: str, reference: str) -> str:
    effect = f"CASE {direction} WHEN 'HIGHER_IS_RISKY' THEN CASE WHEN {x} > {reference} THEN 'risk artisi' ELSE 'risk azalisi' END WHEN 'LOWER_IS_RISKY' THEN CASE WHEN {x} < {reference} THEN 'risk artisi' ELSE 'risk azalisi' END ELSE 'yon etkisi tanimsiz' END"
    return f"""CASE WHEN {x} IS NULL THEN 'deger missing oldugu icin yon yorumu yok' WHEN {reference} IS NULL OR {label} IS NULL THEN 'referans olmadigi icin yon yorumu yok'
        WHEN abs({x} - {reference}) <= 1e-9 THEN {label} || ' ile ayni seviyede' ELSE {label} || ' gore ' || CASE WHEN {x} > {reference} THEN 'artmis' ELSE 'azalmis' END || '; ' || {effect} END"""


def _reference(part: str, x: str, previous: str, peer: str, train: str, z: str, peer_pct: str, raw_pct: str) -> str:
    """What a value is compared with: its label or its value."""
    label = part == "label"
    a, b, c = ("'peer medyan'", "'train medyan'", "'musteri onceki ay'") if label else (peer, train, previous)
    return f"""CASE WHEN {x} IS NULL THEN CASE WHEN {peer} IS NOT NULL THEN {a} WHEN {train} IS NOT NULL THEN {b} END
        WHEN {peer} IS NOT NULL AND (coalesce(abs({z}) >= 2, FALSE) OR {peer_pct} >= {raw_pct} * 0.75) THEN {a} WHEN {previous} IS NOT NULL THEN {c} WHEN {peer} IS NOT NULL THEN {a} WHEN {train} IS NOT NULL THEN {b} END"""


_riskier = lambda direction, x, y: f"coalesce(CASE {direction} WHEN 'HIGHER_IS_RISKY' THEN {x} > {y} WHEN 'LOWER_IS_RISKY' THEN {x} < {y} END, FALSE)"
_bucket = lambda missing, comment: f"CASE WHEN {missing} OR contains({comment}, 'risk artisi') THEN 0 WHEN contains({comment}, 'risk azalisi') THEN 2 ELSE 1 END"


def _said(x: str, previous: str, peer: str, direction: str, same_term: str) -> str:
    return f"""CASE WHEN {x} IS NULL OR {previous} IS NULL THEN NULL WHEN {same_term} THEN 'onceki ay ayni finansal term oldugu icin trend kaniti zayif'
        WHEN NOT {_riskier(direction, x, previous)} AND {_riskier(direction, x, peer)} THEN 'onceki finansal veriye gore iyilesme var ama peer''e gore halen riskli'
        WHEN {_riskier(direction, x, peer)} THEN 'peer''e gore risk sinyali onceki ay bilgisinden daha belirgin' END"""


_long = lambda source, names: " UNION ALL ".join(f"SELECT mono_id, cohort_dt, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in names)
REASONS = f"""{PREPARED},
sev AS (SELECT mono_id, cohort_dt, feature, round(abs(value), 5) AS severity FROM ({_long('z', _PREP)}) WHERE cohort_dt = {AT}),
val AS ({_long(f"(SELECT * FROM panel WHERE cohort_dt = {AT})", _PREP)}),
prev AS (SELECT mono_id, feature, value AS previous FROM (SELECT *, row_number() OVER (PARTITION BY mono_id, feature ORDER BY cohort_dt DESC) AS ago FROM ({_long(_train, _PREP)})) WHERE ago = 1),
trn AS (SELECT feature, median(value) AS train FROM ({_long(_train, _PREP)}) GROUP BY 1),
cand AS (SELECT mono_id, cohort_dt, feature, severity, value, previous, train, severity / total * 100 AS share, rank, CASE WHEN mono_id::BIGINT % 4 <> 0 THEN round(value / 2, 4) END AS peer,
    CASE feature WHEN 'bank_total_risk' THEN 'HIGHER_IS_RISKY' ELSE 'UNKNOWN' END AS direction
    FROM (SELECT *, sum(severity) OVER (PARTITION BY mono_id) AS total, row_number() OVER (PARTITION BY mono_id ORDER BY severity DESC, feature) AS rank FROM sev) JOIN val USING (mono_id, cohort_dt, feature) LEFT JOIN prev USING (mono_id, feature) JOIN trn USING (feature)
    WHERE rank <= 2 AND severity > 0),
ref AS (SELECT *, {_reference('label', 'value', 'previous', 'peer', 'train', 'severity', 'share', '0.0')} AS label, {_reference('value', 'value', 'previous', 'peer', 'train', 'severity', 'share', '0.0')} AS reference FROM cand),
com AS (SELECT *, {_comment('direction', 'value', 'label', 'reference')} AS comment FROM ref),
first AS (SELECT *, row_number() OVER (PARTITION BY mono_id ORDER BY {_bucket('value IS NULL', 'comment')}, share DESC, rank) AS place FROM com)"""

# the ratios of FORMULAS, with denominator floors of each side of the split
RATIOS = {
    "bank_risk_to_assets": ("bank_total_risk", "toplam_varlik_ttr"),
    "memzuc_limit_utilization": ("memzuc_total_risk", "memzuc_total_limit"),
    "l1y_debt_to_sales": ("bank_total_risk", "fs_net_sales_cumulative_l1y"),
    "internal_returns_to_sales": ("returned_amount", "fs_net_sales_cumulative_l1y"),
    "memzuc_to_bank_risk_ratio": ("memzuc_total_risk", "bank_total_risk"),
}
_sides = lambda source: " UNION ALL ".join(
    f"SELECT {_keep}, '{f}' AS feature, {_ratio(n, d, source)} AS value FROM {source}" for f, (n, d) in RATIOS.items()
) + f" UNION ALL SELECT {_keep}, 'rating_group' AS feature, rating_group AS value FROM {source}"


def _renamed(sql: str, names: str, suffix: str) -> str:
    for name in names.split():
        sql = re.sub(rf"\b{name}\b", f"{name}{suffix}", sql)
    return sql


SPLIT = f"""{YEARS}, {_sized('panel', 'toplam_varlik_ttr', 'ctx')}, yr AS (SELECT * FROM ctx WHERE cohort_dt = {AT}), tr AS (SELECT * FROM ctx WHERE cohort_dt < {AT}),
now_long AS MATERIALIZED (SELECT *, {LOG.format('value')} AS t FROM ({_sides('yr')})), past_long AS MATERIALIZED (SELECT *, {LOG.format('value')} AS t FROM ({_sides('tr')})), {_peers('now_long')}"""
_FEATURES = (*RATIOS, "rating_group")
_levels4 = [keys.removeprefix("cohort_dt").removeprefix(", ") for keys in _LEVELS.values()]
EVIDENCE = f"""{SPLIT},
h AS (SELECT mono_id, feature, cohort_dt, value FROM past_long WHERE value IS NOT NULL),
m1 AS (SELECT mono_id, feature, median(value) AS median, stddev_samp(value) AS sd, count(*) AS n, arg_max(value, cohort_dt) AS previous FROM h GROUP BY ALL),
m AS (SELECT mono_id, feature, any_value(m1.median) AS median, any_value(sd) AS sd, any_value(n) AS n, any_value(previous) AS previous, median(abs(value - m1.median)) AS mad FROM h JOIN m1 USING (mono_id, feature) GROUP BY ALL),
tail AS (SELECT *, row_number() OVER (PARTITION BY mono_id, feature ORDER BY cohort_dt DESC) AS ago FROM h),
pts AS (SELECT mono_id, feature, value, ago FROM tail WHERE ago < 6 UNION ALL SELECT mono_id, feature, value, 0 FROM now_long WHERE value IS NOT NULL),
sl AS (SELECT mono_id, feature, regr_slope(value, -ago) AS slope FROM pts GROUP BY ALL),
rs1 AS (SELECT feature, median(value) AS m, stddev_samp(value) AS sd, count(*) AS n FROM h GROUP BY 1),
rs2 AS (SELECT feature, any_value(sd) AS sd, any_value(n) AS n, median(abs(value - m)) AS mad FROM h JOIN rs1 USING (feature) GROUP BY 1),
rs AS (SELECT feature, CASE WHEN n < 2 THEN 1.0 ELSE {_scale('1.0')} END AS rscale FROM rs2),
{', '.join(f"l{i} AS (SELECT feature, {keys + ', ' if keys else ''}median(value) AS v{i} FROM past_long WHERE value IS NOT NULL GROUP BY ALL HAVING {'count(*) >= 50' if keys else 'TRUE'})" for i, keys in enumerate(_levels4))},
e1 AS (SELECT p.mono_id, p.feature, p.value, p.peer_z, p.peer_level, p.peer_support, m.previous, m.median, m.sd, m.mad, m.n, slope, rscale, coalesce({', '.join(f'v{i}' for i in range(5))}) AS season
    FROM peers p LEFT JOIN m USING (mono_id, feature) LEFT JOIN sl USING (mono_id, feature) LEFT JOIN rs USING (feature) {' '.join(f"LEFT JOIN l{i} USING (feature{', ' + keys if keys else ''})" for i, keys in enumerate(_levels4))}),
e2 AS (SELECT *, CASE WHEN ({_scale('0.0')}) <> 0 THEN (value - median) / ({_scale('0.0')}) END AS history_z, CASE WHEN n >= 2 THEN (value - median) / ({_scale('1.0')}) END AS month_z,
    CASE WHEN rscale IS NOT NULL THEN (value - season) / greatest(rscale, 1e-6) END AS season_z, value IS NOT NULL AND coalesce(n, 0) >= 3 AS enough FROM e1),
e3 AS (SELECT *, CASE WHEN enough THEN slope END AS slope_6m, coalesce(enough AND abs(value - median) / ({_scale('1.0')}) >= 3, FALSE) AS broken FROM e2),
e AS (SELECT *, greatest(coalesce(abs(peer_z), 0), coalesce(abs(history_z), 0), coalesce(abs(month_z), 0)) + CASE WHEN broken THEN 1.5 ELSE 0 END + CASE WHEN value IS NULL THEN 0.5 ELSE 0 END AS strength FROM e3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY mono_id ORDER BY strength DESC, feature) AS rank FROM e)"""

_PEER_CTES = "g1 g2 overall p1 p2 p3 p4 peers"
_four = lambda x: f"coalesce(printf('%.4f', round({x}, 4) + 0.0), '')"
_six = lambda x: f"regexp_replace(printf('%.6f', round({x}, 6) + 0.0), '[.]?0+$', '')"
_pct = "CASE WHEN abs(previous) >= 1e-9 THEN (value - previous) / abs(previous) * 100 END"  # in a panel of years the same month of the last year is the one before
_SAID = {
    "value": "value", "previous_value": "previous", "change_pct": _pct, "median": "median", "p25": "p25", "p75": "p75", "history_z": "history_z", "slope_6m": "slope_6m", "slope_12m": "CASE WHEN enough THEN slope12 END", "trend_break_flag": "",
    "yoy_change_pct": _pct, "same_month_customer_z": "month_z", "seasonal_peer_median": "season", "seasonal_peer_z": "season_z", "peer_median": "peer_median", "peer_z": "peer_z",
}
PROMPTS = f"""{EVIDENCE}, spread AS (SELECT mono_id, feature, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.75) AS p75 FROM h GROUP BY ALL),
sl12 AS (SELECT mono_id, feature, regr_slope(value, -ago) AS slope12 FROM (SELECT mono_id, feature, value, ago FROM tail WHERE ago < 12 UNION ALL SELECT mono_id, feature, value, 0 FROM now_long WHERE value IS NOT NULL) GROUP BY ALL),
said AS (SELECT mono_id, rank, concat_ws(' | ', '- ' || feature, {', '.join(f"'{k}=' || {_six(x) if x else 'broken::VARCHAR'}" for k, x in _SAID.items())}, 'peer_support=' || peer_support::BIGINT, 'peer_level=' || peer_level, 'peer_quality=' || peer_quality) AS line
    FROM ranked LEFT JOIN spread USING (mono_id, feature) LEFT JOIN sl12 USING (mono_id, feature) LEFT JOIN (SELECT mono_id, feature, peer_median, peer_quality FROM peers) USING (mono_id, feature))"""


def _sig(x: str) -> str:
    """Six significant digits without trailing zeros."""
    every = ", ".join(f"printf('%.{k}f', ({x})::DOUBLE)" for k in range(16))
    fixed = f"[{every}][(least(15, greatest(0, 5 - floor(log10(abs({x}))))) + 1)::INT]"
    return f"CASE WHEN {x} = 0 THEN '0' WHEN contains({fixed}, '.') THEN regexp_replace({fixed}, '[.]?0+$', '') ELSE {fixed} END"


_first_by = lambda metric: f"row_number() OVER (PARTITION BY mono_id ORDER BY {metric} DESC NULLS LAST, feature)"
_line = lambda head, numbers, *others: f"concat_ws('; ', '{head}: feature=' || feature, {', '.join([f"'{k}=' || {_sig(x)}" for k, x in numbers.items()] + list(others))})"
ASSESSED = f"""{PROMPTS},
as1 AS (SELECT mono_id, feature, previous, {_pct} AS yoy, month_z, season, season_z, slope_6m, CASE WHEN enough THEN slope12 END AS slope_12m, broken, peer_z, peer_support, peer_level, peer_median, peer_quality
    FROM ranked LEFT JOIN sl12 USING (mono_id, feature) LEFT JOIN (SELECT mono_id, feature, peer_median, peer_quality FROM peers) USING (mono_id, feature)),
as2 AS (SELECT *, greatest(abs(month_z), abs(season_z), abs(yoy / 100)) AS ms, greatest(abs(slope_6m), abs(slope_12m), CASE WHEN broken THEN 10.0::DOUBLE END) AS mt, abs(peer_z) AS mp FROM as1),
as3 AS (SELECT *, {_first_by('ms')} AS rs_, {_first_by('mt')} AS rt_, {_first_by('mp')} AS rp_ FROM as2),
as4 AS (SELECT mono_id, count(*) FILTER (peer_quality = 'ZAYIF') AS weak,
    max({_line('Sezon', {'same_month_last_year': 'previous', 'yoy_change_pct': 'yoy', 'same_month_z': 'month_z', 'seasonal_peer_median': 'season', 'seasonal_peer_z': 'season_z'})}) FILTER (rs_ = 1 AND ms IS NOT NULL) AS season_line,
    max({_line('Trend', {'slope_6m': 'slope_6m', 'slope_12m': 'slope_12m'}, "'trend_break=' || broken::INT")}) FILTER (rt_ = 1 AND mt IS NOT NULL) AS trend_line,
    max({_line('Peer', {'peer_median': 'peer_median', 'peer_z': 'peer_z'}, "'peer_support=' || peer_support::BIGINT", "'peer_quality=' || peer_quality", "'peer_level=' || peer_level")}) FILTER (rp_ = 1 AND mp IS NOT NULL) AS peer_line FROM as3 GROUP BY 1),
as5 AS (SELECT p.mono_id, ({' + '.join(f'({c} IS NOT NULL)::INT' for c in MEASURES)}) / {len(MEASURES)}::DOUBLE AS covered, {' + '.join(f'({c} IS NULL)::INT' for c in MEASURES)} AS lacking, coalesce(k, 0) AS periods
    FROM panel p LEFT JOIN (SELECT mono_id, count(DISTINCT cohort_dt) AS k FROM panel WHERE cohort_dt < {AT} GROUP BY 1) USING (mono_id) WHERE cohort_dt = {AT})"""
# the last months of each series with what the peers of the month say, as text
PACKAGES = f"""{EVIDENCE}, {_renamed(_peers('past_long', 'cohort_dt'), _PEER_CTES, '_past')},
seen AS (SELECT *, FALSE AS now FROM peers_past WHERE value IS NOT NULL AND (mono_id, feature) IN (SELECT (mono_id, feature) FROM peers) UNION ALL BY NAME SELECT *, TRUE AS now FROM peers),
back AS (SELECT *, row_number() OVER (PARTITION BY mono_id, feature ORDER BY cohort_dt DESC) AS place FROM seen),
told AS (SELECT mono_id, feature, string_agg(strftime(cohort_dt, '%Y-%m-%d') || ':' || {_four('value')} || ':' || now::VARCHAR || ':' || (peer_median IS NOT NULL)::VARCHAR || ':' || {_four('peer_median')} || ':' || {_four('peer_z')} || ':'
    || peer_support::BIGINT::VARCHAR || ':' || peer_quality || ':' || peer_level, ' | ' ORDER BY cohort_dt) AS series FROM back WHERE place <= 6 GROUP BY ALL),
known AS (SELECT unnest([{', '.join(f"'{f}'" for f in _FEATURES)}]) AS feature, unnest(['bank_risk', 'memzuc', 'financial', 'other', 'memzuc', 'pd_rating']) AS category,
    unnest([{', '.join(f"'{n} / {d}'" for n, d in RATIOS.values())}, NULL]) AS formula, unnest([{', '.join(f"""'["{n}", "{d}"]'""" for n, d in RATIOS.values())}, '[]']) AS source_columns)"""
_wide = lambda source, out: f"{out} AS (SELECT mono_id, cohort_dt, {', '.join(f"max(CASE WHEN feature = '{f}' THEN peer_z END) AS {f}" for f in _FEATURES)} FROM {source} GROUP BY ALL)"
RESIDUAL = f"""{SPLIT}, {_renamed(_peers('past_long'), _PEER_CTES, '_past')}, {_wide('peers', 'wn')}, {_wide('peers_past', 'wp')},
f AS (SELECT {', '.join(f'coalesce(median({c}), 0) AS {c}' for c in _FEATURES)} FROM wp),
b AS (SELECT {', '.join(f'quantile_cont(coalesce(w.{c}, f.{c}), 0.01) AS {c}_low, quantile_cont(coalesce(w.{c}, f.{c}), 0.99) AS {c}_high' for c in _FEATURES)} FROM wp w, f),
x AS (SELECT w.mono_id, w.cohort_dt, {', '.join(_bounded.format(f'greatest({c}_low, least({c}_high, coalesce(w.{c}, f.{c})))') + f' AS {c}' for c in _FEATURES)} FROM (SELECT * FROM wn UNION ALL SELECT * FROM wp) w, f, b),
s AS (SELECT {', '.join(f'median({c}) AS {c}_c, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) > 1e-9 THEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) WHEN stddev_pop({c}) > 1e-9 THEN stddev_pop({c}) ELSE 1.0 END AS {c}_s' for c in _FEATURES)} FROM x WHERE cohort_dt < {AT}),
r AS (SELECT mono_id, cohort_dt, round(list_sum(list_reverse_sort([{', '.join(f'abs(({c} - {c}_c) / {c}_s)' for c in _FEATURES)}])[1:3]) / 3, 12) AS residual FROM x, s),
rp AS (SELECT residual FROM r WHERE cohort_dt < {AT})"""

# The models in SQL: the same keyed choices, trees level by level, the autoencoder pass by pass.
_PRIME, _TREES, _SIZE, _DEPTH, _PASSES = 2_147_483_647, 150, 256, 8, 40
_hex = lambda text, at=1: f"(('0x' || substr(md5({text}), {at}, 8))::BIGINT % {_PRIME})"
_D, _H = len(_FEATURES), len(_FEATURES) // 2
_W = 2 * _D * _H + _H + _D
MODEL_ROWS = f"""{RESIDUAL},
fx AS MATERIALIZED (SELECT mono_id, cohort_dt, mono_id || '|' || cohort_dt::VARCHAR AS k, [{', '.join(f'({c} - {c}_c) / {c}_s' for c in _FEATURES)}] AS v FROM x, s),
ft AS MATERIALIZED (SELECT k, v, {_hex('k')} AS h1, {_hex('k', 9)} AS h2 FROM fx WHERE cohort_dt < {AT})"""


def _forest() -> str:
    key = lambda what: _hex(f"'42:' || tree || ':' || node || ':{what}'")
    out = f"""{MODEL_ROWS},
seeds AS (SELECT tree, {_hex("'42:' || tree || ':a'")} AS a, {_hex("'42:' || tree || ':b'")} AS b FROM range({_TREES}) r(tree)),
d0 AS MATERIALIZED (SELECT tree, 1::BIGINT AS node, v FROM (SELECT tree, v, row_number() OVER (PARTITION BY tree ORDER BY (h1 * a + h2 + b) % {_PRIME}, k) AS place FROM ft, seeds) WHERE place <= {_SIZE})"""
    for i in range(_DEPTH + 1):
        split = f"n > 1 AND len(o) > 0 AND {i} < {_DEPTH}"
        out += f""",
n{i} AS MATERIALIZED (SELECT tree, node, n, CASE WHEN {split} THEN o[{key('feature')} % greatest(len(o), 1) + 1] END AS f, low, high FROM
    (SELECT *, list_filter(range(1, {_D + 1}), lambda j: high[j] > low[j]) AS o FROM (SELECT tree, node, count(*) AS n, [{', '.join(f'min(v[{j}])' for j in range(1, _D + 1))}] AS low, [{', '.join(f'max(v[{j}])' for j in range(1, _D + 1))}] AS high FROM d{i} GROUP BY ALL))),
t{i} AS MATERIALIZED (SELECT tree, node, f, low[f] + {key('cut')} / {_PRIME}::DOUBLE * (high[f] - low[f]) AS cut,
    CASE WHEN f IS NULL THEN round(({i} + CASE WHEN n > 2 THEN 2 * (ln(n - 1) + 0.5772156649015329::DOUBLE) - 2 * (n - 1) / n WHEN n = 2 THEN 1 ELSE 0 END) / 1e-9::DOUBLE)::BIGINT ELSE 0 END AS length FROM n{i})"""
        if i < _DEPTH:
            out += f""",
d{i + 1} AS MATERIALIZED (SELECT tree, 2 * node + CASE WHEN v[f] >= cut THEN 1 ELSE 0 END AS node, v FROM d{i} JOIN t{i} USING (tree, node) WHERE f IS NOT NULL)"""
    return out + ",\nnodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(_DEPTH + 1)) + ")"


def _walk() -> str:
    """Every row down every tree."""
    out = ",\nw0 AS (SELECT k, v, tree, 1::BIGINT AS node, 0::BIGINT AS length FROM fx, seeds)"
    for i in range(_DEPTH + 1):
        out += f""",
w{i + 1} AS (SELECT k, v, w.tree, CASE WHEN f IS NULL THEN 0 WHEN v[f] >= cut THEN 2 * node + 1 ELSE 2 * node END AS node, w.length + coalesce(t.length, 0) AS length FROM w{i} w LEFT JOIN t{i} t USING (tree, node))"""
    return out + f",\niso AS MATERIALIZED (SELECT k, sum(length)::BIGINT AS total FROM w{_DEPTH + 1} GROUP BY 1)"


def _coder() -> str:
    """Each pass over the rows that aren't held out gives the next weights; w has those into the layer, its biases, those out of it and their biases."""
    w1, b1 = lambda j, k: f"w[{j * _H + k + 1}]", lambda k: f"w[{_D * _H + k + 1}]"
    w2, b2 = lambda k, j: f"w[{_D * _H + _H + k * _D + j + 1}]", lambda j: f"w[{2 * _D * _H + _H + j + 1}]"
    raw = "[" + ", ".join(" + ".join(f"v[{j + 1}] * {w1(j, k)}" for j in range(_D)) + f" + {b1(k)}" for k in range(_H)) + "]"
    off = "[" + ", ".join(" + ".join(f"greatest(raw[{k + 1}], 0) * {w2(k, j)}" for k in range(_H)) + f" + {b2(j)} - v[{j + 1}]" for j in range(_D)) + "]"
    back = "[" + ", ".join("CASE WHEN raw[{0}] > 0 THEN 2 * ({1}) ELSE 0 END".format(k + 1, " + ".join(f"e[{j + 1}] * {w2(k, j)}" for j in range(_D))) for k in range(_H)) + "]"
    sums = [f"v[{j + 1}] * back[{k + 1}]" for j in range(_D) for k in range(_H)] + [f"back[{k + 1}]" for k in range(_H)]
    sums += [f"2 * greatest(raw[{k + 1}], 0) * e[{j + 1}]" for k in range(_H) for j in range(_D)] + [f"2 * e[{j + 1}]" for j in range(_D)]
    square = "list_sum(list_transform(e, lambda y: y * y))"
    bound = f"sqrt(6 / {_D + _H}::DOUBLE)"
    key = _hex("'42:' || i || ':weight'")
    out = f""",
rows_ AS MATERIALIZED (SELECT v, h2 % 10 = 0 AND (SELECT count(*) FROM ft) >= 50 AS held FROM ft), sizes AS (SELECT count(*) FILTER (NOT held) AS n, count(*) FILTER (held) AS n_held FROM rows_),
aw0 AS MATERIALIZED (SELECT w, list_transform(w, lambda y: 0.1::DOUBLE) AS step, list_transform(w, lambda y: 0::DOUBLE) AS before, w AS best, 'inf'::DOUBLE AS best_loss, 0 AS waited, FALSE AS done
    FROM (SELECT list((2 * {key} / {_PRIME}::DOUBLE - 1) * {bound} ORDER BY i) AS w FROM range({_W}) r(i)))"""
    for p in range(_PASSES):
        out += f""",
ag{p} AS MATERIALIZED (SELECT [{', '.join(f'coalesce(sum({x}) FILTER (NOT held), 0)' for x in sums)}] AS g, coalesce(sum({square}) FILTER (held), 0) AS held_sum FROM
    (SELECT v, held, raw, e, {back} AS back FROM (SELECT v, held, w, raw, {off} AS e FROM (SELECT v, held, w, {raw} AS raw FROM rows_, aw{p})))),
au{p} AS MATERIALIZED (SELECT a.*, list_transform(g, lambda y: y / (n * {_D})) AS g, held_sum / (n_held * {_D}) AS loss, held_sum / (n_held * {_D}) < best_loss - 1e-4 AS gain FROM aw{p} a, ag{p}, sizes),
av{p} AS MATERIALIZED (SELECT *, done OR (NOT gain AND waited + 1 >= 8) AS stop, list_transform(range(1, {_W + 1}), lambda i: sign(g[i] * before[i])) AS turned FROM au{p}),
ax{p} AS MATERIALIZED (SELECT *, list_transform(range(1, {_W + 1}), lambda i: CASE turned[i] WHEN 1 THEN least(step[i] * 1.2::DOUBLE, 1.0::DOUBLE) WHEN -1 THEN step[i] * 0.5::DOUBLE ELSE step[i] END) AS next_step,
    list_transform(range(1, {_W + 1}), lambda i: CASE WHEN turned[i] < 0 THEN 0.0::DOUBLE ELSE g[i] END) AS next_before FROM av{p}),
aw{p + 1} AS MATERIALIZED (SELECT CASE WHEN stop THEN w ELSE list_transform(range(1, {_W + 1}), lambda i: w[i] - sign(next_before[i]) * next_step[i]) END AS w, next_step AS step, next_before AS before,
    CASE WHEN gain AND NOT done THEN w ELSE best END AS best, CASE WHEN gain AND NOT done THEN loss ELSE best_loss END AS best_loss, CASE WHEN gain THEN 0 ELSE waited + 1 END AS waited, stop AS done FROM ax{p})"""
    return out + f""",
final AS (SELECT CASE WHEN n_held > 0 THEN best ELSE w END AS w FROM aw{_PASSES}, sizes),
err AS MATERIALIZED (SELECT k, {square} / {_D} AS err FROM (SELECT k, {off} AS e FROM (SELECT k, v, w, {raw} AS raw FROM fx, final)))"""


ENSEMBLE = f"""{_forest()}{_walk()}{_coder()},
res AS (SELECT mono_id || '|' || cohort_dt::VARCHAR AS k, residual FROM r), every AS MATERIALIZED (SELECT mono_id, cohort_dt, total, residual, err FROM fx JOIN iso USING (k) JOIN err USING (k) JOIN res USING (k)),
past AS (SELECT * FROM every WHERE cohort_dt < {AT}), size_ AS (SELECT count(*)::DOUBLE AS n FROM past),
pct AS MATERIALIZED (SELECT mono_id, (SELECT count(*) FROM past p WHERE p.total >= e.total) / n * 100 AS if_score, (SELECT count(*) FROM past p WHERE p.residual <= e.residual) / n * 100 AS residual_score,
    (SELECT count(*) FROM past p WHERE p.err <= e.err) / n * 100 AS autoencoder_score FROM every e, size_ WHERE cohort_dt = {AT}),
ens AS (SELECT *, greatest(0, least(100, if_score * 0.4::DOUBLE + residual_score * 0.35::DOUBLE + autoencoder_score * 0.25::DOUBLE)) AS ensemble_score FROM pct),
lim AS (SELECT greatest(quantile_cont(ensemble_score, 0.95), 90.0) AS sari, quantile_cont(ensemble_score, 0.98) AS q2, quantile_cont(ensemble_score, 0.99) AS q3 FROM ens),
lim2 AS (SELECT sari, greatest(q2, 95.0, sari) AS turuncu, greatest(q3, 97.5, q2, 95.0, sari) AS kirmizi FROM lim)"""

# the reasons of the run: severities, what each value is compared with, and the order in which a review reads them
_plain = lambda x: f"""CASE WHEN {x} IS NULL THEN 'NA' WHEN {x} = 0 THEN '0' WHEN abs({x}) >= 1000 THEN printf('%.0f', round_even({x}, 0)) {' '.join(f"WHEN abs({x}) >= {low} THEN regexp_replace(printf('%.{d}f', round({x}::DECIMAL(30, 6), {d})::DOUBLE), '[.]?0+$', '')" for low, d in ((10, 2), (1, 3), (0.01, 4), (0.0001, 6)))} ELSE printf('%.2e', {x}) END"""
FLAGSHIP = f"""{ENSEMBLE},
latest AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY mono_id ORDER BY cohort_dt DESC) = 1), before AS (SELECT mono_id, feature, value AS previous FROM ({_sides('latest')})),
usual AS (SELECT feature, median(value) AS train FROM past_long GROUP BY 1),
grave AS (SELECT mono_id, feature, abs(z) AS severity FROM (SELECT mono_id, unnest(v) AS z, unnest([{', '.join(f"'{f}'" for f in _FEATURES)}]) AS feature FROM fx WHERE cohort_dt = {AT})),
why AS (SELECT g.*, severity / CASE WHEN total = 0 THEN 1.0 ELSE total END * 100 AS share, p.value, peer_median AS peer, peer_z, peer_support, peer_level, peer_quality, previous, train,
    CASE WHEN regexp_matches(feature, 'risk|pd|utilization|debt') THEN 'HIGHER_IS_RISKY' ELSE 'UNKNOWN' END AS direction, row_number() OVER (PARTITION BY mono_id ORDER BY severity DESC, feature) AS grade
    FROM (SELECT *, sum(severity) OVER (PARTITION BY mono_id) AS total FROM grave) g JOIN peers p USING (mono_id, feature) LEFT JOIN before USING (mono_id, feature) JOIN usual USING (feature) WHERE severity > 0),
why2 AS (SELECT *, {_reference('label', 'value', 'previous', 'peer', 'train', 'peer_z', 'share', '0.0')} AS label, {_reference('value', 'value', 'previous', 'peer', 'train', 'peer_z', 'share', '0.0')} AS reference FROM why),
why3 AS (SELECT *, {_comment('direction', 'value', 'label', 'reference')} AS comment, {_said('value', 'previous', 'peer', 'direction', 'FALSE')} AS said, round_even(share, 2) AS pct, replace(feature, '_', ' ') AS named,
    round(value, 6) AS v6, round(previous, 6) AS prev6, round(peer, 6) AS peer6, round(peer_z, 4) AS z4 FROM why2),
why4 AS (SELECT *, row_number() OVER (PARTITION BY mono_id ORDER BY {_bucket('value IS NULL', 'comment')}, share DESC, grade) AS place, printf('%.1f', round(pct::DECIMAL(30, 2), 1)::DOUBLE) AS pct1,
    concat_ws(':', feature, (value IS NULL)::VARCHAR, {', '.join(_four(f'{c}::DECIMAL(30, 6)') for c in ('v6', 'prev6', 'peer6', 'z4', 'train'))}, pct1, peer_support::BIGINT::VARCHAR, peer_level, peer_quality, coalesce(label, ''), comment, coalesce(said, ''), '') AS part FROM why3),
why5 AS (SELECT *, CASE WHEN value IS NULL THEN named || ': deger missing; katki %' || pct1 || '; referans=' || coalesce(label, 'NA')
    WHEN label = 'peer medyan' THEN concat_ws('; ', named || ': peer''e gore sapma yuksek', 'gerceklesen=' || {_plain('v6')}, 'peer=' || {_plain('peer6')}, 'peer_z=' || {_plain('z4')}, 'peer_support=' || peer_support::BIGINT, 'peer_temsil=' || peer_quality, 'katki=%' || pct1, comment, said)
    ELSE named || ': gerceklesen=' || {_plain('v6')} || ', onceki=' || {_plain('prev6')} || ', peer=' || {_plain('peer6')} || ', katki=%' || pct1 || '; ' || comment END AS told FROM why4 WHERE place <= 3),
whys AS (SELECT mono_id, {', '.join(f'max(told) FILTER (place = {i}) AS reason_{i}' for i in (1, 2, 3))}, string_agg(part, ' | ' ORDER BY place) AS reason_details, bool_or(regexp_matches(feature, 'irb|pd|rating|memzuc|bank|risk')) AS credit FROM why5 GROUP BY 1),
full_ AS (SELECT mono_id, count(value) / {len(_FEATURES)}::DOUBLE AS covered FROM peers GROUP BY 1),
run1 AS (SELECT ens.*, covered, (1 - covered) * 100 AS gap, w.* EXCLUDE (mono_id), CASE WHEN ensemble_score >= kirmizi THEN 'KIRMIZI' WHEN ensemble_score >= turuncu THEN 'TURUNCU' WHEN ensemble_score >= sari THEN 'SARI' ELSE 'NORMAL' END AS alert_band,
    greatest(0, least(100, (covered * 0.65::DOUBLE + (1 - (greatest(if_score, residual_score, autoencoder_score) - least(if_score, residual_score, autoencoder_score)) / 100) * 0.35::DOUBLE) * 100)) AS confidence
    FROM ens JOIN full_ USING (mono_id) LEFT JOIN whys w ON w.mono_id = ens.mono_id CROSS JOIN lim2),
run2 AS (SELECT *, CASE WHEN alert_band = 'NORMAL' AND (gap >= 30 OR covered < 0.7) THEN 'DATA_GAP' WHEN credit IS NULL THEN 'UNKNOWN' WHEN credit THEN 'CREDIT_RISK' ELSE 'FINANCIAL_SIGNAL' END AS alert_type FROM run1)"""

# Answers of customers and what the contract makes of them.
ANSWERS = """k AS (SELECT c_custkey AS k, c_custkey::VARCHAR AS mono_id, c_mktsegment AS seg, c_acctbal AS bal FROM customer),
a1 AS (SELECT *, k % 19 = 0 AS broken, concat_ws(',', CASE WHEN k % 13 = 0 THEN 'reason_summary' END, CASE WHEN k % 17 = 0 THEN 'reason_1_weight' END, CASE WHEN k % 6 = 0 THEN 'risk_level' END) AS missing FROM k),
a2 AS (SELECT *, CASE WHEN broken THEN 'no answer could be decoded' WHEN missing <> '' THEN 'missing required fields: ' || missing WHEN k % 11 = 0 THEN 'period_position must be 0: 1' END AS error,
    k % 3 <> 2 AS is_anomaly, CASE k % 4 WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'PD_RISKI' ELSE 'PEER_UYUMSUZLUGU' END AS anomaly_type, CASE k % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 ELSE k % 100 / 100::DOUBLE END AS anomaly_score,
    seg || ' ozet' AS reason_summary, CASE WHEN k % 7 = 0 THEN '' ELSE 'account balance of ' || lower(seg) END AS reason_1, k % 10 / 10::DOUBLE AS w1, CASE WHEN k % 2 <> 0 THEN 'order total: current=1; previous=2; peer_z=3' END AS reason_2,
    CASE WHEN k % 3 = 0 THEN 'nothing like it' END AS reason_3 FROM a1)"""
_good = lambda x: f"CASE WHEN error IS NULL THEN {x} END"
_number = lambda x: f"CASE WHEN {x} = 0 THEN '0' ELSE regexp_replace(regexp_replace(CASE WHEN abs({x}) >= 10 THEN printf('%.4f', {x}::DOUBLE) WHEN abs({x}) >= 1 THEN printf('%.5f', {x}::DOUBLE) ELSE printf('%.6f', {x}::DOUBLE) END, '0+$', ''), '[.]$', '') END"
_records = lambda n1, n2, n3: f"""CASE WHEN coalesce(reason_1, '') = '' AND coalesce(reason_2, '') = '' AND coalesce(reason_3, '') = '' THEN [{{'feature': 'GENEL_DEGERLENDIRME', 'evidence': '', 'interpretation': reason_summary}}]
    ELSE list_filter([{', '.join(f"CASE WHEN coalesce(reason_{i}, '') <> '' THEN {{'feature': 'REASON_{i}', 'evidence': concat_ws('; ', printf('weight=%.4f', {w}), {n}), 'interpretation': reason_{i}}} END" for i, w, n in ((1, 'w1', n1), (2, '0.0::DOUBLE', n2), (3, '0.0::DOUBLE', n3)))}], lambda r: r IS NOT NULL) END"""  # noqa: E731
_NUMBERS = f"""CASE f WHEN 0 THEN concat_ws('; ', 'feature=Order total', CASE WHEN k % 5 <> 0 THEN 'current=' || k % 50 END, 'history_median=10', CASE WHEN k % 5 <> 0 AND k % 4 > 0 THEN 'history_z=' || {_number('round((k % 50 - 10) / (k % 4)::DOUBLE, 6)')} END, 'risk_direction=HIGHER_IS_RISKY')
    WHEN 1 THEN concat_ws('; ', 'feature=Account balance', 'current=' || {_number('round(bal / 1000)')}, 'history_median=0', CASE WHEN k % 4 > 0 THEN 'history_z=' || {_number('round(round(bal / 1000) / (k % 4)::DOUBLE, 6)')} END, 'risk_direction=HIGHER_IS_RISKY')
    WHEN 2 THEN concat_ws('; ', 'feature=Share of the segment', 'current=' || k % 9, 'risk_direction=HIGHER_IS_RISKY') END"""
# The first reason speaks of the account balance, the second of the order total, the third of nothing: it has the feature at its place.
REASON_NUMBERS = f"""{ANSWERS},
m AS (SELECT *, {_NUMBERS.replace('CASE f', "CASE CASE WHEN reason_1 <> '' THEN 1 END")} AS n1, {_NUMBERS.replace('CASE f', 'CASE CASE WHEN reason_2 IS NOT NULL THEN 0 END')} AS n2, {_NUMBERS.replace('CASE f', 'CASE CASE WHEN reason_3 IS NOT NULL THEN 2 END')} AS n3, {_NUMBERS.replace('CASE f', 'CASE 0')} AS n0 FROM a2 WHERE error IS NULL),
e AS (SELECT mono_id, k, w1, n1, n2, n3, reason_summary || '. Sayisal ozet: ' || coalesce(n1, n0) || '.' AS reason_summary, CASE WHEN reason_1 = '' THEN '' ELSE reason_1 || '. Sayisal kanit: ' || n1 || '.' END AS reason_1, reason_2,
    reason_3 || '. Sayisal kanit: ' || n3 || '.' AS reason_3 FROM m)"""

ORACLES: dict[str, str] = {
    "decision_contract": f"""WITH {ANSWERS} SELECT mono_id, {_good('is_anomaly')} AS is_anomaly, {_good('anomaly_type')} AS anomaly_type, {_good("'YUKSEK'")} AS risk_level, {_good('round(anomaly_score, 6)')} AS anomaly_score, {_good('reason_summary')} AS reason_summary,
        {_good('reason_1')} AS reason_1, {_good('reason_2')} AS reason_2, {_good('round(w1, 6)')} AS reason_1_weight, {_good('0.0::DOUBLE')} AS reason_2_weight, {_good('0.0::DOUBLE')} AS reason_3_weight, {_good("CASE WHEN is_anomaly THEN 'Manuel incele' ELSE 'Izle' END")} AS recommended_action,
        {_good('len(' + _records('NULL', 'NULL', 'NULL') + ')')}::BIGINT AS n_reasons, {_good('(' + _records('NULL', 'NULL', 'NULL') + ')[1].feature')} AS first_reason, {_good('(' + _records('NULL', 'NULL', 'NULL') + ')[1].evidence')} AS first_evidence, error FROM a2""",
    "reasons_with_numbers": f"""WITH {REASON_NUMBERS} SELECT mono_id, reason_summary, reason_1, reason_2, reason_3, to_json({_records('n1', 'n2', 'n3')})::VARCHAR AS main_reasons FROM e""",
    "decision_result_rows": f"""WITH {ANSWERS} SELECT 'run-1' AS run_id, mono_id, '2000-12-31' AS cohort_dt, is_anomaly::INT AS is_anomaly, anomaly_type, 'YUKSEK' AS risk_level, round(anomaly_score, 6) AS anomaly_score, round(anomaly_score, 6) AS llm_confidence,
        CASE WHEN k % 8 <> 0 THEN round(bal / 100, 2) END AS ml_ensemble_score, CASE WHEN k % 8 <> 0 AND bal <= 5000 THEN 0 ELSE 1 END AS ml_is_anomaly, CASE WHEN k % 8 <> 0 THEN CASE WHEN bal > 5000 THEN 'KIRMIZI' ELSE 'NORMAL' END END AS ml_alert_band, NULL::DOUBLE AS ml_if_score,
        reason_summary, nullif(reason_1, '') AS reason_1, round(w1, 6) AS reason_1_weight, reason_2, reason_3, CASE WHEN is_anomaly THEN 'Manuel incele' ELSE 'Izle' END AS recommended_action, 'rules' AS llm_model, 'customers' AS evidence_source, NULL::VARCHAR AS caveat FROM a2 WHERE error IS NULL""",
    "isolation_forest_nodes": f"WITH {_forest()} SELECT tree::INT AS tree, node::INT AS node, coalesce(f - 1, -1)::INT AS feature, round(coalesce(cut, 0), 6) AS threshold, (length // 1000)::BIGINT AS length FROM nodes",
    "ensemble_scores": f"""WITH {ENSEMBLE} SELECT mono_id, round(if_score, 4) AS if_score, round(residual_score, 4) AS residual_score, round(autoencoder_score, 4) AS autoencoder_score, round(ensemble_score, 4) AS ensemble_score,
        round(greatest(0, least(100, (0.65::DOUBLE + (1 - (greatest(if_score, residual_score, autoencoder_score) - least(if_score, residual_score, autoencoder_score)) / 100) * 0.35::DOUBLE) * 100)), 4) AS agreement,
        CASE WHEN ensemble_score >= kirmizi THEN 'KIRMIZI' WHEN ensemble_score >= turuncu THEN 'TURUNCU' WHEN ensemble_score >= sari THEN 'SARI' ELSE 'NORMAL' END AS alert_band FROM ens, lim2""",
    "reason_references": f"""WITH {FACTS} SELECT mono_id, {_reference('label', 'actual', 'previous', 'peer', 'train', 'peer_z', 'peer_pct', '50.0')} AS label,
        round({_reference('value', 'actual', 'previous', 'peer', 'train', 'peer_z', 'peer_pct', '50.0')}, 4) AS value FROM facts""",
    "reason_comments": f"""WITH {FACTS}, c AS (SELECT *, {_comment('direction', 'actual', "'peer medyan'", 'peer')} AS comment FROM facts)
        SELECT mono_id, CASE WHEN term_column IS NULL OR term IS NULL THEN NULL WHEN term = previous_term THEN term_column || '=' || term || '; onceki ayla ayni finansal term tasiniyor'
            WHEN previous_term IS NOT NULL THEN term_column || '=' || term || '; onceki term=' || previous_term ELSE term_column || '=' || term END AS term_detail, comment,
        {_said('actual', 'previous', 'peer', 'direction', 'coalesce(term_column IS NOT NULL AND term = previous_term, FALSE)')} AS previous_comment, {_bucket('actual IS NULL', 'comment')}::BIGINT AS review_bucket FROM c""",
    "reason_rows": f"""WITH {REASONS} SELECT mono_id, {DAY}, feature, value IS NULL AS is_missing_reason, round(value, 4) AS actual, round(round(share, 2), 1) AS contribution_pct, label AS reference_used, comment AS direction_comment,
        {_said('value', 'previous', 'peer', 'direction', 'FALSE')} AS previous_comment FROM first WHERE place = 1""",
    "reason_detail_rows": """WITH r AS (SELECT c_custkey AS k, c_acctbal, unnest(CASE c_custkey % 4 WHEN 0 THEN [1, 2] WHEN 1 THEN [3] ELSE [] END) AS rank FROM customer)
        SELECT CAST(k AS VARCHAR) AS mono_id, '2000-12-31' AS cohort_dt, CASE WHEN rank = 2 THEN 2 ELSE 1 END::BIGINT AS feature_rank, 'f' || (k % 5 + rank) AS feature, round(c_acctbal * rank, 4) AS actual, k * rank AS peer_support,
        (k % 50)::DOUBLE AS peer_pct, CAST(NULL AS VARCHAR) AS label FROM r""",
    "shaped_results": """SELECT CAST(c_custkey AS VARCHAR) AS mono_id, '2000-12-31' AS cohort_dt, CASE WHEN c_custkey % 5 > 1 THEN c_custkey % 100 + 0.25::DOUBLE END AS anomaly_score, CAST(NULL AS DOUBLE) AS ensemble_score,
        substring(repeat(c_mktsegment, 20), 1, 32) AS alert_band, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS reason_1, c_custkey % 7 AS rank_in_run FROM customer""",
    "decision_reason_rows": """WITH r AS (SELECT c_custkey AS k, c_mktsegment, unnest(range(1, CAST(c_custkey % 4 + 1 AS BIGINT))) AS i FROM customer)
        SELECT 'run-1' AS run_id, CAST(k AS VARCHAR) AS mono_id, '2000-12-31' AS cohort_dt, i AS reason_rank, ['a', 'b', 'c'][i] AS feature, 'z=' || (k % 10) AS evidence, least(2000, 300 * length(c_mktsegment)) AS n_interpretation FROM r""",
    "evidence_ranked": f"""WITH {EVIDENCE} SELECT mono_id, feature, round(value, 4) + 0.0 AS value, round(previous, 4) + 0.0 AS previous_value, round(peer_z, 4) + 0.0 AS peer_z, round(history_z, 4) + 0.0 AS history_z, round(slope_6m, 4) + 0.0 AS slope_6m,
        round(month_z, 4) + 0.0 AS same_month_customer_z, round(season_z, 4) + 0.0 AS seasonal_peer_z, round(strength, 4) AS evidence_strength, broken AS trend_break_flag, rank AS evidence_rank FROM ranked""",
    "decision_feature_rows": f"""WITH {EVIDENCE} SELECT 'run-1' AS run_id, mono_id, '2000-12-31' AS cohort_dt, feature, rank AS feature_rank, round(value, 4) AS value, coalesce(n, 0) AS period_count, peer_level,
        CAST(peer_support AS BIGINT) AS peer_support, CAST(broken AS INT) AS trend_break, CAST(value IS NULL AS INT) AS missing_flag FROM ranked""",
    "residual_scores": f"""WITH {RESIDUAL} SELECT mono_id, round(residual, 5) AS residual, round((SELECT count(*) FROM rp WHERE rp.residual <= r.residual) / (SELECT CAST(count(*) AS DOUBLE) FROM rp) * 100, 2) AS residual_score FROM r WHERE cohort_dt = {AT}""",
    "month_profile": f"WITH {MONTHS} SELECT strftime(cohort_dt, '%Y-%m-%d') AS month, count(*) AS n_rows FROM panel GROUP BY 1",
    "month_tail": f"WITH {MONTHS} SELECT strftime(cohort_dt, '%Y-%m-%d') AS month, count(*) AS n_rows FROM panel GROUP BY 1 ORDER BY 1 DESC LIMIT 6",
    "numeric_coverage": f"WITH {YEARS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(count({c}) / count(*), 6) AS coverage, count(DISTINCT {c}) AS n_distinct, round(1 - count({c}) / count(*), 6) AS missing_rate FROM panel" for c in MEASURES),
    "locale_numeric_parse": """
        SELECT o_orderkey, round(CASE o_orderkey % 5
            WHEN 0 THEN CAST((o_orderkey % 900 + 1) || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS DOUBLE)
            WHEN 1 THEN CAST((o_orderkey % 10000) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS DOUBLE)
            WHEN 2 THEN CAST((o_orderkey % 90) || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '.5' AS DOUBLE) END, 6) AS number FROM orders""",
    "mixed_date_parse": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "window_split_counts": f"WITH {YEARS} SELECT 'train' AS part, count(*) AS n_rows, count(DISTINCT mono_id) AS n_ids FROM panel WHERE cohort_dt < {AT} UNION ALL SELECT 'score', count(*), count(DISTINCT mono_id) FROM panel WHERE cohort_dt = {AT}",
    "latest_prior_by_id": f"WITH {YEARS} SELECT mono_id, strftime(max(cohort_dt), '%Y-%m-%d') AS cohort_dt, round(arg_max(bank_total_risk, cohort_dt), 6) AS bank_total_risk FROM panel WHERE cohort_dt < {AT} GROUP BY 1",
    "asof_previous_value": f"""WITH {YEARS}, prev AS (SELECT mono_id, arg_max(bank_total_risk, cohort_dt) AS previous FROM panel WHERE cohort_dt < {AT} GROUP BY 1)
        SELECT mono_id, round(bank_total_risk, 6) AS value, round(previous, 6) AS previous, round(CASE WHEN abs(previous) >= 1e-9 THEN (bank_total_risk - previous) / abs(previous) * 100 END, 4) AS change_pct
        FROM panel LEFT JOIN prev USING (mono_id) WHERE cohort_dt = {AT}""",
    "new_entities": f"WITH {YEARS} SELECT mono_id FROM panel WHERE cohort_dt = {AT} EXCEPT SELECT mono_id FROM panel WHERE cohort_dt < {AT}",
    "union_latest": f"WITH {YEARS} SELECT mono_id, {DAY}, CASE WHEN n_orders > 1 THEN n_orders * 10 ELSE n_orders END AS n_orders FROM panel",
    "safe_ratio": f"WITH {YEARS} SELECT mono_id, {DAY}, round({_ratio('bank_total_risk', 'toplam_varlik_ttr')}, 6) AS ratio FROM panel",
    "formula_nested": f"""WITH {YEARS}, r AS (SELECT *, {_ratio('bank_total_risk', 'toplam_varlik_ttr')} AS a, {_ratio('memzuc_total_risk', 'memzuc_total_limit')} AS d FROM panel)
        SELECT mono_id, {DAY}, round({_ratio('a', 'd', 'r')} - 2 * n_orders, 6) AS b, CAST(NULL AS DOUBLE) AS c FROM r""",
    "signed_log1p": "SELECT c_custkey, round(sign(c_acctbal) * ln(1 + abs(c_acctbal)), 6) AS t FROM customer",
    "feature_coverage_select": f"WITH {YEARS} " + _union_features("count({c}) FILTER (cohort_dt < DATE '2000-12-31') / count(*) FILTER (cohort_dt < DATE '2000-12-31') >= 0.5 AND count(DISTINCT {c}) FILTER (cohort_dt <= DATE '2000-12-31') > 1"),
    "features_with_gaps": f"WITH {YEARS} "
    + _union_features("greatest(1 - count({c}) FILTER (cohort_dt < DATE '2000-12-31') / count(*) FILTER (cohort_dt < DATE '2000-12-31'), 1 - count({c}) FILTER (cohort_dt = DATE '2000-12-31') / count(*) FILTER (cohort_dt = DATE '2000-12-31')) >= 0.005"),
    "size_bucket_quartiles": f"WITH {YEARS}, {_sized('panel', 'bank_total_risk', 'ctx')} SELECT mono_id, {DAY}, peer_size FROM ctx",
    "peer_stats_by_level": f"WITH {LONG} "
    + " UNION ALL ".join(
        f"""SELECT feature, '{name}' AS level, max(n) AS support, round(max(m), 6) AS median, round(max(tm), 6) AS t_median, round(median(abs(t - tm)), 6) AS mad
        FROM (SELECT *, count(value) OVER w AS n, median(value) OVER w AS m, median(t) OVER w AS tm FROM long WINDOW w AS (PARTITION BY feature, {keys})) GROUP BY feature, {keys} HAVING max(n) >= 50"""
        for name, keys in _LEVELS.items()
    ),
    "peer_hierarchy_z": f"WITH {LONG}, {_peers('long')} SELECT mono_id, {DAY}, feature, peer_level, CAST(peer_support AS BIGINT) AS peer_support, round(peer_median, 6) AS peer_median, round(peer_z, 5) AS peer_z, CAST(peer_score AS DOUBLE) AS peer_score, peer_quality FROM peers",
    "peer_quality": f"WITH {LONG}, {_peers('long')} SELECT 'quality' AS kind, peer_quality AS name, count(*) AS n FROM peers GROUP BY 2 UNION ALL SELECT 'level', peer_level, count(*) FROM peers GROUP BY 2",
    "peer_diagnostics": f"""WITH {LONG}, {_peers('long')},
        d AS (SELECT count(*) AS total, {', '.join(f"round_even(count(*) FILTER (peer_quality = '{q}') / count(*) * 100, 2) AS {n}" for q, n in (('GUCLU', 'strong_pct'), ('KABUL_EDILEBILIR', 'acceptable_pct'), ('ZAYIF', 'weak_pct')))},
            round_even(count(*) FILTER (peer_level IN ('AY_SEGMENT_SEKTOR_SIZE', 'AY_SEGMENT_SEKTOR', 'AY_SEGMENT_SIZE')) / count(*) * 100, 2) AS narrow_pct,
            {', '.join(f'round_even(quantile_cont(peer_support, 0.{p}), 2) AS support_p{p}' for p in (10, 50, 90))} FROM peers),
        e AS (SELECT *, round_even(strong_pct + acceptable_pct, 2) AS good_pct FROM d),
        r AS (SELECT *, CASE WHEN good_pct >= 95 AND weak_pct <= 5 AND support_p10 >= 50 AND support_p50 >= 100 AND narrow_pct >= 75 THEN 'PASS' WHEN weak_pct <= 15 AND good_pct >= 85 AND support_p10 >= 50 THEN 'WARN' ELSE 'FAIL' END AS result FROM e)
        SELECT *, CASE result WHEN 'PASS' THEN 'PEER_SET_KURUMSAL_OLARAK_GUCLU' WHEN 'WARN' THEN 'PEER_SET_KABUL_EDILEBILIR_EK_KONTROL_GEREKIR' ELSE 'PEER_SET_ZAYIF_SEGMENTASYON_VE_FALLBACK_GOZDEN_GECIRILMELI' END AS assessment FROM r""",
    "robust_scale_ladder": f"""WITH {YEARS}, t AS (SELECT musteri_segment, cohort_dt, {LOG.format('returned_amount')} AS t FROM panel),
        a AS (SELECT musteri_segment, cohort_dt, median(t) AS m, quantile_cont(t, 0.75) - quantile_cont(t, 0.25) AS iqr, stddev_samp(t) AS sd, count(t) AS n FROM t GROUP BY 1, 2),
        b AS (SELECT musteri_segment, cohort_dt, any_value(iqr) AS iqr, any_value(sd) AS sd, any_value(n) AS n, median(abs(t - m)) AS mad FROM t JOIN a USING (musteri_segment, cohort_dt) GROUP BY 1, 2)
        SELECT musteri_segment, {DAY}, round(CASE WHEN n = 0 THEN 1.0 WHEN mad > 1e-9 THEN greatest(mad * 1.4826, 1e-6) WHEN iqr > 1e-9 THEN greatest(iqr / 1.349, 1e-6) WHEN n < 2 THEN NULL ELSE greatest(sd, 1.0) END, 6) AS scale FROM b""",
    "preprocessor_stats": f"WITH {PREPARED} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(f.{c}, 5) AS fill, round({c}_low, 5) AS low, round({c}_high, 5) AS high, round({c}_c, 5) AS center, round({c}_s, 5) AS scale FROM f, b, s" for c in _PREP),
    "winsor_robust_transform": f"WITH {PREPARED} SELECT mono_id, {DAY}, {', '.join(f'round({c}, 5) AS {c}' for c in _PREP)} FROM z",
    "row_top3_mean": f"WITH {PREPARED} SELECT mono_id, {DAY}, round(list_sum(list_reverse_sort([{', '.join(f'abs({c})' for c in _PREP)}])[1:2]) / 2, 5) AS residual FROM z",
    "empirical_percentile": f"WITH {SCORES} SELECT mono_id, round(ensemble_score, 6) AS ensemble_score FROM scores",
    "band_thresholds": f"WITH {SCORES} SELECT 'sari' AS band, round(sari, 6) AS threshold FROM th UNION ALL SELECT 'turuncu', round(turuncu, 6) FROM th UNION ALL SELECT 'kirmizi', round(kirmizi, 6) FROM th",
    "band_assign": f"WITH {SCORES} SELECT mono_id, alert_band FROM banded",
    "balanced_selection": f"""WITH {SCORES}
        (SELECT mono_id, alert_band, round(ensemble_score, 6) AS selection_score, 'ANOMALY' AS selection_group FROM banded WHERE alert_band <> 'NORMAL' ORDER BY ensemble_score DESC, mono_id LIMIT 5)
        UNION ALL (SELECT mono_id, alert_band, round(ensemble_score, 6), 'NORMAL' FROM banded WHERE alert_band = 'NORMAL' ORDER BY ensemble_score, mono_id LIMIT 5)""",
    "companion_join": f"""WITH {SCORES} SELECT p.mono_id, strftime(p.cohort_dt, '%Y-%m-%d') AS cohort_dt, round(ensemble_score, 6) AS ml_ensemble_score, alert_band AS ml_alert_band, coalesce(alert_band, '') <> 'NORMAL' AS ml_is_anomaly
        FROM panel p LEFT JOIN banded b ON p.mono_id = b.mono_id WHERE year(p.cohort_dt) >= 2000""",
    "confidence_coverage": f"""WITH {YEARS}, c AS (SELECT *, ((returned_amount IS NOT NULL)::INT + (bank_total_risk IS NOT NULL)::INT + (toplam_varlik_ttr IS NOT NULL)::INT + (quantity IS NOT NULL)::INT) / 4.0 AS c, n_orders * 7 % 100 AS a, quantity % 100 AS b FROM panel)
        SELECT mono_id, {DAY}, round(CAST(c AS DOUBLE), 6) AS coverage, round(CAST((1 - c) * 100 AS DOUBLE), 6) AS data_gap, CAST(4 - 4 * c AS BIGINT) AS n_missing,
        round(greatest(0, least(100, (0.65 * CAST(c AS DOUBLE) + 0.35 * (1 - (greatest(a, b) - least(a, b)) / 100)) * 100)), 4) AS confidence FROM c""",
    "family_severity_top_reasons": f"""WITH {PREPARED}, l AS ({' UNION ALL '.join(f"SELECT mono_id, cohort_dt, '{c}' AS feature, round(abs({c}), 5) AS s FROM z" for c in _PREP)}),
        r AS (SELECT *, sum(s) OVER (PARTITION BY mono_id, cohort_dt) AS total, row_number() OVER (PARTITION BY mono_id, cohort_dt ORDER BY s DESC, feature) AS rank FROM l)
        SELECT mono_id, {DAY}, feature, rank, round(s / total * 100, 3) AS contribution FROM r WHERE rank <= 2 AND s > 0""",
    "alert_type_queue": f"""WITH {SCORES}, g AS (SELECT *, CAST(length(mono_id) * 13 % 50 AS DOUBLE) AS gap FROM banded),
        k AS (SELECT *, CASE WHEN alert_band = 'NORMAL' AND (gap >= 30 OR 1 - gap / 100 < 0.7) THEN 'DATA_GAP' WHEN ensemble_score > 50 THEN 'CREDIT_RISK' WHEN ensemble_score > 20 THEN 'FINANCIAL_SIGNAL' ELSE 'UNKNOWN' END AS alert_type FROM g)
        SELECT mono_id, alert_type, CASE WHEN alert_band = 'NORMAL' THEN CASE WHEN alert_type = 'DATA_GAP' OR gap >= 30 THEN 'DATA_QUALITY_REVIEW' ELSE 'NO_ACTION' END WHEN alert_band = 'KIRMIZI' THEN 'URGENT_FINANCIAL_REVIEW'
        WHEN alert_band = 'TURUNCU' THEN 'FINANCIAL_REVIEW' ELSE 'WATCHLIST' END AS review_queue FROM k""",
    "alert_counts_grouping_sets": f"WITH {SCORES} SELECT alert_band, musteri_segment, count(*) AS n FROM banded GROUP BY GROUPING SETS ((alert_band), (musteri_segment))",
    "history_metrics": f"WITH {HISTORY} SELECT mono_id, n AS period_count, round(median, 4) AS median, round(p25, 4) AS p25, round(p75, 4) AS p75, round({_scale('0.0')}, 8) AS robust_scale FROM m",
    "rolling_medians": f"WITH {HISTORY} SELECT mono_id, round(median(value) FILTER (ago <= 3), 4) AS rolling_3m_median, round(median(value) FILTER (ago <= 6), 4) AS rolling_6m_median, round(median(value) FILTER (ago <= 12), 4) AS rolling_12m_median, round(max(value) FILTER (ago = 1), 4) AS previous_value FROM tail GROUP BY 1",
    "trend_slope_break": f"""WITH {HISTORY}, c AS (SELECT mono_id, value, ago FROM tail WHERE ago <= 12 UNION ALL SELECT mono_id, value, 0 FROM now),
        s AS (SELECT mono_id, regr_slope(value, -ago) FILTER (ago < 6) AS s6, regr_slope(value, -ago) FILTER (ago < 12) AS s12 FROM c GROUP BY 1)
        SELECT mono_id, round(CASE WHEN n >= 3 THEN s6 END, 3) AS slope_6m, round(CASE WHEN n >= 3 THEN s12 END, 3) AS slope_12m, coalesce(n >= 3 AND abs(value - median) / ({_scale('1.0')}) >= 3, FALSE) AS trend_break_flag
        FROM now LEFT JOIN m USING (mono_id) LEFT JOIN s USING (mono_id)""",
    "same_month_value": f"""WITH {HISTORY}, y AS (SELECT * FROM h WHERE month(cohort_dt) = 6),
        y1 AS (SELECT mono_id, median(value) AS med, stddev_samp(value) AS sd, count(*) AS n, arg_max(value, cohort_dt) AS last FROM y GROUP BY 1),
        y2 AS (SELECT mono_id, any_value(med) AS med, any_value(sd) AS sd, any_value(n) AS n, any_value(last) AS last, median(abs(value - med)) AS mad FROM y JOIN y1 USING (mono_id) GROUP BY 1)
        SELECT mono_id, round(last, 3) AS same_month_last_year_value, round(CASE WHEN abs(last) >= 1e-9 THEN (value - last) / abs(last) * 100 END, 3) AS yoy_change_pct, round(med, 3) AS same_month_customer_median,
        round(CASE WHEN n >= 2 THEN (value - med) / ({_scale('1.0')}) END, 3) AS same_month_customer_z FROM now LEFT JOIN y2 USING (mono_id)""",
    "seasonal_peer_median": f"""WITH {MONTHS}, {_sized('panel', 'toplam_varlik_ttr', 'ctx')}, t AS (SELECT * FROM ctx WHERE cohort_dt < {MONTH} AND month(cohort_dt) = 6 AND bank_total_risk IS NOT NULL),
        l0 AS (SELECT peer_segment, peer_sector, peer_size, median(bank_total_risk) AS v FROM t GROUP BY ALL HAVING count(*) >= 50), l1 AS (SELECT peer_segment, peer_sector, median(bank_total_risk) AS v FROM t GROUP BY ALL HAVING count(*) >= 50),
        l2 AS (SELECT peer_segment, peer_size, median(bank_total_risk) AS v FROM t GROUP BY ALL HAVING count(*) >= 50), l3 AS (SELECT peer_segment, median(bank_total_risk) AS v FROM t GROUP BY ALL HAVING count(*) >= 50), l4 AS (SELECT median(bank_total_risk) AS v FROM t)
        SELECT c.mono_id, round(coalesce(l0.v, l1.v, l2.v, l3.v, l4.v), 4) AS seasonal_peer_median FROM (SELECT * FROM ctx WHERE cohort_dt = {MONTH}) c LEFT JOIN l0 USING (peer_segment, peer_sector, peer_size) LEFT JOIN l1 USING (peer_segment, peer_sector)
        LEFT JOIN l2 USING (peer_segment, peer_size) LEFT JOIN l3 USING (peer_segment) CROSS JOIN l4""",
    "snapshot_series_window": f"""WITH {HISTORY}, a AS (SELECT mono_id, cohort_dt, value, FALSE AS c FROM h WHERE mono_id IN (SELECT mono_id FROM now) UNION ALL SELECT mono_id, {MONTH}, value, TRUE FROM now),
        r AS (SELECT *, row_number() OVER (PARTITION BY mono_id ORDER BY cohort_dt DESC) AS ago FROM a)
        SELECT mono_id, row_number() OVER (PARTITION BY mono_id ORDER BY cohort_dt) - 1 AS position, {DAY}, round(value, 4) AS value, c AS is_current_snapshot FROM r WHERE ago <= 6""",
    "reference_scales": f"""WITH {LONG}, a AS (SELECT feature, median(value) AS m, stddev_samp(value) AS sd, count(value) AS n FROM long GROUP BY 1), b AS (SELECT feature, any_value(sd) AS sd, any_value(n) AS n, median(abs(value - m)) AS mad FROM long JOIN a USING (feature) GROUP BY 1)
        SELECT feature, round(CASE WHEN n < 2 THEN 1.0 ELSE {_scale('1.0')} END, 4) AS reference_scale FROM b""",
    "entity_quality": f"""WITH {YEARS}, p AS (SELECT mono_id, count(DISTINCT cohort_dt) AS k FROM panel WHERE cohort_dt < {AT} GROUP BY 1)
        SELECT mono_id, musteri_segment, round(({' + '.join(f'({c} IS NOT NULL)::INT' for c in MEASURES)}) / {len(MEASURES)}, 6) AS coverage_ratio, CAST({' + '.join(f'({c} IS NULL)::INT' for c in MEASURES)} AS BIGINT) AS missing_feature_count,
        coalesce(k, 0) AS customer_history_periods, coalesce(k, 0) < 3 AS insufficient_history_flag FROM panel LEFT JOIN p USING (mono_id) WHERE cohort_dt = {AT}""",
    "category_normalize": "SELECT c_custkey, CASE WHEN c_custkey % 4 = 2 THEN c_mktsegment ELSE 'SEG_NA' END AS segment FROM customer",
    "ensemble_flagship": f"""WITH {FLAGSHIP} SELECT mono_id, '2000-12-31' AS cohort_dt, round(ensemble_score, 4) AS ensemble_score, {', '.join(f'round_even({c}, 1) AS {c}' for c in ('if_score', 'residual_score', 'autoencoder_score', 'confidence'))},
        round_even(covered, 4) AS coverage_ratio, alert_band, alert_type, CASE WHEN alert_band = 'NORMAL' THEN CASE WHEN alert_type = 'DATA_GAP' OR gap >= 30 THEN 'DATA_QUALITY_REVIEW' ELSE 'NO_ACTION' END WHEN alert_band = 'KIRMIZI' THEN 'URGENT_FINANCIAL_REVIEW'
        WHEN alert_band = 'TURUNCU' THEN 'FINANCIAL_REVIEW' ELSE 'WATCHLIST' END AS review_queue, reason_1, reason_2, reason_3, coalesce(reason_details, '') AS reason_details FROM run2""",
    "prompt_dry_run": f"""WITH {PROMPTS} SELECT mono_id, '2000-12-31' AS cohort_dt, 'Karar ver.' || chr(10) || 'musteri=' || mono_id || ' donem=2000-12-31' || chr(10) || string_agg(line, chr(10) ORDER BY rank) AS prompt FROM said WHERE rank <= 12 GROUP BY 1""",
    "evidence_packages": f"""WITH {PACKAGES} SELECT mono_id, '2000-12-31' AS cohort_dt, feature, round(value, 4) + 0.0 AS value, round(peer_z, 4) + 0.0 AS peer_z, round(history_z, 4) + 0.0 AS history_z, round(slope_6m, 4) + 0.0 AS slope_6m,
        round(season_z, 4) + 0.0 AS seasonal_peer_z, round(strength, 4) + 0.0 AS evidence_strength, broken AS trend_break_flag, rank AS evidence_rank, feature AS label, category, formula, source_columns,
        CASE WHEN feature = 'rating_group' OR regexp_matches(feature, 'risk|pd|utilization|debt') THEN 'HIGHER_IS_RISKY' ELSE 'UNKNOWN' END AS risk_direction, series FROM ranked LEFT JOIN told USING (mono_id, feature) LEFT JOIN known USING (feature)""",
    "entity_assessments": f"""WITH {ASSESSED} SELECT mono_id, '2000-12-31' AS cohort_dt, coalesce(season_line, 'Sezon: yeterli sezon metrigi yok; karar sezon kanitina dayanmiyor.') AS seasonality_assessment,
        coalesce(trend_line, 'Trend: yeterli trend metrigi yok; karar trend kanitina dayanmiyor.') AS trend_assessment, coalesce(peer_line, 'Peer: yeterli peer metrigi yok; karar peer kanitina dayanmiyor.') AS peer_assessment,
        'Caveat: ' || concat_ws('; ', 'coverage_ratio=' || {_sig('covered')}, 'missing_feature_count=' || lacking, 'customer_history_periods=' || periods, CASE WHEN weak > 0 THEN 'weak_peer_features=' || weak END) AS caveat
        FROM as4 JOIN as5 USING (mono_id)""",
    "variable_names": """WITH n AS (SELECT p_partkey, p_partkey % 16 AS i, replace(p_name, ' ', '_') AS tail FROM part),
        v AS (SELECT p_partkey, i, CASE WHEN i IN (0, 1, 2, 12, 13, 14) THEN ['mono_id', 'data_time', 'cst_sector', '', '', '', '', '', '', '', '', '', 'rating_group', 'irb_model_pd', 'yukleme_zmn'][i + 1]
            ELSE ['', '', '', 'memzuc_', 'fs_', 'irb_', 'x_tkn_', 'kkb_', 'bank_', 'my_external_', 'x_rating_', 'alacak_', '', '', '', ''][i + 1] || tail END AS name FROM n),
        c AS (SELECT *, CASE WHEN p_partkey % 10 = 0 THEN 'made' WHEN i < 15 THEN ['identity_time', 'technical', 'context', 'memzuc', 'financial', 'pd_rating', 'internal_kkb', 'kkb', 'bank_risk', 'external', 'pd_rating', 'financial', 'pd_rating', 'pd_rating', 'technical'][i + 1]
            WHEN regexp_matches(name, '^(fs_|l1y_|q_)') THEN 'financial' ELSE 'other' END AS category FROM v)
        SELECT p_partkey, name, category, CASE WHEN i = 0 THEN 'id' WHEN i = 12 THEN 'direct_rating_signal_allowed' WHEN i = 13 THEN 'pd_value_excluded_from_llm_features' WHEN category = 'pd_rating' THEN 'pd_rating_signal'
            WHEN i IN (2, 14) THEN 'context_or_peer' WHEN i = 1 THEN 'technical_excluded' ELSE 'numeric_source_candidate' END AS role FROM c""",
    "risk_directions": "SELECT p_partkey, ['LOWER_IS_RISKY', 'HIGHER_IS_RISKY', 'HIGHER_IS_RISKY', 'UNKNOWN'][p_partkey % 4 + 1] AS ml, ['LOWER_IS_RISKY', 'HIGHER_IS_RISKY', 'LOWER_IS_RISKY', 'UNKNOWN'][p_partkey % 4 + 1] AS evidence FROM part",
    "text_token_match": "SELECT c_custkey, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(c_name || '-' || c_mktsegment || '-of it'), '[^0-9a-zçğıöşü]+'), lambda w: length(w) >= 3))), ' ') AS tokens FROM customer",
    "json_extract_repair": "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS k FROM events",
    "event_daily_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "user_day_panel": "SELECT CAST(user_id AS VARCHAR) AS mono_id, strftime(ts, '%Y-%m-%d') AS cohort_dt, count(*) AS n_events, round(round(sum(value), 4), 3) AS total_value, round(avg(CAST(json_extract(props, '$.k') AS DOUBLE)), 4) AS mean_k FROM events GROUP BY 1, 2",
    "customer_year_panel": f"WITH {YEARS} SELECT mono_id, {DAY}, musteri_segment, cst_nace_code_id, {', '.join(f'round({c}, 4) AS {c}' for c in MEASURES)} FROM panel",
    "rank_in_run": f"WITH {SCORES} SELECT mono_id, round(ensemble_score, 6) AS ensemble_score, row_number() OVER (ORDER BY scores.ensemble_score DESC NULLS LAST, mono_id NULLS FIRST) AS rank_in_run FROM scores",
    "top_scores": f"WITH {SCORES} SELECT mono_id, round(ensemble_score, 6) AS ensemble_score FROM scores ORDER BY scores.ensemble_score DESC, mono_id LIMIT 500",
    "peer_ratio_outliers": f"""WITH {YEARS}, {_sized('panel', 'toplam_varlik_ttr', 'ctx')}, yr AS (SELECT * FROM ctx WHERE cohort_dt = {AT}),
        long AS (SELECT *, {LOG.format('value')} AS t FROM (SELECT {_keep}, 'bank_risk_to_assets' AS feature, {_ratio('bank_total_risk', 'toplam_varlik_ttr', 'yr')} AS value FROM yr)), {_peers('long')},
        o AS (SELECT mono_id, round(value, 6) AS value, peer_level, CAST(peer_support AS BIGINT) AS peer_support, round(peer_z, 5) AS peer_z FROM peers WHERE peer_z IS NOT NULL)
        SELECT * FROM o ORDER BY abs(peer_z) DESC, mono_id LIMIT 100""",
}
