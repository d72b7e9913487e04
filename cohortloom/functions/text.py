"""Text, date and label expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, tokens and texts of the alert policy.
NULLISH = ("", "nan", "None", "NaN", "NaT", "<NA>")
RISES_WITH = ("risk", "pd", "utilization", "supheli", "alacak", "receivable", "debt", "tkn", "tbe", "cash_share", "st_mt_cash_share")
FALLS_WITH = ("profit", "kar", "equity", "ozkaynak", "ebitda", "margin")
CREDIT_TOKENS = ("irb", "pd", "rating", "memzuc", "bank", "risk")
TRUE_WORDS = ("1", "true", "t", "yes", "y", "evet", "e", "on")
FALSE_WORDS = ("0", "false", "f", "no", "n", "hayir", "h", "off")
SUFFIXES = ("__peer_z", "__missing_flag")
# What a variable is about, told by its name: whole names, beginnings, parts; the first line that fits counts.
CATEGORIES = (
    ("identity_time", ("mono_id", "cohort_dt"), (), ()),
    ("technical", ("kkbguncelsorgu_no", "yukleme_zmn", "data_time", "created_at"), (), ()),
    ("context", ("musteri_segment", "cst_sector", "cst_nace_code", "cst_nace_code_id", "bilanco_flg", "ref_donem_id"), (), ()),
    ("memzuc", (), (), ("memzuc",)),
    ("financial", ("equity_l1y", "toplam_varlik_ttr", "financial_term_l1y", "financial_term_q", "annualization_q"), ("fs_", "l1y_", "q_"), ("supheli", "alacak", "receivable")),
    ("pd_rating", (), ("irb_",), ("pd", "rating")),
    ("internal_kkb", (), (), ("tkn", "tbe")),
    ("kkb", (), (), ("kkb",)),
    ("bank_risk", (), ("bank_",), ()),
    ("external", (), (), ("external",)),
)
DIRECT_SIGNALS, EXCLUDED_VALUES = ("rating_group",), ("irb_rating_pd", "irb_model_pd", "pd_ratio", "pd_to_rating_group")
CONTEXT_NAMES = ("musteri_segment", "rating_group", "cst_sector", "cst_nace_code", "cst_nace_code_id", "financial_term_l1y", "financial_term_q", "annualization_q", "ref_donem_id", "yukleme_zmn")
DATE_PATTERNS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "dd-MM-yyyy", "yyyyMMdd")


def text_or_null(x: Column, longest: int | None = None) -> Column:
    """Trimmed text; NULL for what stands for nothing, cut after ``longest`` characters."""
    bare = F.trim(x.cast("string"))
    bare = F.when(~bare.isin(*NULLISH), bare)
    return F.substring(bare, 1, longest) if longest else bare


def category(x: Column, default: str) -> Column:
    bare = F.trim(x.cast("string"))
    return F.coalesce(F.when(~bare.isin("", "nan", "None"), bare), F.lit(default))


def mixed_date(x: Column) -> Column:
    """A day from text in ISO or day-first form, with or without a time; NULL for anything else."""
    text = F.trim(x.cast("string"))
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(p)) for p in DATE_PATTERNS), F.try_to_timestamp(text)).cast("date")


def base_feature(name: Column) -> Column:
    return F.regexp_replace(name, f"({'|'.join(SUFFIXES)})$", "")


def truth(x: Column) -> Column:
    """True, false or NULL from words of several languages and numbers."""
    word = F.lower(F.trim(x.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def any_token(x: Column, tokens: tuple[str, ...]) -> Column:
    return F.lower(x).rlike("|".join(map(re.escape, tokens)))


def risk_direction(feature: Column, configured: Column | None = None, falls_first: bool = False) -> Column:
    """HIGHER_IS_RISKY, LOWER_IS_RISKY or UNKNOWN: as configured, else by tokens in the name; which list comes first is a parameter."""
    rises, falls = any_token(feature, RISES_WITH), any_token(feature, FALLS_WITH)
    first, second = ((falls, "LOWER_IS_RISKY"), (rises, "HIGHER_IS_RISKY"))[:: 1 if falls_first else -1]
    by_name = F.when(first[0], first[1]).when(second[0], second[1]).otherwise("UNKNOWN")
    if configured is None:
        return by_name
    given = F.upper(F.trim(configured))
    return F.when(given.isin("HIGHER_IS_RISKY", "LOWER_IS_RISKY"), given).otherwise(by_name)


def variable_category(name: Column, configured: Column | None = None) -> Column:
    """What a variable is about: as configured, else by its name (``CATEGORIES``), else ``other``."""
    bare, out = F.lower(F.trim(name)), F.lit("other")
    for label, names, beginnings, parts in reversed(CATEGORIES):
        fits = bare.isin(*names) if names else F.lit(False)
        pattern = "|".join([*(f"^{re.escape(b)}" for b in beginnings), *map(re.escape, parts)])
        out = F.when(fits | bare.rlike(pattern) if pattern else fits, label).otherwise(out)
    return out if configured is None else F.coalesce(text_or_null(configured), out)


def column_role(name: Column, about: Column, direct: tuple[str, ...] = (), excluded: tuple[str, ...] = ()) -> Column:
    """What a column of a raw table is used for; ``about`` is its category. ``direct`` and ``excluded`` of a dictionary replace the usual names."""
    bare = F.lower(F.trim(name))
    return (
        F.when(bare == "mono_id", "id")
        .when(bare == "cohort_dt", "time")
        .when(bare.isin(*(direct or DIRECT_SIGNALS)), "direct_rating_signal_allowed")
        .when(bare.isin(*(excluded or EXCLUDED_VALUES)), "pd_value_excluded_from_llm_features")
        .when(about == "pd_rating", "pd_rating_signal")
        .when(bare.isin(*CONTEXT_NAMES), "context_or_peer")
        .when(bare.isin(*CATEGORIES[1][1]), "technical_excluded")
        .otherwise("numeric_source_candidate")
    )


def is_riskier(direction: Column, x: Column, reference: Column) -> Column:
    return F.coalesce(F.when(direction == "HIGHER_IS_RISKY", x > reference).when(direction == "LOWER_IS_RISKY", x < reference), F.lit(False))


def direction_comment(direction: Column, x: Column, label: Column, reference: Column) -> Column:
    delta = x - reference
    effect = (
        F.when(direction == "HIGHER_IS_RISKY", F.when(delta > 0, "risk artisi").otherwise("risk azalisi"))
        .when(direction == "LOWER_IS_RISKY", F.when(delta < 0, "risk artisi").otherwise("risk azalisi"))
        .otherwise("yon etkisi tanimsiz")
    )
    return (
        F.when(x.isNull(), "deger missing oldugu icin yon yorumu yok")
        .when(reference.isNull() | label.isNull(), "referans olmadigi icin yon yorumu yok")
        .when(F.abs(delta) <= 1e-9, F.concat(label, F.lit(" ile ayni seviyede")))
        .otherwise(F.concat(label, F.lit(" gore "), F.when(delta > 0, "artmis").otherwise("azalmis"), F.lit("; "), effect))
    )


def quality_label(support: Column, score: Column, level: Column) -> Column:
    """A strong group is strong whatever else holds; then the weak ones; the rest is acceptable."""
    strong = (support >= 100) & (score >= 80) & ~level.isin("AY", "GLOBAL_FEATURE", "AY_SEGMENT")
    weak = (support < 50) | (score < 60) | level.isin("AY", "GLOBAL_FEATURE")
    return F.when(strong, "GUCLU").when(weak, "ZAYIF").otherwise("KABUL_EDILEBILIR")


def alert_type(band: Column, gap: Column, covered: Column, features: Column) -> Column:
    """``features``: the names of the leading reasons."""
    joined = F.array_join(F.slice(features, 1, 3), " ")
    return (
        F.when((band == "NORMAL") & ((gap >= 30) | (covered < 0.7)), "DATA_GAP")
        .when(F.size(features) == 0, "UNKNOWN")
        .when(any_token(joined, CREDIT_TOKENS), "CREDIT_RISK")
        .otherwise("FINANCIAL_SIGNAL")
    )


def review_queue(band: Column, kind: Column, gap: Column) -> Column:
    quiet = F.when((kind == "DATA_GAP") | (gap >= 30), "DATA_QUALITY_REVIEW").otherwise("NO_ACTION")
    return F.when(band == "NORMAL", quiet).when(band == "KIRMIZI", "URGENT_FINANCIAL_REVIEW").when(band == "TURUNCU", "FINANCIAL_REVIEW").otherwise("WATCHLIST")


def assessment(result: Column) -> Column:
    return (
        F.when(result == "PASS", "PEER_SET_KURUMSAL_OLARAK_GUCLU")
        .when(result == "WARN", "PEER_SET_KABUL_EDILEBILIR_EK_KONTROL_GEREKIR")
        .otherwise("PEER_SET_ZAYIF_SEGMENTASYON_VE_FALLBACK_GOZDEN_GECIRILMELI")
    )


def plain_number(x: Column) -> Column:
    """Digits by magnitude, without trailing zeros; NA for a missing value."""
    size = F.abs(x)
    bare = lambda digits: F.regexp_replace(F.format_string(f"%.{digits}f", x), r"\.?0+$", "")
    return (
        F.when(x.isNull(), "NA")
        .when(size == 0, "0")
        .when(size >= 1000, F.format_string("%.0f", F.bround(x, 0)))
        .when(size >= 10, bare(2))
        .when(size >= 1, bare(3))
        .when(size >= 0.01, bare(4))
        .when(size >= 0.0001, bare(6))
        .otherwise(F.format_string("%.2e", x))
    )


def tokens(x: Column) -> Column:
    """Distinct words of three characters or more, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(x), "[^0-9a-zçğıöşü]+"), lambda w: F.length(w) >= 3)))


def has_numeric_evidence(x: Column) -> Column:
    """Whether a text names at least three different keys before = or :."""
    return F.size(F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"([a-z_][a-z0-9_]*)\s*[=:]"), 1))) >= 3


def term_column(feature: str) -> str | None:
    """The column that names the financial term of a feature."""
    name = feature.lower()
    if name.startswith("q_") or name.endswith("_q"):
        return "financial_term_q"
    return "financial_term_l1y" if "l1y" in name else None


def masked_url(url: str) -> str:
    """Scheme and host of an address, nothing else."""
    found = re.match(r"([a-z][a-z0-9+.-]*://)(?:[^/@]*@)?([^/?#]*)", url or "", re.IGNORECASE)
    return f"{found[1]}{found[2]}/***" if found else "***"


def escaped_braces(template: str) -> str:
    return template.replace("{", "{{").replace("}", "}}")


def valid_identifier(name: str) -> str:
    """A table or schema name, or an error."""
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_$#]{0,127}", name or ""):
        raise ValueError(f"not a valid identifier: {name!r}")
    return name
