"""Licence notices found by the Dice coefficient over word bigrams, in DataFrame functions only.

A text is normalised (lower case, everything but a-z and 0-9 is a space), so that line breaks and comment marks don't
matter, and becomes one sequence of words. A template, a one-line notice, a standard header, a whole licence or an SPDX
line, is compared with windows of 0.8, 1 and 1.25 times its own number of bigrams: at every place that has one of its
bigrams for templates of up to ``FINE_WORDS`` words, else at as many places over its length. Numbers of a notice or header
(``version 2.1``) must all stand in the window, so that versions of one licence are told apart.

A window with ``c`` of the ``b`` bigrams of a template reaches a coefficient of ``t`` only if ``c >= b*t/(2-t)``. The
number of a text's bigrams that occur in any template, then in the template itself, therefore rules out most templates
of most texts before any window is made, and loses none.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction
from importlib import resources
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_or_empty

#: One-line notices that are looked for, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]
_SCALE = 1_000_000_000
#: Templates of up to so many words are looked for at every place, longer ones at so many places a length.
FINE_WORDS = 64
#: Numbers of templates of up to so many words must occur; longer ones number their sections.
VERSIONED_WORDS = 150
_PARTS = (Fraction(4, 5), Fraction(1), Fraction(5, 4))


class Template(NamedTuple):
    license: str
    title: str
    text: str
    words: list[str]
    pairs: list[str]  # distinct, in order of the alphabet
    required: list[str]  # words that a window must have
    lengths: list[int]  # of windows, in bigrams
    step: int


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def template(license: str, title: str, text: str, whole_title: bool = False) -> Template:
    words = _words(text)
    pairs = sorted({f"{x} {y}" for x, y in zip(words, words[1:], strict=False)})
    if not pairs:
        raise ValueError("a template has two words or more")
    needed = words if whole_title else [w for w in words if w.isdigit() and len(words) <= VERSIONED_WORDS]
    lengths = sorted({max(1, round((len(words) - 1) * part)) for part in _PARTS})
    return Template(license, title, text, words, pairs, sorted(set(needed)), lengths, -(-len(words) // FINE_WORDS))


def license_texts() -> list[tuple[str, str, str]]:
    """``(SPDX identifier, what it is, text)`` of the whole licences and standard headers that come with the library."""
    out = []
    for file in sorted((f for f in resources.files("cohortloom.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name):
        name, header = file.name.removesuffix(".txt"), ".header" in file.name
        name = name.removesuffix(".header")
        out.append((name, f"{name}, {'standard header' if header else 'whole text'}", file.read_text("utf-8")))
    return out


def default_templates() -> list[Template]:
    """One-line notices, the licence texts and headers, and an SPDX line for every licence among them."""
    out = [template(name, text, text) for name, text in TEMPLATES] + [template(*x) for x in license_texts()]
    for name in sorted({t.license for t in out}):
        line = f"SPDX-License-Identifier: {name}"
        out.append(template(name, line, line, whole_title=True))
    return out


def _need(size: int, t: Fraction) -> int:
    """Least number of common bigrams with which any window can reach the threshold."""
    return math.ceil(size * t / (2 - t))


def _strings(values: list[str]) -> str:
    """A constant array of words or bigrams (a-z, 0-9 and single spaces) as SQL text."""
    joined = "\\n".join(values)
    return f"split('{joined}', '\\n')" if values else "cast(array() AS array<string>)"


def _windows(k: int, x: Template, t: Fraction, pool: str) -> str:
    """All windows of the text that reach the threshold with template ``k``, as SQL text; NULL where there can be none."""
    known, need = _strings(x.pairs), _need(len(x.pairs), t)
    if x.step == 1:
        inside = ", ".join(f"'{p}'" for p in x.pairs)
        starts = f"filter(sequence(1, size(pairs)), i -> pairs[i - 1] IN ({inside}))"
    else:
        starts = f"sequence(1, size(pairs), {x.step})"
    windows = f"flatten(transform({starts}, i -> transform(array({', '.join(map(str, x.lengths))}), n -> named_struct('i', i, 'n', n))))"
    allowed = f" AND size(array_except({_strings(x.required)}, slice(words, w.i, w.n + 1))) = 0" if x.required else ""
    counted = (
        f"transform({windows}, w -> named_struct('i', w.i, 'n', w.n, 'c', cast(size(array_intersect(slice(pairs, w.i, w.n), {known})) AS long), "
        f"'total', size(array_distinct(slice(pairs, w.i, w.n))) + {len(x.pairs)}L, 'ok', true{allowed}))"
    )
    reached = f"filter({counted}, w -> w.ok AND {2 * t.denominator}L * w.c >= {t.numerator}L * w.total)"
    code = f"(2L * w.c * {_SCALE}L) div w.total"
    made = f"transform({reached}, w -> named_struct('first', w.i, 'weight', w.c * ({code}), 'k', {k}, 'n', w.n, 'last', w.i + w.n + 1, 'code', {code}))"
    return f"CASE WHEN size({pool}) >= {need} AND size(array_intersect({pool}, {known})) >= {need} THEN {made} END"


#: Windows in order of their place: of one and the last that was kept, if they share a word, the heavier stays (ties: the
#: template that comes first, then the earlier one). ``b`` has them sorted.
_STANDING = (
    "aggregate(b, cast(array() AS array<struct<first:int,weight:bigint,k:int,n:int,last:int,code:bigint>>), (kept, x) -> "
    "CASE WHEN size(kept) = 0 OR x.first >= element_at(kept, -1).last THEN concat(kept, array(x)) "
    "WHEN x.weight > element_at(kept, -1).weight OR x.weight = element_at(kept, -1).weight AND x.k < element_at(kept, -1).k THEN concat(slice(kept, 1, size(kept) - 1), array(x)) ELSE kept END)"
)
#: An SPDX line: what follows its mark up to the end of the line, and what stands between identifiers there.
SPDX_LINE, SPDX_BETWEEN = r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)", r"(?i)[ \t()*/<>#;,\"'-]*(?:^|[ \t()])(?:OR|AND|WITH)(?:$|[ \t()])[ \t()]*|[ \t()]+"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: str = "0.8", templates: list[Template] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_notices, licenses, license, dice, template``.

    Every window that reaches the threshold counts, with common bigrams times coefficient as its weight. They are taken in
    order of their place (then the heavier, the template that comes first, the shorter): of one and the last that was
    kept, if they share a word, the heavier stays. ``n_notices`` is the number of windows that stand, so a notice that
    comes again counts again. ``licenses`` are their distinct licences and those that the expression of an SPDX line names
    (``MIT OR Apache-2.0``) among the templates' licences, in order of the alphabet, joined by commas; the other columns
    tell of the heaviest window (ties: the first template, then the first place); null without one. Null and empty texts
    have no notices; repeated rows give a row each; null ids are kept; other columns are ignored. Rows are independent
    and nothing is shuffled.
    """
    templates = default_templates() if templates is None else templates
    t = Fraction(threshold)
    if not templates:
        raise ValueError("no templates")
    fine = [x for x in templates if x.step == 1]
    text = text_or_empty(text_col)
    named = F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SPDX_LINE), 1), lambda line: F.split(line, SPDX_BETWEEN))))
    rows = docs.select(docs[id_col].alias("doc_id"), F.when(F.contains(F.lower(text), F.lit("spdx")), named).alias("named"), F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ").alias("words"))
    least = min(_need(len(x.pairs), t) for x in templates)
    rows = rows.select("doc_id", "named", "words", F.when(F.size("words") > least, F.expr("zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1), (x, y) -> concat(x, ' ', y))")).alias("pairs"))

    def pool(some: list[Template]) -> str:
        union = sorted({p for x in some for p in x.pairs})
        return f"array_distinct(filter(pairs, x -> x IN ({', '.join(map(repr, union))})))" if union else "cast(array() AS array<string>)"

    rows = rows.select("doc_id", "named", "words", "pairs", F.expr(pool(fine)).alias("hit"), F.expr(pool([x for x in templates if x.step > 1])).alias("far_hit"))
    every = ", ".join(_windows(k, x, t, "hit" if x.step == 1 else "far_hit") for k, x in enumerate(templates))
    in_turn = "(x, y) -> CASE WHEN x.first <> y.first THEN x.first - y.first WHEN x.weight <> y.weight THEN IF(x.weight > y.weight, -1, 1) WHEN x.k <> y.k THEN x.k - y.k ELSE x.n - y.n END"
    found = rows.select("doc_id", "named", F.expr(f"CASE WHEN greatest(size(hit), size(far_hit)) >= {least} THEN array_sort(flatten(filter(array({every}), x -> x IS NOT NULL)), {in_turn}) END").alias("b"))
    found = found.select("doc_id", "named", F.expr(f"CASE WHEN size(b) > 0 THEN {_STANDING} END").alias("best"))
    found = found.select("doc_id", "named", "best", F.expr("array_max(transform(best, x -> named_struct('weight', x.weight, 'k', -x.k, 'place', -x.first, 'code', x.code)))").alias("top"))
    names = F.array(*(F.lit(x.license) for x in templates))
    by_name = F.create_map(*(F.lit(v) for name in sorted({x.license for x in templates}) for form in spdx_forms(name) for v in (form, name)))
    spdx = F.filter(F.transform(F.coalesce("named", F.array().cast("array<string>")), lambda x: by_name[F.lower(x)]), lambda x: x.isNotNull())
    standing = F.transform(F.coalesce("best", F.expr("cast(array() AS array<struct<first:int,weight:bigint,k:int,n:int,last:int,code:bigint>>)")), lambda x: F.element_at(names, x["k"] + 1))
    told = F.array_sort(F.array_distinct(F.concat(standing, spdx)))
    return found.select(
        "doc_id",
        F.greatest(F.size("best"), F.lit(0)).cast("long").alias("n_notices"),
        F.when(F.size(told) > 0, F.array_join(told, ",")).alias("licenses"),
        F.when(F.size("best") > 0, F.element_at(names, 1 - F.col("top.k"))).alias("license"),
        F.when(F.size("best") > 0, F.col("top.code") / _SCALE).alias("dice"),
        F.when(F.size("best") > 0, F.element_at(F.array(*(F.lit(x.title) for x in templates)), 1 - F.col("top.k"))).alias("template"),
    )


def spdx_forms(license: str) -> list[str]:
    """Ways to write a licence in an SPDX expression, in lower case."""
    bare = license.lower()
    return [bare, f"{bare}+", f"{bare}-only", f"{bare}-or-later"]


def license_sql(threshold: str = "0.8", templates: list[Template] | None = None) -> str:
    """The same scan in DuckDB SQL by joins of words: windows of every text that has enough bigrams of a template at all."""
    templates = default_templates() if templates is None else templates
    t = Fraction(threshold)
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ",\n".join(f"({k}, {quoted(x.license)}, {quoted(x.title)}, {quoted(x.text)}, {quoted(' '.join(x.required))}, {x.step}, {x.lengths!r})" for k, x in enumerate(templates))
    normal = lambda c: f"string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return rf"""
WITH templates(k, license, template, body, required, step, lengths) AS (VALUES {rows}),
known AS MATERIALIZED (SELECT DISTINCT k, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT k, w, unnest(range(1, len(w))) AS i FROM (SELECT k, {normal("body")} AS w FROM templates))),
sizes AS MATERIALIZED (SELECT k, count(*) AS b FROM known GROUP BY k),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS row_uid, doc_id, text FROM documents),
rows AS MATERIALIZED (SELECT row_uid, doc_id, {normal("coalesce(text, '')")} AS w FROM numbered),
words AS MATERIALIZED (SELECT row_uid, i AS pos, w[i] AS word, CASE WHEN i < len(w) THEN w[i] || ' ' || w[i + 1] END AS pair FROM (SELECT row_uid, w, unnest(range(1, len(w) + 1)) AS i FROM rows)),
likely AS MATERIALIZED (
    SELECT row_uid, k FROM words JOIN known USING (pair) JOIN sizes USING (k)
    GROUP BY row_uid, k, b HAVING count(DISTINCT pair) * {2 * t.denominator - t.numerator} >= {t.numerator} * b),
starts AS (
    SELECT row_uid, k, pos AS first FROM likely JOIN templates USING (k) JOIN known USING (k) JOIN words USING (row_uid, pair) WHERE step = 1
    UNION
    SELECT row_uid, k, pos FROM likely JOIN templates USING (k) JOIN words USING (row_uid) WHERE step > 1 AND pair IS NOT NULL AND (pos - 1) % step = 0),
windows AS MATERIALIZED (SELECT row_uid, k, first, unnest(lengths) AS n FROM starts JOIN templates USING (k)),
counted AS (
    SELECT v.row_uid, v.k, first, n, count(DISTINCT w.pair) AS a, count(DISTINCT p.pair) AS c
    FROM windows v JOIN words w ON w.row_uid = v.row_uid AND w.pos BETWEEN first AND first + n - 1 LEFT JOIN known p ON p.k = v.k AND p.pair = w.pair
    GROUP BY v.row_uid, v.k, first, n),
asked AS (SELECT k, unnest(string_split(required, ' ')) AS word FROM templates WHERE required <> ''),
present AS (
    SELECT v.row_uid, v.k, first, n, count(DISTINCT w.word) AS present
    FROM windows v JOIN asked USING (k) JOIN words w ON w.row_uid = v.row_uid AND w.word = asked.word AND w.pos BETWEEN first AND first + n
    GROUP BY v.row_uid, v.k, first, n),
reached AS (
    SELECT row_uid, k, first, first + n + 1 AS last, n, 2 * c * {_SCALE} // (a + b) AS code, c * (2 * c * {_SCALE} // (a + b)) AS weight
    FROM counted JOIN sizes USING (k) LEFT JOIN (SELECT k, count(*) AS wanted FROM asked GROUP BY k) USING (k) LEFT JOIN present USING (row_uid, k, first, n)
    WHERE 2 * c * {t.denominator} >= {t.numerator} * (a + b) AND coalesce(wanted, 0) = coalesce(present, 0)),
in_turn AS (SELECT row_uid, list([struct_pack(first := first, last := last, weight := weight, k := k, code := code)] ORDER BY first, weight DESC, k, n) AS b FROM reached GROUP BY row_uid),
swept AS (SELECT row_uid, list_reduce(b, lambda kept, x: CASE WHEN x[1].first >= kept[-1].last THEN list_concat(kept, x)
    WHEN x[1].weight > kept[-1].weight OR (x[1].weight = kept[-1].weight AND x[1].k < kept[-1].k) THEN list_concat(kept[:-2], x) ELSE kept END) AS kept FROM in_turn),
standing AS MATERIALIZED (SELECT row_uid, s.first AS first, s.weight AS weight, s.k AS k, s.code AS code FROM (SELECT row_uid, unnest(kept) AS s FROM swept)),
told AS (
    SELECT row_uid, count(*) AS n_notices, list(license) AS found,
        min_by(struct_pack(license := license, template := template, dice := code / {float(_SCALE)}), struct_pack(w := -weight, k := k, p := first)) AS top
    FROM standing JOIN templates USING (k) GROUP BY row_uid),
forms AS (SELECT license, lower(license) || unnest(['', '+', '-only', '-or-later']) AS form FROM (SELECT DISTINCT license FROM templates)),
lines AS (SELECT row_uid, unnest(regexp_extract_all(coalesce(text, ''), '{SPDX_LINE.replace("'", "''")}', 1)) AS line FROM numbered),
spdx AS (SELECT row_uid, list(DISTINCT license) AS named FROM (SELECT row_uid, lower(unnest(regexp_split_to_array(line, '{SPDX_BETWEEN.replace("'", "''")}'))) AS form FROM lines) JOIN forms USING (form) GROUP BY row_uid)
SELECT doc_id, coalesce(n_notices, 0) AS n_notices, nullif(array_to_string(list_sort(list_distinct(list_concat(coalesce(found, []), coalesce(named, [])))), ','), '') AS licenses, top.license AS license, top.dice AS dice, top.template AS template
FROM rows LEFT JOIN told USING (row_uid) LEFT JOIN spdx USING (row_uid)
"""
