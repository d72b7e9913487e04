"""Language identification: sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Document frequencies are counted over all training rows on the executors. The weights are fitted on the driver by
follow-the-regularised-leader with elastic-net penalties, on a sample of the training rows bounded by
``per_label`` rows expected for each language and ``max_labels`` languages; a fifth of the sample is held back to
calibrate the probabilities with one temperature. Prediction runs over whole texts on the executors.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import map_arrow, split_remainder, text_or_empty

#: n-grams of one to three characters go to 2**BITS numbers.
BITS, ORDERS = 15, (1, 2, 3)
BUCKETS = 1 << BITS
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    idf: np.ndarray  # (BUCKETS,)
    active: np.ndarray  # buckets in order that have a weight other than 0
    weights: np.ndarray  # (active, labels)
    bias: np.ndarray
    temperature: float

    def logits(self, buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(self.active):
            return self.bias
        at = np.minimum(np.searchsorted(self.active, buckets), len(self.active) - 1)
        known = self.active[at] == buckets
        return values[known] @ self.weights[at[known]] + self.bias


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's n-grams and how often each occurs; in lower case, each run of other than letters as one space. Empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    line = np.full(len(points) + 2, 32, np.uint32)
    line[1:-1] = np.where(letter, points, 32)
    space = line == 32
    line = line[~(space & np.concatenate(([False], space[:-1])))]
    hashed = line * np.uint32(0x9E3779B1)
    found = [(hashed[1:-1] >> np.uint32(32 - BITS)).astype(np.int64)]
    for order in ORDERS[1:]:
        hashed = (hashed[:-1] * np.uint32(0x85EBCA6B) + line[order - 1 :]) * np.uint32(0xC2B2AE35) + np.uint32(order)
        found.append((hashed >> np.uint32(32 - BITS)).astype(np.int64))
    every = np.concatenate(found)
    if len(every) < BUCKETS // 16:  # of short texts sorting takes less time
        return np.unique(every, return_counts=True)
    counts = np.bincount(every, minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def _tf_idf(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[buckets]
    return values / max(np.sqrt(values @ values), 1e-12)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_labels: int, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of FTRL-proximal over (label, buckets, values) rows; the last row of its state is the bias, without l1."""
    z, n = np.zeros((BUCKETS + 1, n_labels)), np.zeros((BUCKETS + 1, n_labels))

    def weights(at: np.ndarray) -> np.ndarray:
        lasso = np.where(at == BUCKETS, 0.0, l1)[:, None]
        zs = z[at]
        return np.where(np.abs(zs) <= lasso, 0.0, -(zs - np.sign(zs) * lasso) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for label, buckets, values in rows:
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            before = n[at]
            n[at] = before + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(before)) / alpha * w
    every = weights(np.arange(BUCKETS + 1))
    return every[:-1], every[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, of a grid; 1 without rows. Each row's own label counts (n + 1) / (n + 2) of n
    rows and the others share the rest, so that a sample without an error doesn't claim certainty."""
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1 / (n + 2) / (k - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)
    return float(min(np.geomspace(0.02, 5, 120), key=lambda t: -(target * np.log(np.maximum(_softmax(logits / t), 1e-300))).sum()))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the ``text`` rows each bucket occurs, and the number of rows with letters; BUCKETS + 1 numbers reach the driver."""

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            total = np.zeros(BUCKETS + 1, np.int64)
            for text in batch.column("text").to_pylist():
                buckets, _ = gram_counts(text)
                total[buckets] += 1
                total[BUCKETS] += len(buckets) > 0
            at = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

        return step

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in map_arrow(rows.select("text"), task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out[:-1], int(out[-1])


def fit_language_model(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_label: int = 1000, max_labels: int = 200) -> LanguageModel:
    """Fit on the rows that meet ``training`` and have a language. Without any, the model has no labels.

    The draw is a hash of id and text, so that the model is the same however the table is split into files; rows that
    repeat id, text and language are drawn once. Null and empty texts have no n-grams and teach only the bias.
    """
    rows = docs.where(training & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), text_or_empty(text_col).alias("text"), F.xxhash64(F.col(id_col), text_or_empty(text_col)).alias("draw")
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(max_labels + 1).collect()}
    if len(sizes) > max_labels:
        raise ValueError(f"more than max_labels={max_labels} languages")
    labels = sorted(sizes)
    df, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    if not labels:
        return LanguageModel([], idf, np.empty(0, np.int64), np.zeros((0, 0)), np.zeros(0), 1.0)
    share = F.element_at(F.create_map(*(F.lit(x) for k in labels for x in (k, min(1.0, per_label / sizes[k])))), F.col("lang"))
    sample = rows.where(F.pmod("draw", F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["draw", "lang"])

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            grams = [gram_counts(text) for text in batch.column("text").to_pylist()]
            made = [[b.astype("<u2").tobytes() for b, _ in grams], [c.astype("<u4").tobytes() for _, c in grams]]
            return pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), *(pa.array(x, pa.binary()) for x in made)], names=["lang", "draw", "buckets", "counts"])

        return step

    number = {label: k for k, label in enumerate(labels)}
    found = sorted(map_arrow(sample, task, "lang string, draw long, buckets binary, counts binary").collect(), key=lambda r: (r["draw"], r["lang"]))
    fitted, held = [], []
    for i, r in enumerate(found):
        buckets = np.frombuffer(bytes(r["buckets"]), "<u2").astype(np.int64)
        row = (number[r["lang"]], buckets, _tf_idf(buckets, np.frombuffer(bytes(r["counts"]), "<u4"), idf))
        (held if i % 5 == 4 else fitted).append(row)
    weights, bias = fit_ftrl(fitted, len(labels))
    active = np.flatnonzero(weights.any(axis=1))
    model = LanguageModel(labels, idf, active, weights[active], bias, 1.0)
    logits = np.array([model.logits(b, x) for _, b, x in held]).reshape(-1, len(labels))
    return replace(model, temperature=fit_temperature(logits, np.array([k for k, _, _ in held], np.int64)))


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns, or else the id alone, with ``lang_pred``, ``score``, the calibrated probability, and ``has_letters``.

    Null texts, texts without a letter, and all texts under a model without labels are ``und`` with score 0; of equal
    scores the language that comes first in the alphabet is given. Rows are independent; repeated rows and null ids give a
    row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS * max_labels numbers

    def task():
        m = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores, letters = [], [], []
            for text in batch.column("__text").to_pylist():
                buckets, counts = gram_counts(text)
                letters.append(len(buckets) > 0)
                if not len(buckets) or not m.labels:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = _softmax(m.logits(buckets, _tf_idf(buckets, counts, m.idf)) / m.temperature)
                k = int(p.argmax())
                langs.append(m.labels[k])
                scores.append(float(p[k]))
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(letters, pa.bool_())], names=[*names, "lang_pred", "score", "has_letters"])

        return step

    names = list(keep or (id_col,))
    rows = docs.select(*(docs[c] for c in names), text_or_empty(text_col).alias("__text"))
    return map_arrow(rows, task, ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes[:-1]) + ", lang_pred string, score double, has_letters boolean")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = (), per_label: int = 1000, max_labels: int = 200) -> DataFrame:
    """Fit on the rows whose crc32(id) modulo 3 is not 1 and predict all; ``held_out`` tells the others.

    Null ids count as the empty text (remainder 0, so they are learned from); null languages are not learned from; what
    becomes of null and letterless texts, ties and repeated rows ``predict_language`` says. Empty input gives an empty result.
    The driver holds a sample of about ``per_label`` rows of each language; a table with more than ``max_labels`` languages
    is an error, which a higher number avoids at the price of as much more memory.
    """
    held_out = split_remainder(id_col, 3) == 1
    model = fit_language_model(docs, ~held_out, id_col, text_col, lang_col, per_label, max_labels)
    return predict_language(docs, model, id_col, text_col, keep).withColumn("held_out", held_out)
