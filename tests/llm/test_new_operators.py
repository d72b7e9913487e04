"""Filter audit, token counts by a transducer and importance resampling against brute force, with the hard cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import filter_audit, importance_resampling, token_counts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Names that the operators use inside; in a table they must do no harm.
CLASH = "part string, hash long, fails int, n int, copies long, salt int, line string, words int, noise long, bucket int, n_bytes long, text_hash long, good int"
SCHEMA = f"doc_id long, text string, source string, {CLASH}"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark, rows):
    """rows of (doc_id, text, source)."""
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4, 5, "l", 6, 7, 8, 9, 10, 11) for r in rows], SCHEMA).repartition(3)


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def prose(rnd, n, capitals=0.05):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa la mu nu été naïve 中文 x7".split()
    return " ".join((w := rnd.choice(words) + str(rnd.randint(0, 40)), w.upper() if rnd.random() < capitals else w)[1] for _ in range(n))


@pytest.fixture(scope="module")
def hard():
    rnd = random.Random(11)
    copied = prose(rnd, 70)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, copied, "b"), (4, copied, "b"), (4, copied, "c"), (5, copied, "a"), (None, copied, "a"), (None, "no id " * 60, ""), (6, prose(rnd, 20_000), "b"),
            (7, "Same #tag\n" * 80, "c"), (8, "Same #tag\n" * 80, "c"), (9, "CAPS ONLY", "c"), (10, "\n\n" + copied + "\nlast line", "d"), (None, "lonely", "only nulls")]
    rows += [(i, prose(rnd, rnd.choice([5, 30, 60, 200]), rnd.choice([0, 0.5])) + rnd.choice(["", " $5", "\n" + copied]), rnd.choice("abcd")) for i in range(20, 80)]
    return rows


def brute_audit(rows, labels):
    """Every order applied to every row of every part, filter by filter."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    big = math.inf
    for i, text, _ in rows:
        first[text or ""] = min(first.get(text or "", big), big if i is None else i)
    of_part = {}
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {f for f, fails in {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": first[text] < (big if i is None else i)}.items() if fails}
        of_part.setdefault(part or "", []).append((failed, i in good, i in toxic))
    out = {}
    for part, docs in of_part.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("salted", [1, 1024])
def test_filter_audit(spark, hard, monkeypatch, salted):
    monkeypatch.setattr(filter_audit, "SALTED", salted)
    labels = [(i, i % 2, (i or 0) % 3 == 0) for i, *_ in hard if i and i % 5] + [(4, 1, 0), (4, None, 1), (None, 1, 1), (9999, 1, 1)]
    labels = [(i, q, int(t or 0)) for i, q, t in labels]
    got = filter_audit.filter_audit(table(spark, hard), label_table(spark, labels)).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}
    assert len(found) == len(got) and found == brute_audit(hard, labels)


def test_filter_audit_of_empty_tables(spark, hard):
    assert filter_audit.filter_audit(table(spark, []), label_table(spark, [])).count() == 0
    got = filter_audit.filter_audit(table(spark, hard), label_table(spark, [])).collect()
    assert {r.part for r in got} == {s or "" for _, _, s in hard} and not any(r.good_lost or r.toxic_lost for r in got)


def test_filter_audit_sql_agrees(spark, hard):
    rows = [r for r in hard if r[0] is not None]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    con.execute("create table labels (doc_id bigint, quality int, toxic int)")
    con.executemany("insert into labels values (?, ?, ?)", labels)
    result = con.sql(filter_audit.FILTER_AUDIT_SQL)
    want = {tuple(r) for r in result.fetchall()}
    got = filter_audit.filter_audit(table(spark, rows), label_table(spark, labels)).select(*result.columns)
    assert {tuple(r) for r in got.collect()} == want


def test_copies_of_a_text_never_meet_in_one_task(spark, monkeypatch):
    """A third of all rows are one text: its rows are dealt to many salts, each with the smallest id."""
    monkeypatch.setattr(filter_audit, "SALTED", 8)
    rows = [(i, "one text" if i % 3 else f"text {i}", "s") for i in range(600)]
    docs = table(spark, rows).select("doc_id", filter_audit.F.lit("s").alias("part"), "text").withColumn("hash", filter_audit.F.xxhash64("text"))
    scratch = filter_audit.Scratch(spark, "test")
    found = filter_audit.repeats_of_smaller(docs, scratch)
    assert sorted(r.doc_id for r in found.collect()) == [i for i in range(600) if i % 3 and i != 1]
    scratch.drop()


def library_counts(texts):
    library = Tokenizer.from_file(TOKENIZER)
    return [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def odd_texts():
    rnd = random.Random(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "eéèçauxntr ", "'stremvldEV ", "!?.,'#$- a1", "ab", "中文字한글 é", "0123456789abcdef", "".join(map(chr, range(0x2FF))), "éà ç각ｆ½²", "<|endoftext>sar \n"]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([0, 3, 10, 40, 300]))) for a in alphabets for _ in range(150)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(30)) for _ in range(150)]
    return [*texts, "", "don't we'll they've I'm 'tis ''s !'s 'r 're 'rex 'lla 'l' 'v 'é'", "a<|endoftext|>b<|startoftext|><|ENDOFTEXT|> <|end<|endoftext|>", "x" * 5000, "İıſK ΑΣ", "'S'LL'Re"]


@pytest.mark.parametrize("chunk", [1, 7, 1024])
def test_transducer_counts_are_those_of_the_library(chunk):
    texts = odd_texts()
    assert list(token_counts.Transducer(TOKENIZER).counts(texts, chunk=chunk)) == library_counts(texts)


@pytest.mark.parametrize(("entries", "block"), [(40_000, 500), (1 << 22, 333)])
def test_counts_depend_on_neither_table_nor_blocks(entries, block):
    """Tables that are dropped again and again, and texts that span many blocks of the tape."""
    texts = odd_texts()[::3] + ["".join(random.Random(1).choice("etaoin shrdlu") for _ in range(3000)), "q" * 4001]
    made = token_counts.Transducer(TOKENIZER, entries)
    assert list(made.counts(texts, block=block, chunk=16)) == library_counts(texts)
    assert len(made._states) * made._columns <= entries


def test_chunk_maps_compose():
    """However a tape is cut, the counts at every symbol and the exit state are the same, from any entry state."""
    made = token_counts.Transducer(TOKENIZER)
    tape = made.symbols("Unbelievable'll-don't transmogrification 12'ré <|endoftext|>x" * 5 + "y" * 50)
    _, entry = made.run(made.symbols("interna"), made._states[0])
    whole, exit_ = made.run(tape, entry, chunk=len(tape))
    for chunk in (1, 2, 3, 10, 64):
        counts, last = made.run(tape, entry, chunk=chunk)
        assert (counts == whole).all() and last == exit_
    assert whole.sum() + 1 == library_counts(["interna" + "Unbelievable'll-don't transmogrification 12'ré <|endoftext|>x" * 5 + "y" * 50])[0] - library_counts(["interna"])[0] + 1


def test_a_tokenizer_of_another_kind_is_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        token_counts.Transducer(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts(spark, hard):
    got = sorted(map(tuple, token_counts.token_counts(table(spark, hard), TOKENIZER, limit=100).collect()), key=str)
    texts = [t or "" for _, t, _ in hard]
    want = sorted([(i, len(t.encode()), n, n > 100) for (i, *_), t, n in zip(hard, texts, library_counts(texts), strict=True)], key=str)
    assert got == want
    assert token_counts.token_counts(table(spark, []), TOKENIZER).count() == 0


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_grams(text, n):
    words = brute_words(text)
    return [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)], len(words)


def brute_resample(rows, target, n, buckets, min_words, percent, seed):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for text in texts for g in brute_grams(text, n)[0]) for texts in ([r[1] for r in rows], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for i, text, _ in rows:
        grams, words = brute_grams(text, n)
        weight = sum(gain[bucket(g)] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize(("n", "buckets", "min_words", "percent"), [(1, 10_000, 20, 10), (1, 50, 1, 100), (2, 300, 20, 50), (3, 1000, 5, 30)])
def test_importance_resampling(spark, hard, n, buckets, min_words, percent):
    rnd = random.Random(2)
    target = [prose(rnd, 30).replace(" ", "\n", 3) for _ in range(20)] + [None, ""]
    got = importance_resampling.importance_resample(table(spark, hard), table(spark, [(i, t, "t") for i, t in enumerate(target)]), n, buckets, min_words, percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(hard, target, n, buckets, min_words, percent, 2024)


def test_importance_resampling_of_empty_tables(spark, hard):
    empty = table(spark, [])
    assert importance_resampling.importance_resample(empty, table(spark, hard)).count() == 0
    got = importance_resampling.importance_resample(table(spark, hard), empty).collect()
    assert sorted(map(tuple, got), key=str) == brute_resample(hard, [], 1, 10_000, 20, 10, 2024)


def test_segments_are_counted_once_and_crossings_added(spark):
    """Whole n-gram counts come of distinct lines times their occurrences and of what lies over line ends."""
    texts = ["a b\nc\n\nd e f", "a b\nc d", "a b", "", "x\ny\nz"] * 3
    for n in (1, 2, 4):
        got = {r.bucket: r.n for r in importance_resampling.segment_counts(spark.createDataFrame([(t,) for t in texts], "text string"), n, 997).collect()}
        assert got == dict(Counter(zlib.crc32(g.encode()) % 997 for t in texts for g in brute_grams(t, n)[0]))
    assert np.array_equal(importance_resampling.bucket_gains([(0, 1)], [(1, 1)], 2), [math.floor(1000 * math.log(1 / 2)), math.floor(1000 * math.log(2))])


def test_resampling_sql_agrees(spark, hard):
    rows = [r for r in hard if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    target = [(i, t) for i, t in enumerate([prose(random.Random(4), 40), None, "été\nnaïve"])]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into benchmark values (?, ?)", target)
    result = con.sql(importance_resampling.resampling_sql())
    got = importance_resampling.importance_resample(table(spark, rows), table(spark, [(*t, "t") for t in target])).select(*result.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(result.fetchall(), key=str)
