"""The pipeline against a brute-force version of its stages, and the registered queries' form."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
from test_llm_operators import LANGUAGES, SPACES, brute_components, crc, expected_ids, naive_best_fit


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")


def rows_of(n=60):
    rnd = random.Random(12)
    rows = []
    for i in range(n):
        lang, words = rnd.choice(list(LANGUAGES.items()))
        rows.append((i, " ".join(rnd.choice(words.split()) + rnd.choice("abcdefgh") for _ in range(rnd.randint(20, 80))), lang))
    for i in range(n, n + 20):
        _, text, lang = rows[rnd.randrange(n)]
        words = text.split()
        if i % 2:
            words[rnd.randrange(len(words))] = "edited"
        rows.append((i, ("  " if i % 3 else "\n").join(words), lang))
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !!", None), (5, rows[5][1], "en"), (None, "the people of that which was here", "en"), (103, rows[3][1].upper(), None)]
    rnd.shuffle(rows)
    return rows


def brute(rows):
    """Only languages of the corpus occur, so that the first stage drops texts without a letter alone."""
    docs = [(i, t) for i, t, _ in rows if any(c.isalpha() for c in t or "")]
    order = lambda r: (r[0] is None, r[0] or 0)
    seen: dict[str, tuple] = {}
    for r in sorted(docs, key=order):
        seen.setdefault(re.sub(SPACES, " ", r[1]), r)
    docs = sorted(seen.values(), key=order)
    numbered = [(k, t) for k, (_, t) in enumerate(docs)]
    kept = {k for k, _, label in brute_components(numbered) if k == label}
    return [docs[k] for k in sorted(kept)]


def test_pipeline_is_its_brute_force_version(spark, tmp_path):
    rows = rows_of()
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = Counter()
    for i, t in brute(rows):
        ids = expected_ids(t, 0)
        want.update((i, k, a, len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for k, a in enumerate(range(0, len(ids), 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert len({r.sequence_id for r in got}) == naive_best_fit([r.length for r in got], 2048)


def test_equal_file_names_in_two_folders(spark, tmp_path):
    """Rows at the same place of files of the same name are different rows."""
    for part in ("a", "b"):
        rows = [(1 if part == "a" else 2, "hello world one", "en"), (3 if part == "a" else 4, f"other text of part {part} here", "en")]
        documents(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/source/{part}")
        (file,) = (tmp_path / "source" / part).glob("*.parquet")
        folder = tmp_path / "documents.parquet" / f"part={part}"
        folder.mkdir(parents=True)
        file.rename(folder / "same-name.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for stage in (corpus_pipeline.exact_stage, corpus_pipeline.near_stage):
        assert sorted(r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()) == [1, 3, 4]


def test_documents_in_another_language_go(spark, tmp_path):
    rows = [(i, text, "nl" if lang == "fr" else lang) for i, text, lang in rows_of(90) if i is not None and i < 90]
    short = [(500 + k, text, None) for k, text in enumerate(("the people of that", "der die das", "Der"))]
    out = corpus_pipeline.language_stage(spark, documents(spark, rows + short), str(tmp_path))
    kept = {r.doc_id for r in out.collect()}
    assert kept == {i for i, _, lang in rows if lang != "nl"} | {500, 501, 502}
    unlabelled = [(1, "some text", None), (2, "12 34", None), (3, None, None)]
    assert [r.doc_id for r in corpus_pipeline.language_stage(spark, documents(spark, unlabelled), str(tmp_path)).collect()] == [1]


def test_stages_keep_the_columns_and_stand_empty_tables(spark, tmp_path):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_registered_queries(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert set(entry.oracle_sql()) <= names
