"""Words of many texts are hashed together, as each text's alone are."""

from __future__ import annotations

import random

import numpy as np

from cohortloom.llm import ngram_lm, shingles


def test_blocks_give_what_single_texts_give(monkeypatch):
    rnd = random.Random(5)
    texts = ["", " ", "One", "\ud800x éÉ", " a  b ", "a" * 40] + ["".join(rnd.choice("abC \t\nü") for _ in range(rnd.randrange(60))) for _ in range(300)]
    alone = [shingles.word_hashes(t) for t in texts]
    for size in (1, 100, 1 << 16):
        monkeypatch.setattr(shingles, "BLOCK_BYTES", size)
        hashes, counts = shingles.words_of_texts(texts)
        assert counts.tolist() == list(map(len, alone)) and hashes.tolist() == np.concatenate(alone).tolist()
        ((at, tokens, first),) = ngram_lm._chunks(texts)
        assert at == 0 and np.flatnonzero(tokens == ngram_lm.END).tolist() == (np.append(first[1:], len(tokens)) - 1).tolist()
        assert len(tokens) == len(hashes) + len(texts)
    assert shingles.words_of_texts([])[0].tolist() == []


def test_distinct_is_unique():
    keys = np.array([5, 1, 2**63 + 1, 5, 1], np.uint64)
    found, place = ngram_lm._distinct(keys)
    assert (found.tolist(), place.tolist()) == tuple(x.tolist() for x in np.unique(keys, return_inverse=True)) and found.dtype == keys.dtype
