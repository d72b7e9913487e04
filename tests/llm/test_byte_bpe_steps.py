"""Pre-tokens are encoded together: what neighbours have in common is worked out once, and memories never change a result."""

from __future__ import annotations

import random

import public_tokenizers

from cohortloom.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_common_beginnings_are_worked_out_once(monkeypatch):
    encoder, rnd = byte_bpe.PrefixEncoder(byte_bpe.load_ranks(RANKS)), random.Random(3)
    pieces = [b"", b"\xff", b" the", *{bytes(rnd.choice(b"aehnort ") for _ in range(rnd.randrange(1, 24))) for _ in range(400)}]
    pieces += [p + b"zzq" for p in pieces] + [p[:5] for p in pieces]
    pieces = list(set(pieces))
    alone, done, last = {p: encoder.encode(p) for p in pieces}, [], encoder._last
    monkeypatch.setattr(encoder, "_last", lambda *x: done.append(1) or last(*x))
    assert dict(encoder.encode_all(pieces)) == alone
    assert len(done) < 0.8 * sum(map(len, pieces))


def test_memories_are_forgotten_by_halves(monkeypatch):
    texts = ["one two three", "", "two three four five", "one two", "five six seven eight", "one \ud800 two"]
    whole = [x.tolist() for x in byte_bpe.Tokenizer(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN).encode(texts)]
    monkeypatch.setattr(byte_bpe, "MEMORY_ENTRIES", 3)
    monkeypatch.setattr(byte_bpe, "STRETCH_CHARS", 5)
    small = byte_bpe.Tokenizer(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    assert [x.tolist() for x in small.encode(texts)] == whole and small.older
    assert len(small.known) < 12
