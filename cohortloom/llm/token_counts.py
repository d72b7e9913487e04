"""Token counts without ids: a tokenizer compiled to a deterministic finite-state transducer that emits counts.

**Machine.** States stand for what the rest of a text can depend on: the kind of the pre-token that is being read, and of
its bytes the longest suffix that begins some token, with the last token of the encoding at each place where such a
beginning starts. (Exactly one token can end each prefix of a pre-token, and a token may follow another only if no merge
across their border comes first; so this decides which token ends the next prefix.) Prefixes with the same future are one
state. A transition carries the change of "tokens, if the text ended here", so that the sum of its counts over a text is
the number of tokens: nothing is emitted late. States and transitions are compiled when a text first needs them and kept
in one table per worker process, of a stated size; a full table is dropped and compiled again, results don't depend on it.

**Chunks.** The symbols of many texts are one tape, with a reset between texts, cut into chunks of equal length. A chunk is
a map from its entry state to an exit state and counts. All chunks are run at once, a step of numpy for each symbol
position. Composition of the maps in order is a parallel prefix scan: at first every chunk is run from the reset state,
then its map is evaluated at the exit state of the chunk before it, until no entry changes. An evaluation ends where it
meets the state that was recorded at the same place, from where on both runs are one; white space, and nearly always a few
bytes, bring that about. The prefix sums of the counts give each text its number.

The tape is cut into blocks whose exit state is the next one's entry, so memory doesn't grow with the length of a text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import map_arrow, text_or_empty, texts_of

#: Symbols of a block of the tape, and of a chunk in it.
BLOCK, CHUNK = 1 << 22, 1024
#: Entries (states x symbols) of the transition table of a worker process, four bytes each.
TABLE_ENTRIES = 32_000_000
#: The pipelines of tokenizers that can be compiled: how the library's file describes them.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Below it no character is changed by composition, alone or with others.
COMPOSED_FROM = 0x300

_RESET, _SPECIAL = 0, 1
_NEVER = 1 << 62
_MISSING = -1
_ZERO = 128  # a table entry is 256 times the next state, and the count plus this


class _Full(Exception):
    """The table has no room for what this block needs."""


class Merges:
    """Which tokens stand where in the encoding of a pre-token, by the merges of a tokenizer file.

    Strings are in the file's alphabet of bytes; the last byte of a pre-token carries the suffix for ends of words.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.vocabulary, self.suffix = vocabulary, suffix
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.halves = {a + b: (a, b, i) for i, (a, b) in enumerate(merges)}
        if len(self.halves) != len(merges):
            raise ValueError("two merges make one token: this tokenizer can't be compiled")
        stems = {t.removesuffix(suffix) for t in vocabulary}
        self.longest = max(map(len, stems), default=1)
        self.beginnings = {s[:k] for s in stems for k in range(1, len(s))}
        self._right: dict[str, list[tuple[str, int]]] = {}
        self._left: dict[str, list[tuple[str, int]]] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}

    def _edge(self, token: str, side: int, known: dict[str, list[tuple[str, int]]]) -> list[tuple[str, int]]:
        """Tokens along one edge, from the whole one to a byte, each with the rank of the merge that ends it."""
        if token not in known:
            out, ends, at = [], _NEVER, token
            while at:
                out.append((at, ends))
                halves = self.halves.get(at)
                at, ends = (halves[side], halves[2]) if halves else ("", 0)
            known[token] = out
        return known[token]

    def fits(self, left: str, right: str) -> bool:
        """Whether both tokens' bytes together are encoded as just these two tokens."""
        pair = (left, right)
        if (known := self._fits.get(pair)) is None:
            rank_of = self.rank.get
            known = self._fits[pair] = not any(
                (rank := rank_of((x, y))) is not None and rank < x_ends and rank <= y_ends
                for x, x_ends in self._edge(left, 1, self._right)
                for y, y_ends in self._edge(right, 0, self._left)
            )
        return known

    def whole(self, token: str) -> bool:
        """Whether the token's own bytes are encoded as it."""
        if (known := self._whole.get(token)) is None:
            halves = self.halves.get(token)
            known = self._whole[token] = token in self.vocabulary and (halves is None or (self.whole(halves[0]) and self.whole(halves[1]) and self._last_merge(*halves)))
        return known

    def _last_merge(self, a: str, b: str, rank: int) -> bool:
        """Whether no other merge across the border of the two halves comes before theirs."""
        rank_of = self.rank.get
        return not any(
            (r := rank_of((x, y))) is not None and r < x_ends and r <= y_ends and (x, y) != (a, b)
            for x, x_ends in self._edge(a, 1, self._right)
            for y, y_ends in self._edge(b, 0, self._left)
            if (x, y) != (a, b)
        ) and rank >= 0


class Transducer:
    """The compiled tokenizer: states, transitions and the symbols of characters."""

    def __init__(self, path: str, table_entries: int = TABLE_ENTRIES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model, steps = made["model"], made["normalizer"]["normalizers"]
        splits = made["pre_tokenizer"]["pretokenizers"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if [s["type"] for s in steps] != NORMALIZERS or splits[0]["pattern"].get("Regex") != PATTERN or model["type"] != "BPE" or not model["end_of_word_suffix"] or not plain or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in made["added_tokens"]):
            raise ValueError(f"{path}: only lower-casing BPE with word ends can be compiled")
        library = Tokenizer.from_file(path)
        self._normalize, self._pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self._merges = Merges(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        added = sorted((t["content"] for t in made["added_tokens"]), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        self._entries = table_entries
        self._alphabet: dict[int, str] = {}
        self._symbols: dict[tuple[str, int], int] = {}
        self._symbol: list[tuple[str, str]] = [("", ""), ("", "")]
        self._length = np.zeros(0x110000, np.uint8)
        self._place = np.zeros(0x110000, np.int32)
        self._pool = np.zeros(1 << 10, np.uint16)
        self._pooled = 0
        self._columns = 64
        self._forget()

    # -- symbols

    def _byte(self, byte: int) -> str:
        """The letter that the file's alphabet has for a byte: printable ones stand for themselves, the rest from U+0100 on."""
        if not self._alphabet:
            free = 0x100
            for b in range(256):
                stands = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF
                self._alphabet[b] = chr(b if stands else free)
                free += not stands
        return self._alphabet[byte]

    def _kind(self, char: str) -> str:
        """What the tokenizer's own splitting makes of a character: L(etter), N(umber), O(ther) or white space."""
        if not self._pieces(char):
            return ""
        if len(self._pieces(f"a{char}a")) == 1:
            return "L"
        return "O" if len(self._pieces(f"!{char}!")) == 1 else "N"

    def _learn(self, point: int) -> None:
        """The symbols of a character: a reset, or its bytes, the first of which tells the kind."""
        chars = self._normalize(chr(point)) if point < COMPOSED_FROM else chr(point)
        out = []
        for char in chars:
            if kind := self._kind(char):
                for i, byte in enumerate(char.encode("utf-8")):
                    key = ("C" if i else kind, byte)
                    if key not in self._symbols:
                        self._symbols[key] = len(self._symbol)
                        self._symbol.append((key[0], self._byte(byte)))
                    out.append(self._symbols[key])
            else:
                out.append(_RESET)
        if self._pooled + len(out) > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros(max(len(out), len(self._pool)), np.uint16)])
        self._pool[self._pooled : self._pooled + len(out)] = out
        self._length[point], self._place[point] = len(out), self._pooled
        self._pooled += len(out)

    def _of_piece(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        if points.size and points.max() >= COMPOSED_FROM:
            points = np.frombuffer(self._normalize(text).encode("utf-32-le", "replace"), "<u4")
        lengths = self._length[points]
        if not lengths.all():
            for point in np.unique(points[lengths == 0]).tolist():
                self._learn(point)
            lengths = self._length[points]
        places = self._place[points]
        if lengths.max(initial=1) == 1:
            return self._pool[places]
        ends = np.cumsum(lengths, dtype=np.int64)
        within = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        return self._pool[np.repeat(places, lengths) + within]

    def symbols(self, text: str) -> np.ndarray:
        """The tape of a text. Strings of added tokens are one symbol each, as the library finds them in the raw text."""
        if self._added is None or not self._added.search(text):
            return self._of_piece(text)
        special, out = np.array([_SPECIAL], np.uint16), []
        for i, piece in enumerate(self._added.split(text)):
            out += [special, self._of_piece(piece)] if i else [self._of_piece(piece)]
        return np.concatenate(out)

    # -- states

    def _forget(self) -> None:
        """An empty table with the reset state alone. A state is (kind, suffix, last tokens): kind "" for the reset state,
        "'" for an apostrophe that may begin a contraction, with what follows it, or that of a pre-token. last tokens: for
        each length k of a suffix that begins a token, (k, last token before it or None, tokens before it less tokens if the pre-token ended here)."""
        self._states: list[tuple] = [("", "", ())]
        self._number: dict[tuple, int] = {self._states[0]: 0}
        self._table = np.full((256, self._columns), _MISSING, np.int32)

    def _number_of(self, state: tuple) -> int:
        if (known := self._number.get(state)) is None:
            known = self._number[state] = len(self._states)
            self._states.append(state)
        return known

    def _push(self, kind: str, suffix: str, lasts: tuple, byte: str) -> tuple[tuple, int]:
        """A pre-token's state with one more byte, and the change of the count if it ends there. In an empty one nothing is before the byte."""
        merges = self._merges
        before = lasts or ((0, None, 0),)
        text = suffix + byte
        ended, last, count, whole = None, "", 0, False
        for k, token, tokens in reversed(before):  # the longest beginning first
            stem = text[len(text) - k - 1 :]
            if ended is None and merges.whole(final := stem + merges.suffix) and (token is None or merges.fits(token, final)):
                ended = tokens + 1
            if not whole and merges.whole(stem) and (token is None or merges.fits(token, stem)):
                last, count, whole = stem, tokens + 1, True
        if ended is None or not whole:
            raise ValueError("a byte is no token")
        kept = [(0, last, count - ended)]
        longest = 0
        for k, token, tokens in before:
            if (stem := text[len(text) - k - 1 :]) in merges.beginnings:
                kept.append((k + 1, token, tokens - ended))
                longest = k + 1
        return (kind, text[len(text) - longest :] if longest else "", tuple(kept)), ended

    def _begin(self, kind: str, byte: str) -> tuple[tuple, int]:
        """The state behind the first byte of a pre-token."""
        if byte == "'":
            return ("'", "", ()), self._push("O", "", (), byte)[1]
        state, count = self._push(kind, "", (), byte)
        return (self._states[0], count) if kind == "N" and byte.isascii() else (state, count)

    def _step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        if symbol == _RESET:
            return self._states[0], 0
        if symbol == _SPECIAL:
            return self._states[0], 1
        kind, byte = self._symbol[symbol]
        run, suffix, lasts = state
        if run == "'":
            # "'" counts as one pre-token and what follows it as another until both turn out to be a contraction
            after = suffix + byte
            if kind == "L" and after in CONTRACTIONS:
                whole = self._count("'" + after)
                return self._states[0], whole - self._count("'") - (self._count(suffix) if suffix else 0)
            if kind == "L" and any(c.startswith(after) for c in CONTRACTIONS):
                return ("'", after, ()), self._count(after) - (self._count(suffix) if suffix else 0)
            run, suffix, lasts = self._plain("L" if suffix else "O", suffix or "'")
        if run and (kind == "C" or (kind == run and kind != "N")):
            return self._push(run, suffix, lasts, byte)
        return self._begin(kind, byte)

    def _plain(self, kind: str, text: str) -> tuple:
        """The state of a pre-token that has these bytes so far."""
        state = (kind, "", ())
        for byte in text:
            state, _ = self._push(kind, state[1], state[2], byte)
        return state

    def _count(self, word: str) -> int:
        """Tokens of a whole pre-token."""
        total, state = 0, ("L", "", ())
        for byte in word:
            state, change = self._push("L", state[1], state[2], byte)
            total += change
        return total

    def _compile(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Fill the table where it lacks these transitions."""
        if len(self._symbol) > self._columns:
            while len(self._symbol) > self._columns:
                self._columns *= 2
            self._table = np.concatenate([self._table, np.full((len(self._table), self._columns - self._table.shape[1]), _MISSING, np.int32)], 1)
        for state, symbol in {*zip(states.tolist(), symbols.tolist(), strict=True)}:
            after, change = self._step(self._states[state], symbol)
            number = self._number_of(after)
            if len(self._states) * self._columns > self._entries:
                raise _Full
            if number >= len(self._table):
                self._table = np.concatenate([self._table, np.full_like(self._table, _MISSING)])
            self._table[state, symbol] = number * 256 + change + _ZERO

    def _steps(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Table entries of transitions, all of which are compiled afterwards."""
        found = self._table.reshape(-1).take(states * self._columns + symbols)
        if found.size and found.min() == _MISSING:
            lacking = found == _MISSING
            self._compile(states[lacking], symbols[lacking])
            found = self._table.reshape(-1).take(states * self._columns + symbols)
        return found

    # -- chunks

    def _run(self, tape: np.ndarray, entry: int, chunk: int) -> tuple[np.ndarray, int]:
        """Counts at each symbol of a block and its exit state, by the composed maps of its chunks."""
        n = len(tape)
        lanes = -(-n // chunk)
        padded = np.full(lanes * chunk, _RESET, np.int64)
        padded[:n] = tape
        rows = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
        if len(self._symbol) > self._columns:
            self._compile(np.zeros(0, np.int64), np.zeros(0, np.int64))
        went = np.empty((chunk, lanes), np.int32)
        state = np.zeros(lanes, np.int64)
        for i in range(chunk):
            went[i] = found = self._steps(state, rows[i])
            state = (found >> 8).astype(np.int64)
        entries, true = np.zeros(lanes, np.int64), np.concatenate([[entry], state[:-1]])
        while (open_ := np.flatnonzero(entries != true)).size:
            entries = true.copy()
            state = true[open_]
            for i in range(chunk):
                found = self._steps(state, rows[i, open_])
                apart = found != went[i, open_]
                went[i, open_] = found
                # counts of this step may differ where the states behind it agree; from there on the runs are one
                state = (found >> 8).astype(np.int64)
                if not apart.all():
                    open_, state = open_[apart], state[apart]
                if not open_.size:
                    break
            true = np.concatenate([[entry], (went[-1, :-1] >> 8).astype(np.int64)])
        counts = ((went & 255) - _ZERO).T.reshape(-1)[:n]
        exit_ = int(went[(n - 1) % chunk, lanes - 1] >> 8) if n else entry
        return counts, exit_

    def run(self, tape: np.ndarray, entry: tuple, chunk: int = CHUNK) -> tuple[np.ndarray, tuple]:
        """Counts and the exit state of any tape; one that needs more states than a table holds is run in halves."""
        try:
            counts, exit_ = self._run(tape, self._number_of(entry), min(chunk, max(1, len(tape))))
            return counts, self._states[exit_]
        except _Full:
            self._forget()
            if len(tape) == 1:
                raise
            half = len(tape) // 2
            first, middle = self.run(tape[:half], entry, chunk)
            second, last = self.run(tape[half:], middle, chunk)
            return np.concatenate([first, second]), last

    def counts(self, texts: Iterable[str], block: int = BLOCK, chunk: int = CHUNK) -> Iterator[int]:
        """Tokens of each text, in order."""
        reset = np.zeros(1, np.uint16)
        tapes: list[np.ndarray] = []
        size = 0

        def together() -> Iterator[int]:
            tape = np.concatenate([x for t in tapes for x in (t, reset)])
            counts, _ = self.run(tape, self._states[0], chunk)
            sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            ends = np.cumsum([len(t) + 1 for t in tapes])
            yield from (sums[ends] - sums[np.concatenate([[0], ends[:-1]])]).tolist()

        for text in texts:
            tape = self.symbols(text)
            if tapes and size + len(tape) > block:
                yield from together()
                tapes, size = [], 0
            if len(tape) > block:
                total, state = 0, self._states[0]
                for at in range(0, len(tape), block):
                    counts, state = self.run(tape[at : at + block], state, chunk)
                    total += int(counts.sum(dtype=np.int64))
                yield total
            else:
                tapes.append(tape)
                size += len(tape) + 1
        if tapes:
            yield from together()


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The compiled tokenizer of this worker process."""
    return Transducer(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: UTF-8 bytes and tokens of each whole text as the ``tokenizers`` library
    counts them without special tokens around it; strings of added tokens inside a text are one token each.

    Null and empty texts have 0 of both. Rows are independent: repeated rows and null ids give a row each, other columns
    are ignored whatever their names, an empty table gives an empty result. ``tokenizer_path`` must be readable on every
    worker. No shuffle.
    """

    def task():
        counts = transducer(tokenizer_path).counts

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = np.fromiter(counts(texts_of(batch)), np.int64, batch.num_rows)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

        return step

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return map_arrow(rows, task, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_tokens long, over_limit boolean")
