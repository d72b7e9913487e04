"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string exactly one token can end it in the string's BPE encoding. Storing that last token per
prefix gives the encoding by walking back, and makes two things exact and cheap: appending bytes (the stored part stays
as it is) and re-encoding after an edit (work stops as soon as the stored tokens agree again).

Two tokens may stand side by side if and only if no merge across their border would happen before the merges that built
them: the tokens along the right edge of the left one and along the left edge of the right one are compared by rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortloom.llm.common import map_arrow, text_or_empty

#: Pre-tokens a worker remembers between documents, twice: those met since the memory was last full, and those met between
#: that and the time before. Results do not depend on it.
MEMORY_ENTRIES = 400_000
#: Characters of text whose new pre-tokens are encoded together.
STRETCH_CHARS = 1_000_000
_NEVER = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PrefixState:
    """A byte string and, for each of its prefixes, the last token of that prefix's encoding (``last[0]`` is unused)."""

    __slots__ = ("data", "last")

    def __init__(self) -> None:
        self.data, self.last = b"", [-1]


class PrefixEncoder:
    """Exact BPE of single pre-tokens by ``ranks`` (token bytes -> rank, which is also its id)."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {rank: data for data, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._whole: dict[int, bool] = {}
        self._right: dict[int, list[tuple[bytes, int]]] = {}
        self._left: dict[int, list[tuple[bytes, int]]] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    def _built_whole(self, token: int) -> bool:
        """Whether merging the token's own bytes ends in this token; remembers the two halves of its last merge."""
        if token not in self._whole:
            data = self.token[token]
            parts, halves = [data[i : i + 1] for i in range(len(data))], None
            while len(parts) > 1:
                found = [(rank, i) for i in range(len(parts) - 1) if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None]
                if not found:
                    break
                _, i = min(found)
                halves = (self.ranks[parts[i]], self.ranks[parts[i + 1]])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._whole[token] = len(parts) == 1
            self._halves[token] = halves if len(parts) == 1 else None
        return self._whole[token]

    def _edge(self, token: int, side: int, known: dict[int, list[tuple[bytes, int]]]) -> list[tuple[bytes, int]]:
        """Tokens along one edge, from whole to byte, each with the rank of the merge that ends it."""
        if token not in known:
            out, ends = [], _NEVER
            at: int | None = token
            while at is not None:
                out.append((self.token[at], ends))
                self._built_whole(at)
                halves, ends = self._halves[at], at
                at = halves[side] if halves else None
            known[token] = out
        return known[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes together is just these two tokens."""
        pair = (left, right)
        if (known := self._fits.get(pair)) is None:
            if len(self._fits) > 4 * MEMORY_ENTRIES:
                self._fits.clear()
            rank_of = self.ranks.get
            known = self._fits[pair] = not any(
                (rank := rank_of(x + y)) is not None and rank < x_ends and rank <= y_ends
                for x, x_ends in self._edge(left, 1, self._right)
                for y, y_ends in self._edge(right, 0, self._left)
            )
        return known

    def _last(self, data: bytes, last: list[int], end: int) -> int:
        """Only one token ends the prefix, so places may be tried in any order: first where the token before it began, lengthened by a byte, then from the shortest on."""
        rank_of, whole, fits = self.ranks.get, self._whole, self._fits
        first = end - 1 - len(self.token[last[end - 1]]) if end > 1 else 0
        token = rank_of(data[first:end])
        if token is not None and (whole.get(token) or self._built_whole(token)) and (not first or self.fits(last[first], token)):
            return token
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            token = rank_of(data[start:end])
            if token is not None and start != first and (whole.get(token) or self._built_whole(token)):
                if not start:
                    return token
                known = fits.get((last[start], token))
                if known or known is None and self.fits(last[start], token):
                    return token
        raise ValueError("a byte has no rank")

    def append(self, state: PrefixState, more: bytes) -> PrefixState:
        """Lengthen ``state`` in place; what it held is not looked at again."""
        begin, state.data = len(state.data), state.data + more
        data, last, last_of = state.data, state.last, self._last
        for end in range(begin + 1, len(data) + 1):
            last.append(last_of(data, last, end))
        return state

    def cut(self, state: PrefixState, length: int) -> PrefixState:
        """Keep only the first bytes of ``state``, in place: last tokens of prefixes stay as they are."""
        state.data = state.data[:length]
        del state.last[length + 1 :]
        return state

    def replace(self, state: PrefixState, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns the number of prefixes whose last token was worked out.

        Behind the edit, once as many prefixes as the longest token has bytes end as they did before, all later ones do.
        """
        old, shift, done, same = state.last, len(new) - (stop - start), 0, 0
        state.data = state.data[:start] + new + state.data[stop:]
        last = old[: start + 1]
        for end in range(start + 1, len(state.data) + 1):
            last.append(self._last(state.data, last, end))
            done += 1
            same = same + 1 if end > start + len(new) and last[end] == old[end - shift] else 0
            if same >= self.longest and end >= start + len(new) + self.longest:
                last += old[end - shift + 1 :]
                break
        state.last = last
        return done

    def tokens(self, state: PrefixState) -> list[int]:
        out, at = [], len(state.data)
        while at:
            out.append(state.last[at])
            at -= len(self.token[out[-1]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        """The encoding of one pre-token; one that is a token itself is that token, merges or not."""
        if not data:
            return []
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        return self.tokens(self.append(PrefixState(), data))


    def encode_all(self, pieces: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Pre-tokens with their encodings, in order of their bytes: of each only what follows the prefix that it has in common with the one before is worked out."""
        state = PrefixState()
        for data in sorted(pieces):
            if not data or data in self.ranks:
                yield data, self.encode(data)
                continue
            common, held = 0, state.data
            if data.startswith(held):
                common = len(held)
            else:
                for x, y in zip(held, data, strict=False):
                    if x != y:
                        break
                    common += 1
            yield data, self.tokens(self.append(self.cut(state, common), data[common:]))


class ByteTable:
    """Byte strings by number, for joining many of them at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.fromiter(map(len, strings), np.int64, len(strings))
        self.start = np.cumsum(self.length) - self.length

    def joined(self, ids: np.ndarray) -> bytes:
        length = self.length[ids]
        shift = self.start[ids] - (np.cumsum(length) - length)
        at = np.repeat(shift, length)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()


class Tokenizer:
    """Texts to ids, with a memory of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.encoder, self.find = PrefixEncoder(ranks), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        new: dict[bytes, list[str]] = {}
        for piece in pieces:
            if (ids := self.older.get(piece)) is not None:
                self.known[piece] = ids
            else:
                new.setdefault(piece.encode("utf-8", "replace"), []).append(piece)
        for data, ids in self.encoder.encode_all(list(new)):
            found = np.array(ids, "<u4").tobytes()
            for piece in new[data]:
                self.known[piece] = found

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; the new pre-tokens of a stretch of texts are encoded together."""
        at = 0
        while at < len(texts):
            size, split = 0, []
            while at < len(texts) and (not split or size + len(texts[at]) <= STRETCH_CHARS):
                size += len(texts[at])
                split.append(self.find(texts[at]))
                at += 1
            if len(self.known) > MEMORY_ENTRIES:
                self.known, self.older = {}, self.known
            self._learn(set().union(*split).difference(self.known))
            ids_of = self.known.__getitem__
            for pieces in split:
                yield np.frombuffer(b"".join(map(ids_of, pieces)), "<u4")


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One for each worker process."""
    return Tokenizer(load_ranks(path), pattern)


def encode_bpe(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text as little-endian 32-bit integers; null and empty texts: no ids.

    Rows are independent: repeated rows and null ids give a row each; other columns are ignored.
    """

    def task():
        encode = tokenizer(ranks_path, pattern).encode

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [x.tobytes() for x in encode(batch.column("text").to_pylist())]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

        return step

    rows = docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(rows, task, f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary")


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded, the ids decoded again, and digests of both."""

    def task():
        known = tokenizer(ranks_path, pattern)
        encode, by_rank = known.encode, known.encoder.token
        top = max(by_rank, default=-1) + 1
        token_bytes = ByteTable([by_rank.get(i, b"") for i in range(top)])
        decimals = ByteTable([b"%d," % i for i in range(top)])

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_sha, decoded_sha = [], [], []
            for ids in encode(batch.column("text").to_pylist()):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(decimals.joined(ids)[:-1]).hexdigest())
                decoded_sha.append(hashlib.sha256(token_bytes.joined(ids)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    rows = docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(rows, task, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
