"""Hashed words and word shingles of whole texts, by numpy."""

from __future__ import annotations

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text that are hashed at once.
BLOCK_BYTES = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word: runs of other than ASCII white space, A-Z in lower case; and where it begins. Every eight
    bytes of a word are scrambled with their place before they are summed."""
    data = _LOWER[np.frombuffer(data, np.uint8)]
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = ~_SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    edge = np.concatenate(([0], edge, [len(data)]) if word[0] else (edge, [len(data)]))
    starts, ends = edge[:-1:2] if len(edge) % 2 else edge[::2], edge[1::2]
    starts = starts[: len(ends)]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    place = at & 7
    lane_starts = np.flatnonzero(place == 0)
    lanes = np.bitwise_or.reduceat(data[word].astype(np.uint64) << (place << 3).view(np.uint64), lane_starts)
    lanes = mixed(lanes ^ mixed(((at[lane_starts] >> 3) + 1).astype(np.uint64) * _P))
    first_lane = np.cumsum((lengths + 7) // 8) - (lengths + 7) // 8
    return mixed(np.add.reduceat(lanes, first_lane) + lengths.astype(np.uint64)), starts


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word."""
    return _hashed(text.encode("utf-8", "replace"))[0]


def words_of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, and how many each text has. Short texts are hashed together, a line break between them."""
    hashes, counts, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(texts):
        block, size = [], 0
        while at < len(texts) and size < BLOCK_BYTES:
            block.append(texts[at].encode("utf-8", "replace"))
            size += len(block[-1]) + 1
            at += 1
        found, starts = _hashed(b"\n".join(block))
        ends = np.cumsum(np.fromiter(map(len, block), np.int64, len(block)) + 1)
        hashes.append(found)
        counts.append(np.diff(np.searchsorted(starts, ends), prepend=0))
    return np.concatenate(hashes), np.concatenate(counts)


def shingle_hashes(text: str, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles; of fewer words the whole sequence is one, of none there is none."""
    words = word_hashes(text)
    n = min(size, len(words))
    if not n:
        return words
    out = np.full(len(words) - n + 1, np.uint64(n))
    for i in range(n):
        out = mixed(out * _P + words[i : len(words) - n + 1 + i])
    return np.unique(out)
