"""Interpolated modified Kneser-Ney n-gram model of order 2 or 3, counted in Spark, stored as sorted hash arrays, mapped by workers.

Passes over the texts, each a Spark job whose tasks put out packed arrays per shard and whose shuffle brings the arrays of
a shard together:

1. words: 64-bit hashes and counts of all training tokens; the sorted hashes of a shard are one stretch of the
   vocabulary, and a word's id is its rank in it;
2. n-grams of the highest order as ids, and their counts. Trigrams are dealt by their first two words. A shard stores its
   trigrams as sorted hashes (the leading bits are a place in a table, the next 32 are kept; about two in 10**9 unseen
   n-grams are taken for seen ones) and what follows each context; pairs are stored alike. From its distinct trigrams come the numbers of
   different words before each pair, which a second shuffle sums: the bigrams' counts. A shard of bigrams takes all pairs
   of a left word, but the pairs of a word that makes up more than an eighth of a shard are spread over all shards. From
   the distinct pairs come the statistics of the left words (how many followers once, twice, more often) and of the right
   ones (how many predecessors), which are merged into the vocabulary in a last shuffle. At order 2 the bigrams and their
   plain counts come from the texts;
3. scores: tasks look up words, pairs and trigrams of whole documents by binary search in the mapped arrays.

A document is its words (A-Z in lower case) and one end; its first word follows a start, which is never predicted, and
depends on it alone, with plain counts. Shards of n-grams grow in number with the training tokens (``SHARD_TOKENS`` a shard),
those of words with the shuffle partitions, so that the arrays of one shard stay small however large the corpus.
"""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.array_files import map_arrays, store_arrays
from cohortloom.llm.common import map_arrow, shared_folder, shuffle_partitions, split_remainder, text_or_empty
from cohortloom.llm.shingles import mixed, words_of_texts

#: Hash of the end of a document; words have greater ones.
END = np.uint64(1)
#: Characters of text that are counted at once, and that are scored at once: fewer, since scoring holds many numbers a token and gains little by more.
CHUNK_CHARS, SCORED_CHARS = 12_000_000, 3_000_000
#: Training tokens for each shard of n-grams.
SHARD_TOKENS = 4_000_000
#: Of a word: different followers counted once, twice, more often; different words before it; counts of its followers.
STATS = ("n1", "n2", "n3", "before", "total")


_OTHER_SEED, _ODD = np.uint64(0x5851F42D4C957F2D), np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NgramModel:
    order: int
    folder: str
    shards: int  # of pairs and triples
    first_id: tuple[int, ...]  # of each shard's words; the last is the number of all words, and the id of the start
    train_tokens: int
    train_docs: int
    triple_discounts: tuple[float, float, float]
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    distinct_pairs: int
    word_spread: float  # what the discounts leave of the continuation probabilities


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the numbers of n-grams seen once to four times; where those can't tell, half of the count."""
    if not (n1 and n2):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(d if 0 < d < k else k / 2 for k, d in enumerate(found, 1))  # type: ignore[return-value]


def _packed(*columns: np.ndarray) -> bytes:
    """Unsigned columns of one length by byte planes, compressed: bytes that are mostly alike lie together."""
    return zstandard.compress(b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns), 1)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    blob = zstandard.decompress(blob)
    width = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(blob) // sum(width), 0, []
    for k, w in zip(kinds, width, strict=True):
        out.append(np.frombuffer(blob, np.uint8, n * w, at).reshape(w, n).T.copy().view(k).ravel())
        at += n * w
    return out


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and each one's sums."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order].astype(np.int64), first) if len(first) else np.empty(0, np.int64) for v in values)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and each key's place among them: only these are sorted."""
    codes, found = pd.factorize(keys)
    order = np.argsort(found)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found[order], place[codes]


def _delta(ids: np.ndarray) -> np.ndarray:
    return np.diff(ids, prepend=ids[:1] * 0)


def _shard_of_word(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Stretches of equal length of all 32-bit beginnings."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _chunks(texts: list[str], chars: int | None = None):
    """(index of the first document, token hashes with ends, first token of each document) of stretches of documents."""
    at, chars = 0, chars or CHUNK_CHARS
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= chars):
            size, stop = size + len(texts[stop]), stop + 1
        words, lengths = words_of_texts(texts[at:stop])
        lengths = lengths + 1
        ends = np.cumsum(lengths)
        tokens, word = np.full(int(ends[-1]), END), np.ones(int(ends[-1]), bool)
        word[ends - 1] = False
        tokens[word] = np.maximum(words, END + np.uint64(1))
        yield at, tokens, ends - lengths
        at = stop


class Vocabulary:
    """The mapped vocabulary of a model folder: ids of hashes, and statistics by id."""

    def __init__(self, folder: str, first_id: tuple[int, ...], with_stats: bool) -> None:
        self.folder, self.first_id = folder, np.array(first_id, np.int64)
        self.shards = len(first_id) - 1
        self.files = [map_arrays(f"{folder}/words", str(s)) if first_id[s + 1] > first_id[s] else None for s in range(self.shards)]
        self.stats = [map_arrays(f"{folder}/stats", str(s)) if f is not None else None for s, f in enumerate(self.files)] if with_stats else []

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Of sorted hashes; -1 for words that were not in the training texts."""
        out = np.full(len(hashes), -1, np.int64)
        cuts = np.searchsorted(_shard_of_word(hashes, self.shards), np.arange(self.shards + 1))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b and self.files[s] is not None:
                known = self.files[s]["hash"]
                at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == hashes[a:b], at + self.first_id[s], -1)
        return out

    def gather(self, name: str, ids: np.ndarray) -> np.ndarray:
        """The statistic of sorted ids; 0 for -1 and for the start."""
        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.first_id)
        files = self.files if name == "count" else self.stats
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b and files[s] is not None:
                out[a:b] = files[s][name][ids[a:b] - self.first_id[s]]
        return out


@lru_cache(maxsize=2)
def _vocabulary(folder: str, first_id: tuple[int, ...], with_stats: bool) -> Vocabulary:
    return Vocabulary(folder, first_id, with_stats)


@lru_cache(maxsize=8)
def _shard_files(folder: str, kind: str, shards: int) -> list[dict[str, np.ndarray] | None]:
    out: list[dict[str, np.ndarray] | None] = [None] * shards
    for s in range(shards):
        with contextlib.suppress(FileNotFoundError):  # a shard without n-grams has no file
            out[s] = map_arrays(f"{folder}/{kind}", str(s))
    return out


def _by_shard(shard: np.ndarray, shards: int):
    """Each shard that occurs, and where."""
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if a < b:
            yield s, order[a:b]


def _few_bytes(n: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each, those of 255 and more beside them."""
    large = np.flatnonzero(n >= 255)
    return {"count": np.minimum(n, 255).astype(np.uint8), "large_at": large.astype(np.int64), "large": n[large].astype(np.int64)}


def _count_at(f: dict[str, np.ndarray], at: np.ndarray, found: np.ndarray) -> np.ndarray:
    n = np.where(found, f["count"][at], 0).astype(np.int64)
    if len(many := np.flatnonzero(n == 255)):
        n[many] = f["large"][np.searchsorted(f["large_at"], at[many])]
    return n


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)


def _shard_of_triple(pair: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(pair) % np.uint64(shards)).astype(np.int64)


def _triple_hash(pair: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(pair ^ _OTHER_SEED) + (word.astype(np.uint64) + np.uint64(1)) * _ODD)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _hash_table(hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted hashes as the ends of buckets by leading bits, some eight hashes each, and the 32 bits that come next."""
    bits = max(0, (len(hashes) // 8).bit_length() - 1)
    ends = np.searchsorted(_bucket(hashes, bits), np.arange((1 << bits) + 1))
    return {"bucket": ends.astype(np.uint32), "rest": (hashes << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)}


def _find(f: dict[str, np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a stored table of hashes, and whether they are there: binary search in all buckets at once."""
    bits = (len(f["bucket"]) - 1).bit_length() - 1
    bucket, rest = _bucket(hashes, bits), (hashes << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
    low, end = f["bucket"][bucket].astype(np.int64), f["bucket"][bucket + 1].astype(np.int64)
    high, last = end.copy(), len(f["rest"]) - 1
    for _ in range(int((high - low).max(initial=0)).bit_length()):
        middle = (low + high) >> 1
        less = (low < high) & (f["rest"][np.minimum(middle, last)] < rest)
        low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
    at = np.minimum(low, last)
    return at, (low < end) & (f["rest"][at] == rest)


def _shard_of_pair(left: np.ndarray, right: np.ndarray, left_count: np.ndarray, total: int, shards: int) -> np.ndarray:
    frequent = left_count * 8 * shards > total
    key = mixed(left.astype(np.uint64) + np.uint64(1))
    return (np.where(frequent, mixed(key + right.astype(np.uint64)), key) % np.uint64(shards)).astype(np.int64)


def _previous(ids: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[first] = start
    return out


def _blobs(shard: np.ndarray, made: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (shard, blob) of columns that are ordered by shard."""
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(shard) else np.zeros(1, np.int64)
    at = list(zip(cuts.tolist(), cuts[1:].tolist(), strict=False))
    return pa.RecordBatch.from_arrays([pa.array([int(shard[a]) for a, _ in at], pa.int32()), pa.array([_packed(*(c[a:b] for c in made)) for a, b in at], pa.binary())], names=["shard", "blob"])


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _texts(docs: DataFrame, text_col: str, training: Column) -> DataFrame:
    return docs.where(training).select(text_or_empty(text_col).alias("text"))


def _count_words(texts: DataFrame, folder: str, shards: int) -> tuple[tuple[int, ...], int, int]:
    """Write the vocabulary; ids at which shards begin, number of tokens and of documents."""

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for _, tokens, _ in _chunks(batch.column("text").to_pylist()):
                words, counts = np.unique(tokens, return_counts=True)
                out.append(_blobs(_shard_of_word(words, shards), [words, counts.astype(np.uint32)]))
            return _joined(out)

        return step

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(b, "<u8", "<u4") for b in group["blob"]]
        words, counts = _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        s = int(group["shard"].iloc[0])
        store_arrays(f"{folder}/words", str(s), {"hash": words, "count": counts.astype(np.int64)})
        ends = int(counts[words == END].sum())
        return pd.DataFrame({"shard": [s], "words": [len(words)], "tokens": [int(counts.sum())], "ends": [ends]})

    blobs = map_arrow(texts, task, "shard int, blob binary")
    found = blobs.groupBy("shard").applyInPandas(merge, "shard int, words long, tokens long, ends long").collect()  # a row a shard
    sizes = np.zeros(shards, np.int64)
    for r in found:
        sizes[r["shard"]] = r["words"]
    first = tuple(int(x) for x in np.concatenate(([0], np.cumsum(sizes))))
    return first, sum(r["tokens"] for r in found), sum(r["ends"] for r in found)


def _pair_blobs(words: Vocabulary, pairs: np.ndarray, n: np.ndarray, tokens: int, shards: int) -> pa.RecordBatch:
    """Rows (shard, blob) of distinct sorted pairs and their counts."""
    left, right = _halves(pairs)
    ids, at = np.unique(left, return_inverse=True)
    count = np.where(ids == words.first_id[-1], tokens, words.gather("count", ids))  # the start is spread like a frequent word
    shard = _shard_of_pair(left, right, count[at], tokens, shards)
    order = np.argsort(shard, kind="stable")
    shard, left, right, n = shard[order], left[order], right[order], n[order]
    return _blobs(shard, [_steps(shard, left), right.astype(np.uint32), n.astype(np.uint32)])


def _steps(shard: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Differences of the sorted ids of each shard."""
    return np.where(np.concatenate(([True], shard[1:] != shard[:-1])), ids, ids - np.concatenate(([0], ids[:-1]))).astype(np.uint32)


def _count_triples(texts: DataFrame, folder: str, shards: int, first_id: tuple[int, ...], tokens: int) -> DataFrame:
    """Write triples and what follows their contexts; rows ``shard, blob, seen`` of pairs counted by the words before them,
    those of first words by their number, and, in shard -1, numbers of triples counted 1, 2, 3, 4 and any."""
    start = first_id[-1]

    def task():
        words = _vocabulary(folder, first_id, False)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for _, hashes, first in _chunks(batch.column("text").to_pylist()):
                known, at = _distinct(hashes)
                right = words.ids(known)[at]
                left = _previous(right, first, start)
                pairs, at = _distinct(_key(_previous(left, first, start), left))
                triples, n = np.unique(_key(at, right), return_counts=True)
                at, right = _halves(triples)
                shard = _shard_of_triple(pairs, shards)[at]
                order = np.argsort(shard, kind="stable")
                shard, right, n = shard[order], right[order], n[order]
                before, left = _halves(pairs[at[order]])
                out.append(_blobs(shard, [_steps(shard, before), left.astype(np.uint32), right.astype(np.uint32), n.astype(np.uint32)]))
            return _joined(out)

        return step

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(b, *["<u4"] * 4) for b in group["blob"]]
        s = int(group["shard"].iloc[0])
        pair = np.concatenate([_key(np.cumsum(p[0].astype(np.uint64)), p[1]) for p in parts])
        word, n = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
        hashes = _triple_hash(pair, word)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        distinct = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        n = np.add.reduceat(n[order].astype(np.int64), distinct)
        hashes, pair, word = hashes[distinct], pair[order[distinct]], word[order[distinct]]
        left = pair & np.uint64(0xFFFFFFFF)
        inner = left != np.uint64(start)
        of, total, *seen = _summed(pair[inner], n[inner], n[inner] == 1, n[inner] == 2, n[inner] >= 3)
        stored = {"total": total, **dict(zip(("n1", "n2", "n3"), seen, strict=True))}
        few, many = (total > 1) & (total < 255), total >= 255  # a context that occurs once has one follower, once
        hashes_of = mixed(of[few])
        order = np.argsort(hashes_of)
        small = _hash_table(hashes_of[order]) | {k: x[few][order].astype(np.uint8) for k, x in stored.items()}
        store_arrays(f"{folder}/contexts", str(s), small | {"large_key": of[many], **{f"large_{k}": x[many].astype(np.int64) for k, x in stored.items()}})
        store_arrays(f"{folder}/triples", str(s), _hash_table(hashes[inner]) | _few_bytes(n[inner]))
        pairs, different = _summed(_key(left, word), np.where(inner, 1, n))
        blobs = _pair_blobs(_vocabulary(folder, first_id, False), pairs, different, tokens, shards).to_pydict()
        n = n[inner]
        return pd.DataFrame({"shard": [*blobs["shard"], -1], "blob": [*blobs["blob"], b""], "seen": [*[None] * len(blobs["shard"]), [*(int((n == k).sum()) for k in (1, 2, 3, 4)), len(n)]]})

    blobs = map_arrow(texts, task, "shard int, blob binary")
    return blobs.groupBy("shard").applyInPandas(merge, "shard int, blob binary, seen array<long>")


def _plain_pairs(texts: DataFrame, folder: str, shards: int, first_id: tuple[int, ...], tokens: int) -> DataFrame:
    """Rows ``shard, blob, seen`` of pairs and how often they occur."""
    start = first_id[-1]

    def task():
        words = _vocabulary(folder, first_id, False)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for _, hashes, first in _chunks(batch.column("text").to_pylist()):
                known, at = _distinct(hashes)
                right = words.ids(known)[at]
                pairs, n = np.unique(_key(_previous(right, first, start), right), return_counts=True)
                out.append(_pair_blobs(words, pairs, n, tokens, shards))
            return _joined(out)

        return step

    return map_arrow(texts, task, "shard int, blob binary").withColumn("seen", F.lit(None).cast("array<long>"))


def _merge_pairs(blobs: DataFrame, folder: str, first_id: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Write pairs and the words' statistics; numbers of triples, of pairs, and of words by predecessors, counted 1, 2, 3, 4 and any."""
    start = first_id[-1]
    bounds = np.array(first_id, np.int64)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        if group["shard"].iloc[0] < 0:
            return pd.DataFrame({"target": -3, "blob": b"", "seen": group["seen"]})
        parts = [_unpacked(b, "<u4", "<u4", "<u4") for b in group["blob"]]
        keys = np.concatenate([np.cumsum(left.astype(np.uint64)) << np.uint64(32) | right for left, right, _ in parts])
        keys, n = _summed(keys, np.concatenate([p[2] for p in parts]))
        s = int(group["shard"].iloc[0])
        hashes = mixed(keys)
        order = np.argsort(hashes)
        store_arrays(f"{folder}/pairs", str(s), _hash_table(hashes[order]) | _few_bytes(n[order]))
        left, right = _halves(keys)
        ids, n1, n2, n3, total = _summed(left, n == 1, n == 2, n >= 3, n)
        after, before = _summed(right, np.ones(len(right), np.int64))
        every = np.concatenate((ids, after))
        zero, none = np.zeros(len(ids), np.int64), np.zeros(len(after), np.int64)
        every, n1, n2, n3, total, before = _summed(every, *(np.append(x, none) for x in (n1, n2, n3, total)), np.append(zero, before))
        target = np.searchsorted(bounds, every, side="right") - 1
        target[every == start] = -1  # the start's followers
        out = []
        for t in np.unique(target).tolist():
            at = target == t
            out.append((t, _packed(_delta(every[at]).astype(np.uint32), *(x[at].astype(np.uint32) for x in (n1, n2, n3, before)), total[at].astype(np.uint64)), None))
        out.append((-2, b"", [*(int((n == k).sum()) for k in (1, 2, 3, 4)), len(n)]))
        return pd.DataFrame(out, columns=["target", "blob", "seen"])

    def merge_stats(group: pd.DataFrame) -> pd.DataFrame:
        t = int(group["target"].iloc[0])
        if t < -1:
            return pd.DataFrame({"target": [t], "seen": [[int(x) for x in np.sum([np.asarray(x) for x in group["seen"]], axis=0)]]})
        parts = [_unpacked(b, *["<u4"] * 5, "<u8") for b in group["blob"]]
        ids, *stats = _summed(np.concatenate([np.cumsum(p[0].astype(np.int64)) for p in parts]), *(np.concatenate([p[k] for p in parts]) for k in range(1, 6)))
        if t == -1:
            store_arrays(f"{folder}/stats", "start", dict(zip(STATS, (x.astype(np.int64) for x in stats), strict=True)))
            return pd.DataFrame({"target": [t], "seen": [[0] * 5]})
        full = {}
        for name, x in zip(STATS, stats, strict=True):
            full[name] = np.zeros(first_id[t + 1] - first_id[t], np.int64 if name == "total" else np.uint32)
            full[name][ids - first_id[t]] = x
        store_arrays(f"{folder}/stats", str(t), full)
        before = stats[3]
        return pd.DataFrame({"target": [t], "seen": [[*(int((before == k).sum()) for k in (1, 2, 3, 4)), int((before > 0).sum())]]})

    merged = blobs.groupBy("shard").applyInPandas(merge, "target int, blob binary, seen array<long>")
    found = merged.groupBy("target").applyInPandas(merge_stats, "target int, seen array<long>").collect()  # a row a shard
    triples, pairs = (next((np.array(r["seen"]) for r in found if r["target"] == t), np.zeros(5, np.int64)) for t in (-3, -2))
    words = np.sum([np.zeros(5, np.int64), *(np.array(r["seen"]) for r in found if r["target"] >= 0)], axis=0)
    return triples, pairs, words


def fit_ngram_model(docs: DataFrame, training: Column, text_col: str = "text", order: int = 3, folder: str | None = None) -> NgramModel:
    """Count the rows that meet ``training`` and write the model to ``folder``, by default in the shared one. No rows give a model that knows no word."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/ngrams-{uuid.uuid4().hex}"
    if "://" not in folder:
        folder = folder if folder.startswith("file:") else f"file://{folder}"
    shards = shuffle_partitions(spark)
    texts = _texts(docs, text_col, training)
    first_id, tokens, n_docs = _count_words(texts, folder, shards)
    if first_id[-1] >= 1 << 32:
        raise ValueError("more than 2**32 words")
    shards = max(shards, -(-int(tokens) // SHARD_TOKENS))
    count = _count_triples if order == 3 else _plain_pairs
    triples, pairs, words = _merge_pairs(count(texts, folder, shards, first_id, tokens), folder, first_id)
    d = discounts(*(int(x) for x in words[:4]))
    seen = [int(words[0]), int(words[1]), int(words[4] - words[0] - words[1])]
    spread = sum(x * n for x, n in zip(d, seen, strict=True)) / pairs[4] if pairs[4] else 1.0
    of_triples, of_pairs = (discounts(*(int(x) for x in seen[:4])) for seen in (triples, pairs))
    return NgramModel(order, folder, shards, first_id, int(tokens), int(n_docs), of_triples, of_pairs, d, int(pairs[4]), float(spread))


class Scorer:
    """Log probabilities under a model's mapped arrays."""

    def __init__(self, model: NgramModel) -> None:
        self.m = m = model
        self.words = _vocabulary(m.folder, m.first_id, True)
        self.pairs = _shard_files(m.folder, "pairs", m.shards)
        self.triples, self.contexts = (_shard_files(m.folder, kind, m.shards) if m.order == 3 else [] for kind in ("triples", "contexts"))
        self.start = {k: int(x[0]) for k, x in map_arrays(f"{m.folder}/stats", "start").items()} if m.train_docs else dict.fromkeys(STATS, 0)

    def _pair_counts(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), np.int64)
        known = np.flatnonzero((left >= 0) & (right >= 0))
        if not len(known):
            return out
        shard = _shard_of_pair(left[known], right[known], left_count[known], self.m.train_tokens, self.m.shards)
        for s, rows in _by_shard(shard, self.m.shards):
            if (f := self.pairs[s]) is not None:
                out[known[rows]] = _count_at(f, *_find(f, mixed(_key(left[known[rows]], right[known[rows]]))))
        return out

    def _of_contexts(self, pair: np.ndarray, shard: np.ndarray) -> dict[str, np.ndarray]:
        """How often known pairs have a follower, and how many followers once, twice, more often."""
        out = {k: np.full(len(pair), k in ("total", "n1"), np.int64) for k in ("total", "n1", "n2", "n3")}
        for s, rows in _by_shard(shard, self.m.shards):
            if (f := self.contexts[s]) is None:
                continue
            if len(f["rest"]):
                at, found = _find(f, mixed(pair[rows]))
                for k, x in out.items():
                    x[rows[found]] = f[k][at[found]]
            if len(keys := f["large_key"]):
                at = np.minimum(np.searchsorted(keys, pair[rows]), len(keys) - 1)
                found = keys[at] == pair[rows]
                for k, x in out.items():
                    x[rows[found]] = f[f"large_{k}"][at[found]]
        return out

    def _triple_counts(self, pair: np.ndarray, word: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pair), np.int64)
        hashes = _triple_hash(pair, word)
        for s, rows in _by_shard(shard, self.m.shards):
            if (f := self.triples[s]) is not None and len(f["rest"]):
                out[rows] = _count_at(f, *_find(f, hashes[rows]))
        return out

    def _after_two(self, pair: np.ndarray, seen: np.ndarray, word: np.ndarray, p: np.ndarray, of: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Probabilities of words ``by`` after pairs ``of`` (places in ``word`` and in ``pair``, of which ``seen`` are known), where ``p`` is theirs after one word."""
        m = self.m
        known = np.flatnonzero(seen)
        place = np.full(len(pair), -1, np.int64)
        place[known] = np.arange(len(known))
        shard = _shard_of_triple(pair[known], m.shards)
        stats = self._of_contexts(pair[known], shard)
        rows = np.flatnonzero(seen[of])
        at = place[of[rows]]
        n = np.zeros(len(rows), np.int64)
        both = np.flatnonzero(word[by[rows]] >= 0)
        n[both] = self._triple_counts(pair[known][at[both]], word[by[rows[both]]], shard[at[both]])
        kept = sum(d * stats[k] for d, k in zip(m.triple_discounts, ("n1", "n2", "n3"), strict=True))
        out = p.copy()
        out[rows] = (n - np.array([0.0, *m.triple_discounts])[np.minimum(n, 3)] + kept[at] * p[rows]) / stats["total"][at]
        return out

    def score(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each document: number of known tokens, log10 probability by add-one unigrams, and by the model."""
        m, start = self.m, self.m.first_id[-1]
        distinct, at = _distinct(hashes)
        ids = self.words.ids(distinct)
        order = np.argsort(ids, kind="stable")
        stats = {}
        for name in ("count", *STATS):
            stats[name] = np.empty(len(ids), np.int64)
            stats[name][order] = self.words.gather(name, ids[order])
        base = np.log10((stats["count"] + 1) / (m.train_tokens + (start + 1)))
        before = stats["before"]
        taken = np.array([0.0, *m.word_discounts])[np.minimum(before, 3)]
        unigram = (before - taken) / max(m.distinct_pairs, 1) + m.word_spread / (start + 1)
        # the follower statistics of each distinct word, then of the start
        total = np.append(stats["total"], self.start["total"])
        kept = sum(d * np.append(stats[k], self.start[k]) for d, k in zip(m.pair_discounts, ("n1", "n2", "n3"), strict=True))
        ids = np.append(ids, start)
        left = _previous(at, first, len(ids) - 1)
        pair, where = _distinct(left.astype(np.int64) * len(ids) + at)
        left, right = np.divmod(pair, len(ids))
        spread_like = np.append(stats["count"], m.train_tokens)
        n = self._pair_counts(ids[left], ids[right], spread_like[left])
        of_left = total[left]
        taken = np.array([0.0, *m.pair_discounts])[np.minimum(n, 3)]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(of_left > 0, (n - taken) / of_left + kept[left] / of_left * unigram[right], unigram[right])
        logs = np.log10(p)[where]
        later = np.ones(len(hashes), bool)
        later[first] = False
        later = np.flatnonzero(later)
        if m.order == 3 and len(later):
            triple, example, back = np.unique(_key(where[later - 1], at[later]), return_index=True, return_inverse=True)
            logs[later] = np.log10(self._after_two(_key(ids[left], ids[right]), n > 0, ids, p[where[later[example]]], *_halves(triple)))[back]
        return np.add.reduceat(stats["count"][at] > 0, first, dtype=np.int64), np.add.reduceat(base[at], first), np.add.reduceat(logs, first)


@lru_cache(maxsize=2)
def _scorer(model: NgramModel) -> Scorer:
    return Scorer(model)


def score_documents(docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row; a null or empty text is its end alone. ``perplexity`` is 10 ** (-score / n_tokens)."""

    def task():
        scorer = _scorer(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, made = [], []
            for _, hashes, first in _chunks(batch.column("text").to_pylist(), SCORED_CHARS):
                n.append(np.diff(np.append(first, len(hashes))))
                made.append(scorer.score(hashes, first))
            known, base, score = (np.concatenate(x) for x in zip(*made, strict=True))
            total = np.full(batch.num_rows, model.train_tokens, np.int64)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (np.concatenate(n), known, total, base, score))], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        return step

    rows = docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(rows, task, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def ngram_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3) -> DataFrame:
    """Learn from the rows whose crc32(id) modulo 7 is not 2 and score all; ``held_out`` tells the others. Repeated rows and null ids count and score as rows of their own."""
    held_out = split_remainder(id_col, 7) == 2
    model = fit_ngram_model(docs, ~held_out, text_col, order)
    return score_documents(docs, model, id_col, text_col).withColumn("held_out", split_remainder("doc_id", 7) == 2)
