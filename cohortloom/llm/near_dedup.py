"""Near-duplicates on word shingles: MinHash bands, sequential Bayesian pruning of candidates, exact confirmation.

Documents with the same set of shingles are one vertex from the start. Vertices that agree on all hashes of a band meet
in its bucket. A candidate pair's signatures are compared 16 hashes at a time; it is dropped as soon as the posterior
probability (uniform prior) that its similarity reaches the threshold is below ``miss``. What is left is confirmed on
the full sets, and only confirmed links count.

Not all pairs of a bucket are listed. First every member of a bucket is compared with one hub, the member that meets
most others; a hub's set travels once to every ``TOGETHER`` members or so. Then members of the components found so far
are compared across components only, in blocks of about ``BLOCK`` x ``BLOCK`` members inside tasks: those of a bucket's
largest component against the rest, and the rest among themselves, so that a member is copied no more than twice
``rest / BLOCK`` times. Where more than ``REST`` members are outside the largest component, all members of such buckets are
joined exactly instead, by prefix filtering: of a set of n shingles the n/4 that fewest of them have must hold one that a
set linked with it has too, and what only one set has meets nothing. Boilerplate that millions share so costs rows in
proportion to its documents. A block's surviving pairs travel as one packed row and are confirmed in one place, most
alike first, passing over pairs that are connected already.

At a similarity of exactly 0.75 a link is lost with a probability of 5.2e-6 for sharing no band and of 6.3e-6 for being
pruned in one of the eight looks (``miss`` bounds the posterior at each look); above it with less.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Scratch, map_arrow, text_or_empty, written
from cohortloom.llm.components import connected_components
from cohortloom.llm.shingles import shingle_hashes

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
#: Most members of a bucket's part; a block compares one part with another.
BLOCK = 256
#: Members outside the largest component of a bucket from which on it is joined by prefix filtering.
REST = 4096
#: Members of a bucket that take one copy of what they are joined with.
TOGETHER = 512
#: Shingles that are counted as frequent are those in more sets than this, or than a millionth of all occurrences.
FREQUENT, MOST_FREQUENT = 1000, 1_000_000
#: Pairs whose signatures are looked at together.
CHUNK = 1 << 14


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20).integers(0, 1 << 32, (2, HASHES), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the shingles."""
    a, b = _functions()
    high, low = (shingles >> np.uint64(32)).astype(np.uint32), shingles.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 1024):
        x = high[at : at + 1024, None] * a
        x += low[at : at + 1024, None] ^ b
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def least_matches(threshold: float, miss: float, hashes: int = HASHES, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): after n compared hashes, fewer than m agreeing ones leave a posterior below ``miss``.

    With m of n and a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed; the probability of the
    threshold or more is that of at most m successes in n + 1 trials of that probability.
    """
    out = []
    for n in range(step, hashes + 1, step):
        below = np.cumsum([comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(n + 2)])
        out.append((n, int(np.searchsorted(below, miss))))
    return out


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the pairs (i, j) of signatures that the posterior doesn't rule out at any step."""
    out = []
    for begin in range(0, len(i), CHUNK):
        at, agreed, done = np.arange(begin, min(begin + CHUNK, len(i))), 0, 0
        for n, least in steps:
            agreed = agreed + (sig[i[at], done:n] == sig[j[at], done:n]).sum(axis=1)
            keep = agreed >= least
            at, agreed, done = at[keep], agreed[keep], n
        out.append(at)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _agreement(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair the number of agreeing hashes, and the first band that agrees in all of its hashes (or 0)."""
    total, first = np.empty(len(i), np.int64), np.empty(len(i), np.int64)
    for begin in range(0, len(i), CHUNK):
        part = slice(begin, begin + CHUNK)
        alike = sig[i[part]] == sig[j[part]]
        total[part] = alike.sum(axis=1)
        first[part] = alike.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
    return total, first


def surviving_block(sig: np.ndarray, left: np.ndarray, right: np.ndarray, apart: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``left`` and ``right`` members that are ``apart`` and not ruled out."""
    n, least = steps[0]
    agreed = np.zeros(apart.shape, np.int16)
    for k in range(n):
        agreed += sig[left, k][:, None] == sig[right, k][None, :]
    i, j = np.nonzero(apart & (agreed >= least))
    i, j = left[i], right[j]
    keep = surviving(sig, i, j, steps)
    return i[keep], j[keep]


def linked(p: np.ndarray, q: np.ndarray, threshold: int) -> bool:
    """Whether 100 * intersection >= threshold * union of two sorted sets."""
    at = np.searchsorted(q, p)
    at[at == len(q)] = 0
    both = int((q[at] == p).sum())
    return 100 * both >= threshold * (len(p) + len(q) - both)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))


def _described(rows: DataFrame, size: int) -> DataFrame:
    """``doc_id, row_key, n_shingles, digest, sig``: digest (null without shingles) of the sorted set, and its signature."""

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, digest, sig = [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_hashes(text, size)
                n.append(len(shingles))
                digest.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                sig.append(signature(shingles).tobytes() if len(shingles) else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "row_key", "n_shingles", "digest", "sig"],
            )

        return step

    return map_arrow(rows, task, f"doc_id {dict(rows.dtypes)['doc_id']}, row_key long, n_shingles long, digest binary, sig binary")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """``digest, shingles``: the full sets of ``rows(text, digest)`` whose set has that digest."""

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = {}
            for text, digest in zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                shingles = shingle_hashes(text, size).tobytes()
                if hashlib.blake2b(shingles, digest_size=16).digest() == digest:
                    found[digest] = shingles
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["digest", "shingles"])

        return step

    return map_arrow(rows.select("text", "digest"), task, "digest binary, shingles binary").dropDuplicates(["digest"])


def _band_keys() -> Column:
    """An array with the number of each band and the hash of its part of the signature."""
    return F.array(*(F.xxhash64(F.lit(k), F.substring("sig", 1 + 4 * ROWS * k, 4 * ROWS)) for k in range(BANDS)))


def _sized(a: str, b: str, threshold: int) -> Column:
    return 100 * F.least(a, b) >= threshold * F.greatest(a, b)


def _salts(n: Column | str) -> Column:
    return F.ceil((F.col(n) if isinstance(n, str) else n) / TOGETHER).cast("int")


def _on_bucket(rows: DataFrame, about: DataFrame) -> DataFrame:
    """``rows(band, digest, n_members, ...)`` joined with what ``about(band, n_members, ...)`` says of buckets: a large bucket in as many places as it has ``TOGETHER`` members."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("digest", F.lit("salt")), _salts("n_members")).cast("int"))
    return salted.join(about.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts("n_members") - 1))).drop("n_members"), ["band", "salt"]).drop("salt")


def _checked(pairs: DataFrame, of: DataFrame, check: Callable[[bytes, list[bytes]], list[bool] | np.ndarray]) -> DataFrame:
    """The ``a, b, n_members`` of ``pairs`` for which ``check`` of what ``of(digest, payload)`` has of ``a`` and of several ``b`` is true.

    The rows of one ``a`` are dealt to a place for every ``TOGETHER`` of them, and its payload goes to each of those once.
    """
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b", F.lit("pair")), _salts("n_members")).cast("int"))
    hubs = pairs.select("a", "salt").distinct().join(of.select(F.col("digest").alias("a"), "payload"), "a").select("a", "salt", F.lit(None).cast("binary").alias("b"), F.lit(0).cast("long").alias("n_members"), "payload")
    members = pairs.join(of.select(F.col("digest").alias("b"), "payload"), "b").select("a", "salt", "b", "n_members", "payload")
    dealt = hubs.union(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, payload = None, b""
        for batch in batches:
            a, b, p = (batch.column(c).to_pylist() for c in ("a", "b", "payload"))
            at, keep = 0, []
            while at < len(a):
                if b[at] is None:
                    hub, payload = a[at], p[at]
                    at += 1
                    continue
                end = at
                while end < len(a) and b[end] is not None and a[end] == hub:
                    end += 1
                if end == at:
                    raise ValueError("pairs without what they are held against")
                keep += [at + k for k, ok in enumerate(check(payload, p[at:end])) if ok]
                at = end
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b", "n_members")], names=["a", "b", "n_members"])

    return dealt.select("a", "b", "n_members", "payload").mapInArrow(run, "a binary, b binary, n_members long")


def _hub_links(members: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: int, steps: list[tuple[int, int]]) -> DataFrame:
    """Links of each bucket's hub and its other members: those that sizes and signatures don't rule out, confirmed on full sets."""
    degrees = members.groupBy("digest").agg(F.sum("n_members").alias("degree"))
    ranked = members.join(degrees, "digest")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("degree", "digest", "n_shingles")).alias("hub"), F.max("n_members").alias("n_members"))
    pairs = _on_bucket(members, hubs).where((F.col("digest") != F.col("hub.digest")) & _sized("n_shingles", "hub.n_shingles", threshold))
    pairs = pairs.groupBy(F.col("hub.digest").alias("a"), F.col("digest").alias("b")).agg(F.max("n_members").alias("n_members"))

    def alike(x: bytes, ys: list[bytes]) -> np.ndarray:
        sig = np.frombuffer(x + b"".join(ys), "<u4").reshape(-1, HASHES)
        out = np.zeros(len(ys), bool)
        out[surviving(sig, np.zeros(len(ys), np.int64), np.arange(1, len(sig)), steps)] = True
        return out

    def confirmed(x: bytes, ys: list[bytes]) -> list[bool]:
        own = np.frombuffer(x, np.uint64)
        return [linked(np.frombuffer(y, np.uint64), own, threshold) for y in ys]

    likely = _checked(pairs, sigs.withColumnRenamed("sig", "payload"), alike)
    return _checked(likely, sets.withColumnRenamed("shingles", "payload"), confirmed).select("a", "b")


def _streamed(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of one key after the other from batches in its order; those of a key may span batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        keys = table.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _mixed(labelled: DataFrame) -> DataFrame:
    """``band, n_members, top, n_top, rest`` of the buckets with members of several components: the largest of these, its members, and all others."""
    counts = labelled.groupBy("band", "label").agg(F.count("*").alias("n"), F.max("n_members").alias("n_members"))
    buckets = counts.groupBy("band").agg(F.sum("n").alias("n"), F.max("n_members").alias("n_members"), F.max(F.struct("n", "label")).alias("top"))
    return buckets.where("n > top.n").select("band", "n_members", F.col("top.label").alias("top"), F.col("top.n").alias("n_top"), (F.col("n") - F.col("top.n")).alias("rest"))


def _block_rows(labelled: DataFrame, mixed: DataFrame) -> DataFrame:
    """``block, across, second, digest, label, n_shingles``: members of the ``mixed`` buckets in every block they are compared in."""
    rows = _on_bucket(labelled, mixed)
    in_top = F.col("label") == F.col("top")
    parts = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    rows = rows.withColumns({"in_top": in_top, "top_parts": parts("n_top"), "parts": parts("rest")})
    rows = rows.withColumn("part", F.pmod(F.xxhash64("digest", F.lit("part")), F.when(F.col("in_top"), F.col("top_parts")).otherwise(F.col("parts"))).cast("int"))
    place = lambda kind, p, q, across, second: F.struct(F.xxhash64("band", F.lit(kind), p, q).alias("block"), across.alias("across"), second.alias("second"))
    own, yes, no = F.col("part"), F.lit(True), F.lit(False)
    against_rest = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: place(0, own, q, yes, no))
    against_top = F.transform(F.sequence(F.lit(0), F.col("top_parts") - 1), lambda q: place(0, q, own, yes, yes))
    among_rest = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: place(1, F.least(own, q), F.greatest(own, q), own != q, own > q))
    places = F.when(F.col("in_top"), against_rest).otherwise(F.concat(against_top, among_rest))
    return rows.select("digest", "label", "n_shingles", F.inline(places))


def _rare_members(hot: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Prefix filtering of the ``hot(digest, label)`` sets: ``digest, label, n_shingles, band, n_members`` with a band for each
    shingle that a set must share one of to be linked, the rarest of it, where another set has it."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
            size = np.array([len(x) for x in shingles], np.int64)
            for at in range(0, len(size), 64):
                n = size[at : at + 64]
                row = pa.array(np.repeat(np.arange(at, at + len(n)), n))
                yield pa.RecordBatch.from_arrays([batch.column("digest").take(row), batch.column("label").take(row), pa.array(np.repeat(n, n)), pa.array(np.concatenate(shingles[at : at + 64]))], names=["digest", "label", "n_shingles", "band"])

    hot_sets = hot.join(sets, "digest")
    tokens = hot_sets.select("digest", "label", "shingles").mapInArrow(spread, "digest binary, label binary, n_shingles long, band long")
    counts = tokens.groupBy("band").agg(F.count("*").alias("n_members")).where("n_members > 1")
    occurrences = hot_sets.agg(F.sum(F.octet_length("shingles")) / 8).first()[0] or 0
    least = max(FREQUENT, math.ceil(occurrences / MOST_FREQUENT))
    frequent = counts.where(F.col("n_members") > least)  # at most MOST_FREQUENT rows
    marked = tokens.join(F.broadcast(frequent), "band", "left")
    rare = marked.where("n_members IS NULL").drop("n_members").join(counts.where(F.col("n_members") <= least), "band")
    every = marked.where("n_members IS NOT NULL").unionByName(rare)
    sorted_sets = every.groupBy("digest", "label", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("n_members", "band"))).alias("shared"))
    wanted = F.col("n_shingles") - F.ceil(F.col("n_shingles") * threshold / 100) + 1 - (F.col("n_shingles") - F.size("shared"))
    kept = sorted_sets.where(wanted > 0).select("digest", "label", "n_shingles", F.inline(F.slice("shared", F.lit(1), wanted.cast("int"))))
    return kept.select("digest", "label", "n_shingles", "band", "n_members")


def _block_candidates(rows: DataFrame, sigs: DataFrame, threshold: int, steps: list[tuple[int, int]], banded: bool) -> DataFrame:
    """``block, members, pairs``: for each block of ``rows`` the members and the pairs across components that neither sizes nor
    signatures rule out, most alike first, as 16-bit positions; if ``banded`` each pair only where its first common band meets."""
    rows = rows.join(sigs, "digest").repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _streamed(batches, "block"):
            if block.num_rows < 2:
                continue
            label = np.unique(np.array(block.column("label").to_pylist(), object), return_inverse=True)[1]
            sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), "<u4").reshape(-1, HASHES)
            size, second = block.column("n_shingles").to_numpy(), block.column("second").to_numpy()
            across = block.column("across")[0].as_py()
            left = np.flatnonzero(~second) if across else np.arange(len(size))
            right = np.flatnonzero(second) if across else left
            p, q = size[left][:, None], size[right][None, :]
            apart = (label[left][:, None] != label[right][None, :]) & (100 * np.minimum(p, q) >= threshold * np.maximum(p, q))
            i, j = surviving_block(sig, left, right, apart if across else np.triu(apart, 1), steps)
            if not len(i):
                continue
            agreed, first = _agreement(sig, i, j)
            # the band of this block is one whose hashes all members share
            here = (sig == sig[0]).all(axis=0).reshape(BANDS, ROWS).all(axis=1)
            keep = np.flatnonzero(here[first]) if banded else np.arange(len(i))
            keep = keep[np.argsort(-agreed[keep], kind="stable")]
            if not len(keep):
                continue
            used, at = np.unique(np.concatenate((i[keep], j[keep])), return_inverse=True)
            digests = block.column("digest").take(pa.array(used)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [block.column("block").slice(0, 1).combine_chunks(), pa.array([digests], pa.list_(pa.binary())), pa.array([at.astype("<u2").tobytes()], pa.binary())], names=["block", "members", "pairs"]
            )

    return rows.mapInArrow(run, "block long, members array<binary>, pairs binary")


def _block_links(candidates: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between the members of each block, confirmed on full sets; pairs that confirmed ones already connect are passed over."""
    rows = candidates.select("block", F.posexplode("members").alias("at", "digest"), "pairs").withColumn("pairs", F.when(F.col("at") == 0, F.col("pairs")))
    rows = rows.join(sets, "digest").repartition("block").sortWithinPartitions("block", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _streamed(batches, "block"):
            digests = block.column("digest").to_pylist()
            shingles = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
            pairs = np.frombuffer(block.column("pairs")[0].as_py(), "<u2").reshape(2, -1)
            above = list(range(len(digests)))

            def root(x: int, above: list[int] = above) -> int:
                while above[x] != x:
                    above[x] = above[above[x]]
                    x = above[x]
                return x

            found = []
            for i, j in pairs.T.tolist():
                if root(i) != root(j) and linked(shingles[i], shingles[j], threshold):
                    above[root(i)] = root(j)
                    found.append((digests[i], digests[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found, strict=True)], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, threshold: int = 75, miss: float = 1e-6) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Sets with 100 * intersection >= ``threshold`` * union are linked; ``component_id`` is the smallest id reachable.
    Null and empty texts and texts without a word have no shingles and are linked with nothing: their component is their
    own id. Null ids count as larger than all others; a row without id is kept if its whole component has none.
    Repeated rows give a row each, with ``kept`` where the id is the component's. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "near")
    steps = least_matches(threshold / 100, miss)
    rows = _rows(docs, id_col, text_col)
    leaf = scratch.written(_described(rows, shingle_words), "leaf")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col("row_key"))
    vertices = scratch.written(leaf.where("digest is not null").groupBy("digest").agg(F.min(order).alias("first")), "vertices")
    reps = leaf.join(vertices.select("digest", F.col("first.row_key").alias("row_key")), ["digest", "row_key"]).select("digest", "n_shingles", "sig")
    reps = scratch.written(reps.dropDuplicates(["digest"]), "signatures")
    banded = reps.select("digest", "n_shingles", F.explode(_band_keys()).alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n_members")).where("n_members > 1")
    members = scratch.written(banded.join(shared, "band"), "members")
    active = members.select("digest").distinct()
    sigs = scratch.written(reps.join(active, "digest", "left_semi").select("digest", "sig"), "active")
    wanted = vertices.join(active, "digest", "left_semi").select("digest", F.col("first.row_key").alias("row_key"))
    sets = scratch.written(_sets(rows.join(wanted, "row_key"), shingle_words), "sets")

    links = scratch.written(_hub_links(members, sigs, sets, threshold, steps), "links")
    labels = connected_components(links, scratch)
    labelled = members.join(labels, F.col("digest") == F.col("vertex"), "left").drop("vertex").withColumn("label", F.coalesce("label", "digest"))
    labelled = scratch.written(labelled, "labelled")
    mixed = scratch.written(_mixed(labelled), "mixed")
    candidates = [_block_candidates(_block_rows(labelled, mixed.where(F.col("rest") <= REST)), sigs, threshold, steps, True)]
    if mixed.where(F.col("rest") > REST).limit(1).count():
        hot = _on_bucket(labelled, mixed.where(F.col("rest") > REST).select("band", "n_members")).select("digest", "label").distinct()
        rare = scratch.written(_rare_members(hot, sets, threshold), "rare")
        candidates.append(_block_candidates(_block_rows(rare, _mixed(rare)), sigs, threshold, steps, False))
    for some in candidates:
        links = links.union(scratch.written(_block_links(scratch.written(some, "candidates"), sets, threshold), "links"))
    labels = connected_components(links, scratch)

    labelled = vertices.join(labels, F.col("digest") == F.col("vertex"), "left").select("digest", F.coalesce("label", "digest").alias("label"), "first")
    smallest = labelled.groupBy("label").agg(F.min(F.struct("first.missing", "first.id")).alias("smallest"))
    of_digest = labelled.select("digest", "label").join(smallest, "label").select("digest", F.col("smallest.id").alias("component_id"))
    joined = leaf.select("doc_id", "n_shingles", "digest").join(of_digest, "digest", "left")
    result = joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    result = written(result, "near-result")
    scratch.drop()
    return result
