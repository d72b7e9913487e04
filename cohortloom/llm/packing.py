"""Packing of token sequences by best-fit decreasing, exact over all documents.

Pieces of equal length are interchangeable, and so are open bins of equal remaining capacity. Best-fit decreasing over
all pieces is therefore decided by the number of pieces of each length alone (at most ``capacity`` numbers, however many
documents there are): lengths go in descending order, a segment tree over remaining capacities finds the tightest open
bins in logarithmic time, and a whole run of equal bins is filled at once. The plan says which ranks of each length go
to which bins; on the executors every piece looks its rank up in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import map_arrow, shuffle_partitions, text_or_empty, texts_of, written
from cohortloom.llm.words import id_bytes


class CapacityTree:
    """Which remaining capacities have open bins: a segment tree that finds the smallest one of at least ``need``."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, capacity: int, runs: int) -> None:
        at = capacity + self.size
        while at:
            self.open[at] += runs
            at >>= 1

    def tightest(self, need: int) -> int | None:
        at = need + self.size
        if self.open[at]:
            return need
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_plan(pieces_by_length: dict[int, int], capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of so many pieces of each length: ``length, first rank, first bin, pieces a bin, offset``.

    Pieces of ``length`` from ``first rank`` on, up to the next entry of that length, fill bins from ``first bin`` on in
    turn, so many in each, from ``offset``. Placing a piece leaves its bin the tightest as long as another one fits.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}  # by remaining capacity: first bin, number of bins
    bins = 0

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            runs.setdefault(room, []).append((first, count))
            tree.add(room, 1)

    for length in sorted(pieces_by_length, reverse=True):
        rank, left = 0, pieces_by_length[length]
        if not 0 < length <= capacity:
            raise ValueError("a piece must have between 1 and capacity tokens")
        while left:
            room = tree.tightest(length)
            if room is None:
                room, fits = capacity, capacity // length
                first, count = bins, -(-left // fits)
                bins += count
            else:
                first, count = runs[room].pop()
                tree.add(room, -1)
            fits = room // length
            full, rest = divmod(min(left, fits * count), fits)
            yield length, rank, first, fits, capacity - room
            leave(room - fits * length, first, full)
            if rest:
                leave(room - rest * length, first + full, 1)
            used = full + (rest > 0)
            if used < count:
                leave(room, first + used, count - used)
            rank += full * fits + rest
            left -= full * fits + rest


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Whole texts (null: empty) as ids and ``end_id``, cut after every ``capacity`` ids: ``row_uid, doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (little-endian 32-bit)."""

    def task():
        encode, end = id_bytes(tokenizer_path), int(end_id).to_bytes(4, "little")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(encode(texts_of(batch))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
            row = pa.array(row, pa.int32())
            columns = {"row_uid": batch.column("row_uid").take(row), "doc_id": batch.column("doc_id").take(row), "piece": pa.array(piece, pa.int32())}
            columns |= {k: pa.array(v, pa.int64()) for k, v in (("start", start), ("length", length), ("ids_crc32", crc))}
            return pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(kept, pa.binary())} if keep_ids else {}))

        return step

    rows = docs.select(F.monotonically_increasing_id().alias("row_uid"), docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(rows, task, f"row_uid long, doc_id {dict(rows.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


def pack_best_fit(pieces: DataFrame, capacity: int = 2048, order_by: tuple[str, ...] = ("row_uid", "piece")) -> DataFrame:
    """``pieces`` (a written table with a ``length``) with ``sequence_id`` and ``offset``; empty input gives an empty result.

    ``order_by`` must tell any two pieces apart. Ranks within a length are counted in parts by a hash of it, so that a
    length that a third of all pieces share is no single task's work.
    """
    spark = pieces.sparkSession
    parts = F.pmod(F.xxhash64(*order_by), F.lit(shuffle_partitions(spark))).cast("int")
    marked = pieces.withColumn("__part", parts)
    counts = marked.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    by_length = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = np.array([*best_fit_plan(by_length, capacity)], np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("__part")
    counts = counts.withColumn("__before", F.sum("__n").over(before) - F.col("__n")).drop("__n")
    within = Window.partitionBy("length", "__part").orderBy(*order_by)
    ranked = marked.withColumn("__rank", F.row_number().over(within) - 1).join(counts, ["length", "__part"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    names = pieces.columns

    def task():
        order = np.lexsort((plan[:, 1], plan[:, 0]))
        length, first_rank, first_bin, fits, offset = plan[order].T
        key = length * (1 << 44) + first_rank

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "__rank"))
            at = np.searchsorted(key, own * (1 << 44) + rank, side="right") - 1
            turn = rank - first_rank[at]
            sequence, place = first_bin[at] + turn // fits[at], offset[at] + turn % fits[at] * own
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(place)], names=[*names, "sequence_id", "offset"])

        return step

    schema = ", ".join(f"`{c}` {kind}" for c, kind in pieces.dtypes)
    return map_arrow(ranked.select(*names, "__rank"), task, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents packed: one row per piece. Repeated rows are packed each; null ids are kept as they are; a null or empty text is one piece of ``end_id`` alone."""
    pieces = written(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    return pack_best_fit(pieces, capacity).drop("row_uid")
