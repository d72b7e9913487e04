"""Token ids as raw binary shards, and a minimal perfect hash index from document keys to places in them.

The store is a folder that driver and executors share:

* ``ids``: raw little-endian ids (16-bit if the vocabulary allows, else 32-bit) of documents in ascending key order, one
  file for each range partition, named by partition and task attempt;
* ``shards``: a Parquet table with the documents of each stretch of at most ``SHARD_IDS`` ids (or one longer document).
  Spark commits one attempt of a task, so that files of other attempts are never referred to;
* ``index``: one row per bucket of keys. A bucket holds a minimal perfect hash function of its keys (displacements per
  group of keys) and, by its value, a fingerprint of the key and the file, the offset, the length and the number of ids
  before it in the whole store. A lookup is one hash, one displacement, one compared fingerprint and one read of a range
  of a file: payloads are never shuffled.

A key is a document id and a number that tells repeated rows of one id apart (0, 1, ... in the order that Spark reads
them). Rows without id come first and are told apart likewise. Rows of one id may span range partitions.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.array_files import as_uri
from cohortloom.llm.common import shared_folder, shuffle_partitions, text_or_empty, texts_of
from cohortloom.llm.words import id_bytes

SHARD_IDS, SHARD_DOCS = 1 << 18, 4096
BUCKET_KEYS = 4096
GROUP_KEYS = 3
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

#: Ids of a file that are read at once.
READ_IDS = 1 << 21
_PLACE = ("part", "attempt", "offset", "length", "start")


@dataclass(frozen=True)
class TokenStore:
    spark: SparkSession
    path: str
    id_type: str
    width: int
    buckets: int

    @property
    def shards(self) -> DataFrame:
        return self.spark.read.schema(f"part int, attempt long, seq int, first long, n_ids long, ids array<{self.id_type}>, copies array<int>, lengths array<long>").parquet(f"{self.path}/shards")

    @property
    def index(self) -> DataFrame:
        return self.spark.read.schema("bucket int, n int, displacements binary, fingerprints binary, places binary").parquet(f"{self.path}/index")


def _mixed(keys: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys for each seed."""
    x = keys ^ (np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def build_perfect_hash(keys: np.ndarray) -> np.ndarray:
    """Displacements of a minimal perfect hash of distinct uint64 ``keys``: groups by falling size try seeds until all
    their keys find free places; a group of one key gets the number of a free place itself, as a negative number."""
    n = len(keys)
    groups = max(1, -(-n // GROUP_KEYS))
    group = (_mixed(keys, 0) % np.uint64(groups)).astype(np.int64)
    size = np.bincount(group, minlength=groups)
    order = np.argsort(group, kind="stable")
    first = np.cumsum(size) - size
    out, taken = np.zeros(groups, np.int64), np.zeros(n, bool)
    for g in np.argsort(-size, kind="stable").tolist():
        if size[g] < 2:
            break
        members = keys[order[first[g] : first[g] + size[g]]]
        seed, tries = 1, 4
        while True:  # more seeds at a time the longer it takes
            seeds = np.arange(seed, seed + tries, dtype=np.uint64)
            places = (_mixed(members[None, :], seeds[:, None]) % np.uint64(n)).astype(np.int64)
            ok = ~taken[places].any(axis=1)
            for k in np.flatnonzero(ok).tolist():
                if len(set(places[k].tolist())) == size[g]:
                    break
            else:
                seed, tries = seed + tries, min(2 * tries, 2048)
                if seed > 1 << 24:
                    raise ValueError("keys are not distinct")
                continue
            out[g], taken[places[k]] = seed + k, True
            break
    single = np.flatnonzero(size == 1)
    out[single] = -1 - np.flatnonzero(~taken)[: len(single)]
    return out


def perfect_hash(keys: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    """The place of each key; any other key gets some place too, which its fingerprint tells."""
    if not n:
        return np.zeros(len(keys), np.int64)
    d = displacements[(_mixed(keys, 0) % np.uint64(len(displacements))).astype(np.int64)]
    return np.where(d < 0, -1 - d, (_mixed(keys, np.maximum(d, 0).astype(np.uint64)) % np.uint64(n)).astype(np.int64))


def _keyed(df: DataFrame, buckets: int, id_col: str = "doc_id", copy_col: str = "copy") -> DataFrame:
    """With ``key`` (64 bits), ``fingerprint`` (32 other bits) and ``bucket``."""
    return (
        df.withColumn("key", F.xxhash64(F.lit("key"), id_col, copy_col))
        .withColumn("fingerprint", F.hash(F.lit("fingerprint"), id_col, copy_col))
        .withColumn("bucket", F.pmod(F.hash(F.lit("bucket"), id_col, copy_col), F.lit(buckets)))
    )


def _mph_keys(key: np.ndarray, fingerprint: np.ndarray) -> np.ndarray:
    return key.astype(np.int64).view(np.uint64) ^ (fingerprint.astype(np.int64).view(np.uint64) << np.uint64(17))


def _file(path: str, part: int, attempt: int) -> str:
    return f"{path}/ids/{part}-{attempt}.ids"


def write_store(docs: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> TokenStore:
    """Encode whole texts (null: empty), append ``end_id``, write shards in ascending id order and their index."""
    spark = docs.sparkSession
    path = as_uri(path or f"{shared_folder(spark)}/token-store-{uuid.uuid4().hex}")
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text"), F.monotonically_increasing_id().alias("row_uid"))
    id_type = dict(rows.dtypes)["doc_id"]
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "doc_id", "row_uid").sortWithinPartitions("doc_id", "row_uid")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = id_bytes(tokenizer_path), int(end_id).to_bytes(4, "little")
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        last, copy, seq, at, out = None, -1, 0, 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    files, place = pafs.FileSystem.from_uri(_file(path, part, attempt))
                    files.create_dir(place.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(place)
                shards: list[tuple[int, list[int], list[int]]] = []  # first id, copies, lengths
                keys = batch.column("doc_id").to_pylist()
                for doc_id, ids in zip(keys, encode(texts_of(batch)), strict=True):
                    ids += end
                    copy = copy + 1 if copy >= 0 and last == doc_id else 0
                    last, n = doc_id, len(ids) // 4
                    if not shards or sum_of_last + n > SHARD_IDS or len(shards[-1][1]) >= SHARD_DOCS:
                        shards.append((at, [], []))
                        sum_of_last = 0
                    shards[-1][1].append(copy)
                    shards[-1][2].append(n)
                    out.write(ids if kind == "<u4" else np.frombuffer(ids, "<u4").astype(kind).tobytes())
                    sum_of_last, at = sum_of_last + n, at + n
                size = [len(x[1]) for x in shards]
                begin = np.cumsum([0, *size])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(size), pa.int32()),
                        pa.array([attempt] * len(size), pa.int64()),
                        pa.array(range(seq, seq + len(size)), pa.int32()),
                        pa.array([x[0] for x in shards], pa.int64()),
                        pa.array([sum(x[2]) for x in shards], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(begin, pa.int32()), batch.column("doc_id")),
                        pa.array([x[1] for x in shards], pa.list_(pa.int32())),
                        pa.array([x[2] for x in shards], pa.list_(pa.int64())),
                    ],
                    names=["part", "attempt", "seq", "first", "n_ids", "ids", "copies", "lengths"],
                )
                seq += len(size)
        finally:
            if out is not None:
                out.close()

    schema = f"part int, attempt long, seq int, first long, n_ids long, ids array<{id_type}>, copies array<int>, lengths array<long>"
    ordered.select("doc_id", "text").mapInArrow(write, schema).write.parquet(f"{path}/shards")
    store = TokenStore(spark, path, id_type, np.dtype(kind).itemsize, 1)
    known = store.shards
    n_docs = known.agg(F.sum(F.size("ids"))).first()[0] or 0
    store = TokenStore(spark, path, id_type, store.width, max(1, -(-n_docs // BUCKET_KEYS)))
    # of each part the ids before it, and the copies of its first id in the parts before it; single tasks see one row a part
    parts = known.groupBy("part").agg(
        F.sum("n_ids").alias("n"), F.min_by(F.get("ids", F.lit(0)), "seq").alias("first_id"), F.max_by(F.element_at("ids", -1), "seq").alias("last_id"), F.max_by(F.element_at("copies", -1) + 1, "seq").alias("last_copies")
    )
    in_turn = Window.orderBy("part")
    parts = parts.select("part", "first_id", "last_id", (F.sum("n").over(in_turn) - F.col("n")).alias("part_start"), F.sum("last_copies").over(Window.partitionBy("last_id").orderBy("part")).alias("so_far"))
    goes_on = F.lag("last_id").over(in_turn).eqNullSafe(F.col("first_id")) & F.lag("part").over(in_turn).isNotNull()
    parts = parts.select("part", "first_id", "part_start", F.when(goes_on, F.lag("so_far").over(in_turn)).otherwise(0).cast("int").alias("copies_before"))
    entries = known.select("part", "attempt", "first", F.explode(F.arrays_zip("ids", "copies", "lengths", _running("lengths"))).alias("doc")).join(parts, "part")
    entries = entries.select(
        F.col("doc.ids").alias("doc_id"),
        (F.col("doc.copies") + F.when(F.col("doc.ids").eqNullSafe(F.col("first_id")), F.col("copies_before")).otherwise(0)).cast("int").alias("copy"),
        F.col("part").cast("long").alias("part"),
        "attempt",
        (F.col("first") + F.col("doc.offsets")).alias("offset"),
        F.col("doc.lengths").alias("length"),
        (F.col("part_start") + F.col("first") + F.col("doc.offsets")).alias("start"),
    )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = _mph_keys(group["key"].to_numpy(), group["fingerprint"].to_numpy())
        d = build_perfect_hash(keys)
        order = np.argsort(perfect_hash(keys, d, len(keys)))
        places = group[list(_PLACE)].to_numpy(np.int64)[order]
        return pd.DataFrame({"bucket": [int(group["bucket"].iloc[0])], "n": [len(keys)], "displacements": [d.astype("<i4").tobytes()], "fingerprints": [group["fingerprint"].to_numpy()[order].astype("<i4").tobytes()], "places": [places.astype("<i8").tobytes()]})

    index = _keyed(entries, store.buckets).select("bucket", "key", "fingerprint", *_PLACE).groupBy("bucket").applyInPandas(build, "bucket int, n int, displacements binary, fingerprints binary, places binary")
    index.write.parquet(f"{path}/index")
    return store


def _running(lengths: str):
    """Exclusive running sums of an array, as a column named offsets."""
    sums = F.aggregate(lengths, F.struct(F.lit(0).cast("long").alias("t"), F.array().cast("array<long>").alias("a")), lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["a"], F.array(s["t"])).alias("a")), lambda s: s["a"])
    return sums.alias("offsets")


def find(store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id, copy`` of ``keys`` with the place of each in the store; keys that it doesn't have are left out."""

    def look(asked: pa.Table, bucket: pa.Table) -> pa.Table:
        n = asked.num_rows
        places, found = np.zeros((n, len(_PLACE)), np.int64), np.zeros(n, bool)
        if n and bucket.num_rows:
            b = bucket.to_pylist()[0]
            own = asked.column("fingerprint").to_numpy()
            at = perfect_hash(_mph_keys(asked.column("key").to_numpy(), own), np.frombuffer(b["displacements"], "<i4").astype(np.int64), b["n"])
            found = np.frombuffer(b["fingerprints"], "<i4")[at] == own
            places = np.frombuffer(b["places"], "<i8").reshape(-1, len(_PLACE))[at]
        out = pa.table([asked.column("doc_id"), asked.column("copy"), *(pa.array(places[:, i]) for i in range(len(_PLACE)))], names=["doc_id", "copy", *_PLACE])
        return out.filter(pa.array(found))

    asked = _keyed(keys.select("doc_id", "copy"), store.buckets)
    return asked.groupBy("bucket").cogroup(store.index.groupBy("bucket")).applyInArrow(look, f"doc_id {store.id_type}, copy int, " + ", ".join(f"{c} long" for c in _PLACE))


def _read_places(store: TokenStore, keys: DataFrame, column: str, schema: str, made: Callable[[memoryview], int | bytes], kind: pa.DataType) -> DataFrame:
    """The places of ``keys`` in order of the files, and in ``column`` what ``made`` gives for the ids of each as little-endian 32-bit integers."""
    path, width = store.path, store.width
    stretch = F.floor(F.col("offset") / READ_IDS)
    places = find(store, keys).repartition(shuffle_partitions(store.spark), "part", stretch).sortWithinPartitions("part", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_file, source = None, None
        for batch in batches:
            part, attempt, offset, length = (batch.column(c).to_numpy() for c in _PLACE[:4])
            out, i = [], 0
            while i < len(part):
                j = i + 1  # places that follow one another in one file, and are not too many ids together, are one read
                while j < len(part) and part[j] == part[i] and offset[j] + length[j] - offset[i] <= READ_IDS and offset[j] <= offset[j - 1] + length[j - 1] + SHARD_DOCS:
                    j += 1
                name = _file(path, int(part[i]), int(attempt[i]))
                if name != open_file:
                    files, place = pafs.FileSystem.from_uri(name)
                    open_file, source = name, files.open_input_file(place)
                begin, end = int(offset[i]), int((offset[i:j] + length[i:j]).max())
                ids = memoryview(np.frombuffer(source.read_at((end - begin) * width, begin * width), f"<u{width}").astype("<u4").tobytes())
                out += [made(ids[4 * (a - begin) : 4 * (a - begin + n)]) for a, n in zip(offset[i:j].tolist(), length[i:j].tolist(), strict=True)]
                i = j
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), batch.column("start"), batch.column("length"), pa.array(out, kind)], names=["doc_id", "copy", "start", "n_tokens", column])

    return places.mapInArrow(read, f"doc_id {store.id_type}, copy int, start long, n_tokens long, {column} {schema}")


def fetch_ids(store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, start, n_tokens, ids`` of ``keys`` (little-endian unsigned 32-bit ids), read by ranges of the files."""
    return _read_places(store, keys, "ids", "binary", bytes, pa.binary())


def fetch_digests(store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, start, n_tokens, ids_crc32`` of the stored ids of ``keys``, read by ranges of the files."""
    return _read_places(store, keys, "ids_crc32", "long", zlib.crc32, pa.int64())


def document_keys(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, copy``: the keys of all rows."""
    sizes = docs.groupBy(docs[id_col].alias("doc_id")).agg(F.count("*").alias("n"))
    return sizes.select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("copy"))


def stored_digests(docs: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the store of all documents and read every one of them back by its key."""
    store = write_store(docs, tokenizer_path, vocabulary, end_id, id_col, text_col)
    return fetch_digests(store, document_keys(docs, id_col)).drop("copy")
