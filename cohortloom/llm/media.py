"""Binary payloads as PNG images in a binary column, read back with every check, and hashed by their low frequencies."""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortloom.llm.common import map_arrow, text_or_empty, written

#: Payloads are padded with bytes 255 to a multiple of this, which is also the width of the images.
BLOCK = 576
#: Side of the square that an image is averaged to, and of its corner of low frequencies that makes the hash.
POOLED, KEPT = 32, 8
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: np.ndarray, level: int = 1) -> bytes:
    """An 8-bit grey image of a (height, width) array; each row by the one of the filters none, sub and up with the least sum of absolute differences."""
    height, width = samples.shape
    left = np.zeros_like(samples)
    left[:, 1:] = samples[:, :-1]
    above = np.zeros_like(samples)
    above[1:] = samples[:-1]
    ways = (samples, samples - left, samples - above)
    cost = np.stack([np.abs(way.view(np.int8)).view(np.uint8).sum(axis=1, dtype=np.int64) for way in ways])
    chosen = cost.argmin(axis=0)
    rows = np.empty((height, width + 1), np.uint8)
    rows[:, 0] = chosen
    for kind, way in enumerate(ways):
        rows[chosen == kind, 1:] = way[chosen == kind]
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def _unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo the five PNG filters for one byte a sample: runs of rows of none, sub and up together; average and Paeth depend
    on the sample before and go one by one."""
    out = np.empty_like(rows)
    above = np.zeros(rows.shape[1], np.uint8)
    cuts = np.flatnonzero(np.concatenate(([True], kinds[1:] != kinds[:-1], [True]))) if len(kinds) else np.zeros(1, np.int64)
    for i, end in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        kind = int(kinds[i])
        if kind == 0:
            out[i:end] = rows[i:end]
        elif kind == 1:
            np.add.accumulate(rows[i:end], axis=1, dtype=np.uint8, out=out[i:end])
        elif kind == 2:
            np.add.accumulate(rows[i:end], axis=0, dtype=np.uint8, out=out[i:end])
            out[i:end] += above
        elif kind not in (3, 4):
            raise ValueError(f"filter {kind} does not exist")
        for at in range(i, end) if kind in (3, 4) else ():
            row = rows[at]
            left = corner = 0
            for j, (value, up) in enumerate(zip(row.tolist(), above.tolist(), strict=True)):
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    by_left, by_up, by_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
                    guess = left if by_left <= by_up and by_left <= by_corner else up if by_up <= by_corner else corner
                left, corner = (value + guess) & 255, up
                out[at, j] = left
            above = out[at]
        above = out[end - 1]
    return out


def decode_png(media: bytes) -> np.ndarray:
    """The (height, width) samples of an 8-bit grey image; ValueError for whatever is damaged or of another form."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, header, data, ended = 8, b"", [], False
    while at < len(media) and not ended:
        if at + 12 > len(media):
            raise ValueError("cut off within a chunk")
        size, kind = struct.unpack_from(">I4s", media, at)
        if at + 12 + size > len(media):
            raise ValueError("cut off within a chunk")
        body = media[at + 8 : at + 8 + size]
        if zlib.crc32(media[at + 4 : at + 8 + size]) != struct.unpack_from(">I", media, at + 8 + size)[0]:
            raise ValueError(f"checksum of {kind!r} does not hold")
        if kind == b"IHDR":
            header = body
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"IEND":
            ended = True
        elif not kind[0] & 32:
            raise ValueError(f"chunk {kind!r} is not known")
        at += 12 + size
    if not ended or len(header) != 13:
        raise ValueError("no complete image")
    width, height, *form = struct.unpack(">IIBBBBB", header)
    if form != [8, 0, 0, 0, 0]:
        raise ValueError("not 8-bit grey without interlacing")
    try:
        raw = zlib.decompress(b"".join(data))
    except zlib.error as error:
        raise ValueError(str(error)) from error
    if len(raw) != height * (width + 1):
        raise ValueError("wrong number of samples")
    rows = np.frombuffer(raw, np.uint8).reshape(height, width + 1)
    return _unfilter(rows[:, 0], np.ascontiguousarray(rows[:, 1:]))


@lru_cache(maxsize=512)
def _pooling(size: int, to: int) -> np.ndarray:
    """(to, size) weights of the average over ``to`` equal stretches of ``size`` samples."""
    edge = np.arange(to + 1) * size / to
    cell = np.arange(size)
    return (np.clip(np.minimum(edge[1:, None], cell + 1) - np.maximum(edge[:-1, None], cell), 0, None) * to / size).astype(np.float64)


@lru_cache(maxsize=1)
def _cosines() -> np.ndarray:
    return np.cos(np.pi * np.outer(np.arange(KEPT), np.arange(POOLED) + 0.5) / POOLED)


def frequency_hash(samples: np.ndarray) -> bytes:
    """64 bits: which of the lowest cosine coefficients of the pooled image are above the median of those but the first."""
    height, width = samples.shape
    across = samples @ _pooling(width, POOLED).T if width != POOLED else samples.astype(np.float64)
    small = _pooling(height, POOLED) @ across if height != POOLED else across
    low = np.round(_cosines() @ small @ _cosines().T, 4).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media``: each whole text in UTF-8 (null: empty), padded to the next positive multiple of 576, as a PNG image."""

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, media = [], []
            for text in batch.column("text").to_pylist():
                data = text.encode()
                sizes.append(len(data))
                data += b"\xff" * ((-len(data)) % BLOCK or BLOCK * (not data))
                media.append(encode_png(np.frombuffer(data, np.uint8).reshape(-1, BLOCK)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

        return step

    rows = docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(rows, task, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, media binary")


def media_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """All columns but ``media`` and, from its stored bytes, ``payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, phash, problem``.

    Null, damaged and foreign media have null payload features and say in ``problem`` what is wrong; else that is null.
    """
    others = [c for c in media.columns if c != media_col]

    def features(data: bytes | None) -> tuple:
        if data is None:
            return None, None, None, None, None, None, "null"
        stored = len(data), hashlib.sha256(data).hexdigest()
        try:
            samples = decode_png(data)
        except ValueError as error:
            return None, None, None, *stored, None, str(error)
        payload = samples.tobytes()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), *stored, frequency_hash(samples) if samples.size else bytes(8), None

    kinds = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "phash": pa.binary(), "problem": pa.string()}

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = list(zip(*(features(data) for data in batch.column(media_col).to_pylist()), strict=True))
            return pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.array(column, kind) for column, kind in zip(made, kinds.values(), strict=True)], names=others + list(kinds))

        return step

    before = ", ".join(f"`{c}` {kind}" for c, kind in media.dtypes if c != media_col)
    return map_arrow(media, task, before + ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, phash binary, problem string")


def media_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts stored as media in a table of the shared folder, read back and described. Repeated rows give a row each."""
    return media_features(written(store_media(docs, id_col, text_col), "media"))
