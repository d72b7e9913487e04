"""Files of numpy arrays in the shared folder, written once by tasks and memory-mapped by workers."""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs

_local: dict[str, str] = {}


def as_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def store_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file with all arrays. It takes its name when complete, so a task that is run again does no harm."""
    files, path = pafs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    head = json.dumps({k: [a.dtype.str, len(a)] for k, a in arrays.items()}).encode()
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(len(head).to_bytes(8, "little") + head + b" " * (-len(head) % 8))
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes())
            out.write(bytes(-a.nbytes % 8))
    try:
        files.move(draft, f"{path}/{name}")
    except OSError:  # stores that refuse to move onto a file: the one of an earlier attempt is the same
        if files.get_file_info(f"{path}/{name}").type != pafs.FileType.File:
            raise
        files.delete_file(draft)


def map_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory. From a store that is not a mounted folder, each worker process first copies the file to a temporary one, which is gone when the process ends."""
    files, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
    if not isinstance(files, pafs.LocalFileSystem):
        files, path = pafs.LocalFileSystem(), _copied(files, path)
    out: dict[str, np.ndarray] = {}
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        head = json.loads(f.read(size))
    at = 8 + size + -size % 8
    for k, (kind, n) in head.items():
        out[k] = np.memmap(path, kind, "r", at, (n,)) if n else np.empty(0, kind)
        at += out[k].nbytes + -out[k].nbytes % 8
    return out


def _copied(files: pafs.FileSystem, path: str) -> str:
    if path not in _local:
        handle, own = tempfile.mkstemp(prefix="cohortloom-")
        with os.fdopen(handle, "wb") as out, files.open_input_stream(path) as source:
            while block := source.read(1 << 22):
                out.write(block)
        _local[path] = own
        atexit.register(os.unlink, own)
    return _local[path]
