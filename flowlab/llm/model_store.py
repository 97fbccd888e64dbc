"""Model files in the shared folder (``spark.checkpoint.dir``): tasks write named arrays into one
file each, tasks on any executor map them into memory. A folder that is no local path is read
and written with pyarrow's filesystems, and each worker maps a copy of its own."""

from __future__ import annotations

import json
import os
import pickle
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import xxhash
from pyspark.sql import SparkSession

from flowlab.llm.chunk_ids import remembered, take_over
from flowlab.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def _local(folder: str) -> str | None:
    u = urlparse(folder)
    return u.path if u.scheme in ("", "file") else None


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write ``arrays`` as one file; repeated attempts of a task write the same file anew."""
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (a.dtype.str, at, len(a))
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    begin = -(-(len(text) + 16) // 64) * 64
    parts = [begin.to_bytes(8, "little"), len(text).to_bytes(8, "little"), text, bytes(begin - 16 - len(text))]
    for a in arrays.values():
        parts += [a.tobytes(), bytes(-a.nbytes % 64)]
    path = _local(folder)
    if path:
        os.makedirs(path, exist_ok=True)
        draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            f.writelines(parts)
        os.replace(draft, f"{path}/{name}")
    else:
        from pyarrow import fs

        where, inner = fs.FileSystem.from_uri(folder)
        where.create_dir(inner, recursive=True)
        with where.open_output_stream(f"{inner}/{name}") as f:
            for p in parts:
                f.write(p)


def load(folder: str, name: str, mapped: bool = True) -> dict[str, np.ndarray]:
    """The arrays of :func:`save`, mapped, or read into memory (for small files)."""
    path = _local(folder)
    if path:
        whole = np.memmap(f"{path}/{name}", np.uint8, "r") if mapped else np.fromfile(f"{path}/{name}", np.uint8)
    elif not mapped:
        from pyarrow import fs

        where, inner = fs.FileSystem.from_uri(folder)
        with where.open_input_stream(f"{inner}/{name}") as f:
            whole = np.frombuffer(f.read(), np.uint8)
    else:
        from pyarrow import fs

        where, inner = fs.FileSystem.from_uri(folder)
        copy = tempfile.TemporaryFile()
        with where.open_input_stream(f"{inner}/{name}") as f:
            while block := f.read(1 << 24):
                copy.write(block)
        copy.flush()
        whole = np.memmap(copy, np.uint8, "r")
    begin, size = (int.from_bytes(whole[i:i + 8].tobytes(), "little") for i in (0, 8))
    head = json.loads(whole[16:16 + size].tobytes())
    out = {}
    for k, (kind, at, n) in head.items():
        d = np.dtype(kind)
        out[k] = whole[begin + at:begin + at + n * d.itemsize].view(d)
    return out


_HELD: dict[str, object] = remembered({})


def put(spark: SparkSession, kind: str, model) -> str:
    """Write a fitted model of bounded size to the shared folder; its place is what tasks carry."""
    folder = new_folder(spark, kind)
    save(folder, "model", {"pickled": np.frombuffer(pickle.dumps(model), np.uint8)})
    return folder


def get(folder: str):
    """The model of :func:`put`. A worker holds one at a time, so models that lazy results still
    refer to don't pile up in workers as broadcasts would."""
    if folder not in _HELD:
        take_over()
        _HELD[folder] = pickle.loads(load(folder, "model", mapped=False)["pickled"].tobytes())
    return _HELD[folder]


class HashedRows:
    """Rows of numbers by string, told apart by 64-bit hashes: two arrays instead of a dictionary, as
    every worker holds one."""

    def __init__(self, keys: list[str], rows: np.ndarray):
        hashes = hash_strings(keys)
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], np.asarray(rows)[order]

    def __len__(self):
        return len(self.hashes)

    def find(self, keys: list[str]) -> np.ndarray:
        """The place of each key's row, -1 without one."""
        asked = hash_strings(keys)
        if not len(self.hashes):
            return np.full(len(asked), -1)
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        return np.where(self.hashes[at] == asked, at, -1)


def hash_strings(keys: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass")) for k in keys), np.uint64, len(keys))
