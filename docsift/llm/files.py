"""Binary files in the shared store, by URI, from executors or the driver."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlsplit

import numpy as np


def local_path(uri: str) -> str | None:
    parts = urlsplit(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def create(uri: str):
    """A writable binary stream; parents are made."""
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(inner), recursive=True)
    return store.open_output_stream(inner)


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A file's numbers: memory-mapped where the store is a mounted folder, else read once."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    return Ranges(uri, dtype)[:]


class Ranges:
    """A file's numbers by range: slices of a memory map where the store is a mounted folder, else range reads."""

    def __init__(self, uri: str, dtype: str):
        path, self.dtype = local_path(uri), np.dtype(dtype)
        self.map = None if path is None else mapped(uri, dtype)
        if self.map is None:
            from pyarrow import fs

            store, inner = fs.FileSystem.from_uri(uri)
            self.file = store.open_input_file(inner)
            self.size = self.file.size() // self.dtype.itemsize

    def __getitem__(self, part: slice) -> np.ndarray:
        if self.map is not None:
            return self.map[part]
        lo, hi, _ = part.indices(self.size)
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at(max(0, hi - lo) * width, lo * width), self.dtype)
