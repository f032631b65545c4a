"""Arrays in the shared folder: written once by tasks, memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np

_open: dict[tuple[str, str], np.ndarray] = {}


def _local(uri: str) -> str | None:
    return uri if uri.startswith("/") else "/" + uri.split(":", 1)[1].lstrip("/") if uri.startswith("file:") else None


class Growing:
    """An array that is written piece by piece, under another name until close(), so that a repeated task leaves one whole file."""

    def __init__(self, uri: str):
        self.uri, self.tmp = uri, f"{uri}.{uuid.uuid4().hex}"
        path = _local(self.tmp)
        if path:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            self.store, self.out = None, open(path, "wb")
        else:
            from pyarrow import fs

            self.store, at = fs.FileSystem.from_uri(self.tmp)
            self.store.create_dir(os.path.dirname(at))
            self.out = self.store.open_output_stream(at)

    def add(self, a: np.ndarray) -> None:
        if a.size:
            self.out.write(np.ascontiguousarray(a).data)

    def close(self) -> None:
        self.out.close()
        if self.store is None:
            os.replace(_local(self.tmp), _local(self.uri))
        else:
            self.store.move(*(self.store.from_uri(u)[1] for u in (self.tmp, self.uri)))


def write_array(uri: str, a: np.ndarray) -> None:
    out = Growing(uri)
    out.add(a)
    out.close()


def map_array(uri: str, dtype) -> np.ndarray:
    """The array, mapped; a file that is not on a mounted folder is copied to the worker's own folder and removed once mapped."""
    key = (uri, np.dtype(dtype).str)
    if key not in _open:
        if len(_open) > 4096:
            _open.clear()
        path = _local(uri)
        if path:
            _open[key] = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        else:
            from pyarrow import fs

            store, at = fs.FileSystem.from_uri(uri)
            with tempfile.NamedTemporaryFile() as f:
                with store.open_input_stream(at) as source:
                    while part := source.read(1 << 22):
                        f.write(part)
                f.flush()
                _open[key] = np.memmap(f.name, dtype, "r") if os.path.getsize(f.name) else np.zeros(0, dtype)
    return _open[key]
