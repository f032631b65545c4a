"""Opening of files by tasks: a local or mounted path, or a store that Arrow knows."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from typing import Any

from pyarrow import fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it that a uri names."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def opened(uri: str) -> Any:
    """A file to seek in and read from."""
    store, path = at(uri)
    return store.open_input_file(path)


def created(uri: str, made: set[str] | None = None) -> Any:
    """A file to write; made: folders that this task has made already."""
    store, path = at(uri)
    folder = posixpath.dirname(path)
    if made is None or folder not in made:
        store.create_dir(folder, recursive=True)
        if made is not None:
            made.add(folder)
    return store.open_output_stream(path)


def entries(uri: str, inner: bool) -> Iterator[tuple[str, bool]]:
    """(uri, is it a folder) of what is in a folder, or of a file itself, as Spark lists it: without hidden and empty files.  inner: files of inner folders instead of these."""
    store, path = at(uri)
    root = "file:" if isinstance(store, fs.LocalFileSystem) else uri[: len(uri) - len(path)]
    info = store.get_file_info(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=inner))
    for f in found:
        hidden = any(part[:1] in "_." for part in f.path[len(path) :].split("/") if part)
        if not hidden and (f.size if f.type == fs.FileType.File else not inner):
            yield root + f.path, f.type == fs.FileType.Directory


def content(uri: str) -> bytes:
    """A whole file, decompressed if its name says so."""
    store, path = at(uri)
    with store.open_input_stream(path, compression="detect") as f:
        return f.read()


def removed(uri: str) -> None:
    store, path = at(uri)
    if store.get_file_info(path).type != fs.FileType.NotFound:
        (store.delete_dir if store.get_file_info(path).type == fs.FileType.Directory else store.delete_file)(path)
