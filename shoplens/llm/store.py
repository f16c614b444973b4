"""Files that executors write into, and read from, the shared folder."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyarrow import fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:`` ...) or an absolute path."""
    return pafs.FileSystem.from_uri(uri)


def write_whole(uri: str, fill: Callable) -> None:
    """Write a file under a temporary name, then move it into place.

    A lost or repeated task leaves either no file or the whole one: the final
    name appears only when ``fill(stream)`` has ended.
    """
    fs, path = resolve(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temporary) as stream:
        fill(stream)
    fs.move(temporary, path)


def open_input(uri: str):
    """A random-access file; local files are memory-mapped (zero copy)."""
    fs, path = resolve(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        import pyarrow as pa
        return pa.memory_map(path, "r")
    return fs.open_input_file(path)
