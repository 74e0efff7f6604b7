"""Files that tasks write into, and read ranges from, the shared folder.

A task writes under a name of its own; only names in the manifest that Spark commits count, so a
retried or speculative task leaves at most an orphan that no reader sees.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI or plain path."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def new_file(folder: str, suffix: str) -> str:
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    system, path = filesystem(uri)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    system, path = filesystem(uri)
    return system.open_input_file(path)


def read_range(uri: str, begin: int, size: int) -> bytes:
    with open_input(uri) as f:
        f.seek(begin)
        return f.read(size)
