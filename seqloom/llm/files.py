"""Binary files in the shared folder, written and read by tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, of a path with or without a scheme."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write(path: str, parts) -> str:
    """Write the buffers under a name of this attempt's own, so that attempts of one task never meet; return it."""
    path = f"{path}-{uuid.uuid4().hex}"
    system, at = place(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        for part in parts:
            out.write(part)
    return path


def mapped(path: str) -> pa.Buffer:
    """The whole file: memory-mapped where it is local, else read."""
    system, at = place(path)
    if isinstance(system, fs.LocalFileSystem):
        with pa.memory_map(at) as f:
            return f.read_buffer()
    with system.open_input_file(at) as f:
        return f.read_buffer()
