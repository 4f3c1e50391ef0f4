"""Files with exact names, written and read by workers through the shared file system."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder, as a worker opens it."""
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def put(uri: str, name: str, content: bytes) -> None:
    """Write a file under a hidden name and rename it when whole, so a repeated task replaces it by the same file."""
    files, root = folder(uri)
    files.create_dir(root, recursive=True)
    hidden = f"{root}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as out:
        out.write(content)
    files.move(hidden, f"{root}/{name}")


def get(path: str | None) -> bytes | None:
    """A file's content, or null where there is none."""
    if not path:
        return None
    try:
        files, at = folder(path)
        with files.open_input_stream(at, compression=None) as stream:
            return stream.read()
    except (OSError, pa.ArrowInvalid):
        return None


def pieces(path: str, size: int = 1 << 20):
    """A file's bytes, as they are, in pieces."""
    files, at = folder(path)
    with files.open_input_stream(at, compression=None) as stream:
        while piece := stream.read(size):
            yield piece
