"""Binary files in the shared folder, read and written from within tasks."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark import TaskContext


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it; a bare path is a mounted folder."""
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


class Folder:
    """Where a task writes files. Names are new in each attempt, so a repeated or
    speculative task overwrites nothing; only files that the job's index names count.
    """

    def __init__(self, root: str, suffix: str):
        self.fs, self.path = filesystem(root)
        self.root, self.suffix, self.files = root.rstrip("/"), suffix, 0
        self.fs.create_dir(self.path, recursive=True)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        self.stem = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"

    def next(self) -> tuple[str, object]:
        name = f"{self.stem}-{self.files:05d}{self.suffix}"
        self.files += 1
        return f"{self.root}/{name}", self.fs.open_output_stream(f"{self.path}/{name}", compression=None)


def open_input(uri: str):
    """A random-access file."""
    system, path = filesystem(uri)
    return system.open_input_file(path)


def file_size(uri: str) -> int:
    system, path = filesystem(uri)
    return system.get_file_info(path).size
