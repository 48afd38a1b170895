"""Files in the shared folder, written by tasks.

A task writes under a name of its own attempt and reports the name only when the file is
whole, so a repeated or lost attempt leaves nothing that a reader would see.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def attempt_path(folder: str, suffix: str) -> str:
    """A name in ``folder`` no other attempt uses."""
    files, path = open_fs(folder)
    files.create_dir(path, recursive=True)
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    return f"{folder}/part-{part:05d}-{uuid.uuid4().hex}{suffix}"
