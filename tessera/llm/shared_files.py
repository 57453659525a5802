"""Binary files that tasks write to and read from the shared folder, on any file system that has an address."""

from __future__ import annotations

import posixpath

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder given as a path or an address (file:, hdfs:, s3:, gs:)."""
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def attempt_name(part: int, ending: str) -> str:
    """A file name of its own for each attempt of a task; manifests name the attempt that counts."""
    from pyspark import TaskContext

    return f"part-{part:06d}-{TaskContext.get().taskAttemptId()}.{ending}"


def join(folder: str, name: str) -> str:
    return posixpath.join(folder, name)
