"""Binary files that tasks write to and read from a shared folder.

A task names its files by its attempt and returns the names, so that a file
counts only if its attempt succeeded; what a lost attempt left is never read.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, number: int, suffix: str) -> str:
    context = TaskContext.get()
    return f"{prefix}-{context.partitionId():06d}-{context.taskAttemptId()}-{number:05d}{suffix}"


def output(folder: str, name: str):
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def input_stream(uri: str):
    system, path = _open(uri)
    return system.open_input_stream(path, compression=None)


def input_file(uri: str):
    """For reading at offsets."""
    system, path = _open(uri)
    return system.open_input_file(path)
