"""Files that tasks write to, and read from, the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs

from perron.session import shared_dir


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" not in path:
        path = path.removeprefix("file:")
        if path.startswith("/"):
            return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def new_file(folder: str, suffix: str) -> str:
    """A name that no other task and no other attempt uses; files of failed attempts are never listed."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def open_output(path: str):
    system, at = file_system(path)
    return system.open_output_stream(at, compression=None)


def open_input(path: str):
    system, at = file_system(path)
    return system.open_input_stream(at, compression=None)


__all__ = ["file_system", "new_file", "open_input", "open_output", "shared_dir"]
