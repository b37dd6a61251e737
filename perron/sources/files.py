"""Folders and files that tasks list, open and write themselves."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" not in path:
        path = path.removeprefix("file:")
        if path.startswith("/"):
            return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def entries(folder: str, recursive: bool = False) -> Iterator[fs.FileInfo]:
    """What lies in a folder; nothing if there is no such folder. Names that start with ``_`` or ``.`` are left out."""
    system, path = file_system(folder)
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=recursive)):
        if not any(part[:1] in ("_", ".") for part in info.path[len(path) :].split("/") if part):
            yield info


def read_file(path: str) -> bytes:
    system, at = file_system(path)
    with system.open_input_stream(at, compression=None) as stream:
        return stream.read()


def _write_aside(system: fs.FileSystem, at: str, data: bytes) -> str:
    """Writes a hidden file next to ``at``; its path."""
    folder, _, name = at.rpartition("/")
    system.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(temporary, compression=None) as out:
        out.write(data)
    return temporary


def write_file(path: str, data: bytes) -> None:
    """The file appears as a whole: it is written under another name and then moved."""
    system, at = file_system(path)
    system.move(_write_aside(system, at, data), at)


def create_file(spark: SparkSession, path: str, data: bytes) -> bool:
    """Like :func:`write_file`, but only where there is no such file; False where another writer was first.

    A mounted file system links the written file to its name, elsewhere Hadoop's rename decides. Both are one step on POSIX
    mounts and on HDFS; an object store without a rename of its own cannot tell two writers apart at the same moment.
    """
    system, at = file_system(path)
    temporary = _write_aside(system, at, data)
    try:
        if isinstance(system, fs.LocalFileSystem):
            os.link(temporary, at)
            return True
        hadoop = spark._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        return not store.exists(target) and store.rename(hadoop.Path(f"{path.rpartition('/')[0]}/{temporary.rpartition('/')[2]}"), target)
    except FileExistsError:
        return False
    finally:
        if system.get_file_info(temporary).is_file:
            system.delete_file(temporary)
