"""Files that tasks write and read in the shared folder, through pyarrow's file systems.

A task writes under a name of its own attempt, during the write and after it, and
hands the name on in its rows. So a task that runs twice leaves two whole files,
of which only the one named in the rows that Spark kept is ever read; rows may
come in another order the second time. The folder goes with the others that
``drop_intermediates`` deletes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyarrow import NativeFile, fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from starloom.session import shared_folder, track


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder's URI below the session's shared folder."""
    root = shared_folder(spark)
    root = root if ":/" in root else f"file://{root}"
    folder = f"{root}/{kind}-{uuid4().hex}"
    track(folder)
    return folder


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; Spark's names of S3 are pyarrow's ``s3``."""
    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"s3:{rest}" if colon and scheme in ("s3a", "s3n") else uri)


@contextmanager
def committed(uri: str) -> Iterator[NativeFile]:
    """An output stream for a file that appears when the block ends well."""
    system, path = locate(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.part"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, path)


def task_file(folder: str, kind: str, suffix: str) -> str:
    """A URI below ``folder`` that no other attempt of this or another task uses."""
    task = TaskContext.get()
    attempt = task.taskAttemptId() if task else 0
    return f"{folder}/{kind}-{task_number():06d}-{attempt}.{suffix}"


def task_number() -> int:
    """The number of the partition this task works on."""
    task = TaskContext.get()
    return task.partitionId() if task else 0
