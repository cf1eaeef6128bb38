"""Files in the cluster's shared folder, written and read inside tasks.

Any file system that pyarrow knows by URI serves.  A file appears under its name only when it
is complete, and a repeated task writes the same name again, so lost executors leave no half
files behind.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

from docketflow.session import shared_dir


def located(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def new_folder(spark: SparkSession, kind: str) -> str:
    """The URI of a new folder in the shared folder; the driver makes it."""
    uri = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    system, path = located(uri)
    system.create_dir(path, recursive=True)
    return uri


@contextmanager
def written(uri: str) -> Iterator:
    """An output stream whose file takes its name at the end."""
    system, path = located(uri)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with system.open_output_stream(part) as out:
            yield out
    except BaseException:
        system.delete_file(part)
        raise
    system.move(part, path)


def opened(uri: str):
    system, path = located(uri)
    return system.open_input_file(path)
