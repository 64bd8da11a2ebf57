"""Binary files in the shared folder, written and read inside tasks.

A task attempt writes files under names of its own; the manifest that Spark commits says which ones count. So a task
that is run again leaves no wrong data, only an unnamed file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from metaloom.llm.common import checkpoint_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """The URI of a folder of its own in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4()}"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """A new file to write, with its folder."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def read_stream(uri: str):
    store, path = opened(uri)
    return store.open_input_stream(path, compression=None)


def read_random(uri: str):
    store, path = opened(uri)
    return store.open_input_file(path)
