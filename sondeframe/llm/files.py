"""Files in the shared folder, by URI, from executors and the driver.

``pyarrow.fs`` serves local paths, HDFS and object stores alike.  A writer uses a
name of its own for each attempt; only names that reach a committed manifest table
are ever read, so retried or speculative tasks leave at most unread files.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def new_file(folder: str, suffix: str) -> tuple[str, object]:
    """(uri, output stream) of a new file in ``folder``."""
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    name = uuid.uuid4().hex + suffix
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}")


def read_at(uri: str):
    """A random-access file."""
    system, path = open_fs(uri)
    return system.open_input_file(path)
