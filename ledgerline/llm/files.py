"""Files on shared storage, written and read inside tasks.

Paths are those of Spark (``file:``, ``hdfs:``, ``s3a:`` ...), opened with
Arrow's file systems.  A file is written under a name of the task's attempt and
moved to its own name when complete, so an attempt that is lost or runs twice
leaves whole files only.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyarrow import fs


def _at(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if not re.match(r"[a-z][a-z0-9+.-]*:", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


@contextmanager
def written(path: str):
    """An output stream whose bytes become the file ``path`` when the block ends well."""
    system, name = _at(path)
    folder = name.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    own = f"{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(own, compression=None) as out:
        yield out
    system.move(own, name)


def opened(path: str):
    """A buffered input stream of the file's bytes as they are."""
    system, name = _at(path)
    return system.open_input_stream(name, compression=None, buffer_size=1 << 20)


def read(path: str) -> bytes:
    with opened(path) as stream:
        return stream.read()
