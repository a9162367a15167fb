"""Files in the shared folder, opened by tasks through Arrow's filesystems."""

from __future__ import annotations

import uuid

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a URI or absolute path, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str):
    """A stream to a new file in ``folder`` and the file's URI. Each attempt of a task writes a file of its own;
    those that count are the ones named in the rows of attempts that were committed."""
    uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    where, path = located(uri)
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return where.open_output_stream(path, compression=None), uri


def opened(uri: str):
    where, path = located(uri)
    return where.open_input_file(path)
