"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI or path, and the folder's path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str):
    """A new binary file; tasks name theirs by attempt, so a repeated task never meets it."""
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield out
