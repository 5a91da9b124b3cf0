"""File access of tasks by URI, so that any store that pyarrow knows will do."""

from __future__ import annotations

from pyarrow import fs


def _resolve(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """A binary output stream to a new file; missing folders are made."""
    system, path = _resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def stream(uri: str):
    """A buffered binary input stream."""
    system, path = _resolve(uri)
    return system.open_input_stream(path, compression=None, buffer_size=1 << 20)


def seekable(uri: str):
    """A random-access file."""
    system, path = _resolve(uri)
    return system.open_input_file(path)
