"""Reading and writing whole files and byte ranges in the cluster's shared folder from tasks.

Goes through ``pyarrow.fs``, so any store it knows (a mounted folder, HDFS, an
object store) works. A file is written under an attempt's own name and then
moved to its final one: a task that is run again after a lost executor replaces
the file by an equal one, and a reader never sees half a file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, chunks) -> int:
    """Write an iterable of bytes as one file; returns its length."""
    store, path = open_store(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    size = 0
    with store.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    try:
        store.move(attempt, path)
    except OSError:  # some stores do not replace a file: an earlier attempt's equal one stays
        if store.get_file_info(path).type == fs.FileType.NotFound:
            raise
        store.delete_file(attempt)
    return size


class RangeReader:
    """Byte ranges of files, keeping the file read last open."""

    def __init__(self):
        self._uri = None
        self._file = None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self._uri:
            self.close()
            store, path = open_store(uri)
            self._file, self._uri = store.open_input_file(path), uri
        return self._file.read_at(length, offset)

    def size(self, uri: str) -> int:
        if uri != self._uri:
            self.read(uri, 0, 0)
        return self._file.size()

    def close(self):
        if self._file is not None:
            self._file.close()
        self._uri = self._file = None
