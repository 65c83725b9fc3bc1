"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style URI (``file:/x``, ``hdfs://h/x``, ``s3://b/x``)."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Writer:
    """A file that appears under its name when it is complete. A task that
    runs again writes the same content under the same name."""

    def __init__(self, folder: str, name: str):
        self.fs, path = opened(folder)
        self.fs.create_dir(path, recursive=True)
        self.target, self.draft = f"{path}/{name}", f"{path}/.{name}-{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.draft, self.target)


class Reader:
    def __init__(self, folder: str, name: str):
        self.fs, path = opened(folder)
        self.file = self.fs.open_input_file(f"{path}/{name}")
        self.size = self.file.size()

    def read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def close(self) -> None:
        self.file.close()
