"""Files in the cluster's shared folder, written by tasks: temporary names, then a rename, then a manifest."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs as pafs


def filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder (any address that Arrow knows, or a plain path) and the path in it."""
    return pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), os.path.abspath(root))


class Committed:
    """One output file. Bytes go to a name of this attempt alone; ``commit`` moves it to its final name.

    A repeated attempt writes the same bytes under the same final name, so a lost executor or
    a speculative copy changes nothing; what a dead attempt left stays under ``_tmp``.
    """

    def __init__(self, root: str, name: str):
        self.fs, base = filesystem(root)
        self.final, self.temporary = f"{base}/{name}", f"{base}/_tmp/{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(f"{base}/_tmp", recursive=True)
        self.out = self.fs.open_output_stream(self.temporary)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; returns the offset at which the data starts."""
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.final)


def read_file(root: str, name: str) -> bytes:
    fs, base = filesystem(root)
    with fs.open_input_file(f"{base}/{name}") as f:
        return f.read()
