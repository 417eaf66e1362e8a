"""Files of report trees, listed and read on the executors by path."""

from __future__ import annotations

import os
import re
from urllib.parse import unquote

from regflow.session import ship_by_value

ship_by_value(__name__)


def open_store(uri: str):
    """(file system, path in it) of a local path or a URI with any scheme pyarrow knows."""
    from pyarrow import fs

    local = re.match(r"^file:(?://)?(/.*)$", uri)
    if local or not re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://", uri):
        return fs.LocalFileSystem(), os.path.abspath(unquote(local.group(1)) if local else uri)
    return fs.FileSystem.from_uri(uri)


class Store:
    """Opens files below a root by the paths that a listing gives, which begin with the root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.files, self.base = open_store(self.root)

    def inner(self, path: str) -> str:
        if not path.startswith(f"{self.root}/"):
            raise ValueError(f"{path} is not below {self.root}")
        return f"{self.base.rstrip('/')}/{path[len(self.root) + 1 :]}"

    def read(self, path: str) -> bytes:
        with self.files.open_input_stream(self.inner(path)) as stream:
            return stream.read()
