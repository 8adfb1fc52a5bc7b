"""Folders that tasks and stream drivers reach without a Spark session: local paths and what pyarrow can open."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it. ``file:/a`` is read as ``file:///a``."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:"):]
    if path.startswith("/"):
        return fs.LocalFileSystem(), path.rstrip("/")
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside.rstrip("/")


def visible(name: str) -> bool:
    """Spark's rule: names that begin with a dot or an underscore are not data."""
    return not name.startswith((".", "_"))
