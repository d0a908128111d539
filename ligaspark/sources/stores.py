"""Files as tasks open them by themselves: any store that Arrow's file systems reach (shared folders, HDFS, S3, ...), by URI or path."""

from __future__ import annotations

import os

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def files(path: str) -> list[tuple[str, int, int]]:
    """(path, size, time of change in ns) of the file, or of the files of the folder, by name; hidden ones, as Spark has them, are left out."""
    store, at = opened(path)
    scheme = path.split("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else [i for i in store.get_file_info(fs.FileSelector(at, recursive=True)) if i.type == fs.FileType.File]
    shown = lambda p: not any(x[:1] in "._" for x in p[len(at) :].split("/") if x)
    return sorted((scheme + i.path, i.size, i.mtime_ns) for i in found if i is info or shown(i.path))


def splits(path: str, size: int) -> list[tuple[str, int, int]]:
    """(path, start, end) of stretches of about ``size`` bytes of all files of ``path``."""
    return [(p, a, min(a + size, n)) for p, n, _ in files(path) for a in range(0, n, size)]
