"""Files by path or address in stores that pyarrow opens: listing, reading by byte range, writing, moving."""

from __future__ import annotations

import fnmatch

import pyarrow.fs as pafs


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path in it; a path without a scheme is local."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def listed(path: str, endings: tuple[str, ...]) -> list[tuple[str, int]]:
    """(address, bytes) of a file, of a folder's files with such endings, or of those that fit a pattern in the last part of the path; hidden files are left out."""
    fs, at = opened(path)
    scheme = path[: len(path) - len(at)] if path.endswith(at) else ""
    name = at.rstrip("/").rsplit("/", 1)[-1]
    if any(c in name for c in "*?["):
        top, fits = at.rstrip("/").rsplit("/", 1)[0], lambda n: fnmatch.fnmatchcase(n, name)
    elif fs.get_file_info(at).type == pafs.FileType.Directory:
        top, fits = at, lambda n: n.endswith(endings)
    else:
        info = fs.get_file_info(at)
        if info.type != pafs.FileType.File:
            raise FileNotFoundError(path)
        return [(path, info.size)]
    found = [i for i in fs.get_file_info(pafs.FileSelector(top)) if i.type == pafs.FileType.File and fits(i.base_name) and not i.base_name.startswith((".", "_"))]
    if not found:
        raise FileNotFoundError(path)
    return sorted((f"{scheme}{i.path}", i.size) for i in found)


def exists(path: str) -> bool:
    fs, at = opened(path)
    return fs.get_file_info(at).type == pafs.FileType.File
