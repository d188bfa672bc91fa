"""File-system access for readers and writers that run inside tasks (pyarrow file systems).

Works for local paths, ``file:`` URIs and any scheme pyarrow supports (hdfs, s3, gs).
"""

from __future__ import annotations

import fnmatch
import posixpath

import pyarrow.fs as pafs


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return pafs.LocalFileSystem(), p
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def uri(fs: pafs.FileSystem, p: str, like: str) -> str:
    """Rebuild a path in the caller's style (plain local path or ``scheme://``)."""
    if isinstance(fs, pafs.LocalFileSystem):
        return p
    scheme = like.split("://", 1)[0]
    return f"{scheme}://{p}"


def list_files(path: str, suffix: str | None = None, exclude_suffix: str | None = None) -> list[tuple[str, int]]:
    """(path, size) of the files under ``path`` (a file, a directory or a glob on the last component)."""
    fs, p = resolve(path)
    pattern = None
    if any(ch in posixpath.basename(p) for ch in "*?["):
        p, pattern = posixpath.dirname(p), posixpath.basename(p)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        infos = [info]
    else:
        infos = fs.get_file_info(pafs.FileSelector(p, recursive=False))
    out = []
    for i in infos:
        name = posixpath.basename(i.path)
        if i.type != pafs.FileType.File or name.startswith(("_", ".")):
            continue
        if pattern and not fnmatch.fnmatch(name, pattern):
            continue
        if suffix and not name.endswith(suffix):
            continue
        if exclude_suffix and name.endswith(exclude_suffix):
            continue
        out.append((uri(fs, i.path, path), i.size))
    return sorted(out)


def remove_files(path: str, prefix: str) -> int:
    """Delete the files of directory ``path`` whose names begin with ``prefix``; a missing directory has none."""
    fs, p = resolve(path)
    if fs.get_file_info(p).type != pafs.FileType.Directory:
        return 0
    gone = [i.path for i in fs.get_file_info(pafs.FileSelector(p, recursive=False))
            if i.type == pafs.FileType.File and posixpath.basename(i.path).startswith(prefix)]
    for g in gone:
        fs.delete_file(g)
    return len(gone)


def is_file(path: str) -> bool:
    fs, p = resolve(path)
    return fs.get_file_info(p).type == pafs.FileType.File


def list_folders(path: str, prefix: str) -> list[str]:
    """Folders directly in ``path`` whose names begin with ``prefix``."""
    fs, p = resolve(path)
    if fs.get_file_info(p).type != pafs.FileType.Directory:
        return []
    return [uri(fs, i.path, path) for i in fs.get_file_info(pafs.FileSelector(p, recursive=False))
            if i.type == pafs.FileType.Directory and posixpath.basename(i.path).startswith(prefix)]


def remove_folder(path: str) -> None:
    """Delete a folder and what it holds; a missing one is fine."""
    fs, p = resolve(path)
    if fs.get_file_info(p).type == pafs.FileType.Directory:
        fs.delete_dir(p)


def move_file(path: str, to: str) -> None:
    """Rename within one file system."""
    fs, p = resolve(path)
    fs.move(p, resolve(to)[1])


def write_atomic(path: str, data_chunks, skip_empty: bool = False) -> int:
    """Write bytes to ``path`` through a temporary name and a rename (a retried task overwrites).

    With ``skip_empty`` no file is created when ``data_chunks`` yields nothing."""
    import uuid

    it = iter(data_chunks)
    first = next(it, None)
    if first is None and skip_empty:
        return 0
    fs, p = resolve(path)
    fs.create_dir(posixpath.dirname(p), recursive=True)
    tmp = posixpath.join(posixpath.dirname(p), f"_tmp-{uuid.uuid4().hex}-{posixpath.basename(p)}")
    n = 0
    with fs.open_output_stream(tmp, compression=None) as f:
        for c in ([first] if first is not None else []):
            f.write(c)
            n += len(c)
        for c in it:
            f.write(c)
            n += len(c)
    fs.move(tmp, p)
    return n
