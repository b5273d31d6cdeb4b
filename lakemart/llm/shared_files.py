"""Files of plain arrays in the shared folder, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def place(uri: str):
    """File system and path; a path without a scheme is local (a mounted share)."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_arrays(uri: str, arrays: list[np.ndarray]) -> None:
    """All arrays in one file, each from a multiple of 8 bytes, behind their lengths.

    The file appears under its name when it is whole; a repeated task writes the same again.
    """
    system, path = place(uri)
    folder = path.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(np.array([len(arrays), *map(len, arrays)], "<u8").tobytes())
        for a in arrays:
            data = np.ascontiguousarray(a).tobytes()
            out.write(data + b"\0" * (-len(data) % 8))
    system.move(part, path)


def map_arrays(uri: str, kinds: list[str]) -> list[np.ndarray]:
    """The arrays of a file, mapped, not read. From a store that cannot be mapped the file is first
    fetched into an unnamed local file, which goes with the mapping."""
    system, path = place(uri)
    if isinstance(system, fs.LocalFileSystem):
        source = path
    else:
        source = tempfile.TemporaryFile()
        with system.open_input_stream(path) as data:
            while block := data.read(8 << 20):
                source.write(block)
        source.flush()
        source.seek(0, os.SEEK_END)
    whole = np.memmap(source, np.uint8, "r")
    sizes = whole[: 8 + 8 * len(kinds)].view("<u8")[1:].tolist()
    out, at = [], 8 + 8 * len(kinds)
    for n, kind in zip(sizes, kinds, strict=True):
        size = n * np.dtype(kind).itemsize
        out.append(whole[at : at + size].view(kind))
        at += size + -size % 8
    return out
