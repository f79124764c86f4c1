"""Arrays written by tasks into the shared folder and memory-mapped by the workers that read them."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np

from opsgauge.llm.workspace import filesystem


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write one array under a name of its own and then move it to its place, so a task that runs
    twice does no harm."""
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    head = io.BytesIO()
    np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(array))
    part = f"{root}/{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(head.getvalue())
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"")
    fs.move(part, f"{root}/{name}.npy")


def map_array(folder: str, name: str) -> np.ndarray:
    """Memory-map an array. Where the folder is not a mounted one, a copy without a name is mapped; it
    goes when the worker ends."""
    fs, root = filesystem(folder)
    path = f"{root}/{name}.npy"
    if fs.type_name == "local":
        return _mapped(path)
    fd, copy = tempfile.mkstemp()
    try:
        with os.fdopen(fd, "wb") as out, fs.open_input_stream(path, compression=None) as source:
            while piece := source.read(1 << 22):
                out.write(piece)
        return _mapped(copy)
    finally:
        os.unlink(copy)


def _mapped(path: str) -> np.ndarray:
    out = np.load(path, mmap_mode="r")
    return out


@lru_cache(maxsize=None)
def cached_array(folder: str, name: str) -> np.ndarray:
    """The same, once for each worker; the mapped pages belong to the system's cache."""
    return map_array(folder, name)


def pack(*arrays: np.ndarray) -> np.ndarray:
    """Flat arrays of numbers without signs, or of int64, as one array of bytes: for each, its kind and
    length, then its numbers, from multiples of eight bytes on."""
    head = np.array([x for a in arrays for x in (KINDS.index(a.dtype), len(a))], np.int64)
    parts = [np.array([len(arrays)], np.int64).view(np.uint8), head.view(np.uint8)]
    for a in arrays:
        parts += [np.ascontiguousarray(a).view(np.uint8), np.zeros(-a.nbytes % 8, np.uint8)]
    return np.concatenate(parts)


def unpack(packed: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays, as views."""
    n = int(packed[:8].view(np.int64)[0])
    head, at, out = packed[8 : 8 + 16 * n].view(np.int64).reshape(n, 2), 8 + 16 * n, []
    for kind, length in head.tolist():
        size = length * KINDS[kind].itemsize
        out.append(packed[at : at + size].view(KINDS[kind]))
        at += size + -size % 8
    return tuple(out)


KINDS = [np.dtype(t) for t in (np.uint8, np.uint16, np.uint32, np.uint64, np.int64)]


@lru_cache(maxsize=None)
def cached_pack(folder: str, name: str) -> tuple[np.ndarray, ...]:
    """Packed arrays that are one mapped file."""
    return unpack(np.asarray(map_array(folder, name)))
