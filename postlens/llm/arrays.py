"""Numpy arrays in the shared folder, memory-mapped by the tasks that use them."""

from __future__ import annotations

import io
import mmap
import os
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs

CODEC = pa.Codec("zstd", 1)


def _located(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder:  # Spark writes a local path also as file:/path
        folder = f"file://{folder.removeprefix('file:')}"
    return fs.FileSystem.from_uri(folder)


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Write ``folder/name.npy``. The file appears whole, so a repeated task does no harm."""
    files, path = _located(folder)
    files.create_dir(path, recursive=True)
    content = io.BytesIO()
    np.save(content, array)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(content.getbuffer())
    files.move(draft, f"{path}/{name}.npy")


def exists(folder: str, name: str) -> bool:
    files, path = _located(folder)
    return files.get_file_info(f"{path}/{name}.npy").type == fs.FileType.File


def load(folder: str, name: str) -> np.ndarray:
    """The array, mapped from the file; from a store that has no local path, a mapped copy."""
    files, path = _located(folder)
    path = f"{path}/{name}.npy"
    if isinstance(files, fs.LocalFileSystem):  # what fits a page needs no mapping, and nothing cannot be mapped
        return np.load(path, mmap_mode="r" if os.path.getsize(path) > 4096 else None)
    with files.open_input_file(path) as source:
        copy = mmap.mmap(-1, source.size())
        copy.write(source.read())
    copy.seek(0)
    np.lib.format.read_magic(copy)
    shape, _, dtype = np.lib.format.read_array_header_1_0(copy)
    return np.frombuffer(copy, dtype, int(np.prod(shape)), copy.tell()).reshape(shape)


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned numbers as bytes: differences if ascending, then byte by byte, compressed."""
    values = np.asarray(values, "<u8")
    if ascending and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    used = -(-int(values.max(initial=0)).bit_length() // 8)
    body = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :used].T)
    return len(values).to_bytes(8, "little") + bytes([used, ascending]) + bytes(CODEC.compress(body, asbytes=True))


def unpack(data: bytes) -> np.ndarray:
    n, used, ascending = int.from_bytes(data[:8], "little"), data[8], data[9]
    planes = np.zeros((n, 8), np.uint8)
    if n and used:
        planes[:, :used] = np.frombuffer(CODEC.decompress(memoryview(data)[10:], n * used), np.uint8).reshape(used, n).T
    values = planes.reshape(-1).view("<u8")
    return np.cumsum(values, dtype=np.uint64) if ascending else values
