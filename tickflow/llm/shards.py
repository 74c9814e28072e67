"""Arrays in the shared folder: written by tasks under names of their own, memory-mapped by workers."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zlib

import numpy as np
from pyarrow import fs

OPEN_FILES = 4096
_open: dict[str, np.ndarray] = {}


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return re.sub(r"^file:/*", "/", uri)
    return None if "://" in uri else uri


def save(folder: str, name: str, array: np.ndarray) -> str:
    """Write ``array``; a name is used once, so a repeated task disturbs nothing.  Returns its place."""
    uri = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}.npy"
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        np.save(path, array)
    else:
        system, place = fs.FileSystem.from_uri(uri)
        system.create_dir(os.path.dirname(place), recursive=True)
        held = io.BytesIO()
        np.save(held, array)
        with system.open_output_stream(place) as out:
            out.write(held.getvalue())
    return uri


def mapped(uri: str) -> np.ndarray:
    """The array, memory-mapped.  From a remote store it is fetched once into an unlinked scratch file."""
    got = _open.get(uri)
    if got is None:
        path = _local(uri)
        if path is not None:
            got = np.load(path, mmap_mode="r")
        else:
            system, place = fs.FileSystem.from_uri(uri)
            with tempfile.NamedTemporaryFile(suffix=".npy") as scratch, system.open_input_stream(place) as data:
                while block := data.read(1 << 22):
                    scratch.write(block)
                scratch.flush()
                got = np.load(scratch.name, mmap_mode="r")
        if len(_open) >= OPEN_FILES:
            _open.clear()
        _open[uri] = got
    return got


def _squeeze(x: np.ndarray) -> bytes:
    """Bytes of equal place next to each other, deflated: small numbers take little room."""
    return zlib.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def _loosen(raw: bytes, n: int, dtype: str) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(dtype).itemsize, n)
    return np.ascontiguousarray(flat.T).reshape(-1).view(dtype)


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of one length; the first is sorted and goes as differences."""
    n = len(columns[0])
    parts = []
    for i, c in enumerate(columns):
        c = np.diff(c, prepend=c.dtype.type(0)) if i == 0 else c
        raw = _squeeze(c) if n else b""
        parts.append(c.dtype.str.encode().ljust(4) + len(raw).to_bytes(8, "little") + raw)
    return n.to_bytes(8, "little") + b"".join(parts)


def unpack(blob: bytes) -> list[np.ndarray]:
    n, at, out = int.from_bytes(blob[:8], "little"), 8, []
    while at < len(blob):
        dtype, size = blob[at : at + 4].decode().strip(), int.from_bytes(blob[at + 4 : at + 12], "little")
        at += 12
        c = _loosen(blob[at : at + size], n, dtype) if n else np.zeros(0, dtype)
        out.append(np.cumsum(c, dtype=c.dtype) if not out else c)
        at += size
    return out
