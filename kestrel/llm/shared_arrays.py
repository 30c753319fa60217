"""Numpy arrays in files of the shared folder: written whole by tasks, memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np


def _plain(path: str) -> str | None:
    """The path of a mounted folder, None for other stores."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else path


def save(path: str, columns: dict[str, np.ndarray]) -> None:
    """Columns of one length, one after the other. A file is moved into place when whole, so a task
    that runs again, or twice, leaves the same file."""
    n = {len(x) for x in columns.values()}
    assert len(n) == 1
    body = b"".join(np.ascontiguousarray(x).tobytes() for x in columns.values())
    plain, mark = _plain(path), f".{uuid.uuid4().hex}"
    if plain:
        os.makedirs(os.path.dirname(plain), exist_ok=True)
        with open(plain + mark, "wb") as f:
            f.write(body)
        os.replace(plain + mark, plain)
        return
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(at), recursive=True)
    with store.open_output_stream(at + mark) as f:
        f.write(body)
    store.move(at + mark, at)


def load(path: str, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """The columns as memory maps. A file of a store that is not mounted is copied to an unnamed local file first."""
    plain = _plain(path)
    if plain:
        raw = np.memmap(plain, dtype=np.uint8, mode="r") if os.path.getsize(plain) else np.empty(0, np.uint8)
    else:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(path)
        with tempfile.TemporaryFile() as local, store.open_input_stream(at) as f:
            while piece := f.read(1 << 24):
                local.write(piece)
            local.flush()
            raw = np.memmap(local, dtype=np.uint8, mode="r") if local.tell() else np.empty(0, np.uint8)
    width = sum(np.dtype(k).itemsize for k in kinds.values())
    n, out, at = len(raw) // width, {}, 0
    for name, kind in kinds.items():
        size = n * np.dtype(kind).itemsize
        out[name] = raw[at:at + size].view(kind)
        at += size
    return out
