"""Named numpy arrays in one file of the shared folder, memory-mapped when read."""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np

_ALIGN = 64


def _local(uri: str) -> str | None:
    u = urlparse(uri)
    return unquote(u.path) if u.scheme in ("", "file") else None


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write ``name`` under ``folder`` in one step: a repeated or speculative task
    replaces the file by an equal one, and no reader sees a part of it."""
    head, at = {}, 0
    for key, a in arrays.items():
        head[key] = (a.dtype.str, list(a.shape), at)
        at += -(-a.nbytes // _ALIGN) * _ALIGN
    top = json.dumps(head).encode()
    top = len(top).to_bytes(8, "little") + top
    top += b" " * (-len(top) % _ALIGN)
    blocks = [top]
    for a in arrays.values():
        blocks += [np.ascontiguousarray(a).tobytes(), bytes(-a.nbytes % _ALIGN)]
    path, part = _local(folder), f"_{name}.{uuid.uuid4().hex}"
    if path is not None:
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{part}", "wb") as f:
            f.writelines(blocks)
        os.replace(f"{path}/{part}", f"{path}/{name}")
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{part}") as f:
        for b in blocks:
            f.write(b)
    store.move(f"{path}/{part}", f"{path}/{name}")


def read_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file: views of a read-only memory map where the folder is
    a mounted path, else of one block of memory."""
    path = _local(folder)
    if path is not None:
        data = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        with store.open_input_file(f"{path}/{name}") as f:
            data = np.frombuffer(f.read(), np.uint8)
    n = int.from_bytes(data[:8].tobytes(), "little")
    start = -(-(8 + n) // _ALIGN) * _ALIGN
    out = {}
    for key, (kind, shape, at) in json.loads(data[8:8 + n].tobytes()).items():
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[key] = np.asarray(data[start + at:start + at + size]).view(kind).reshape(shape)
    return out
