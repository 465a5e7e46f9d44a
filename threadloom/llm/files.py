"""Bytes made on the driver, shipped to every executor as files of the job."""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np


_shared: set[tuple[str, str]] = set()


def share(spark, content: bytes, label: str) -> str:
    """Ship ``content`` through ``addFile``; executors that join later get it as well.

    Returns the name to give to ``SparkFiles.get``.  It holds a hash of the
    content; equal content is shipped once in an application.
    """
    name = f"{label}-{hashlib.sha256(content).hexdigest()[:24]}"
    if (key := (spark.sparkContext.applicationId, name)) in _shared:
        return name
    path = os.path.join(tempfile.mkdtemp(prefix="threadloom-"), name)
    with open(path, "wb") as out:
        out.write(content)
    spark.sparkContext.addFile(path)
    _shared.add(key)
    return name


def pack(arrays: dict[str, np.ndarray]) -> tuple[bytes, list[tuple]]:
    """Arrays behind one another, and where each lies."""
    layout, parts, at = [], [], 0
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        raw += b"\0" * (-len(raw) % 64)
        layout.append((name, array.dtype.str, array.shape, at))
        parts.append(raw)
        at += len(raw)
    return b"".join(parts), layout


def unpack(path: str, layout: list[tuple]) -> dict[str, np.ndarray]:
    """The arrays of a shipped file, mapped: workers of one machine share its pages."""
    whole = np.memmap(path, np.uint8, "r")
    return {
        name: whole[at : at + int(np.prod(shape)) * np.dtype(kind).itemsize].view(kind).reshape(shape)
        for name, kind, shape, at in layout
    }
