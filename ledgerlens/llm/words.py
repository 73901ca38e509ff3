"""Tokens of a block of text by number, found with Arrow's dictionary encoding.

Looking every occurrence up in a Python dict costs several cache misses a
word; here only the distinct tokens of a block ever become Python objects."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = 32


def ended(block: bytes) -> np.ndarray:
    """The tokens of ``block``, which spaces divide, each with one space after it."""
    raw = np.frombuffer(block + b" ", np.uint8)
    space = raw == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    return raw[keep]


def distinct(raw: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Number of each token of ``ended`` bytes, and the distinct ones, with their spaces."""
    offsets = np.r_[0, np.flatnonzero(raw == SPACE) + 1].astype(np.int64)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    found = tokens.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def coded(block: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Tokens of ``block``, which spaces divide: the number of each in order
    of appearance, and the distinct ones by number."""
    at, tokens = distinct(ended(block))
    return at, [x[:-1] for x in tokens.to_pylist()]
