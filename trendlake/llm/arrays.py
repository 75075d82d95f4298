"""Words of long texts and hashes of arrays, for operators that work on numpy arrays inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)
BREAK = re.compile(rb"[ \t\n\x0b\x0c\r]")
CHUNK = 1 << 20  # bytes of a text that are split into words together


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_chunks(data: bytes, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of ``data`` (what the bytes 0x20 and 0x09-0x0D separate), some at a time: a list of
    all words of a very long text would take many times its bytes."""
    at = 0
    while len(data) - at > size:
        cut = BREAK.search(data, at + size)
        if cut is None:
            break
        yield data[at : cut.start()].split()
        at = cut.end()
    yield (data[at:] if at else data).split()
