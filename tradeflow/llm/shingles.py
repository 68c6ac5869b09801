"""Hashed word shingles of many texts at once.

Words are runs of characters other than ASCII white space, with A-Z lower-cased.
A word's 64-bit hash is a sum of its bytes times fixed random numbers by place, a
shingle's is a sum of its words' hashes times others, each mixed at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHARS = 1_000_000
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
# The hash's own numbers: equal on every machine and in every run.
_PLACES = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 1 << 12, np.uint64) | np.uint64(1)
_BY_WORD = np.random.Generator(np.random.PCG64(4242)).integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in a row, and each text's number of words."""
    raw = [t.encode().lower() for t in texts]
    joined = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    blank = BLANK[joined]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), counts
    owner = np.cumsum(first) - 1
    place = np.arange(len(joined)) - starts[np.maximum(owner, 0)]
    far = place >= len(_PLACES)
    number = _PLACES[place % len(_PLACES)]
    if far.any():  # words beyond 4096 bytes: every lap gets other numbers
        number[far] = mix(number[far] + place[far].astype(np.uint64))
    value = (joined.astype(np.uint64) + np.uint64(1)) * number
    value[blank] = 0
    return mix(np.add.reduceat(value, starts)), counts


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text. A text with fewer words is
    one shingle; without any word it has none."""
    hashes, counts = word_hashes(texts)
    total = len(hashes)
    rolled = np.zeros(max(0, total - words + 1), np.uint64)
    for i in range(words):
        rolled += hashes[i : i + len(rolled)] * _BY_WORD[i]
    rolled = mix(rolled)
    at = 0
    for n in counts.tolist():
        if n >= words:
            yield np.unique(rolled[at : at + n - words + 1])
        elif n:
            short = (hashes[at : at + n] * _BY_WORD[words + np.arange(n)]).sum(dtype=np.uint64)
            yield mix(np.array([short + np.uint64(n)]))
        else:
            yield np.empty(0, np.uint64)
        at += n


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def batches_of(batch: pa.RecordBatch, column: int, chars: int = CHARS) -> Iterator[pa.RecordBatch]:
    """Slices with about ``chars`` characters of text each."""
    low = size = 0
    for i, text in enumerate(batch.column(column)):
        size += len(text.as_py() or "")
        if size >= chars:
            yield batch.slice(low, i + 1 - low)
            low, size = i + 1, 0
    if low < batch.num_rows:
        yield batch.slice(low)
