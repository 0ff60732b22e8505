"""Segments of strings that near strings share, for the blocked fuzzy join.

A string that may differ from a partner by ``k`` edits is cut into ``k + 1``
segments; one of them stands unchanged in the partner, moved by at most ``k``
places.  A segment's key is a hash of its characters, of the partner's length
and of its place there, both in steps of about an eighth of the length: the
one side gives a segment the keys of all lengths and places that a partner
may have, the other looks up all its windows of the widths in use.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEPS = 3  # length and place in steps of the length's power of two, divided by two to the power of this
CHUNK = 1 << 19  # characters hashed at once
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def step(n: int) -> int:
    return max(1, (1 << n.bit_length() - 1) >> STEPS) if n else 1


def length_class(n: int) -> int:
    """A number of the lengths of one step."""
    return n.bit_length() << 32 | n // step(n)


def key_of(hashes: np.ndarray, width: int, classes, places) -> np.ndarray:
    h = (hashes + np.uint64(width)) * M2 ^ np.asarray(classes, np.uint64) * M3 + np.asarray(places, np.uint64)
    h = (h ^ h >> np.uint64(32)) * M1
    return h ^ h >> np.uint64(29)


def windows(codes: np.ndarray, widths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of all windows of each width."""
    h = np.zeros(len(codes), np.uint64)
    for w in range(1, max(widths, default=0) + 1):
        n = len(codes) - w + 1
        if n <= 0:
            return
        h = (h[:n] ^ h[:n] >> np.uint64(29)) * M1 + codes[w - 1 :]
        if w in widths:
            yield w, h


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)


def given(s: str, k: int) -> tuple[int, list[int], list[int]]:
    """The width of the segments of ``s``, and the keys and places of all that a partner may hold, for up to ``k`` edits."""
    n = len(s)
    width = n // (k + 1)
    starts = [j * n // (k + 1) for j in range(k + 1)]
    h = next(windows(_codes([s]), [width]))[1][starts]
    sizes = {length_class(m): step(m) for m in range(n - k, n + k + 1)}
    of, classes, at, places = [], [], [], []
    for c, by in sizes.items():
        for j, p in enumerate(starts):
            for place in range(max(0, p - k) // by, (p + k) // by + 1):
                of.append(j)
                classes.append(c)
                at.append(place)
                places.append(p)
    return width, key_of(h[of], width, classes, at).view(np.int64).tolist(), places


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHUNK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def looked_up(texts: list[str], widths: list[int], table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, place) of all windows of the texts whose key is in the bitmap ``table``."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    by = np.array([step(n) for n in lengths.tolist()], np.int64)
    classes = np.array([length_class(n) for n in lengths.tolist()], np.uint64)
    of = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(of)) - starts[of]
    left = lengths[of] - place
    at, classes = place // by[of], classes[of]
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for w, h in windows(_codes(texts), widths):
        key = key_of(h, w, classes[: len(h)], at[: len(h)])
        hit = np.flatnonzero(in_table(key, table, bits) & (left[: len(h)] >= w))
        found.append((of[hit], key[hit].view(np.int64), place[hit]))
    return tuple(np.concatenate(c) for c in zip(*found))


def in_table(keys: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    slot = keys & np.uint64((1 << bits) - 1)
    return (table[(slot >> np.uint64(6)).view(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def lists(rows: int, of: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """The values of each of ``rows`` rows as lists; ``of``: their rows, in any order."""
    order = np.argsort(of, kind="stable")
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))]), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(v[order], pa.int64())) for v in values]
