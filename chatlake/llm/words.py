"""Words of many texts at once: where they stand in a buffer of bytes, and a 64-bit hash of each.

Texts are taken as UTF-8 and in slices of about ``SLICE`` bytes (a longer text is a slice of its own), so memory
follows the longest text, not the batch.  A-Z count as a-z in the hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD, SPACE, BREAK = 0, 1, 2
SLICE, LONG = 1 << 20, 48
_MIX = np.uint64(0x9E3779B97F4A7C15)


def kinds(space: bytes, breaks: bytes = b"") -> np.ndarray:
    """For each byte whether it belongs to words, stands between words or also ends a piece."""
    out = np.zeros(256, np.uint8)
    out[list(space)] = SPACE
    out[list(breaks)] = BREAK
    return out


ASCII_SPACE = kinds(b"\x20\x09\x0a\x0b\x0c\x0d")


def _letters() -> np.ndarray:
    table = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)
    table[65:91] = table[97:123]
    return table


LETTERS = _letters()


def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of runs of texts; text i of a run is bytes[offsets[i]:offsets[i + 1]], null as empty."""
    plain = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(plain):
        return
    _, offsets, data = plain.buffers()
    offsets = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(plain):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield whole[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first): text i holds the words first[i] to first[i + 1] - 1."""
    inside = np.zeros(len(buf) + 1, bool)
    inside[:-1] = kind[buf] == WORD
    edge = np.zeros(len(buf) + 1, bool)  # a text begins here
    edge[offsets] = True
    before = np.zeros(len(buf) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, hashes(buf, starts, ends), np.searchsorted(starts, offsets)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h, length = np.zeros(len(starts), np.uint64), ends - starts
    left = np.arange(len(starts))
    for p in range(min(LONG, int(length.max(initial=0)))):
        left = left[length[left] > p]
        x = (h[left] ^ LETTERS[buf[starts[left] + p]]) * _MIX
        h[left] = x ^ (x >> np.uint64(32))
    for i in np.flatnonzero(length > LONG):
        h[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes().lower(), digest_size=8).digest(), "little")
    return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
