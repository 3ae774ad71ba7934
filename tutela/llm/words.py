"""Words of Arrow text columns as numpy arrays.

A word is a maximal run of bytes other than space and the control characters 0x09 to 0x0D.
These never occur inside a multi-byte UTF-8 character, so the work is done on bytes, a few
megabytes of text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) \
        -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about ``limit`` bytes; one longer text is one slice."""
    ends = _offsets(batch.column(column))[1:]
    at, n = 0, batch.num_rows
    while at < n:
        begin = ends[at - 1] if at else _offsets(batch.column(column))[0]
        to = max(at + 1, int(np.searchsorted(ends, begin + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], dtype=kind) if texts.buffers()[1] else np.zeros(1, kind)
    return raw[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end and the offset of each text; a null text is empty."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = _offsets(texts)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else \
        np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass(frozen=True)
class Words:
    """``data[starts[i]:ends[i]]`` is word i; text d has the words ``first[d]`` to ``first[d+1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """For each word, the place of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, seed)


def split(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text; ``lower`` maps the ASCII letters A-Z to small ones first."""
    data, offsets = text_bytes(texts)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    n = len(data)
    inside = np.ones(n, bool)
    inside[(data == 32) | ((data >= 9) & (data <= 13))] = False
    # a text's first byte begins a word even where the text before it ends inside one
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_known: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers; a usual number of them is kept for the next call."""
    have = _known.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * BLOCK_BYTES), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * BLOCK_BYTES:
            _known[int(base)] = have
    return have[:n]


LANED_BYTES = 64  # spans of up to so many bytes are hashed and compared eight bytes at a time
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number (zeros beyond the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) \
        -> np.ndarray:
    """A 64-bit hash of each byte span under a key drawn from ``seed``.

    Every eight bytes are mixed into the state, which the key has scattered, so no text collides by
    its form whatever the key; longer spans than ``LANED_BYTES`` take a keyed byte hash. Where a
    result rests on equality, draw the seed anew for each run or compare bytes (``same_spans``).
    """
    sizes = ends - starts
    key = mix(np.array([seed % (1 << 64)], np.uint64) + np.uint64(0xD1B54A32D192ED03))[0]
    out = mix(sizes.astype(np.uint64) ^ key)
    eights, at = _eights(data), 0
    live = np.flatnonzero((sizes > 0) & (sizes <= LANED_BYTES))
    while len(live):
        left = sizes[live] - at
        lane = eights[starts[live] + at] & _MASKS[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ lane) * _BASE + key)
        at += 8
        live = live[left > 8]
    word = int(key).to_bytes(8, "little")
    for i in np.flatnonzero(sizes > LANED_BYTES):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, key=word)
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray,
               other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each span of ``data`` has the bytes of its partner in ``other``."""
    sizes = ends - starts
    same = sizes == other_ends - other_starts
    mine, theirs, at = _eights(data), _eights(other), 0
    live = np.flatnonzero(same & (sizes > 0) & (sizes <= LANED_BYTES))
    while len(live):
        left = sizes[live] - at
        differ = (mine[starts[live] + at] ^ theirs[other_starts[live] + at]) \
            & _MASKS[np.minimum(left, 8)]
        same[live[differ != 0]] = False
        at += 8
        live = live[(left > 8) & (differ == 0)]
    for i in np.flatnonzero(same & (sizes > LANED_BYTES)):
        same[i] = np.array_equal(data[starts[i]:ends[i]], other[other_starts[i]:other_ends[i]])
    return same


def gram_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes (one fewer than ``size`` shorter)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(seed), np.uint64)
    for i in range(size):
        total = (total ^ words[i:i + n]) * _BASE
        total ^= total >> np.uint64(29)
    return mix(total)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """As ``gram_hashes``, for long runs: prefix sums in place of one step for each word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(_BASE, len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _powers(_INVERSE, n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in log2(width) passes."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def within(first: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of the ``total - size + 1`` runs of words lie in one text."""
    n = max(0, total - size + 1)
    inside = np.ones(n, bool)
    for edge in np.unique(first[1:-1]):
        inside[max(0, edge - size + 1):min(edge, n)] = False
    return inside
