"""Words of many texts as numpy arrays: one pass over the bytes, no Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)

#: Bytes 0x09-0x0D and 0x20 end a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Digits, ASCII letters and all bytes of other characters make a word.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a missing text is empty."""
    return pc.fill_null(column, "").cast(pa.large_binary()).to_pylist()


def blocks(rows: list, size=len, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes together."""
    begin = total = 0
    for i, row in enumerate(rows):
        if i > begin and total + size(row) > limit:
            yield begin, i
            begin, total = i, 0
        total += size(row)
    if begin < len(rows):
        yield begin, len(rows)


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of rows of about BLOCK_BYTES together, with their texts as UTF-8; only one range
    is held as Python objects at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for lo, hi in blocks(sizes, size=lambda n: n):
        yield lo, hi, utf8(column.slice(lo, hi - lo))


@dataclass
class Words:
    """Words of several texts. ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def text(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split(texts: list[bytes], word_bytes: np.ndarray, lower: bool = False) -> Words:
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[1:] = word_bytes[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    return Words(data, starts, ends, np.searchsorted(starts, begins))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and their inverses, at least ``n``."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1024)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of 64-bit codes: differences of one running sum, shifted to zero."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(words: Words) -> np.ndarray:
    """Hashes that deal words out. Equal words have equal ones; so may different words."""
    return span_hashes(_BYTE_CODES[words.data], words.starts, words.ends)


def word_array(words: Words) -> pa.LargeBinaryArray:
    """The words themselves, end to end in one Arrow array."""
    sizes = words.ends - words.starts
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    data = np.ascontiguousarray(words.data[ragged(words.starts, sizes)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def word_codes(words: Words) -> np.ndarray:
    """Number of each word among the distinct ones: equal numbers are equal words."""
    return word_array(words).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def equal_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the span of ``a`` and that of ``b`` hold the same values, place by place."""
    differ = a[ragged(a_starts, lengths)] != b[ragged(b_starts, lengths)]
    return sums_by(np.concatenate([[0], np.cumsum(lengths)]), differ) == 0


def sums_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each range ``first[i]:first[i + 1]``."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
