"""Vectorised kernels over batches of texts: words, 64-bit hashes, windows.

A batch is one byte buffer and the offsets of its documents, as Arrow holds it,
so that no Python object is made for a word. Hashes are polynomials over the
bytes of a word modulo 2**64 with random byte values, then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
STEP = 1 << 17
NO_ID = np.int64(2**63 - 1)
_rng = np.random.Generator(np.random.PCG64(20260101))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_WBASE = 0xD1342543DE82EF95
OTHER_BASE = 0xC2B2AE3D27D4EB4F
_U = np.uint64


def lut(seps: Iterable[int]) -> np.ndarray:
    """For each byte: does it belong to a word?"""
    out = np.ones(256, bool)
    out[list(seps)] = False
    return out


#: Words end at a blank or one of the ASCII controls 9 to 13.
WHITE = lut([0x20, *range(0x09, 0x0E)])
#: Words are made of ASCII letters and digits and of every byte that isn't ASCII.
ALNUM = lut([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = -(-n // STEP) * STEP  # kept by the worker, so hardly more than is needed
        out = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, _U)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=_U))
        got = _powers[base] = (out[0], out[1])
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def columns(batch: pa.RecordBatch, key: str, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (null: NO_ID), bytes and offsets of a batch; a null text is an empty one."""
    ids = batch.column(key).cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    arr = batch.column(text)
    if arr.null_count:
        arr = arr.fill_null("" if not pa.types.is_binary(arr.type) else b"")
    arr = arr.cast(pa.large_binary())
    n = len(arr)
    offs = np.frombuffer(arr.buffers()[1], np.int64, n + 1, arr.offset * 8) if n else np.zeros(1, np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return ids, buf[offs[0] : offs[-1]], offs - offs[0]


def chunks(ids: np.ndarray, buf: np.ndarray, offs: np.ndarray, most: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same in parts of about ``most`` bytes; a document is never cut."""
    lo, n = 0, len(ids)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield ids[lo:hi], buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def documents(batches: Iterable[pa.RecordBatch], key: str = "doc_id", text: str = "text", most: int = CHUNK):
    for batch in batches:
        if batch.num_rows:
            yield from chunks(*columns(batch, key, text), most)
            tidy()


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library: nothing to ask for
    _trim = None


def tidy() -> None:
    """Give memory back: workers live on, and what one task kept would count against the next."""
    _powers.clear()  # as long as the longest text so far, and quickly made again
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def words(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each document the index of its first word (and one index past the last)."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = is_word[buf]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    cut = offs[(offs > 0) & (offs < len(buf))]  # a word never runs into the next document
    first[cut] = w[cut]
    last[cut - 1] = w[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    p, q = powers(base, len(buf) + 1)
    h = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE[buf] * p[: len(buf)], out=h[1:])
    return mix((h[ends] - h[starts]) * q[starts] + _U(0x1234567))


def window_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` items of ``w``, documents not regarded: len(w) - n + 1 of them."""
    if len(w) < n:
        return np.zeros(0, _U)
    p, q = powers(_WBASE, len(w) + 1)
    h = np.zeros(len(w) + 1, _U)
    np.cumsum(w * p[: len(w)], out=h[1:])
    return mix((h[n:] - h[:-n]) * q[: len(w) - n + 1] + _U(n))


def doc_windows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each window of ``n`` words that lies in one document, and the document's index."""
    count = np.maximum(np.diff(first) - n + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    return spread(first[:-1], count), doc


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), then the same for the next."""
    total = int(count.sum())
    out = np.ones(total, np.int64)
    if not total:
        return out
    some = count > 0
    s, c = np.asarray(start)[some].astype(np.int64), np.asarray(count)[some]
    at = np.concatenate([[0], np.cumsum(c)[:-1]])
    out[at] = s
    out[at[1:]] -= s[:-1] + c[:-1] - 1
    return np.cumsum(out)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``length`` that begins at one of ``starts``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1) if len(starts) < 64 else d.__iadd__(np.bincount(starts, minlength=n + 1).astype(np.int32))
    stop = np.minimum(starts + length, n)
    d -= np.bincount(stop, minlength=n + 1).astype(np.int32)
    return np.cumsum(d[:-1]) > 0
