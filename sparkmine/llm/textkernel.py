"""Vectorised word and window hashes over Arrow text batches.

Used inside ``mapInArrow`` tasks.  A word is ``[^\\x20\\x09-\\x0D]+``; texts stay
UTF-8 bytes, so the whole batch is handled by a few NumPy passes and no Python
string is built per word.  A word hash is a 64-bit polynomial of its bytes
(prefix sums over the batch), finished with a 64-bit mixer; a window hash is a
linear combination of its word hashes, finished the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text bytes handled at once (a longer text is a chunk of its own): bounds the scratch arrays.
CHUNK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_COEF = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_powers: dict[str, np.ndarray] = {}


def _power(n: int, inverse: bool) -> np.ndarray:
    """base**i (or its inverse mod 2**64) for i < n, grown on demand."""
    key = "inv" if inverse else "pow"
    have = _powers.get(key)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        p = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        p[0] = 1
        have = _powers[key] = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (bijective for a fixed salt)."""
    x = x + U64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Chunk:
    """Some consecutive texts of a batch: rows lo..hi, their bytes and offsets."""

    def __init__(self, lo: int, hi: int, buf: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.buf, self.offsets = lo, hi, buf, offsets

    def drop_punctuation(self) -> "Chunk":
        """ASCII punctuation removed from the bytes."""
        keep = ~_PUNCT[self.buf]
        at = np.concatenate(([0], np.cumsum(keep)))
        return Chunk(self.lo, self.hi, self.buf[keep], at[self.offsets])

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text index within the chunk) of every word."""
        buf, offsets = self.buf, self.offsets
        n = len(buf)
        if not n:
            z = np.zeros(0, dtype=np.int64)
            return z, z, z
        word = ~_WS[buf]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:n]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1

    def words(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(64-bit hash, text index) of every word, in order."""
        starts, ends, doc = self.spans()
        n = len(self.buf)
        acc = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_LOWER if lower else _BYTE)[self.buf] * _power(n, False), out=acc[1:]) if n else None
        h = (acc[ends] - acc[starts]) * _power(n + 1, True)[starts]
        return mix(h), doc

    def counts(self, doc: np.ndarray) -> np.ndarray:
        """Words of each text of the chunk."""
        return np.bincount(doc, minlength=self.hi - self.lo)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """Cut a string column into chunks of at most ``limit`` bytes or one text;
    a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield Chunk(lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every k-word window within one text."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        acc += h[j : j + m] * _COEF[j]
    at = np.flatnonzero(doc[:m] == doc[k - 1 :])
    return at, mix(acc[at], k)


def shingle_sets(chunk: Chunk, k: int = 5, lower: bool = True):
    """Per text of the chunk: its distinct k-word shingles as a sorted uint64
    array; the whole word sequence as one shingle when it has fewer words."""
    h, doc = chunk.words(lower)
    n = chunk.counts(doc)
    end = np.cumsum(n)
    at, w = windows(h, doc, k)
    m = np.maximum(n - k + 1, 0)
    wend = np.cumsum(m)
    for i in range(chunk.hi - chunk.lo):
        if m[i]:
            yield np.unique(w[wend[i] - m[i] : wend[i]])
        elif n[i]:
            own = h[end[i] - n[i] : end[i]]
            yield mix(np.array([int(np.sum(own * _COEF[: len(own)], dtype=np.uint64))], dtype=np.uint64), 100 + int(n[i]))
        else:
            yield np.zeros(0, dtype=np.uint64)
