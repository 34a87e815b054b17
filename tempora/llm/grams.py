"""Word and word-window hashes of Arrow text columns, vectorised over whole batches.

A word is a maximal run of bytes other than space and 0x09-0x0D; as those
are ASCII this equals ``[^\\x20\\x09-\\x0D]+`` on the decoded text.  Word
hashes and window hashes are Rabin-Karp polynomials modulo 2**64 taken from
prefix sums, followed by a bit mixer, so every window costs the same
whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD95 | 1
_MASK = (1 << 64) - 1
# bytes hashed at a time, so that the 64-bit work arrays stay small
CHUNK_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (grown and kept per process)."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up), np.cumprod(down))
        if size <= 4 * CHUNK_BYTES:
            _tables[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offs[0]:offs[-1]]
    return raw, offs - offs[0]


def byte_slices(offs: np.ndarray, limit: int):
    """Row ranges of at most about ``limit`` bytes (one row at least)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(raw: np.ndarray, offs: np.ndarray, lower: bool = False):
    """Hashes of all words, and where each row's words begin.

    Returns (hash, first): ``hash`` of each word in order, ``first`` of
    length rows + 1, words of row r being ``first[r]:first[r + 1]``.
    """
    space = _IS_SPACE[raw]
    begins = ~space
    ends = begins.copy()
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = offs[(offs > 0) & (offs < len(raw))]
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    del space, begins, ends
    first = np.searchsorted(start, offs)
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        # whole words within one chunk of bytes (one word at least)
        to = max(at + 1, int(np.searchsorted(stop, start[at] + CHUNK_BYTES, "right")))
        lo, hi = int(start[at]), int(stop[to - 1])
        up, down = _powers(_BYTE_BASE, hi - lo + 1)
        part = raw[lo:hi]
        part = (_LOWER[part] if lower else part).astype(np.uint64)
        part += np.uint64(1)
        part *= up[:hi - lo]
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(part, out=total[1:])
        s, e = start[at:to] - lo, stop[at:to] - lo
        h = (total[e] - total[s]) * down[s]
        out[at:to] = mix(h + (e - s).astype(np.uint64) * np.uint64(_WORD_BASE))
        at = to
    return out, first


def windows(word: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Rabin-Karp hash of words i .. i+k-1 for every i, across row borders too."""
    n = len(word)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(_WORD_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word * up[:n], out=total[1:])
    h = (total[k:] - total[:-k]) * down[:n - k + 1]
    return mix(h + np.uint64((k + salt * 0x9E3779B97F4A7C15) & _MASK))


def shingle_sets(word: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each row; fewer words: one shingle of all."""
    win = windows(word, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(win[a:b - k + 1]))
        elif b > a:
            out.append(windows(word[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of x[i .. i+k-1] for every i, by doubling."""
    if len(x) < k:
        return x[:0]
    span, m = 1, x
    while 2 * span <= k:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = k - span
    return m if rest == 0 else np.minimum(m[:len(m) - rest], m[rest:])


def sequence_digests(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each row's whole word sequence."""
    n = len(word)
    up, down = _powers(_WORD_BASE, n + 1)
    a, b = first[:-1], first[1:]
    size = (b - a).astype(np.uint64)
    out = []
    for salt in (0, 0x9E3779B97F4A7C15):
        w = word if not salt else mix(word + np.uint64(salt))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(w * up[:n], out=total[1:])
        out.append(mix((total[b] - total[a]) * down[a] + mix(size + np.uint64(salt | 1))))
    return out[0], out[1]


def span_hashes(word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of words begin .. end-1 for each span."""
    n = len(word)
    up, down = _powers(_WORD_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word * up[:n], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + mix((end - begin).astype(np.uint64)))


def byte_spans(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of bytes begin .. end-1 for each span."""
    up, down = _powers(_BYTE_BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    h = (total[end] - total[begin]) * down[begin]
    return mix(h + (end - begin).astype(np.uint64) * np.uint64(_WORD_BASE))
