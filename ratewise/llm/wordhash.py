"""64-bit hashes of all words of a batch of texts in a few numpy passes, alike in every process.

A word is a maximal run of non-space bytes of the lowercased text (spaces: ASCII white space), or with
``letters_only`` of bytes that are letters, digits or above ASCII. Its hash is a polynomial over its
bytes, taken from running sums and mixed; memory is bounded by cutting the batch between words."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_tables: list[np.ndarray] = []


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size = max(n, CHUNK + 4096)
        with np.errstate(over="ignore"):
            for base, at in ((_P, 0), (_P_INVERSE, 1)):
                t = np.full(size, base, np.uint64)
                t[0] = 1
                _tables[at:at + 1] = [np.multiply.accumulate(t)]
    return _tables[0], _tables[1]


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_SYMBOLS = np.ones(256, bool)
_SYMBOLS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def hash_raw(raw: list[bytes], letters_only: bool = False):
    """(hashes, first byte, end byte, offsets, buffer) of all words of UTF-8 texts, as they are."""
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    gap = (_SYMBOLS if letters_only else _SPACES)[buf]
    hashes, firsts, lasts, at = [], [], [], 0
    while at < len(buf):
        stop = min(len(buf), at + CHUNK)
        if stop < len(buf) and not gap[stop - 1]:
            stop = stop + 1 + int(np.argmax(gap[stop:]))  # to the end of the word: the buffer ends in a gap
        g = gap[at:stop]
        turn = np.flatnonzero(np.diff(np.concatenate(([True], g, [True])).view(np.int8)))
        s, e = turn[::2], turn[1::2]
        power, inverse = _powers(len(g) + 1)
        with np.errstate(over="ignore"):
            run = np.zeros(len(g) + 1, np.uint64)
            np.cumsum((buf[at:stop].astype(np.uint64) + np.uint64(1)) * power[:len(g)], out=run[1:])
            hashes.append(mix64((run[e] - run[s]) * inverse[s] + (e - s).astype(np.uint64)))
        firsts.append(s + at)
        lasts.append(e + at)
        at = stop
    none = np.zeros(0, np.int64)
    first = np.concatenate([*firsts, none])
    offsets = np.concatenate(([0], np.searchsorted(first, ends))).astype(np.int64)
    return np.concatenate([*hashes, none.astype(np.uint64)]), first, np.concatenate([*lasts, none]), offsets, buf


def hash_words(texts: list[str | None], letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, offsets): text i has hashes[offsets[i]:offsets[i + 1]]."""
    h, _, _, offsets, _ = hash_raw([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts], letters_only)
    return h, offsets


def text_batches(texts: list, limit: int = CHUNK):
    """(start, end) ranges of consecutive texts of about ``limit`` characters in all, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
