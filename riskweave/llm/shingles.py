"""Hashes of words and of 5-word shingles for whole batches of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LENGTH = 5
#: Text bytes handled at once; a longer text is handled alone. Arrays of some forty times as many bytes are held.
CHUNK = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = (int(x) * 2 + 1 for x in _rng.integers(2**61, 2**62, 2))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, *range(9, 14)]] = True


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread differences over all bits (a one-to-one map of 64-bit numbers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    space = _IS_SPACE[data]
    before = np.empty(len(space), dtype=bool)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & before)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.flatnonzero(space & ~before)
    lengths = ends - starts
    inside = ~space
    place = np.arange(len(data) - np.count_nonzero(space)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _BYTE[_FOLD[data[inside]]] * powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends_at])))
    return hashes, counts


def shingle_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the index of the text each comes from, repeated ones included.

    A text with fewer than ``LENGTH`` words, but one at least, has its whole sequence as one shingle.
    """
    words, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    found, owners = [], []
    n = len(words) - LENGTH + 1
    if n > 0:
        total = words[:n].copy()
        for k in range(1, LENGTH):
            total = total * np.uint64(_STEP) + words[k:n + k]
        whole = owner[:n] == owner[LENGTH - 1:]
        found.append(mix(total[whole]))
        owners.append(owner[:n][whole])
    first = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < LENGTH)):
        total = np.full(1, 7 + counts[i], dtype=np.uint64)
        for w in words[first[i]: first[i] + counts[i]]:
            total = total * np.uint64(_STEP) + w
        found.append(mix(total))
        owners.append(np.array([i]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def chunks(texts: list[str | None], most: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Encoded texts in groups of about ``most`` bytes, each with the index of its first text."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if held and size + len(b) > most:
            yield start, held
            start, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield start, held


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted by hash and then by text, and the texts' indexes (32 bits)."""
    parts = [(h, (o + start).astype(np.int32)) for start, group in chunks(texts) for h, o in [shingle_hashes(group)]]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    hashes, owners = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    del order
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
    return hashes[~same], owners[~same]
