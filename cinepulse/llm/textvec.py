"""Vectorised hashing of words and character n-grams, in numpy, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Text handled at once: arrays of eight bytes per input byte stay near 10 MB each.
BLOCK_BYTES = 1 << 18

_rng = np.random.default_rng(0x5EED)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over all 64."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _block_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word (run of bytes that are not ASCII white space)."""
    raw = np.frombuffer(data, np.uint8)
    space = np.empty(len(raw) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = IS_SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    up, down = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, U64)
    np.cumsum(BYTE_CODE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64)), starts


def word_hashes(data: bytes) -> np.ndarray:
    """Word hashes of one text of any length, in blocks cut at white space."""
    if len(data) <= BLOCK_BYTES:
        return _block_words(data)[0]
    out, at = [], 0
    while at < len(data):
        stop = at + BLOCK_BYTES
        while stop < len(data) and not IS_SPACE[data[stop]]:
            stop += 1
        out.append(_block_words(data[at:stop])[0])
        at = stop
    return np.concatenate(out)


def grouped(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``BLOCK_BYTES`` together (a longer text is alone)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts and, per text, where its words begin (one more entry at the end)."""
    if len(texts) == 1:
        words = word_hashes(texts[0])
        return words, np.array([0, len(words)])
    words, starts = _block_words(b"\n".join(texts))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words, np.searchsorted(starts, offsets)
