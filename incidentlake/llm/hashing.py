"""Word hashes of whole texts without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 20
BATCH = 1 << 16  # bytes that are hashed at a time if texts allow it, so that the arrays stay in the processor's cache
_BASE = 0x9E3779B97F4A7C15
#: Turns everything in ASCII but letters and digits into spaces.
PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_BLANK = bytes(int(b in (9, 10, 11, 12, 13, 32)) for b in range(256))
_POWERS: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _POWERS:
        codes = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            powers = np.full(PIECE + 1, base, np.uint64)
            powers[0] = 1
            _POWERS.append(np.multiply.accumulate(powers))
        _POWERS.append(codes)
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of at most PIECE bytes."""
    powers, inverse, codes = _tables()
    blank = np.frombuffer(b"\1" + data.translate(_BLANK) + b"\1", np.bool_)
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, stops = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes.take(np.frombuffer(data, np.uint8)) * powers[:len(data)], out=sums[1:])
    return starts, mixed((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))


def word_hash(word: bytes) -> int:
    """The same hash of one word of any length."""
    powers, _, codes = _tables()
    total, shift = 0, 1
    for k in range(0, len(word), PIECE):
        part = np.frombuffer(word[k:k + PIECE], np.uint8)
        total += int((codes[part] * powers[:len(part)]).sum(dtype=np.uint64)) * shift
        shift = shift * pow(_BASE, PIECE, 1 << 64) % (1 << 64)
    return int(mixed(np.array([(total + len(word)) % (1 << 64)], np.uint64))[0])


def word_hashes(texts: Iterable[str | None], table: bytes | None = None) -> Iterator[np.ndarray]:
    """Of each text, the hashes of its words in order; A-Z count as a-z, words stand between white space.

    ``table`` (as for ``bytes.translate``) may turn more bytes into spaces.
    """
    waiting: list[bytes] = []
    size = 0

    def done() -> Iterator[np.ndarray]:
        if waiting:
            starts, hashes = _hashed(b" ".join(waiting))
            ends = np.cumsum([len(w) + 1 for w in waiting])
            yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))
            waiting.clear()

    for text in texts:
        raw = (text or "").encode().lower()
        if table:
            raw = raw.translate(table)
        if size + len(raw) >= BATCH - len(waiting):
            yield from done()
            size = 0
        if len(raw) >= PIECE:  # rare: word by word, for want of longer tables
            known: dict[bytes, int] = {}
            yield np.array([known[w] if w in known else known.setdefault(w, word_hash(w)) for w in raw.split()], np.uint64)
            continue
        waiting.append(raw)
        size += len(raw)
    yield from done()
