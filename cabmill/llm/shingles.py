"""Word shingles of whole texts as 62-bit hashes, computed for many texts at once in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_PIECE = 1 << 20  # bytes hashed at once; only the working set depends on it
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BYTE[_SPACE] = 0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a buffer."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(
        np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]]))
    )
    word_place = np.where(space, 0, place)
    powers = np.full(int(word_place.max()) + 1, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat(_BYTE[data] * powers[word_place], starts)
    return starts, _mixed(sums)


def _cut(text: bytes) -> Iterator[bytes]:
    """Pieces of a long text, each ending before white space."""
    at = 0
    while len(text) - at > _PIECE:
        end = at + _PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _shingled(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingle hashes of one text's words, ascending; below 2**62."""
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = out * _STEP + words[j : n - width + 1 + j]
    return np.unique((_mixed(out) >> np.uint64(2)).view(np.int64))


def shingle_sets(texts: list[bytes | None], size: int = 5) -> Iterator[np.ndarray]:
    """For each text its set of shingles. White space is space, tab, LF, VT, FF and CR; only A-Z
    are lower-cased. Fewer words than ``size`` make one shingle; no words (null too) make none."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total < _PIECE):
            total += len(texts[end] or b"")
            end += 1
        if end == at + 1 and total > _PIECE:
            yield _shingled(
                np.concatenate([_words(np.frombuffer(p, np.uint8))[1] for p in _cut(texts[at])]), size
            )
        else:
            part = [t or b"" for t in texts[at:end]]
            starts, words = _words(np.frombuffer(b" ".join(part) + b" ", np.uint8))
            ends = np.cumsum([len(t) + 1 for t in part])
            cuts = [0, *np.searchsorted(starts, ends)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield _shingled(words[a:b], size)
        at = end


def word_hashes(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the hashes of its words in order (at least 0), and a number for the last two
    bytes of each, A-Z lower-cased."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total < _PIECE):
            total += len(texts[end])
            end += 1
        if end == at + 1 and total > _PIECE:
            parts = [_ended_words(p + b" ") for p in _cut(texts[at])]
            yield np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        else:
            starts, words, endings = _ended_words(b" ".join(texts[at:end]) + b" ")
            ends = np.cumsum([len(t) + 1 for t in texts[at:end]])
            cuts = [0, *np.searchsorted(starts, ends)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield words[a:b], endings[a:b]
        at = end


def _ended_words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    starts, words = _words(data)
    space = _SPACE[data]
    stop = np.flatnonzero(space[1:] & ~space[:-1])  # last bytes of words
    folded = _FOLD[data]
    before = np.where(stop > starts, folded[np.maximum(stop - 1, 0)], 0).astype(np.int64)
    return starts, (words >> np.uint64(1)).view(np.int64), before * 31 + folded[stop]


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
