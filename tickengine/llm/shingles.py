"""Word hashes and shingle hashes of many texts at once, by prefix sums over their bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all others."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _U(seed))


class Rolling:
    """Hashes of any piece of a byte string: sums of byte values times powers of a base."""

    def __init__(self, seed: int):
        self.base = _U(seed | 5)  # odd, 5 modulo 8 or so: powers do not repeat early
        self.inverse = _U(pow(int(self.base), -1, 1 << 64))
        self.values = _byte_values(seed | 1)
        self.powers = np.ones(1, dtype=_U)
        self.inverses = np.ones(1, dtype=_U)

    def _upto(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << int(n - 1).bit_length()
            steps = np.full(size, self.base, dtype=_U)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = self.inverse
            self.inverses = np.multiply.accumulate(steps)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        """Prefix sums; one more than there are bytes."""
        self._upto(len(raw) + 1)
        made = np.zeros(len(raw) + 1, dtype=_U)
        np.cumsum(self.values[raw] * self.powers[: len(raw)], out=made[1:])
        return made

    def pieces(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each ``raw[start:end]``, the same wherever the piece stands."""
        return mix((sums[end] - sums[start]) * self.inverses[start] + (end - start).astype(_U))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_PUNCTUATION = _SPACE.copy()
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_words = Rolling(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Words of a run of texts: place in the joined bytes, hash, and each text's first word."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more than there are texts
    raw: np.ndarray  # the joined bytes, with A-Z as a-z


def read_words(texts: list[bytes], punctuation: bool = True) -> Words:
    """Words are runs without blanks and control spaces; A-Z count as a-z.

    Without ``punctuation``, ASCII signs stand between words as well.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    gap = (_SPACE if punctuation else _PUNCTUATION)[raw]
    raw = _LOWER[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[1], gap.view(np.int8), [1]])))
    start, end = edge[::2], edge[1::2]
    sums = _words.sums(raw)
    offset = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Words(start, end, _words.pieces(sums, start, end), np.searchsorted(start, offset), raw)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of fewer words, the whole run; of none, nothing."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=_U)
    count = max(1, n - size + 1)
    made = np.full(count, min(n, size), dtype=_U)
    for i in range(min(n, size)):
        made = mix(made * _U(0x9E3779B97F4A7C15) + words[i : i + count])
    return made


def chunks(values: list[str | None], most: int = 1_000_000):
    """Texts as bytes, in runs of at most ``most`` bytes, or one longer text."""
    run, size = [], 0
    for value in values:
        raw = (value or "").encode()
        if run and size + len(raw) > most:
            yield run
            run, size = [], 0
        run.append(raw)
        size += len(raw) + 1
    if run:
        yield run
