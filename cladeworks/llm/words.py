"""Words of many texts at once, as 64-bit hashes in flat numpy arrays."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240613)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of lower-cased words: digits, a to z, and all of other scripts.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of words between white space.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        m = 1 << (n - 1).bit_length()
        _POWERS = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, p, np.uint64)]), dtype=np.uint64) for p in (_P, _INVERSE))
    return _POWERS


_POWERS = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


class Words:
    """hashes[offsets[k]:offsets[k + 1]] are the words of text k; begin and end are byte positions in data."""

    def __init__(self, texts: list[str | None], kind: np.ndarray = ALNUM, lower: bool = True):
        raw = [(t or "").encode() for t in texts]
        data = b"\n".join(raw) + b"\n"
        self.data = data.lower() if lower else data
        a = np.frombuffer(self.data, np.uint8)
        inside = kind[a]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        self.begin, self.end = edges[0::2], edges[1::2]
        up, down = _powers(4096)
        # a polynomial over each byte's random number, block by block so that powers stay few
        sums = np.empty(len(a) + 1, np.uint64)
        sums[0] = 0
        place = np.resize(up[:4096], len(a))
        np.cumsum(_BYTE[a] * place, out=sums[1:])
        size = self.end - self.begin
        total = sums[self.end] - sums[self.begin]
        phase = self.begin & 4095
        wraps = np.flatnonzero(phase + size > 4096)
        hashes = total * down[phase]
        for i in wraps.tolist():  # a word across a block's border
            w = a[self.begin[i] : self.end[i]]
            hashes[i] = (_BYTE[w] * np.resize(up[:4096], len(w))).sum(dtype=np.uint64) if len(w) <= 4096 else _long(w, up)
        self.hashes = mix(hashes + size.astype(np.uint64) * _P)
        ends = np.cumsum(np.array([len(r) + 1 for r in raw], np.int64))
        self.offsets = np.concatenate([[0], np.searchsorted(self.begin, ends)])
        self.text_begin = np.concatenate([[0], ends])

    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def _long(word: np.ndarray, up: np.ndarray) -> np.uint64:
    total = np.uint64(0)
    with np.errstate(over="ignore"):
        for at in range(0, len(word), 4096):
            part = word[at : at + 4096]
            total = total * up[4095] * _P + (_BYTE[part] * up[: len(part)]).sum(dtype=np.uint64)
    return total


def runs(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of n words from every word on, and whether those n words are all of one text."""
    total = len(hashes)
    out = np.zeros(total, np.uint64)
    for j in range(n):
        out[: total - j] = mix(out[: total - j] + hashes[j:] * np.uint64(2 * j + 1)) if total > j else out[: total - j]
    last = np.repeat(offsets[1:], np.diff(offsets))
    return out, np.arange(total) + n <= last
