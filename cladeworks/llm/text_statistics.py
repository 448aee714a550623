"""Statistics of whole texts, for many texts at once."""

from __future__ import annotations

import numpy as np

from .words import SOLID, Words, runs

#: Byte classes; every byte is of one.
LOWER, UPPER, DIGIT, BLANK, LINE, STOP, SHOUT, BAR, MARK, QUOTE, OTHER, HIGH = range(12)
_CLASS = np.full(256, OTHER, np.int64)
for _kind, _chars in (
    (LOWER, b"abcdefghijklmnopqrstuvwxyz"),
    (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (DIGIT, b"0123456789"),
    (BLANK, b" \t\r\x0b\x0c"),
    (LINE, b"\n"),
    (STOP, b".,;:?"),
    (SHOUT, b"!"),
    (BAR, b"|"),
    (MARK, b"#*$%&<>"),
    (QUOTE, b"\"'()-"),
):
    _CLASS[list(_chars)] = _kind
_CLASS[128:] = HIGH

NAMES = (
    "log_words", "log_bytes", "word_bytes", "upper", "digit", "stop", "shout", "bar", "mark", "quote", "other", "high", "blank",
    "words_per_line", "repeated_lines", "repeated_runs", "distinct_words", "distinct_in_square_root", "long_words", "short_words",
)

_NOT_LINE = np.ones(256, bool)
_NOT_LINE[10] = False


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes of each owner."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    first = np.ones(len(o), bool)
    first[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[first], minlength=n)


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of NAMES for each text; a null counts as empty."""
    n = len(texts)
    if not n:
        return np.zeros((0, len(NAMES)))
    w = Words(texts, SOLID, lower=False)
    data = np.frombuffer(w.data, np.uint8)
    spans = np.diff(w.text_begin)
    counts = np.bincount(np.repeat(np.arange(n) * 12, spans) + _CLASS[data], minlength=12 * n).reshape(n, 12)[:n]
    counts[:, LINE] -= 1  # the separator
    size = np.maximum(spans - 1, 1)
    owner, words = w.owner(), np.diff(w.offsets)
    lines = Words(texts, _NOT_LINE, lower=False)
    n_lines = np.diff(lines.offsets)
    run, whole = runs(w.hashes, w.offsets, 5)
    n_runs = np.bincount(owner[whole], minlength=n)
    length = w.end - w.begin
    per = lambda a, b: a / np.maximum(b, 1)
    distinct = _distinct(owner, w.hashes, n)
    return np.column_stack([
        np.log1p(words), np.log1p(spans - 1), per(np.bincount(owner, length, n), words),
        *(counts[:, k] / size for k in (UPPER, DIGIT, STOP, SHOUT, BAR, MARK, QUOTE, OTHER, HIGH, BLANK)),
        per(words, n_lines), 1 - per(_distinct(lines.owner(), lines.hashes, n), n_lines) * (n_lines > 0) - (n_lines == 0),
        (n_runs > 0) - per(_distinct(owner[whole], run[whole], n), n_runs), per(distinct, words), distinct / np.sqrt(np.maximum(words, 1)),
        per(np.bincount(owner, length > 20, n), words), per(np.bincount(owner, length <= 3, n), words),
    ]).astype(float)
