"""Statistics of one text, taken from its UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_BLANK = b"\t\n\x0b\x0c\r "
_INNER = bytes(range(0x80, 0xC0))  # second and later bytes of a character
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_HIGH = bytes(range(0x80, 0x100))
_STOPS = (b".", b"!", b"?", b'."', b'!"', b'?"')

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_distinct_words",
    "n_upper", "n_lower", "n_digits", "n_high", "n_plain_words", "n_stops", "n_bangs", "n_bytes",
)


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Number of words inside windows that occur twice or more, exact for any length."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    base, runs, size = code, code, 1
    while size < window:
        grow = size if 2 * size <= window else 1
        m = len(words) - size - grow + 1
        ends = runs if grow == size else base
        pair = runs[:m] * np.int64(len(words) + 1) + ends[size : size + m]
        _, runs, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(counts) == m:
            return 0
        size += grow
    edges = np.zeros(len(words) + 1, np.int64)
    twice = np.nonzero(counts[runs] > 1)[0]
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def _plain(word: bytes) -> bool:
    """Whether a word is letters, and at most punctuation at its end."""
    left = word.rstrip(b".,;:!?").translate(None, _HIGH)
    return left.isalpha() or not left


def statistics(text: bytes) -> tuple[int, ...]:
    """Values of ``NAMES``. Words are runs of non-blank bytes, lines those with a word."""
    words = text.split()
    without = lambda drop: len(text) - len(text.translate(None, drop))
    lines = [x for x in text.split(b"\n") if x.strip()]
    distinct = set(words)
    return (
        len(words),
        len(text.translate(None, _INNER + _BLANK)),
        without(_SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(x.rstrip().endswith(_STOPS) for x in lines),
        len(distinct),
        without(_UPPER),
        without(_LOWER),
        without(_DIGITS),
        without(_HIGH),
        sum(_plain(w) for w in distinct),
        without(b".?,;:"),
        without(b"!"),
        len(text),
    )
