"""Words of many texts at once, as hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd multipliers of the hash.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _word_chars() -> np.ndarray:
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts in order, as 64-bit hashes, and the place of the text of each."""
    return words_laid_out([t.lower() for t in texts])[:2]


def lowered(text: str) -> str:
    """The text in lower case, with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([c.lower() if len(c.lower()) == 1 else c for c in text])


def words_laid_out(lowered_texts: list[str]) -> tuple[np.ndarray, ...]:
    """Words, the place of the text of each, their starts and ends in all texts together, where texts start, characters.

    Words are lower-case runs of letters and digits. A word's hash sums its
    characters times the powers of a constant. Texts stand a line end apart.
    """
    bounds = np.cumsum([0, *[len(t) + 1 for t in lowered_texts]])
    chars = np.frombuffer("\n".join(lowered_texts).encode("utf-32-le"), "<u4")
    inside = _word_chars()[chars]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none, bounds, chars
    places, lengths = np.flatnonzero(inside), ends - starts
    firsts = np.cumsum(lengths) - lengths
    power = np.multiply.accumulate(np.full(int(lengths.max()), STEP))
    offsets = np.arange(len(places)) - np.repeat(firsts, lengths)
    words = scrambled(np.add.reduceat((chars[places].astype(np.uint64) + MIX) * power[offsets], firsts))
    return words, np.searchsorted(bounds[1:], starts, side="right"), starts, ends, bounds, chars
