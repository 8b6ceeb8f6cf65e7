"""Words, shingles and tokens of whole texts, on bytes.

A text is handled as UTF-8 bytes, so text that isn't valid UTF-8 needs no decoding, and only A-Z is
lower-cased. A null text is an empty one.
"""

import numpy as np
from pyspark.sql import functions as F

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = bytes(range(ord("0"), ord("9") + 1))
_PLAIN = bytes(
    c if c >= 0x80 or c in _LETTERS or c in _DIGITS else (c + 32 if chr(c).isupper() else 32)
    for c in range(256)
)


def text_bytes(column="text"):
    """The text as bytes, empty if null; Arrow hands bytes over without decoding them."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def plain_words(data):
    """Lower-cased runs of letters, digits and anything outside ASCII."""
    return data.translate(_PLAIN).split()


def spaced_words(data):
    """Lower-cased runs of anything but white space."""
    return data.lower().split()


_SPACE_BYTES = np.zeros(256, dtype=bool)
_SPACE_BYTES[[9, 10, 11, 12, 13, 32]] = True
_GOLDEN = 0x9E3779B97F4A7C15


def mix(x):
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n, seed):
    """n odd 64-bit numbers, the same on every machine."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLDEN) + np.uint64(seed)
    return mix(steps) | np.uint64(1)


_BY_PLACE = multipliers(256, 17)
_BY_WORD = multipliers(64, 91)


def word_hashes(data):
    """A 64-bit hash of each word of lower-cased bytes, in order.

    Every byte is weighted by its place in its word. Places past 256 start over and count the rounds,
    so the time is linear in the text whatever the lengths of its words.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    inside = ~_SPACE_BYTES[raw]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    letters = raw[inside].astype(np.uint64) + np.uint64(1)
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(letters)) - np.repeat(firsts, lengths)
    weight = _BY_PLACE[place & 255]
    if lengths.max() > 256:
        weight = mix(weight + (place >> 8).astype(np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
    sums = np.add.reduceat(letters * weight, firsts)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(_GOLDEN))


def window_hashes(words, width):
    """A hash of each window of `width` hashed words; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    by_word = _BY_WORD if width <= len(_BY_WORD) else multipliers(width, 91)
    if n < width:
        weights = by_word[:n]
        return mix(np.array([(words * weights).sum() + np.uint64(n)], dtype=np.uint64))
    total = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * by_word[i]
    return mix(total)


def shingle_set(data, width=5):
    """Sorted distinct hashes of the word shingles of a text."""
    return np.unique(window_hashes(word_hashes(data.lower()), width))
