"""Word shingles as numbers: white space cuts words, A to Z are lowered, other characters stay as they are."""

from __future__ import annotations

from functools import cache

MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(h):
    """A bijection of 64-bit numbers that spreads every bit (on an array, in place)."""
    import numpy as np

    h ^= h >> np.uint64(30)
    h *= np.uint64(MIX[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX[1])
    h ^= h >> np.uint64(31)
    return h


@cache
def _tables():
    """Of each byte: whether white space, and a random number (equal for a letter's cases)."""
    import numpy as np

    white = np.zeros(256, bool)
    white[[32, *range(9, 14)]] = True
    number = np.random.default_rng(64).integers(1, 2**63, 256).astype(np.uint64)
    number[65:91] = number[97:123]
    return white, number


def word_hashes(text: str):
    """A 64-bit hash for each word."""
    import numpy as np

    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    white, number = _tables()
    inside = np.concatenate([[False], ~white[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    size = ends - starts
    body = data[starts[0]:]
    starts = starts - starts[0]
    place = np.arange(len(body)) - np.repeat(starts, np.diff(np.append(starts, len(body))))
    power = np.full(int(size.max()) + 1, 0x5851F42D4C957F2D, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    term = number[body] * power[np.minimum(place, len(power) - 1)]
    term[white[body]] = 0
    return mixed(np.add.reduceat(term, starts) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str, words: int):
    """The distinct shingles of so many words, ascending; of fewer words, all of them as one."""
    import numpy as np

    h = word_hashes(text)
    if not len(h):
        return h
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - width + 1 + k]
    return np.unique(mixed(out))
