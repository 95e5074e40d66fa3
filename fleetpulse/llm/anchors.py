"""Sampled positions of a text that equal strings share, and hashes of its substrings.

A window of ``WINDOW`` bytes is represented by the one of its ``GRAM``-byte strings with the
smallest hash, the leftmost of equals. Equal windows choose the same one, wherever they stand,
and neighbouring windows mostly agree: about one position in 35 is chosen.
"""

import numpy as np

from fleetpulse.llm.common import mixed

WINDOW = 100
GRAM = 32
REACH = WINDOW - GRAM + 1
STRIDE = 1 << 16
PLACE = np.uint64((1 << 17) - 1)

_seeds = np.random.default_rng(20240301)
LETTERS = _seeds.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
RADIX = int(_seeds.integers(1 << 61, 1 << 62)) * 4 + 3
_length = STRIDE + WINDOW + 1


def powers(base):
    """base ** k modulo 2 ** 64 for k up to a stride's length."""
    out = np.full(_length, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


UP = powers(RADIX)
DOWN = powers(pow(RADIX, -1, 1 << 64))


def prefix_hashes(data):
    """Running polynomial hash of the bytes, one more entry than bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTERS[data] * UP[:len(data)], out=sums[1:])
    return sums


def substring_hashes(sums, starts, ends):
    return mixed((sums[ends] - sums[starts]) * DOWN[starts])


def strides(data):
    """(start, part) of a long text; each window is in exactly one part."""
    for start in range(0, max(1, len(data) - WINDOW + 1), STRIDE):
        yield start, data[start:start + STRIDE + WINDOW - 1]


def anchors(data):
    """Of each run of windows with one anchor: anchor, first and last window, gram hash, context hash.

    The context is all bytes of the run's windows; its hash holds the anchor's place in it.
    """
    found = []
    for start, part in strides(data):
        if len(part) < WINDOW:
            break
        sums = prefix_hashes(part)
        at = np.arange(len(part) - GRAM + 1)
        grams = substring_hashes(sums, at, at + GRAM)
        keys = (grams & ~PLACE) | at.astype(np.uint64)
        width = 1
        while width * 2 <= REACH:
            keys = np.minimum(keys[:-width], keys[width:])
            width *= 2
        if width < REACH:
            keys = np.minimum(keys[:-(REACH - width)], keys[REACH - width:])
        chosen = (keys & PLACE).astype(np.int64)
        low = np.flatnonzero(np.diff(chosen, prepend=-1))
        high = np.append(low[1:], len(chosen)) - 1
        anchor = chosen[low]
        shape = ((anchor - low) << 7 | (high - low)).astype(np.uint64)
        context = mixed(substring_hashes(sums, low, high + WINDOW) + shape)
        found.append((anchor + start, low + start, high + start, grams[anchor], context))
    if not found:
        return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
    return [np.concatenate(c) for c in zip(*found)]


def window_hashes(data, low, high):
    """Hashes of the windows low..high of a text, taken from their bytes alone."""
    out = []
    for a in range(low, high + 1, STRIDE):
        part = data[a:min(high, a + STRIDE - 1) + WINDOW]
        at = np.arange(len(part) - WINDOW + 1)
        out.append(substring_hashes(prefix_hashes(part), at, at + WINDOW))
    return np.concatenate(out)
