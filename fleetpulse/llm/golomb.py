"""Golomb codes of sorted integers, with a power of two as divisor.

Quotients of the gaps are written in unary and remainders in plain binary, in
two separate streams, so that both directions work on whole arrays.
"""

import struct

import numpy as np

HEAD = "<IBI"  # count, bits of the divisor, bytes of the unary stream


def divisor_bits(span, count):
    """log2 of the divisor for ``count`` values spread evenly over ``span``."""
    return max(0, int(span // max(count, 1)).bit_length() - 1)


def encode(values, start, span):
    """Sorted distinct uint64 values in [start, start + span) as bytes."""
    if not len(values):
        return struct.pack(HEAD, 0, 0, 0)
    gaps = np.diff(values, prepend=np.uint64(start)).astype(np.uint64)
    bits = divisor_bits(span, len(values))
    ends = np.cumsum((gaps >> np.uint64(bits)).astype(np.int64) + 1)
    unary = np.ones(ends[-1], np.uint8)
    unary[ends - 1] = 0
    shifts = np.arange(bits, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(unary).tobytes()
    return struct.pack(HEAD, len(values), bits, len(packed)) + packed + np.packbits(rest.ravel()).tobytes()


def decode(code, start):
    """The values that ``encode`` was given."""
    count, bits, length = struct.unpack_from(HEAD, code)
    if not count:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(code, np.uint8, offset=struct.calcsize(HEAD))
    ends = np.flatnonzero(np.unpackbits(raw[:length]) == 0)[:count]
    gaps = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1) << np.uint64(bits)
    if bits:
        rest = np.unpackbits(raw[length:], count=count * bits).reshape(count, bits)
        gaps += rest.astype(np.uint64) @ (np.uint64(1) << np.arange(bits, dtype=np.uint64))
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(start)
