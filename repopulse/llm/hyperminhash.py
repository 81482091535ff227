"""Sketches of sets of 64-bit hashes: one register a bucket, compressed.

A register holds the smallest hash of its bucket as the number of its leading zeros and
the ten bits after the first one; two registers with equal content hold equal minima but
for rare collisions, whose expected number is taken off the estimate. An empty bucket
borrows the register of the first full one in an order of its own, the same for all sets,
so that registers of small sets agree as often as the sets do, too.
"""

from __future__ import annotations

import numpy as np

REGISTERS = 128
BAND_ROWS = 4
BANDS = REGISTERS // BAND_ROWS
MANTISSA_BITS = 10
_VALUE_BITS = 52
_BUCKET_BITS = REGISTERS.bit_length() - 1
# The order in which each bucket asks the others, from a fixed generator.
LENDERS = np.argsort(
    np.random.Generator(np.random.PCG64(2)).random((REGISTERS, REGISTERS)), axis=1
)
# Of two random minima with rates x and y, x y / (x + y)^2 times this collide.
COLLISION = 0.68 / (1 << MANTISSA_BITS)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers (u16) of a set, not empty, of unsigned 64-bit hashes."""
    bucket = hashes & np.uint64(REGISTERS - 1)
    value = (hashes >> np.uint64(_BUCKET_BITS)) & np.uint64((1 << _VALUE_BITS) - 1)
    placed = np.sort((bucket << np.uint64(_VALUE_BITS)) | value)
    bucket = (placed >> np.uint64(_VALUE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = placed[first] & np.uint64((1 << _VALUE_BITS) - 1)
    fraction, exponent = np.frexp(least.astype(np.float64))
    mantissa = np.clip((2 * fraction - 1) * (1 << MANTISSA_BITS), 0, None).astype(np.int64)
    out = np.zeros(REGISTERS, dtype="<u2")
    full = np.zeros(REGISTERS, dtype=bool)
    full[bucket[first]] = True
    out[full] = ((_VALUE_BITS - exponent) << MANTISSA_BITS) | mantissa
    empty = np.flatnonzero(~full)
    if len(empty):
        asked = LENDERS[empty]
        out[empty] = out[asked[np.arange(len(empty)), full[asked].argmax(axis=1)]]
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """The registers of each band as one signed 64-bit number."""
    return sketch.view("<i8")


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray):
    """Jaccard estimates of rows of registers, and how many of them count as independent."""
    equal = (a == b).sum(axis=1)
    chance = REGISTERS * COLLISION * size_a * size_b / (size_a + size_b) ** 2
    found = np.clip((equal - chance) / (REGISTERS - chance), 0, 1)
    # The buckets that a set of the smaller size fills; the others borrow.
    smaller = np.minimum(size_a, size_b)
    return found, REGISTERS * (1 - np.exp(-smaller / REGISTERS))
