"""Static range asymmetric numeral system over token ids, interleaved in lanes.

Symbol ``i`` of a block belongs to lane ``i % lanes``; one step codes one symbol of
each lane with array arithmetic. A lane's state lies in [2^31, 2^63) and moves
32-bit words. A checkpoint holds all lane states and the place in the words, so that
decoding can start there.

A block, all numbers little-endian:

    magic "RNS1" | lanes u16 | precision u16 | steps between checkpoints u32
    | symbols u32 | words u32 | checkpoints u32 | crc32 of the ids u32
    | per checkpoint: first word u32, states u64 * lanes
    | words u32 * words | crc32 of all before u32
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RNS1"
PRECISION = 20
LANES = 1024
CHECKPOINT_STEPS = 256

_HEAD = struct.Struct("<4sHHIIIII")
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_WORD_MASK = np.uint64(0xFFFFFFFF)


class DamagedBlock(ValueError):
    """A block whose checksum or header does not hold."""


def frequencies(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Scale counts by symbol to a sum of 2^precision; a symbol that occurs keeps one at least."""
    total = int(counts.sum())
    seen = np.count_nonzero(counts)
    if not total:
        return np.zeros(len(counts), dtype=np.uint32)
    if seen > 1 << precision:
        raise ValueError("more symbols than the precision can tell apart")
    exact = counts.astype(np.float64) * ((1 << precision) / total)
    scaled = np.where(counts > 0, np.maximum(np.floor(exact), 1), 0).astype(np.int64)
    spare = (1 << precision) - int(scaled.sum())
    if spare > 0:
        scaled[int(np.argmax(scaled))] += spare
    while spare < 0:  # rare symbols were rounded up: take it from the frequent ones
        largest = np.argsort(-scaled, kind="stable")[: max(1, min(-spare, seen))]
        largest = largest[scaled[largest] > 1]
        scaled[largest] -= 1
        spare += len(largest)
    return scaled.astype(np.uint32)


class Model:
    """The frequency table all blocks share."""

    def __init__(self, freq: np.ndarray, precision: int = PRECISION):
        self.precision = precision
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(
                np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64)
            )
        return self._slots


def encode_block(
    ids: np.ndarray, model: Model, lanes: int = LANES, every: int = CHECKPOINT_STEPS
) -> bytes:
    lanes = max(1, min(lanes, len(ids)))
    steps = -(-len(ids) // lanes)
    precision = np.uint64(model.precision)
    limit = np.uint64(63 - model.precision)
    freq, start = model.freq.take(ids), model.start.take(ids)
    if len(ids) and not freq.all():
        raise ValueError("a symbol without frequency")
    bound, rest = freq << limit, (np.uint64(1) << precision) - freq
    state = np.full(lanes, _LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    saved: list[tuple[int, bytes]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        place = slice(step * lanes, (step + 1) * lanes)
        f = freq[place]
        x = state[: len(f)]
        full = np.flatnonzero(x >= bound[place])
        if len(full):
            large = x[full]
            words.append((large & _WORD_MASK).astype("<u4"))
            written += len(full)
            x[full] = large >> _WORD
        x += (x // f) * rest[place] + start[place]  # quotient and remainder anew, and the start
        if step % every == 0:
            saved.append((written, state.astype("<u8").tobytes()))
    body = b"".join(
        struct.pack("<I", written - before) + states for before, states in reversed(saved)
    ) + b"".join(w.tobytes() for w in reversed(words))
    head = _HEAD.pack(
        MAGIC, lanes, model.precision, every, len(ids), written, len(saved),
        zlib.crc32(ids.astype("<u4").tobytes()),
    )
    block = head + body
    return block + struct.pack("<I", zlib.crc32(block))


def decode_block(block: bytes, model: Model) -> np.ndarray:
    """The ids of a block; every checksum is compared."""
    head = _opened(block)
    ids = np.concatenate(
        [np.empty(0, np.uint32)] + [decode_part(block, model, k) for k in range(head[6])]
    )
    if len(ids) != head[4] or zlib.crc32(ids.astype("<u4").tobytes()) != head[7]:
        raise DamagedBlock("the ids do not have the block's checksum")
    return ids


def decode_part(block: bytes, model: Model, checkpoint: int) -> np.ndarray:
    """The ids from one checkpoint to the next."""
    _, lanes, bits, every, count, n_words, checkpoints, _ = _HEAD.unpack_from(block)
    if bits != model.precision:
        raise DamagedBlock("the block was written with another precision")
    at = _HEAD.size + checkpoint * (4 + 8 * lanes)
    (next_word,) = struct.unpack_from("<I", block, at)
    state = np.frombuffer(block, "<u8", lanes, at + 4).astype(np.uint64)
    words = np.frombuffer(block, "<u4", n_words, _HEAD.size + checkpoints * (4 + 8 * lanes))
    words = words[next_word : next_word + every * lanes].astype(np.uint64)  # a word a symbol at most
    next_word = 0
    precision, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    slots = model.slots
    first = checkpoint * every * lanes
    last = min(count, first + every * lanes)
    out = np.empty(last - first, dtype=np.uint32)
    for place in range(0, last - first, lanes):
        x = state[: min(lanes, last - first - place)]
        slot = x & mask
        symbol = slots.take(slot.view(np.int64)).astype(np.intp)
        out[place : place + len(x)] = symbol
        x >>= precision
        x *= model.freq.take(symbol)
        x += slot
        x -= model.start.take(symbol)
        short = np.flatnonzero(x < _LOW)
        if len(short):
            x[short] = (x[short] << _WORD) | words[next_word : next_word + len(short)]
            next_word += len(short)
    return out


def _opened(block: bytes) -> tuple:
    if len(block) < _HEAD.size + 4 or block[:4] != MAGIC:
        raise DamagedBlock("not a block")
    if zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise DamagedBlock("the block does not have its checksum")
    return _HEAD.unpack_from(block)
