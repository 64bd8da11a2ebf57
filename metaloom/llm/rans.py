"""Static range asymmetric numeral system over whole numbers, many lanes side by side in numpy.

Symbol i of a block belongs to lane i mod lanes. A lane's state is a 64-bit number kept in [2^31, 2^63) by moving
32-bit words out and in. All lanes of a block share one stream of words; a checkpoint holds the states and the place
in the stream before a step, so that decoding can begin there.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 2048
BLOCK = 1 << 20
CHECKPOINT_STEPS = 256

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_HEAD = struct.Struct("<7I")
_MAGIC = 0x424E4152


class Corrupt(ValueError):
    """A block or file that breaks the format."""


class Table:
    """Frequencies scaled to a power of two; every symbol that occurs has at least one slot."""

    def __init__(self, symbols: np.ndarray, slots: np.ndarray, bits: int):
        self.symbols, self.slots, self.bits = symbols.astype(np.uint32), slots.astype(np.uint64), bits
        self.starts = np.concatenate([[0], np.cumsum(self.slots)[:-1]]).astype(np.uint64) if len(slots) else np.zeros(0, np.uint64)
        if len(slots) and int(self.slots.sum()) != 1 << bits:
            raise Corrupt("the slots don't fill the table")
        self.rank = np.full(int(self.symbols.max()) + 1 if len(symbols) else 0, -1, np.int64)
        self.rank[self.symbols] = np.arange(len(symbols))
        self._owner = None

    @property
    def owner(self) -> np.ndarray:
        """The rank of the symbol that each slot belongs to."""
        if self._owner is None:
            self._owner = np.repeat(np.arange(len(self.slots), dtype=np.uint32), self.slots.astype(np.int64))
        return self._owner

    @classmethod
    def of(cls, symbols: list[int], counts: list[int]) -> Table:
        """From counts. Slots are counts scaled down, at least one; the most frequent settle the difference."""
        order = np.argsort(np.array(symbols, np.int64), kind="stable")
        numbers, n = np.array(symbols, np.int64)[order], np.array(counts, np.float64)[order]
        if not len(n):
            return cls(numbers, np.zeros(0), 0)
        bits = min(24, max(16, int(len(n)).bit_length() + 5))
        slots = np.maximum(1, np.floor(n / n.sum() * (1 << bits))).astype(np.int64)
        off = (1 << bits) - int(slots.sum())
        for i in np.argsort(-slots, kind="stable").tolist():
            change = max(off, 1 - int(slots[i]))
            slots[i] += change
            off -= change
            if not off:
                break
        return cls(numbers, slots, bits)

    def to_bytes(self) -> bytes:
        body = struct.pack("<II", self.bits, len(self.symbols)) + self.symbols.astype("<u4").tobytes() + self.slots.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        if len(data) < 12 or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise Corrupt("the frequency table's checksum differs")
        bits, n = struct.unpack_from("<II", data)
        numbers = np.frombuffer(data, "<u4", 2 * n, 8)
        return cls(numbers[:n], numbers[n:], bits)


def encode(symbols: np.ndarray, table: Table, lanes: int = LANES, checkpoint_steps: int = CHECKPOINT_STEPS) -> bytes:
    """One block, independent of all others."""
    n = len(symbols)
    lanes = max(1, min(lanes, n // 64))
    rank = table.rank[symbols] if n else np.zeros(0, np.int64)
    slots, starts = table.slots[rank], table.starts[rank]
    bits = np.uint64(table.bits)
    limits = slots << np.uint64(63 - table.bits)
    state = np.full(lanes, _LOW, np.uint64)
    out, sent, held = [], 0, []
    steps = -(-n // lanes)
    for k in range(steps - 1, -1, -1):
        f, c = slots[k * lanes : (k + 1) * lanes], starts[k * lanes : (k + 1) * lanes]
        x = state[: len(f)]
        over = np.flatnonzero(x >= limits[k * lanes : (k + 1) * lanes])
        if len(over):
            words = x[over]
            out.append(words[::-1].astype(np.uint32))
            sent += len(words)
            x[over] = words >> _WORD
        whole = x // f
        # whole * 2^bits + the rest + the start, where the rest is x - whole * f
        x += whole * ((np.uint64(1) << bits) - f)
        x += c
        if k and k % checkpoint_steps == 0:
            held.append((sent, state.copy()))
    stream = np.concatenate(out)[::-1] if out else np.zeros(0, np.uint32)
    parts = [state.astype("<u8").tobytes()]
    for before, states in reversed(held):
        parts += [struct.pack("<I", sent - before), states.astype("<u8").tobytes()]
    payload = b"".join(parts) + stream.astype("<u4").tobytes()
    head = _HEAD.pack(_MAGIC, n, lanes, checkpoint_steps, len(stream), zlib.crc32(symbols.astype("<u4").tobytes()), zlib.crc32(payload))
    return head + payload


def block_size(head: bytes) -> tuple[int, int]:
    """Symbols and payload bytes of the block with this head."""
    if len(head) < _HEAD.size:
        raise Corrupt("a block is cut off")
    magic, n, lanes, every, words, _, _ = _HEAD.unpack_from(head)
    if magic != _MAGIC or not lanes or not every:
        raise Corrupt("no block begins here")
    marks = max(0, -(-(-(-n // lanes)) // every) - 1)
    return n, 8 * lanes + marks * (4 + 8 * lanes) + 4 * words


HEAD_BYTES = _HEAD.size


def decode(data: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The symbols [first, last) of a block, begun at the checkpoint before; a whole block's checksum is compared."""
    n, size = block_size(data)
    _, _, lanes, every, words, crc, payload_crc = _HEAD.unpack_from(data)
    if len(data) != HEAD_BYTES + size:
        raise Corrupt("a block is cut off")
    if zlib.crc32(memoryview(data)[HEAD_BYTES:]) != payload_crc:
        raise Corrupt("a block's checksum differs")
    last = n if last is None else last
    steps, to = -(-n // lanes), -(-last // lanes)
    mark = first // lanes // every if steps else 0
    at = HEAD_BYTES + (mark * (4 + 8 * lanes) if mark else 0)
    place = struct.unpack_from("<I", data, at - 4 + 0)[0] if mark else 0
    state = np.frombuffer(data, "<u8", lanes, at).astype(np.uint64)
    stream = np.frombuffer(data, "<u4", words, len(data) - 4 * words).astype(np.uint64)
    begin = mark * every
    out = np.empty(max(0, min(to * lanes, n) - begin * lanes), np.uint32)
    mask, bits, owner, slots, starts = np.uint64((1 << table.bits) - 1), np.uint64(table.bits), table.owner, table.slots, table.starts
    for k in range(begin, to):
        x = state[: min(lanes, n - k * lanes)]
        slot = x & mask
        rank = owner[slot]
        out[(k - begin) * lanes : (k - begin) * lanes + len(x)] = rank
        x = slots[rank] * (x >> bits) + slot - starts[rank]
        low = np.flatnonzero(x < _LOW)
        if (taken := len(low)):
            x[low] = (x[low] << _WORD) | stream[place : place + taken]
            place += taken
        state[: len(x)] = x
    found = table.symbols[out]
    if first == 0 and last == n:
        if zlib.crc32(found.astype("<u4").tobytes()) != crc or (n and (state != _LOW).any()):
            raise Corrupt("a block's symbols differ from those encoded")
    return found[first - begin * lanes : last - begin * lanes]
