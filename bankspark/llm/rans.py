"""Static range asymmetric numeral system over blocks of ids.

One frequency table serves all blocks of a segment.  A block codes its ids in interleaved lanes: lane l
holds ids l, l + LANES, ...; each lane has a 64-bit state in [2^31, 2^63) that moves 32-bit words in and
out.  All lanes of all blocks advance together in numpy.  A block stores its lanes' states at the start
and at every ``CHECKPOINT`` steps with the place in the word stream, so decoding may begin at any
checkpoint, and a CRC-32 over everything else in it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE_BITS = 20
LANES = 256
FEW_LANES = 8       # in blocks of fewer than LANES * 16 ids
BLOCK_IDS = 1 << 16
CHECKPOINT = 128    # steps
_LOW = 1 << 31
_HEAD = struct.Struct("<4sIHHI")  # magic, ids, lanes, checkpoints, words
_MAGIC = b"RTB1"


class Table:
    """Quantised frequencies (sum 2^SCALE_BITS) of the symbols that occur."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray):
        self.symbols, self.freq = symbols.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.of_slot = np.repeat(np.arange(len(symbols), dtype=np.int32), freq.astype(np.int64))

    @classmethod
    def of_ids(cls, ids: np.ndarray) -> Table:
        symbols, counts = np.unique(ids, return_counts=True)
        total = 1 << SCALE_BITS
        if len(symbols) > total // 2:
            raise ValueError("more distinct ids than the frequency scale holds")
        freq = np.maximum(1, counts * (total - len(symbols)) // counts.sum())
        freq[np.argmax(freq)] += total - freq.sum()
        return cls(symbols, freq)

    def to_bytes(self) -> bytes:
        return zlib.compress(struct.pack("<I", len(self.symbols)) + np.diff(self.symbols, prepend=np.uint32(0))
                             .astype("<u4").tobytes() + self.freq.astype("<u4").tobytes(), 1)

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        data = zlib.decompress(data)
        n = struct.unpack_from("<I", data)[0]
        values = np.frombuffer(data, "<u4", offset=4)
        return cls(np.cumsum(values[:n], dtype=np.uint32), values[n:])


def _lanes(n: int) -> int:
    return LANES if n >= LANES * 16 else FEW_LANES


def encode(ids: np.ndarray, table: Table, block_ids: int = BLOCK_IDS) -> list[bytes]:
    """Blocks of ``block_ids`` ids; the last may be shorter."""
    full = len(ids) // block_ids
    out = _encode(ids[:full * block_ids].reshape(full, block_ids), table) if full else []
    rest = ids[full * block_ids:]
    return out + (_encode(rest.reshape(1, -1), table) if len(rest) else [])


def _encode(ids: np.ndarray, table: Table) -> list[bytes]:
    blocks, n = ids.shape
    lanes = _lanes(n)
    steps = -(-n // lanes)
    code = np.searchsorted(table.symbols, ids.astype(np.uint32))
    code = np.concatenate([code, np.full((blocks, steps * lanes - n), int(np.argmax(table.freq)))], axis=1)
    code = code.reshape(blocks, steps, lanes).transpose(1, 0, 2)
    state = np.full((blocks, lanes), _LOW, np.uint64)
    words = np.zeros((steps, blocks, lanes), np.uint32)
    moved = np.zeros((steps, blocks, lanes), bool)
    saved: dict[int, np.ndarray] = {}
    shift, room = np.uint64(32), np.uint64((_LOW >> SCALE_BITS) << 32)
    for t in range(steps - 1, -1, -1):
        freq = table.freq[code[t]]
        out = state >= room * freq
        words[t], moved[t] = state.astype(np.uint32), out  # low 32 bits
        state = np.where(out, state >> shift, state)
        whole = state // freq
        state = (whole << np.uint64(SCALE_BITS)) + (state - whole * freq) + table.start[code[t]]
        if t % CHECKPOINT == 0:
            saved[t] = state
    before = np.cumsum(moved.sum(axis=2), axis=0) - moved.sum(axis=2)
    result = []
    for b in range(blocks):
        stream = words[:, b][moved[:, b]]
        marks = sorted(saved)
        body = (_HEAD.pack(_MAGIC, n, lanes, len(marks), len(stream))
                + b"".join(struct.pack("<II", t, int(before[t, b])) + saved[t][b].astype("<u8").tobytes()
                           for t in marks)
                + stream.astype("<u4").tobytes())
        result.append(body + struct.pack("<I", zlib.crc32(body)))
    return result


def decode(blocks: list[bytes], table: Table, checkpoint: int = 0) -> list[np.ndarray]:
    """Ids of each block, from the given checkpoint on; raises ValueError if a checksum is wrong."""
    out: list[np.ndarray | None] = [None] * len(blocks)
    alike: dict[tuple[int, int], list[int]] = {}
    for i, b in enumerate(blocks):
        if len(b) < _HEAD.size + 4 or zlib.crc32(b[:-4]) != struct.unpack("<I", b[-4:])[0] or b[:4] != _MAGIC:
            raise ValueError(f"block {i} is damaged")
        _, n, lanes, _, _ = _HEAD.unpack_from(b)
        alike.setdefault((n, lanes), []).append(i)
    for (n, lanes), members in alike.items():
        for i, ids in zip(members, _decode([blocks[i] for i in members], n, lanes, table, checkpoint)):
            out[i] = ids
    return out  # type: ignore[return-value]


def _decode(blocks: list[bytes], n: int, lanes: int, table: Table, checkpoint: int) -> np.ndarray:
    steps = -(-n // lanes)
    state = np.empty((len(blocks), lanes), np.uint64)
    place = np.empty(len(blocks), np.int64)
    streams, base, first = [], 0, 0
    for k, b in enumerate(blocks):
        _, _, _, marks, count = _HEAD.unpack_from(b)
        if checkpoint >= marks:
            raise ValueError("no such checkpoint")
        at = _HEAD.size + checkpoint * (8 + 8 * lanes)
        first, skip = struct.unpack_from("<II", b, at)
        state[k] = np.frombuffer(b, "<u8", lanes, at + 8)
        place[k] = base + skip
        streams.append(np.frombuffer(b, "<u4", count, _HEAD.size + marks * (8 + 8 * lanes)))
        base += count
    words = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
    codes = np.empty((steps - first, len(blocks), lanes), np.int32)
    mask, bits = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    low, shift = np.uint64(_LOW), np.uint64(32)
    for t in range(steps - first):
        slot = state & mask
        code = table.of_slot[slot]
        codes[t] = code
        state = table.freq[code] * (state >> bits) + slot - table.start[code]
        need = state < low
        if need.any():
            order = np.cumsum(need, axis=1)
            at = (place[:, None] + order - 1)[need]
            state[need] = state[need] << shift | words[at]
            place += order[:, -1]
    return table.symbols[codes.transpose(1, 0, 2).reshape(len(blocks), -1)[:, :n - first * lanes]]


def crc32_combine(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings joined, from their CRCs and the length of the second (public zlib method:
    the first CRC is advanced over ``length`` zero bytes by squaring the one-bit operator)."""
    operator = [0xEDB88320] + [1 << n for n in range(31)]  # one zero bit

    def times(matrix: list[int], vector: int) -> int:
        total, n = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[n]
            vector >>= 1
            n += 1
        return total

    bits = length * 8
    while bits:
        if bits & 1:
            first = times(operator, first)
        operator = [times(operator, row) for row in operator]
        bits >>= 1
    return first ^ second
