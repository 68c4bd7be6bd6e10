"""Patched frame-of-reference blocks of token ids.

Little-endian layout of a payload: ``PFB1``, ids (u32), ids of a block (u32), blocks (u32), byte offset of each block
(u64 each); then the blocks. A block: minimum (u32), exceptions (u16), width in bits (u8), the values less the
minimum in ``width`` bits each (exceptions as 0), positions of exceptions (u16 each), their values less the minimum (u32
each).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"PFB1"
BLOCK = 1024
#: The width of a block holds this part of its values; the others are exceptions.
PERCENTILE = 95
_HEAD, _BLOCK_HEAD = struct.Struct("<4sIII"), struct.Struct("<IHB")


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1))).astype(np.int64) + 1, 0)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """Payload of the ids (any unsigned 32-bit values)."""
    if not 0 < block <= 1 << 16:
        raise ValueError("a block has 1 to 65,536 ids")
    ids = np.asarray(ids, np.int64)
    whole = len(ids) // block * block
    parts = _packed(ids[:whole].reshape(-1, block), percentile)
    if whole < len(ids):
        parts += _packed(ids[None, whole:], percentile)
    start = _HEAD.size + 8 * len(parts)
    offsets = start + np.cumsum([0, *map(len, parts)])[:-1] if parts else np.zeros(0)
    return b"".join([_HEAD.pack(MAGIC, len(ids), block, len(parts)), np.asarray(offsets).astype("<u8").tobytes(), *parts])


def _packed(rows: np.ndarray, percentile: int) -> list[bytes]:
    """The bytes of blocks of equal length; those of one width are packed together."""
    if not len(rows):
        return []
    count = rows.shape[1]
    low = rows.min(axis=1)
    values = (rows - low[:, None]).astype(np.uint32)
    rank = min(count - 1, count * percentile // 100)
    widths = _bit_lengths(np.partition(values, rank, axis=1)[:, rank])
    which, where = np.nonzero(values >> widths.astype(np.uint64)[:, None])
    beyond = values[which, where].astype("<u4")
    values[which, where] = 0
    upto = np.searchsorted(which, np.arange(len(rows) + 1)).tolist()
    where = where.astype("<u2")
    parts = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        some = np.flatnonzero(widths == width)
        kind = "<u2" if width <= 16 else "<u4"
        bits = np.unpackbits(values[some].astype(kind).view(np.uint8).reshape(-1, 2 if width <= 16 else 4), axis=1, bitorder="little")
        packed = np.packbits(bits[:, :width].reshape(len(some), count * width), axis=1, bitorder="little")
        for k, one in zip(some.tolist(), packed):
            i, j = upto[k], upto[k + 1]
            parts[k] = b"".join([_BLOCK_HEAD.pack(int(low[k]), j - i, width), one.tobytes(), where[i:j].tobytes(), beyond[i:j].tobytes()])
    return parts


def block_count(payload: bytes) -> int:
    return _HEAD.unpack_from(payload)[3]


def unpack_block(payload: bytes, k: int) -> np.ndarray:
    """Ids of the k-th block, found by the index of block starts."""
    magic, n, block, blocks = _HEAD.unpack_from(payload)
    if magic != MAGIC or not 0 <= k < blocks:
        raise ValueError("not a block of this payload")
    at = int(np.frombuffer(payload, "<u8", 1, _HEAD.size + 8 * k)[0])
    count = min(block, n - k * block)
    low, exceptions, width = _BLOCK_HEAD.unpack_from(payload, at)
    at += _BLOCK_HEAD.size
    size = (count * width + 7) // 8
    values = np.zeros(count, np.int64)
    if width:
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, size, at), count=count * width, bitorder="little")
        padded = np.zeros((count, 32), np.uint8)
        padded[:, :width] = bits.reshape(count, width)
        values = np.packbits(padded, axis=1, bitorder="little").view("<u4")[:, 0].astype(np.int64)
    at += size
    where = np.frombuffer(payload, "<u2", exceptions, at)
    values[where] = np.frombuffer(payload, "<u4", exceptions, at + 2 * exceptions)
    return values + low


def unpack(payload: bytes) -> np.ndarray:
    """All ids of a payload."""
    magic, n, block, blocks = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a payload")
    out = np.zeros(n, np.uint32)
    whole = n // block
    grid = out[:whole * block].reshape(whole, block)
    by_width: dict[int, list] = {}
    for k, at in enumerate(np.frombuffer(payload, "<u8", blocks, _HEAD.size).tolist()[:whole]):
        low, exceptions, width = _BLOCK_HEAD.unpack_from(payload, at)
        by_width.setdefault(width, []).append((k, low, exceptions, at + _BLOCK_HEAD.size))
    for width, found in by_width.items():
        size = (block * width + 7) // 8
        some, low, exceptions, at = zip(*found)
        raw = b"".join([payload[i:i + size] for i in at]) + bytes(8)
        begin = np.arange(block) * width
        words = np.ndarray((len(some), max(size, 1)), "<u8", raw, strides=(size, 1))  # the eight bytes from every byte on
        values = (words[:, begin >> 3] >> (begin & 7).astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.uint32)
        row = np.repeat(np.arange(len(some)), exceptions)
        places = b"".join([payload[i + size:i + size + 2 * e] for i, e in zip(at, exceptions)])
        beyond = b"".join([payload[i + size + 2 * e:i + size + 6 * e] for i, e in zip(at, exceptions)])
        values[row, np.frombuffer(places, "<u2")] = np.frombuffer(beyond, "<u4")
        grid[list(some)] = values + np.array(low, np.uint32)[:, None]
    if whole < blocks:
        out[whole * block:] = unpack_block(payload, whole)
    return out
