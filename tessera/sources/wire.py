"""Protocol buffer wire format: just what map files need."""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterable

import numpy as np

from ..functions.codec import read_varuint, write_varuint

VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5


def fields(data: bytes) -> dict[int, list]:
    """Values by field number: ints of varints, memory of lengths."""
    out: dict[int, list] = defaultdict(list)
    at, data = 0, memoryview(data)
    while at < len(data):
        key, at = read_varuint(data, at)
        kind = key & 7
        if kind == VARINT:
            value, at = read_varuint(data, at)
        elif kind == BYTES:
            size, at = read_varuint(data, at)
            if at + size > len(data):
                raise ValueError("a field runs past its message")
            value, at = data[at : at + size], at + size
        elif kind in (FIXED64, FIXED32):
            size = 8 if kind == FIXED64 else 4
            value, at = struct.unpack_from("<Q" if size == 8 else "<I", data, at)[0], at + size
        else:
            raise ValueError(f"wire type {kind}")
        out[key >> 3].append(value)
    return out


def packed(parts: list) -> np.ndarray:
    """Unsigned numbers of a repeated field, packed or not."""
    if not parts:
        return np.empty(0, np.uint64)
    if isinstance(parts[0], int):
        return np.array(parts, np.uint64)
    raw = np.frombuffer(b"".join(parts), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    last = np.flatnonzero(raw < 0x80)
    first = np.concatenate([[0], last[:-1] + 1])
    shift = 7 * (np.arange(len(raw)) - np.repeat(first, last - first + 1))
    return np.add.reduceat((raw & 0x7F).astype(np.uint64) << shift.astype(np.uint64), first)


def signed(values: np.ndarray) -> np.ndarray:
    """Zig-zag numbers as signed ones."""
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def deltas(parts: list) -> np.ndarray:
    """Running sums of zig-zag differences."""
    return np.cumsum(signed(packed(parts)))


def message(*pairs: tuple[int, int | bytes | str]) -> bytes:
    """Fields in order, for writing."""
    out = bytearray()
    for number, value in pairs:
        if isinstance(value, int):
            out += write_varuint(number << 3) + write_varuint(value % (1 << 64))
        else:
            value = value.encode() if isinstance(value, str) else value
            out += write_varuint(number << 3 | BYTES) + write_varuint(len(value)) + value
    return bytes(out)


def pack(values: Iterable[int]) -> bytes:
    return b"".join(write_varuint(v % (1 << 64)) for v in values)
