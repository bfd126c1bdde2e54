"""Seven-bit numbers and tag records as bytes, for reading and writing exchange files.

Unsigned numbers hold seven bits a byte, least first, the top bit saying that more follow. Signed
ones keep a sign: their first byte has the more bit, the sign bit and six bits.
"""

from __future__ import annotations

from collections.abc import Sequence

MORE, SIGN = 0x80, 0x40


def write_varuint(n: int) -> bytes:
    if n < 0:
        raise ValueError("an unsigned number is needed")
    out = bytearray()
    while n >= MORE:
        out.append(n & 0x7F | MORE)
        n >>= 7
    return bytes([*out, n])


def read_varuint(data: bytes, at: int = 0) -> tuple[int, int]:
    """The number and the place after it."""
    n = shift = 0
    while True:
        byte = data[at]
        n |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if not byte & MORE:
            return n, at


def write_varint(n: int) -> bytes:
    size, sign = abs(n), SIGN if n < 0 else 0
    if size < 0x40:
        return bytes([sign | size])
    return bytes([MORE | sign | size & 0x3F]) + write_varuint(size >> 6)


def read_varint(data: bytes, at: int = 0) -> tuple[int, int]:
    byte = data[at]
    size, at = byte & 0x3F, at + 1
    if byte & MORE:
        rest, at = read_varuint(data, at)
        size |= rest << 6
    return -size if byte & SIGN else size, at


def unzigzag(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def zigzag(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def write_tags(tags: Sequence[tuple[str, str]], symbols: Sequence[str] = ()) -> bytes:
    """Tags as one record: bytes that follow, tags, a bit for each name that is a symbol (most
    significant first), then the names, a symbol's place in one byte or a zero-ended string."""
    places = {s: i for i, s in enumerate(symbols[:256])}
    names = [x for pair in tags for x in pair]
    bits = bytearray(-(-len(names) // 8))
    body = bytearray()
    for i, name in enumerate(names):
        if name in places:
            bits[i // 8] |= 0x80 >> i % 8
            body.append(places[name])
        else:
            body += name.encode() + b"\0"
    inner = write_varuint(len(tags)) + bytes(bits) + bytes(body)
    return write_varuint(len(inner)) + inner


def read_tags(data: bytes, symbols: Sequence[str] = ()) -> list[tuple[str, str]]:
    _, at = read_varuint(data)
    n, at = read_varuint(data, at)
    bits, at = data[at : at + -(-2 * n // 8)], at + -(-2 * n // 8)
    names = []
    for i in range(2 * n):
        if bits[i // 8] & 0x80 >> i % 8:
            names.append(symbols[data[at]])
            at += 1
        else:
            stop = data.index(0, at)
            names.append(data[at:stop].decode())
            at = stop + 1
    return list(zip(names[::2], names[1::2], strict=True))
