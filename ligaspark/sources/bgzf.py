"""Blocked gzip: files of independent gzip members of at most 64 KB, so a task can begin at any block (SAM/BAM specification, section 4.1)."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

#: Fixed values of the format: how a member begins, and the empty member that ends a file.
MAGIC = b"\x1f\x8b\x08\x04"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
LARGEST = 65_280
_READ = 1 << 20


def member(data: bytes, level: int = 6) -> bytes:
    """One block of at most ``LARGEST`` bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    if len(body) > 65_500:  # cannot be made smaller: stored
        c = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = c.compress(data) + c.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def length(head: bytes, at: int = 0) -> int | None:
    """Length of the block whose header begins at ``at``; None if there is none. Extra fields other than the block's size may be there."""
    if head[at : at + 4] != MAGIC or len(head) < at + 18:
        return None
    stop = at + 12 + struct.unpack_from("<H", head, at + 10)[0]
    i = at + 12
    while i + 6 <= min(stop, len(head)):
        size = struct.unpack_from("<H", head, i + 2)[0]
        if head[i : i + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", head, i + 4)[0] + 1
        i += 4 + size
    return None


def inflate(block: bytes) -> bytes:
    """What a whole block holds; ValueError if it is not one, by form, length or checksum."""
    stop = 12 + struct.unpack_from("<H", block, 10)[0]
    try:
        data = zlib.decompress(block[stop:-8], -15)
    except zlib.error as e:
        raise ValueError(str(e)) from None
    if struct.unpack("<II", block[-8:]) != (zlib.crc32(data), len(data)):
        raise ValueError("checksum of a block")
    return data


def is_blocked(head: bytes) -> bool:
    return length(head) is not None


def first_block(f, start: int, end: int) -> int | None:
    """Where the first block begins at or after ``start`` and before ``end``. Bytes that only look like a header are told by inflating and the checksum."""
    at = start
    while at < end:
        f.seek(at)
        head = f.read(min(_READ, end - at) + (1 << 17))
        i = head.find(MAGIC)
        while 0 <= i < min(_READ, end - at):
            n = length(head, i)
            if n and i + n <= len(head):
                try:
                    inflate(head[i : i + n])
                    return at + i
                except (ValueError, struct.error):
                    pass
            i = head.find(MAGIC, i + 1)
        at += _READ
    return None


def blocks(f, at: int) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of the blocks from the one that begins at ``at`` to the end of the file; ValueError where the file is cut off inside of one."""
    f.seek(at)
    held = b""
    while True:
        n = length(held)
        while n is None or len(held) < n:
            more = f.read(_READ)
            if not more:
                if held:
                    raise ValueError(f"a block is cut off at {at}")
                return
            held += more
            n = length(held)
            if n is None and len(held) >= 1 << 17:
                raise ValueError(f"no block at {at}")
        yield at, inflate(held[:n])
        held, at = held[n:], at + n
