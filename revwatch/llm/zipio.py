"""Range reads in ZIP archives: directories are parsed, stored members are never extracted."""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

Read = Callable[[int, int], bytes]  # (offset, size)

_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    compressed: int
    size: int
    header: int  # offset of the local header

    @property
    def stored(self) -> bool:
        return self.method == 0


def directory(read: Read, length: int) -> tuple[int, int, int]:
    """(offset, size, entries) of the central directory, from the end record or its ZIP64 form."""
    tail_size = min(length, 22 + _MAX16)
    tail = read(length - tail_size, tail_size)
    at = tail.rfind(_END)
    while at >= 0:
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] <= len(tail):
            break
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    entries, size, offset = struct.unpack_from("<HII", tail, at + 10)
    end = length - tail_size + at
    if end >= 20 and (locator := read(end - 20, 20))[:4] == _LOCATOR:
        place = struct.unpack_from("<Q", locator, 8)[0]
        record = read(place, 56)
        if record[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory where its locator points")
        entries, size, offset = struct.unpack_from("<QQQ", record, 32)
    return offset, size, entries


def _wide(extra: bytes, size: int, compressed: int, header: int) -> tuple[int, int, int]:
    """Values that did not fit in 32 bits, from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            own, values = at + 4, []
            for value in (size, compressed, header):
                if value == _MAX32:
                    value = struct.unpack_from("<Q", extra, own)[0]
                    own += 8
                values.append(value)
            return tuple(values)
        at += 4 + n
    return size, compressed, header


def members(read: Read, length: int) -> list[Member]:
    """All entries of the central directory."""
    offset, size, entries = directory(read, length)
    data, at, out = read(offset, size), 0, []
    for _ in range(entries):
        if data[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        compressed, full = struct.unpack_from("<II", data, at + 20)
        names, extras, comments = struct.unpack_from("<HHH", data, at + 28)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + names : at + 46 + names + extras]
        full, compressed, header = _wide(extra, full, compressed, header)
        out.append(Member(name, method, compressed, full, header))
        at += 46 + names + extras + comments
    return out


def data_offset(read: Read, member: Member) -> int:
    """Where a member's bytes begin: the local header's fields may differ from the directory's."""
    head = read(member.header, 30)
    if head[:4] != _LOCAL:
        raise ValueError(f"no local header for {member.name}")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + names + extras
