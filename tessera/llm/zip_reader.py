"""ZIP archives read by byte ranges: end record, ZIP64 records, central directory, stored members. Nothing is extracted."""

from __future__ import annotations

import struct
from dataclasses import dataclass

_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header begins


class ZipRanges:
    """Members of an archive in a seekable file; ``read`` returns any range of a stored one."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.begins: dict[str, int] = {}
        self.members = {m.name: m for m in self._directory()}

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        got = self.source.read(n)
        if len(got) != n:
            raise ValueError("the archive ends too early")
        return got

    def _directory(self) -> list[Member]:
        n = min(self.size, 22 + _FULL16)  # the end record and the longest comment
        tail = self._at(self.size - n, n)
        at = tail.rfind(_END)
        while at >= 0 and (len(tail) - at < 22 or struct.unpack_from("<H", tail, at + 20)[0] != len(tail) - at - 22):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end record: not a ZIP archive, or cut off")
        count, length, offset = struct.unpack_from("<H I I", tail, at + 10)
        place = self.size - n + at
        if place >= 20 and (count == _FULL16 or length == _FULL32 or offset == _FULL32):
            locator = self._at(place - 20, 20)
            if locator[:4] == _LOCATOR:
                record = self._at(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != _END64:
                    raise ValueError("the ZIP64 end record is not where its locator says")
                count, length, offset = struct.unpack_from("<Q Q Q", record, 32)
        return self._entries(self._at(offset, length), count)

    @staticmethod
    def _entries(data: bytes, count: int) -> list[Member]:
        out, at = [], 0
        for _ in range(count):
            if data[at : at + 4] != _ENTRY:
                raise ValueError("a central directory entry is damaged")
            flags, method = struct.unpack_from("<H H", data, at + 8)
            packed, size, n_name, n_extra, n_comment = struct.unpack_from("<I I H H H", data, at + 20)
            header = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46 : at + 46 + n_name]
            extra, end = at + 46 + n_name, at + 46 + n_name + n_extra
            while extra + 4 <= end:
                kind, n = struct.unpack_from("<H H", data, extra)
                if kind == 1:  # ZIP64: 8 bytes for each field that is full, in this order
                    wide = iter(struct.unpack_from(f"<{n // 8}Q", data, extra + 4))
                    size = next(wide) if size == _FULL32 else size
                    packed = next(wide) if packed == _FULL32 else packed
                    header = next(wide) if header == _FULL32 else header
                extra += 4 + n
            out.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, size, header))
            at = end + n_comment
        return out

    def read(self, name: str, offset: int, n: int) -> bytes:
        """``n`` bytes at ``offset`` of a stored member."""
        member = self.members[name]
        if member.method:
            raise ValueError(f"{name} is compressed; only stored members have ranges")
        if offset < 0 or offset + n > member.size:
            raise ValueError(f"{name} has no bytes {offset} to {offset + n}")
        if name not in self.begins:
            head = self._at(member.header, 30)
            if head[:4] != _LOCAL:
                raise ValueError(f"the local header of {name} is damaged")
            self.begins[name] = member.header + 30 + sum(struct.unpack_from("<H H", head, 26))
        return self._at(self.begins[name] + offset, n)
