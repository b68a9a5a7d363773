"""What the EXIF block of a JPEG file says: how the picture is turned, and whether it has a date or a place."""

from __future__ import annotations

import struct

# Tag numbers of the format.
ORIENTATION, CHANGED, TAKEN, DETAILS, PLACE = 0x0112, 0x0132, 0x9003, 0x8769, 0x8825


def _entries(body: bytes, at: int, order: str) -> dict[int, int]:
    """(tag -> value or offset) of one directory; short values stand at the front of their four bytes."""
    (n,) = struct.unpack_from(order + "H", body, at)
    out = {}
    for i in range(n):
        tag, kind, _, value = struct.unpack_from(order + "HHII", body, at + 2 + 12 * i)
        if kind == 3:
            (value,) = struct.unpack_from(order + "H", body, at + 10 + 12 * i)
        out[tag] = value
    return out


def exif(content: bytes) -> tuple[int, bool, bool, bool]:
    """(orientation, whether there is a block, a date, a place); orientation 1 where nothing or nonsense is said."""
    nothing = (1, False, False, False)
    if content[:2] != b"\xff\xd8":
        return nothing
    at = 2
    while at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] not in (0xD9, 0xDA):
        size = int.from_bytes(content[at + 2 : at + 4], "big")
        if content[at + 1] == 0xE1 and content[at + 4 : at + 10] == b"Exif\0\0":
            body = content[at + 10 : at + 2 + size]
            try:
                order = {b"II": "<", b"MM": ">"}[body[:2]]
                first = _entries(body, struct.unpack_from(order + "I", body, 4)[0], order)
                more = _entries(body, first[DETAILS], order) if DETAILS in first else {}
            except (KeyError, struct.error):
                return nothing
            turned = first.get(ORIENTATION, 1)
            return turned if 1 <= turned <= 8 else 1, bool(first), CHANGED in first or TAKEN in more, PLACE in first
        at += 2 + size
    return nothing
