"""Words of letters, digits and all that lies beyond ASCII, A-Z lower-cased, as bytes (operators 11 and 13)."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text that are split at a time.
PART = 4 << 20
#: Digits, lower-case letters and bytes beyond ASCII stay; A-Z become a-z; all others are gaps.
_FLAT = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text of any length in lists, cut only between words."""
    flat, start = text.translate(_FLAT), 0
    while start < len(flat):
        end = flat.find(b" ", start + PART) if len(flat) - start > PART else len(flat)
        end = len(flat) if end < 0 else end
        yield flat[start:end].split()
        start = end
