"""Small helpers on one text, for use inside tasks.

All work on UTF-8 bytes: ``bytes.split`` without an argument splits at exactly 0x20 and
0x09-0x0D, and ``bytes.lower`` changes exactly A-Z.
"""

from __future__ import annotations

import numpy as np

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def raw(text: str | None) -> bytes:
    """UTF-8 bytes of ``text``; null gives none. Lone surrogates pass through."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Maximal runs of anything but 0x20 and 0x09-0x0D."""
    data = raw(text)
    return (data.lower() if lower else data).split()


# Every byte that is no ASCII letter or digit and below 0x80 becomes a blank; A-Z become a-z.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, ASCII digits and anything beyond ASCII."""
    return raw(text).translate(_PLAIN).split()


def codes(words: list[bytes], known: dict[bytes, int] | None = None) -> np.ndarray:
    """Numbers of the words by first appearance; ``known`` is extended when given."""
    table = {} if known is None else known
    return np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
