"""Words of a text, as bytes. Both ways lower or keep A-Z only as their rule says and never touch other scripts."""

from __future__ import annotations

_PLAIN = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    b if b in _PLAIN or b >= 0x80 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def spaced_words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but blanks, tabs and line ends (U+0009 to U+000D); none for null."""
    return text.encode().split() if text else []


def lettered_words(text: str | None) -> list[bytes]:
    """Maximal runs of a-z, 0-9 and non-ASCII characters after lowering A-Z; none for null."""
    return text.encode().translate(_TABLE).split() if text else []
