"""Classes of code points that normalisation and quotes rest on."""

from __future__ import annotations

import unicodedata

# White space, spaces that are drawn thin, glyphs that are drawn blank, invisible formatting,
# ranges of code points that are drawn as nothing, bullets, and the code points that text may not hold.
WHITESPACE = (0x09, 0x0A, 0x0D, 0x20, 0xA0, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2007, 0x2008, 0x2028, 0x2029, 0x3000)
THIN = (0x2006, 0x2009, 0x200A, 0x202F, 0x205F)
BLANK = (0x1878, 0x18AA, 0x2800, 0xA4A2, 0xA4A3, 0xA4B4, 0xA4C1, 0xA4C5)
INVISIBLE = (0xAD, 0x200B, 0xFEFF, 0x2060)
IGNORABLE = (
    (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F),
    (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)
BULLETS = (0x2022, 0x2023, 0x25A0, 0x25A1, 0x25AA, 0x25AB, 0x25CB, 0x25CF, 0x25E6)
FORBIDDEN = (
    (0x00, 0x08), (0x0B, 0x0C), (0x0E, 0x1F), (0x7F, 0x9F), (0x600, 0x605), (0x61C, 0x61C), (0x6DD, 0x6DD), (0x70F, 0x70F), (0x890, 0x891), (0x8E2, 0x8E2),
    (0x200E, 0x200F), (0x202A, 0x202E), (0x2066, 0x2069), (0xD800, 0xDFFF), (0xFFF9, 0xFFFB), (0xFFFD, 0xFFFF), (0x110BD, 0x110BD), (0x110CD, 0x110CD),
)
RESERVED = ((0xFDD0, 0xFDEF), (0xFFFC, 0xFFFC))

_GAPS = frozenset((*WHITESPACE, *THIN, *BLANK))


def ignorable(point: int) -> bool:
    return any(a <= point <= b for a, b in IGNORABLE)


def is_gap(point: int) -> bool:
    """Drawn as a gap or as nothing."""
    return point in _GAPS or ignorable(point)


def is_word(c: str) -> bool:
    """Letters, numbers, marks, invisible formatting and (non-)joiners."""
    return unicodedata.category(c)[0] in "LNM" or ord(c) in (*INVISIBLE, 0x200C, 0x200D)


def pattern(*ranges) -> str:
    """The inside of a character class of Java's or Python's regular expressions: points and ranges."""
    one = lambda p: f"\\u{p:04x}" if p < 0x10000 else chr(p)
    return "".join(one(r) if isinstance(r, int) else one(r[0]) + ("" if r[0] == r[1] else "-" + one(r[1])) for r in ranges)
