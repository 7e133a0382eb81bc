"""Page furniture of scanned texts: page numbers, stamps and running headers.

A scanned text ends with the number of its last page. Its other page numbers are
written in the same style and count up to that one, so a lone number of a
ledger or list isn't taken for one. Below a page number may stand a stamp
and the running header of the next page.
"""

from __future__ import annotations

import re

_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_D = r"([\dOoIlSB]{1,5})"
_STYLES = (
    ("of", re.compile(rf"^[Pp]a[gq][eco] {_D} [oc0]f {_D}$")),
    ("page", re.compile(rf"^[Pp]a[gq][eco] {_D}$")),
    ("dash", re.compile(rf"^- ?{_D} ?-$")),
    ("bracket", re.compile(rf"^\[{_D}\]$")),
    ("slash", re.compile(rf"^p\. ?{_D}/{_D}$")),
    ("roman", re.compile(r"^(?!l$)((?=[ivxl])(?:xl|l?x{0,3})(?:ix|iv|v?i{0,3}))$")),
    ("bare", re.compile(r"^(\d{1,4})$")),
)
_STAMP = re.compile(r"^[A-Z]{3,6}[\dOIlSB]{6,12}$")
_AS_DIGIT = str.maketrans("OoIlSB", "001158")


def _value(style: str, digits: str) -> int:
    if style != "roman":
        return int(digits.translate(_AS_DIGIT))
    total, last = 0, 0
    for c in reversed(digits):
        v = _ROMAN[c]
        total, last = (total - v, last) if v < last else (total + v, v)
    return total


def page_number(line: str) -> tuple[str, int] | None:
    """Style and value of a line that holds nothing but a page number."""
    s = line.strip()
    if not s or len(s) > 20:
        return None
    for style, pattern in _STYLES:
        m = pattern.match(s)
        if m:
            return style, _value(style, m[1])
    return None


def furniture_lines(lines: list[str]) -> dict[int, str]:
    """Index and kind (``number``, ``stamp``, ``header``) of the furniture lines; empty for texts that aren't scanned."""
    end = len(lines) - 1
    while end >= 0 and not lines[end].strip():
        end -= 1
    last = page_number(lines[end]) if end > 0 else None
    if last is None:
        return {}
    style, expected = last
    out = {end: "number"}

    def below(i: int) -> None:
        """A stamp and a header from line i on."""
        if i < end and i not in out and _STAMP.match(lines[i].strip()):
            out[i] = "stamp"
            i += 1
        if i < end and i not in out and is_header(lines[i]):
            out[i] = "header"

    numbers = [(k, p[1]) for k in range(end) if (p := page_number(lines[k])) and p[0] == style]
    plain = style in ("bare", "roman")  # these may stand for something else, so they must count up by one
    for k, value in reversed(numbers):
        stamped = k + 1 < end and bool(_STAMP.match(lines[k + 1].strip()))
        if value == expected - 1 or (value < expected and (stamped or not plain)):
            expected = value
            out[k] = "number"
            below(k + 1)
    # a page break may have lost its number; its stamp still marks it
    for k in range(end):
        if k not in out and _STAMP.match(lines[k].strip()):
            below(k)
    return out


def is_header(line: str) -> bool:
    """A running header by its form; it stands where one is due, below a page number."""
    s = line.strip()
    if not s or len(s) > 60 or s[-1] in ".?!,;:" or s[0] in ">|\"'":
        return False
    ws = s.split()
    return len(ws) <= 6
