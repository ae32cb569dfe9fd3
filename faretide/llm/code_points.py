"""Code points on which the tokenizers library and Python's tables differ.

The library's normal forms know Unicode 9, its patterns Unicode 16 and its lower case Unicode 17;
``unicodedata`` and ``regex`` have versions of their own.
"""

from __future__ import annotations

import re
import unicodedata

# Fixed values, from the Unicode Character Database: ranges of code points in hexadecimal.

#: Letters and numbers since Unicode 17: to the library's patterns they are neither.
LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 "
    "191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
#: Marks since Unicode 10, which the library neither moves nor composes.
MARKS = (
    "07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 "
    "10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 "
    "1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 "
    "1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)
#: Capitals since Unicode 16: a range and the lower case of its first.
CAPITALS = (
    "1C89:1C8A A7CB:0264 A7CC:A7CD A7CE:A7CF A7D2:A7D3 A7D4:A7D5 A7DA:A7DB A7DC:019B "
    "10D50-10D65:10D70 16EA0-16EB8:16EBB"
)
#: White space beyond ASCII.
SPACES = "0085 00A0 1680 2000-200A 2028-2029 202F 205F 3000"


def _ends(part: str) -> tuple[int, int]:
    first, _, last = part.partition("-")
    return int(first, 16), int(last or first, 16)


def among(ranges: str) -> str:
    """The inside of a character class."""
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in map(_ends, ranges.split()))


def _lowered() -> dict[int, int]:
    pairs = (part.split(":") for part in CAPITALS.split())
    return {
        point: int(to, 16) + point - _ends(part)[0]
        for part, to in pairs
        for point in range(_ends(part)[0], _ends(part)[1] + 1)
    }


LOWERED = _lowered()
_all = f"{LETTERS} {NUMBERS} {MARKS} {' '.join(f'{c:X}' for c in LOWERED)}".split()
# A class within 16 bits is one look a character; one beyond them is a look a range.
_lows = among(" ".join(p for p in _all if _ends(p)[1] < 1 << 16))
_low = re.compile(f"[{_lows}]").search
_odd = re.compile(f"[{_lows}{among(SPACES)}]").search
_high = re.compile(f"[{among(' '.join(p for p in _all if _ends(p)[1] >= 1 << 16))}]").search
_beyond = re.compile("[\U00010000-\U0010ffff]").search
_apart = re.compile(f"([{among(MARKS)}])").split


def found_in(text: str) -> bool:
    """Whether a text has any of these."""
    return bool(_low(text) or (_beyond(text) and _high(text)))


def odd(text: str) -> bool:
    """Whether a text has any of these or white space beyond ASCII."""
    return bool(_odd(text) or (_beyond(text) and _high(text)))


def composed(text: str) -> str:
    """The normal form C of a text that may hold later marks."""
    return "".join(unicodedata.normalize("NFC", part) for part in _apart(text))


def older(pattern: str) -> str:
    """A pattern (for ``regex.V1``) whose letters and numbers leave out later ones."""
    for kind, later in ((r"\p{L}", LETTERS), (r"\p{N}", NUMBERS)):
        pattern = pattern.replace(kind, f"[{kind}--[{among(later)}]]")
    return pattern
