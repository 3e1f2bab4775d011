"""Emoji extraction and canonical form, as Column functions.

The pattern takes, longest first: flags, keycaps, tag sequences, and chains of pictographs with presentation selectors,
skin tones and joiners. Sets of characters come from Unicode properties of the installed `regex` module, when loaded.
"""

from __future__ import annotations

from functools import cache

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EMOJI_CAP


@cache
def _ranges(prop: str) -> tuple[tuple[int, int], ...]:
    """Code point ranges of a Unicode property."""
    match = regex.compile(rf"\p{{{prop}}}").match
    out: list[list[int]] = []
    for c in range(0x80, 0x20000):
        if not 0xD800 <= c < 0xE000 and match(chr(c)):
            if out and out[-1][1] == c - 1:
                out[-1][1] = c
            else:
                out.append([c, c])
    return tuple((a, b) for a, b in out)


def _class(ranges) -> str:
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


@cache
def emoji_pattern() -> str:
    """A Java regular expression for one emoji.

    The whole set is a chain of some 150 ranges, and nearly all characters of a text are in none: so one wide range and a few
    coarse ones, of which the set is a part, are looked at before.
    """
    listed = [(0xA9, 0xA9), (0xAE, 0xAE), *(r for r in _ranges("Emoji") if r[0] > 0xFF)]
    coarse: list[tuple[int, int]] = []
    for a, b in listed:
        if coarse and a > 0xFF and a - coarse[-1][1] <= 0x100:
            coarse[-1] = (coarse[-1][0], b)
        else:
            coarse.append((a, b))
    wide = _class([*listed[:2], (listed[2][0], listed[-1][1])])
    one = rf"[{_class(listed)}](?:[\x{{1F3FB}}-\x{{1F3FF}}]|\x{{FE0F}}|\x{{FE0E}})?"
    tags = r"\x{1F3F4}[\x{E0020}-\x{E007E}]+\x{E007F}"
    rest = rf"[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|{tags}|{one}(?:\x{{200D}}{one})*"
    return rf"(?=[0-9#*{wide}])(?:[0-9#*]\x{{FE0F}}?\x{{20E3}}|(?=[{_class(coarse)}])(?:{rest}))"


@cache
def text_style_class() -> str:
    """Characters of text style by default: those to which U+FE0F is added unless a skin tone follows."""
    by_default = _ranges("Emoji_Presentation")
    inside = lambda c: any(a <= c <= b for a, b in by_default)
    singles = [c for a, b in _ranges("Emoji") for c in range(a, b + 1) if not inside(c)]
    return _class([(c, c) for c in singles])


@cache
def selector_bases() -> str:
    """Characters with a text and an emoji style: a lone one is written in emoji style.

    Rule-derived: text-style emoji, and emoji-style ones before U+1F600 that are no flag letter, skin tone or newer sign.
    """
    both = [(a, min(b, 0x1F5FF)) for a, b in _ranges("Emoji_Presentation") if a < 0x1F1E6 or 0x1F300 <= a <= 0x1F5FF]
    return text_style_class() + _class([(a, b) for a, b in both if a <= b])


def extract_emojis(text: Column) -> Column:
    """One entry an occurrence, left to right."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(emoji_pattern()), 0)


def normalize_emoji(emoji: Column) -> Column:
    """Emoji style for lone bases, and for text-style bases within joined sequences."""
    lone = F.regexp_replace(emoji, r"^([%s])\x{FE0E}?$" % text_style_class(), "$1️")
    inner = rf"([{text_style_class()}])\x{{FE0E}}?(?![\x{{FE0F}}\x{{1F3FB}}-\x{{1F3FF}}])"
    return F.when(F.contains(emoji, F.lit("‍")), F.regexp_replace(emoji, inner, "$1️")).otherwise(lone)


def emojis_of(text: Column, cap: int = EMOJI_CAP) -> Column:
    return F.slice(F.transform(extract_emojis(text), normalize_emoji), 1, cap)


def code_points(glyph: Column) -> Column:
    """Lower-case hex code points, four digits at least, by blanks."""
    raw = F.hex(F.encode(glyph, "UTF-32"))
    points = F.regexp_extract_all(F.lower(raw), F.lit("[0-9a-f]{8}"), 0)
    return F.array_join(F.transform(points, lambda p: F.regexp_replace(p, "^0{1,4}", "")), " ")


def from_code_points(points: Column) -> Column:
    padded = F.transform(F.split(points, " "), lambda p: F.lpad(p, 8, "0"))
    return F.decode(F.unhex(F.array_join(padded, "")), "UTF-32")
