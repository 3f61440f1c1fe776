"""Character-level primitives: which characters are invisible, which are blanks, which only look like others.

Used on the executors inside Arrow batches; everything here is plain Python over one string and keeps no state but
caches bounded by the number of code points.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

# Single characters of other scripts (and of phonetic alphabets) that are drawn like a Latin letter,
# each followed by that letter. From the public Unicode confusables data, restricted to letters. What Unicode itself
# tells (compatibility forms, small capitals, Lisu letters by their names) isn't listed but derived.
LOOK_ALIKES = """
АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ҮY Ӏl аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl
ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa γy ιi κk νv οo ρp υu
օo ոn սu հh ցg
ᎠD ᎡR ᎢT ᎥI ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᎽY ᏀG ᏃZ ᏏB ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK
ɑa ɡg ıi ȷj ɩi ᴏo ᴄc ᴠv ᴡw ᴢz
ⲟo ⲞO ⲣp ⲢP ⲥc ⲤC ⲭx ⲬX ⲀA ⲂB ⲈE ⲎH ⲒI ⲔK ⲘM ⲚN ⲦT
"""

#: Hyphens that are drawn as the ordinary one.
HYPHENS = "‐‑⁃−˗﹣－"


_SMALL_CAPITAL = re.compile(r"LATIN LETTER SMALL CAPITAL ([A-Z])")
_LISU = re.compile(r"LISU LETTER (?:([B-DF-HJ-NP-TV-Z])A|([AEIOU]))")


def look_alikes() -> dict[str, str]:
    """Letter -> the Latin letter that it looks like: the listed ones and those that tell by their names."""
    out = {pair[0]: pair[1] for pair in LOOK_ALIKES.split()}
    for o in (*range(0x1D00, 0x1D80), *range(0xA720, 0xA800), *range(0x0250, 0x02B0), *range(0xA4D0, 0xA500)):
        name = unicodedata.name(chr(o), "")
        if m := _SMALL_CAPITAL.fullmatch(name) or _LISU.fullmatch(name):
            out.setdefault(chr(o), m[1] or m[2])
    return out


_LOOKS = look_alikes()


@lru_cache(maxsize=65536)
def invisible(ch: str) -> bool:
    """Format characters, variation selectors and joiners that draw nothing."""
    return unicodedata.category(ch) == "Cf" or ch in "͏ᅟᅠㅤ" or "︀" <= ch <= "️"


@lru_cache(maxsize=65536)
def blank(ch: str) -> bool:
    """Any space separator; tabs and line ends are not blanks of the text but structure."""
    return unicodedata.category(ch) == "Zs"


@lru_cache(maxsize=65536)
def compatible(ch: str) -> str:
    """The ordinary form of a character that Unicode keeps only for compatibility: full width, ligatures, Roman
    numerals, letters in circles and mathematical letters. Fractions, superscripts and signs stay: they mean something
    else."""
    if ch in HYPHENS:
        return "-"
    if ch.isascii():
        return ch
    tag = unicodedata.decomposition(ch).partition(" ")[0]
    kind = unicodedata.category(ch)
    letter = kind[0] == "L" or kind == "Nl" or unicodedata.name(ch, "").startswith(("CIRCLED LATIN", "NEGATIVE CIRCLED LATIN"))
    if tag == "<wide>" or (tag in ("<font>", "<narrow>") and (letter or kind == "Nd")) or (tag in ("<circle>", "<compat>") and letter):
        return unicodedata.normalize("NFKC", ch)
    return ch


@lru_cache(maxsize=65536)
def _drawn(ch: str) -> str:
    if invisible(ch):
        return ""
    if ch.isspace():
        return " "
    out = "".join(_LOOKS.get(c, c) for c in compatible(ch))
    return unicodedata.normalize("NFD", out).casefold()


_BLANK, _BLANKS = re.compile(r"\s"), re.compile(r"\s\s")


def skeleton(text: str) -> str:
    """A key under which texts that are drawn alike are equal; case and the kind and number of blanks don't count."""
    if text.isascii():
        return " ".join(text.casefold().split())
    return " ".join("".join(map(_drawn, text)).split())


def skeleton_with_origin(text: str) -> tuple[str, Sequence[int]]:
    """The skeleton (inner runs of blanks as one, outer ones kept as one) and, for each of its characters, the index in text."""
    if text.isascii() and not _BLANKS.search(text):
        return _BLANK.sub(" ", text.casefold()), range(len(text))
    out: list[str] = []
    origin: list[int] = []
    for i, ch in enumerate(text):
        for c in _drawn(ch):
            if c == " " and out and out[-1] == " ":
                continue
            out.append(c)
            origin.append(i)
    return "".join(out), origin


def is_word(ch: str) -> bool:
    return ch.isalnum() or unicodedata.category(ch)[0] == "M"
