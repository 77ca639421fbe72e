"""Text helpers: slugs, URL tails, title and album normalisation."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notes that do not tell one recording, or one album, from another.
RECORDING_NOTES = (
    "remaster", "remastered", "mono", "stereo", "live", "special edition", "deluxe", "deluxe edition", "bonus track", "single version",
    "radio edit", "album version",
)
ALBUM_NOTES = ("deluxe", "special", "expanded", "remaster", "remastered", "anniversary")


def _any_of(notes: tuple[str, ...]) -> str:
    """Longest first, so that a note is taken whole."""
    return "|".join(re.escape(n) for n in sorted(notes, key=len, reverse=True))


#: A note with a dash before it or not; "remaster" also in brackets, with a year or without.
_TITLE_NOTE = r"(?U)\s*(?:-\s*)?(?:\(\s*(?:\d{4}\s*)?remaster(?:ed)?\s*\)|\b(?:" + _any_of(RECORDING_NOTES) + r")\b)"
#: Brackets that begin with a note, with the space around them.
_ALBUM_NOTE = r"(?U)\s*\((?:" + _any_of(ALBUM_NOTES) + r").*?\)\s*"


PAGE = 64  # code points whose folds are looked up together


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, dict[int, str]]:
    """What compatibility decomposition without combining marks makes of single characters, from the Unicode
    data of Python: letters that become one other letter or go (from, to; what goes comes last), and those that become several, by code point.

    Hangul syllables stay: they decompose into letters of their own, not into marks."""
    one, to, gone, several = [], [], [], {}
    for code in range(0xA0, sys.maxunicode + 1):
        char = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if base == char:
            continue
        if not base:
            gone.append(char)
        elif len(base) == 1:
            one.append(char)
            to.append(base)
        else:
            several[code] = base
    return "".join(one + gone), "".join(to), several


@lru_cache(maxsize=1)
def _pages() -> tuple[list[int], list[str | None]]:
    """The folds to several letters as a table by code point: for each run of PAGE code points where its entries begin (0:
    it has none), and the entries."""
    several = _folds()[2]
    starts, entries = [], []
    for page in range(max(several) // PAGE + 1):
        folds = [several.get(code) for code in range(page * PAGE, (page + 1) * PAGE)]
        starts.append(len(entries) + 1 if any(f is not None for f in folds) else 0)
        entries += folds if starts[-1] else []
    return starts, entries


def fold_accents(text: Column) -> Column:
    """Drop accents and compatibility forms of all scripts, inside the JVM.

    Texts of ASCII stay as they are. In others combining marks are dropped and letters that fold to one letter
    translated, in one pass. Only a text that then holds a character that folds to several (ligatures, say) is taken
    apart, and each of its characters finds its fold in a table by its code point.
    """
    one, to, several = _folds()
    plain = F.translate(text, one, to)
    starts, entries = [F.from_json(F.lit(json.dumps(t)), kind) for t, kind in zip(_pages(), ("array<int>", "array<string>"))]

    def fold(char):
        code = F.ascii(char)
        start = F.coalesce(F.get(starts, F.shiftright(code, PAGE.bit_length() - 1)), F.lit(0))
        return F.coalesce(F.when(start > 0, F.get(entries, start - 1 + code.bitwiseAND(PAGE - 1))), char)

    apart = F.array_join(F.transform(F.split(plain, ""), fold), "")
    holds_several = F.translate(plain, "".join(map(chr, several)), "") != plain
    return F.when(~text.rlike(r"[^\x00-\x7f]"), text).when(holds_several, apart).otherwise(plain)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _tidy(text: Column) -> Column:
    return _strip(F.regexp_replace(text, r"(?U)\s+", " "))


def norm_title(text: Column, fold=fold_accents) -> Column:
    plain = _strip(F.lower(fold(text)))
    plain = F.regexp_replace(F.regexp_replace(plain, _TITLE_NOTE, ""), r"(?U)\(\s*\)", "")
    return F.coalesce(_tidy(plain), F.lit(""))


def norm_album(text: Column, fold=fold_accents) -> Column:
    plain = _strip(F.lower(fold(text)))
    return F.coalesce(_tidy(F.regexp_replace(plain, _ALBUM_NOTE, " ")), F.lit(""))


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def url_tail(url: Column) -> Column:
    """Last path segment, without a query string."""
    return F.substring_index(F.substring_index(url, "/", -1), "?", 1)
