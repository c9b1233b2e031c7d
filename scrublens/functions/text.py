"""Whitespace, special characters and length limits. NULL in, NULL out."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrublens.functions.charclass import SPACE, WORD, strip

_BLANK_RUN = r"[ \t\n\x0B\f\r]+"
_SPECIAL = f"[^{WORD}{SPACE}]"


def clean_space(text: Column) -> Column:
    """Line breaks, form feeds and tabs become spaces, runs of spaces become one,
    and Unicode whitespace is stripped from both ends."""
    return strip(F.regexp_replace(text, _BLANK_RUN, " "))


def remove_all_special(text: Column) -> Column:
    """Each character that is neither a word character nor whitespace becomes one
    space; nothing is collapsed, so the length in code points stays."""
    return F.regexp_replace(text, _SPECIAL, " ")


def remove_selected_special(text: Column, characters: Iterable[str] | None) -> Column:
    """Each listed character becomes one space. An empty list changes nothing."""
    if characters is None:
        raise ValueError("the list of special characters is missing")
    if not _class_body(characters):
        return text
    return F.regexp_replace(text, f"[{_class_body(characters)}]", " ")


def keep_listed_special(text: Column, characters: Iterable[str]) -> Column:
    """Everything but Hangul syllables, ASCII letters and digits, whitespace and
    the listed characters becomes one space."""
    return F.regexp_replace(text, f"[^가-힣a-zA-Z0-9{SPACE}{_class_body(characters)}]", " ")


def blank_outlier(text: Column, shortest: int, longest: int) -> Column:
    """``text`` itself if its stripped length in code points lies in
    ``[shortest, longest]``, else the empty string."""
    fits = F.length(strip(text)).between(shortest, longest)
    return F.when(fits, text).when(text.isNotNull(), F.lit(""))


def _class_body(characters: Iterable[str]) -> str:
    """The characters as literals inside a regex class."""
    listed = "".join(dict.fromkeys("".join(characters)))
    ascii_symbol = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    return re.sub(ascii_symbol, lambda match: f"\\x{ord(match[0]):02X}", listed)
