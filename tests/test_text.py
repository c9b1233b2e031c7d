from __future__ import annotations

import random
import sys

import pytest

from scrublens.functions import text
from scrublens.functions.charclass import WHITESPACE, strip
from tests import plain

ALPHABET = "aZ09_ \t\n\r\x0b\x0c\x1c\x85\xa0  　é가힣ㄱß中²½٣!?.,-^]\\[$%&'\"🙂𝒳"


def strings(count: int, seed: int = 1, alphabet: str = ALPHABET, longest: int = 40) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(count)]


def test_whitespace_is_pythons():
    assert set(WHITESPACE) == {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()}


@pytest.mark.parametrize(
    ("function", "expected"),
    [
        (strip, str.strip),
        (text.clean_space, plain.clean_space),
        (text.remove_all_special, plain.remove_all_special),
        (
            lambda c: text.remove_selected_special(c, "^]-\\[$🙂"),
            lambda s: plain.remove_selected_special(s, "^]-\\[$🙂"),
        ),
        (
            lambda c: text.keep_listed_special(c, ["!", "]", "^", "🙂"]),
            lambda s: plain.keep_listed_special(s, "!]^🙂"),
        ),
    ],
)
def test_like_plain_definition(apply, function, expected):
    cells = strings(1500)
    assert apply(function, cells) == [expected(cell) for cell in cells]


def test_each_character(apply):
    """All of the basic plane, one character per cell, but for what is newer than Java."""
    cells = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    got = apply(text.remove_all_special, cells)
    wrong = [c for c, out in zip(cells, got, strict=True) if out != plain.remove_all_special(c)]
    assert len(wrong) < 100


def test_known_values(apply):
    assert apply(text.clean_space, [" a\t\nb  c ", "a\xa0", None, ""]) == ["a b c", "a", None, ""]
    assert apply(text.remove_all_special, ["가나!다_1", None]) == ["가나 다_1", None]
    assert apply(lambda c: text.keep_listed_special(c, "!"), ["가나!다_1"]) == ["가나!다 1"]
    assert apply(lambda c: text.remove_selected_special(c, "^]-"), ["a^b]c-d"]) == ["a b c d"]


def test_outlier_bounds_count_code_points(apply):
    cells = ["ab🙂", " ab🙂 ", "a🙂", "abcd🙂", "abcde🙂", None]
    expected = ["ab🙂", " ab🙂 ", "", "abcd🙂", "", None]
    assert apply(lambda c: text.blank_outlier(c, 3, 5), cells) == expected


def test_selected_list(apply):
    assert apply(lambda c: text.remove_selected_special(c, ""), ["a!"]) == ["a!"]
    with pytest.raises(ValueError, match="missing"):
        text.remove_selected_special(None, None)


def test_clean_space_twice_is_once(apply):
    cells = strings(300, seed=2)
    once = apply(text.clean_space, cells)
    assert apply(text.clean_space, once) == once


def test_removal_keeps_length(apply):
    cells = strings(300, seed=3)
    assert [len(c) for c in apply(text.remove_all_special, cells)] == [len(c) for c in cells]
