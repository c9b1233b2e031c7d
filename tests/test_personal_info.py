from __future__ import annotations

import random
import re
import time

import pytest

from scrublens.functions import personal_info as pii
from tests import plain
from tests.test_text import strings

DIGITS = "0123456789" * 3 + "-----,,~∼ \n\xa0ax@."
MAILS = "ab1.@@-+_ .Zc\né"

# One per alternative of the account pattern, with what precedes and follows.
ACCOUNTS = [
    "1234567890123",
    "123-45-678,123-45-6781234567890123",
    "123-45-678-90123456789012",
    "123-45-6781234567890123",
    "123-45-678123456789012",
    "123456789012",
    "123-45-678-91234567890123",
    "123-45-678-9012345678901",
    "12345678901",
    "123-45-6789012",
    "---------",
    "12,-3-45-67",
]


def test_known_values(apply):
    masked = {
        "010-1234-5678": "###-####-####",
        "02-123-4567": "##-###-####",
        "1234-1234-1234-1234": "####-####-####-####",
        "4785380592391139": "#############139",
        "900101-1234567": "######-#######",
        "a.b_c@x.co.kr": "#.###@#.##.##",
        "A@X.COM": "A@X.COM",
        "b 010-1234-5678 c 010-1234-56789": "b ###-####-#### c ###-####-####9",
        "": "",
        None: None,
    }
    assert apply(pii.mask_matches, list(masked)) == list(masked.values())
    assert apply(pii.delete_matches, ["1234-1234-1234-1234", None]) == ["", None]
    cells = ["ok\n010-1234-5678\n\nend", "010-1234-5678", "\n", None]
    assert apply(pii.delete_lines, cells) == ["ok\n\nend", "", "\n", None]


def test_strict_masks_longer_matches_whole(apply):
    cell = "b 010-1234-5678 c 010-1234-56789"
    got = apply(lambda c: pii.mask_matches(c, strict=True), [cell])
    assert got == ["b ###-####-#### c ###-####-#####"]


@pytest.mark.parametrize("pattern", pii.ALL_PATTERNS, ids=lambda p: p.name)
def test_each_pattern(apply, pattern):
    """What must hold of each answer, given where the pattern is found."""
    alphabet = MAILS if pattern.name == "email" else DIGITS
    cells = strings(2500, seed=4, alphabet=alphabet, longest=45) + ACCOUNTS
    masked = apply(lambda c: pii.mask_matches(c, [pattern]), cells)
    deleted = apply(lambda c: pii.delete_matches(c, [pattern]), cells)
    without = apply(lambda c: pii.delete_lines(c, [pattern]), cells)
    wanted = re.compile(plain.PATTERNS[pattern.name])
    for cell, mask, rest, lines in zip(cells, masked, deleted, without, strict=True):
        found = wanted.findall(cell)
        if not found:
            assert cell == mask == rest == lines
            continue
        assert len(mask) == len(cell)
        changed = [(a, b) for a, b in zip(cell, mask, strict=True) if a != b]
        assert all(b == "#" and re.match(r"\w", a) for a, b in changed)
        for at in wanted.finditer(cell):
            first = at.start() == wanted.search(cell).start()
            if first:
                assert not re.search(r"[^\W_]", mask[at.start() : at.end()])
        if len(found) == 1:
            assert rest == "".join(cell.split(found[0]))
        assert wanted.search(lines) is None or "\n" in cell
        hit_lines = sum(wanted.search(line) is not None for line in cell.split("\n"))
        assert lines.count("\n") == max(cell.count("\n") - hit_lines, 0)


def test_chain_is_its_patterns_in_turn(apply):
    cells = strings(1500, seed=5, alphabet=DIGITS + MAILS, longest=60) + ACCOUNTS
    for function in (pii.mask_matches, pii.delete_matches, pii.delete_lines):
        by_step = cells
        for pattern in pii.ALL_PATTERNS:
            by_step = apply(lambda c, p=pattern, f=function: f(c, [p]), by_step)
        assert apply(function, cells) == by_step


@pytest.mark.parametrize("pattern", pii.ALL_PATTERNS, ids=lambda p: p.name)
def test_strict_leaves_no_match(apply, pattern):
    cells = strings(800, seed=6, alphabet="0123456789-ab@.k ", longest=40)
    for out in apply(lambda c: pii.mask_matches(c, [pattern], strict=True), cells):
        left = [m[0] for m in re.finditer(plain.PATTERNS[pattern.name], out)]
        assert not any(re.search(r"\w", hit) for hit in left), out


def test_many_matches_in_one_cell(apply):
    cell = "\n".join(f"call 010-{i:04d}-{i:04d} or u{i}@example.com" for i in range(400))
    masked = "\n".join(["call ###-####-#### or {}@#######.###".format("#" * len(f"u{i}")) for i in range(400)])
    assert apply(pii.mask_matches, [cell]) == [masked]
    assert apply(pii.delete_lines, [cell + "\nend"]) == ["end"]


def test_own_pattern(apply):
    ticket = pii.Pattern("ticket", "T-[0-9]+", needs="T-")
    cells = ["see T-12 and T-123", "none", "T-1\n010-1234-5678\nx", None]
    both = [ticket, pii.PHONE]
    assert apply(lambda c: pii.mask_matches(c, [ticket]), cells[:2]) == [
        "see #-## and #-##3",
        "none",
    ]
    assert apply(lambda c: pii.delete_lines(c, both), cells) == ["", "none", "x", None]


def test_long_runs_are_linear(apply):
    """A megabyte without any match, of the kinds a careless pattern rescans."""
    cells = ["a" * 1_000_000, "1 " * 400_000, "@" + "b" * 1_000_000, " " * 1_000_000, "-" * 1_000_000]
    assert apply(pii.mask_matches, cells) == cells


def _one_after_another(cell: str, pattern: pii.Pattern, mask: bool) -> str:
    """The definition: each match in turn, wherever its text can be read by then."""
    for hit in [m[0] for m in re.finditer(plain.PATTERNS[pattern.name], cell)]:
        cell = cell.replace(hit, re.sub(r"\w", "#", hit) if mask else "")
    return cell


def _crowded(count: int) -> list[str]:
    """Cells of many numbers that repeat, touch, hold and continue each other."""
    dice = random.Random(21)

    def digits(n: int) -> str:
        return "".join(dice.choices("012", k=n))

    def number() -> str:
        kinds = (
            f"010-{digits(4)}-{digits(4)}", f"02-{digits(3)}-{digits(4)}", digits(dice.randint(8, 17)),
            "-".join(digits(4) for _ in range(4)), f"{digits(6)} - 1{digits(6)}",
            f"a{digits(2)}@b{digits(1)}.com", f"010-{digits(4)}-{digits(4)} ~ {digits(2)}",
            f"010 - 111{digits(1)} - 11{digits(2)}",
        )
        return dice.choice(kinds)

    cells = []
    for _ in range(count):
        gaps = dice.choice([[" "], ["\n"], [", "], [" ", "\n", "", ",", "-", "가", " - ", "x "]])
        pool = [number() for _ in range(dice.randint(1, 14))]
        cells.append("".join(dice.choice(pool) + dice.choice(gaps) for _ in range(14)))
    return [*cells, "\x01010-1234-5678\x02 010-1234-5678"]


@pytest.mark.parametrize("pattern", pii.ALL_PATTERNS, ids=lambda p: p.name)
def test_replacement_by_position_is_the_fold(apply, monkeypatch, pattern):
    monkeypatch.setattr(pii, "_FEW", 0)
    cells = _crowded(1200)
    got = apply(lambda c: pii.mask_matches(c, [pattern]), cells)
    assert got == [_one_after_another(c, pattern, True) for c in cells]
    got = apply(lambda c: pii.delete_matches(c, [pattern]), cells)
    assert got == [_one_after_another(c, pattern, False) for c in cells]


def test_own_pattern_with_looks_around_it(apply, monkeypatch):
    """A pattern may find a text in one place and not in another; the fold takes both."""
    monkeypatch.setattr(pii, "_FEW", 0)
    own = pii.Pattern("own", "(?<=x)[0-9]+")
    cells = ["x1 x2 1 x22 2 3", "x1x2x3 x4"]
    assert apply(lambda c: pii.mask_matches(c, [own]), cells) == ["x# x# # x## # 3", "x#x#x# x#"]


def test_many_matches_take_linear_time(apply):
    dice = random.Random(22)
    phones = [f"010-{dice.randrange(10**4):04d}-{dice.randrange(10**4):04d}" for _ in range(73_000)]
    mails = [f"u{dice.randrange(10**6)}@x{dice.randrange(99)}.com" for _ in range(30_000)]
    cells = [" ".join(phones), "\n".join(phones[:16_000]), " ".join(mails)]
    start = time.perf_counter()
    masked = apply(pii.mask_matches, cells)
    assert [len(m) for m in masked] == [len(c) for c in cells]
    assert not any(re.search(r"\d", m) for m in masked)
    deleted = apply(pii.delete_matches, cells)
    assert [len(d) for d in deleted] == [72_999, 15_999, 29_999]
    assert time.perf_counter() - start < 60
