"""Find card, account, phone and resident numbers and e-mail addresses in text,
and delete them, mask them, or drop the lines that hold them.

All of it is JVM-side expressions: one regex scan per pattern, then a fold over
the (usually short) list of matches. Where the list is long, a test in linear time tells
whether the fold would change anything but the matches where they stand; if not, the cell
is split at the matches and put together again.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrublens.functions.charclass import SPACE, WORD, bind


@dataclass(frozen=True)
class Pattern:
    """A regex, a literal every match must hold (a cheap test to skip a scan), and the body
    of a class of all characters a match can be made of (None: any)."""

    name: str
    regex: str
    needs: str | None = None
    chars: str | None = None


_GAP = f"[{SPACE}]*+"  # \s*; what follows is never whitespace, so it need not give back

# --- fixed values -----------------------------------------------------------
CARD = Pattern("card", "[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}", needs="-", chars=r"0-9\-")

RESIDENT_NO = Pattern(
    "resident_no", f"[0-9]{{6}}{_GAP}-{_GAP}[0-9]{{7}}", needs="-", chars=rf"0-9\-{SPACE}"
)

_HYPHEN = f"{_GAP}-{_GAP}"
_EXTENSION = f"{_GAP}[~∼,-]{_GAP}[0-9]{{1,4}}"
PHONE = Pattern(
    "phone",
    "(?=[0-9])(?:"
    + "|".join(
        (
            f"[0-9]{{2,3}}{_HYPHEN}[0-9]{{3,4}}{_HYPHEN}[0-9]{{4}}{_EXTENSION}",
            f"[0-9]{{3}}{_HYPHEN}[0-9]{{4}}{_EXTENSION}",
            f"[0-9]{{2,3}}{_HYPHEN}[0-9]{{3,4}}{_HYPHEN}[0-9]{{4}}",
            f"[0-9]{{2,3}}{_GAP}[0-9]{{3,4}}{_GAP}[0-9]{{4}}",
        )
    )
    + ")",
    chars=rf"0-9~∼,\-{SPACE}",
)

# Digit runs of 11 to 13, hyphenated groups, and groups followed by a digit run;
# the first alternative that fits wins. "," and "-" may stand inside a group. The
# look-ahead is no condition of its own: it only saves trying groups in all lengths
# where no digit run follows that could end them.
_GROUPS = r"[0-9,\-]{3,6}-[0-9,\-]{2,6}-[0-9,\-]{2,6}"
_DIGITS_11 = r"[0-9]\p{Nd}{10}"
_DIGITS_12 = r"[0-9]\p{Nd}{11}"
_DIGITS_13 = r"[0-9]\p{Nd}{12}"
_RUN_AFTER_GROUPS = rf"(?=[0-9,\-]{{9,40}}?{_DIGITS_11})"
ACCOUNT = Pattern(
    "account",
    r"(?=[0-9,\-])(?:"
    + "|".join(
        (
            _DIGITS_13,
            _RUN_AFTER_GROUPS + _GROUPS + _GROUPS + _DIGITS_13,
            _RUN_AFTER_GROUPS + _GROUPS + r"-[0-9,\-]{2}" + _DIGITS_12,
            _RUN_AFTER_GROUPS + _GROUPS + _DIGITS_13,
            _RUN_AFTER_GROUPS + _GROUPS + _DIGITS_12,
            _DIGITS_12,
            _RUN_AFTER_GROUPS + _GROUPS + r"-[0-9,\-]" + _DIGITS_13,
            _RUN_AFTER_GROUPS + _GROUPS + r"-[0-9,\-]{2}" + _DIGITS_11,
            _DIGITS_11,
            r"[0-9,\-]{3,6}-[0-9,\-]{2,6}-[0-9,\-]{2,7}",
        )
    )
    + ")",
    chars=r"\p{Nd},\-",
)

# A match cannot start inside a run of these characters, unless right after the match
# before (\G): no start inside a run can succeed where its head failed. Without that, a
# long run with no "@" would be rescanned from each position.
EMAIL = Pattern(
    "email",
    r"(?!(?<=[a-z0-9.\-+_])(?!\G))[a-z0-9.\-+_]++@[a-z0-9.\-+_]+\.[a-z]+",
    needs="@",
    chars=r"a-z0-9.\-+_@",
)

NUMBER_PATTERNS = (CARD, ACCOUNT, PHONE, RESIDENT_NO)

# The order in which a chain applies them.
ALL_PATTERNS = (CARD, ACCOUNT, PHONE, RESIDENT_NO, EMAIL)
# ----------------------------------------------------------------------------


def delete_matches(text: Column, patterns: Sequence[Pattern] = ALL_PATTERNS) -> Column:
    """For each match found, delete every literal occurrence of the matched string."""
    for pattern in patterns:
        text = bind(text, _rewriter(pattern, lambda hits: hits, lambda hit: F.lit("")))
    return text


def mask_matches(
    text: Column, patterns: Sequence[Pattern] = ALL_PATTERNS, strict: bool = False
) -> Column:
    """For each match found, replace every literal occurrence of the matched string
    by itself with each word character turned into ``#``.

    A match that is the beginning of a later, longer one spoils it, and the rest of
    the longer one stays readable. ``strict`` takes the longest matches first, which
    masks both.
    """

    def worth_masking(hits: Column) -> Column:
        # A run of hyphens is an account number to the pattern; masking leaves it as it is.
        hits = F.filter(hits, lambda hit: hit.rlike(f"[{WORD}]"))
        if not strict:
            return hits
        return F.array_sort(hits, lambda a, b: F.length(b) - F.length(a))

    def masked(hit: Column) -> Column:
        return F.regexp_replace(hit, f"[{WORD}]", "#")

    for pattern in patterns:
        text = bind(text, _rewriter(pattern, worth_masking, masked))
    return text


def delete_lines(text: Column, patterns: Sequence[Pattern] = ALL_PATTERNS) -> Column:
    """Drop each ``\\n``-separated line of the cell that holds a match.

    A cell none of whose text matches is not taken apart: a match within a line is
    also one within the cell.
    """
    hit = _any_match(patterns)

    def kept(cell: Column) -> Column:
        lines = F.filter(F.split(cell, "\n", -1), lambda line: ~hit(line))
        return F.when(hit(cell), F.array_join(lines, "\n")).otherwise(cell)

    return bind(text, kept)


def _any_match(patterns: Sequence[Pattern]) -> Callable[[Column], Column]:
    """Whether some pattern matches. The number patterns, all of which begin with a digit
    or another character of a digit group, share a scan."""
    numbers = [p.regex for p in patterns if p in NUMBER_PATTERNS]
    shared = r"(?=[0-9,\-])(?:" + "|".join(numbers) + ")"

    def found(cell: Column) -> Column:
        tests = [cell.rlike(shared)] if numbers else []
        for pattern in patterns:
            if pattern not in NUMBER_PATTERNS:
                test = cell.rlike(pattern.regex)
                tests.append(_holds(cell, pattern) & test if pattern.needs else test)
        return reduce(operator.or_, tests, F.lit(False))

    return found


def _holds(cell: Column, pattern: Pattern) -> Column:
    return F.contains(cell, F.lit(pattern.needs))


#: Up to so many matches are replaced one after another without a test; with more, a pass
#: over the cell for each would cost more than the test. The result is the same.
_FEW = 12
#: Longest match for which the test is made, since a regex steps through its characters.
_LONGEST = 256
_BEGIN, _END = "\x01", "\x02"


def _rewriter(
    pattern: Pattern, select: Callable[[Column], Column], swap: Callable[[Column], Column]
) -> Callable[[Column], Column]:
    """Replace every literal occurrence of each selected match, one match after another."""
    regex = F.lit(pattern.regex)

    def rewrite(cell: Column) -> Column:
        def replaced(hits: Column) -> Column:
            folded = F.aggregate(hits, cell, lambda done, hit: F.replace(done, hit, swap(hit)))
            pieces = F.split(cell, pattern.regex, -1)
            every_hit = F.regexp_extract_all(cell, regex, F.lit(0))
            in_place = F.array_join(
                F.zip_with(
                    pieces,
                    F.transform(every_hit, swap),
                    lambda piece, new: F.concat(piece, F.coalesce(new, F.lit(""))),
                ),
                "",
            )
            alone = ~_occurs_elsewhere(cell, pattern, hits) & ~_joins(pieces, hits, swap)
            return (
                F.when(F.size(hits) == 0, cell)
                .when(F.size(hits) <= _FEW, folded)
                .when(alone, in_place)
                .otherwise(folded)
            )

        swapped = bind(select(F.regexp_extract_all(cell, regex, F.lit(0))), replaced)
        if pattern.needs is None:
            return swapped
        return F.when(_holds(cell, pattern), swapped).otherwise(cell)

    return rewrite


def _occurs_elsewhere(cell: Column, pattern: Pattern, hits: Column) -> Column:
    """Whether some hit can be read anywhere but at the matches that equal it: within another
    match, across the edge of one, or beside them. Where that cannot be told, true.

    The matches are put between two marks, and all texts as long as some hit are read off, over
    the marks, but for the matches themselves; none of these may be a hit.
    """
    marks = f"[{_BEGIN}{_END}]"
    one = f"[{pattern.chars}]" if pattern.chars else f"[^{_BEGIN}{_END}]"

    def texts(marked: Column, length: Column) -> Column:
        size, rest = length.cast("string"), (length - 1).cast("string")
        regex = F.concat(
            F.lit(f"(?:(?<!{_BEGIN})|(?<={_BEGIN})(?!{one}{{"),
            size,
            F.lit(f"}}{_END}))(?=({one}(?:{marks}*+{one}){{"),
            rest,
            F.lit("}))"),
        )
        return F.regexp_extract_all(marked, regex, F.lit(1))

    def found(bound: Column) -> Column:
        marked, different = bound["marked"], bound["hits"]
        lengths = F.array_distinct(F.transform(different, F.length))
        read = F.flatten(F.transform(lengths, lambda length: texts(marked, length)))
        others = F.transform(read, lambda t: F.translate(t, _BEGIN + _END, ""))
        too_long = F.array_max(lengths) > _LONGEST
        return F.when(too_long, True).otherwise(F.arrays_overlap(others, different))

    marked = F.regexp_replace(cell, pattern.regex, f"{_BEGIN}$0{_END}")
    bound = F.struct(marked.alias("marked"), F.array_distinct(hits).alias("hits"))
    return F.when(cell.rlike(marks), True).otherwise(bind(bound, found))


def _joins(pieces: Column, hits: Column, swap: Callable[[Column], Column]) -> Column:
    """Whether deleting matches may put together the text of a hit from what was around them.
    Masks leave marks in place, so only an empty replacement can.

    Such a text would hold the last character before a match and the first one after it. The
    pieces between matches stay, so unless one is empty these two are known.
    """
    def unsure(bound: Column) -> Column:
        pieces, all_hits = bound["pieces"], bound["hits"]
        inner = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))
        lefts = F.concat(F.array(pieces[0]), inner)
        rights = F.concat(inner, F.array(F.element_at(pieces, -1)))
        # An empty piece says nothing, but at the ends of the cell, where nothing can join.
        empty = F.exists(inner, lambda piece: piece == "")
        pairs = F.zip_with(lefts, rights, lambda a, b: F.concat(F.right(a, F.lit(1)), F.left(b, F.lit(1))))
        pairs = F.filter(F.array_distinct(pairs), lambda pair: F.length(pair) == 2)
        return empty | F.exists(pairs, lambda pair: F.contains(all_hits, pair))

    bound = F.struct(pieces.alias("pieces"), F.array_join(hits, _BEGIN).alias("hits"))
    return (swap(F.get(hits, 0)) == "") & bind(bound, unsure)
