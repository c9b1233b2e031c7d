"""Character classes shared by every text function, and two small helpers.

Python's ``\\w`` and ``\\s`` cover all of Unicode; Java's do not unless asked, and
``(?U)`` asks for something slightly different again. The bodies below spell the
classes out, so a pattern means the same on any Java version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Class bodies, to be used inside [...].
WORD = r"\p{L}\p{N}_"
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\p{Z}"

# Every whitespace character, as str.strip() sees it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ----------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """``text`` without Unicode whitespace at both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``.

    Higher-order functions are outside Spark's common-subexpression elimination,
    so an expression that needs its input twice would evaluate it twice, and a
    chain of n such steps 2**n times. A one-element ``transform`` binds the value
    to a lambda variable instead.
    """
    return F.transform(F.array(value), use)[0]
