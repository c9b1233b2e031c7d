"""HTML cells to plain text, as a chain of column expressions.

The chain renders a page the way a Markdown converter would, because the sentence
filter at its end looks for Markdown's markers: a sentence glued to a heading, a
bullet, bold text or a link is dropped with it. Only the markers and the reading
order matter; wrapping, escapes and the indents of nested blocks are not imitated.
"""

from __future__ import annotations

import html.entities
import operator
import zlib
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrublens.functions.charclass import SPACE, WORD, bind
from scrublens.functions.personal_info import EMAIL
from scrublens.functions.text import clean_space

_GAP = f"[{SPACE}]*+"

# --- fixed values -----------------------------------------------------------
LINE_BREAK = f"<{_GAP}/?{_GAP}(?:br|BR){_GAP}/?{_GAP}>"

# A sentence that holds one of these is dropped.
SENTENCE_MARKERS = (
    "javascript",
    "/",
    "#",
    "*",
    "![",
    "[!",
    "[(",
    ")]",
    "[]",
    "()",
    ";",
    "뉴스",
    "기사",
    "신문",
    "카카오",
    "네이버",
    "티스토리",
    "무단전재",
    "저작권",
    "재배포",
    "구독",
    "검색어",
    "=",
    "__",
)

# A sentence is cut at the first of each of these, in this order.
SEE_MORE = ("더보기", "더 보기")

_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
_OCTET_V6 = "(?:25[0-5]|(?:2[0-4]|1{0,1}[0-9]){0,1}[0-9])"
_H = "[0-9a-fA-F]{1,4}"
_HOST_CHARS = r"a-z0-9.\-\p{Nd}"
# A leading "www." is made of host characters and needs no part of its own.
_HOST = rf"[{_HOST_CHARS}]+\.[a-z]{{2,6}}"
_IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_PORT = (
    ":[0-9]{1,4}|[1-5][0-9]{4}|6[0-4][0-9]{3}|65[0-4][0-9]{2}|655[0-2][0-9]|6553[0-5]"
)
_PATH = rf"(?:/[{WORD}./\-]*)?"
# Word boundaries, spelled out because \b depends on the Java version.
_TAIL_EDGE = f"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"
_TAIL = f"(?:{_PORT})?{_PATH}{_TAIL_EDGE}"
# A zone may be long; a host that follows it at once begins within it, so it is tried here.
_AFTER_ZONE = f"(?:(?>{_TAIL}){_HOST})?"
_IPV6 = "|".join(
    (
        f"(?:{_H}:){{7}}{_H}",
        f"(?:{_H}:){{1,7}}:",
        f"(?:{_H}:){{1,6}}:{_H}",
        f"(?:{_H}:){{1,5}}(?::{_H}){{1,2}}",
        f"(?:{_H}:){{1,4}}(?::{_H}){{1,3}}",
        f"(?:{_H}:){{1,3}}(?::{_H}){{1,4}}",
        f"(?:{_H}:){{1,2}}(?::{_H}){{1,5}}",
        f"{_H}:(?::{_H}){{1,6}}",
        f":(?:(?::{_H}){{1,7}}|:)",
        "fe80:(?::[0-9a-fA-F]{0,4}){0,4}%[0-9a-zA-Z]+" + _AFTER_ZONE,
        rf"::(?:ffff(?::0{{1,4}}){{0,1}}:){{0,1}}(?:{_OCTET_V6}\.){{3}}{_OCTET_V6}",
        rf"(?:{_H}:){{1,4}}:(?:{_OCTET_V6}\.){{3}}{_OCTET_V6}",
    )
)
# What every address has somewhere: a dot before two letters or between digits, or a colon next
# to another one or between hexadecimal digits. Most cells have none, and this is quick to see.
_ANY_URL = (
    r"[.:](?:(?<=\.)[a-z]{2}|(?<=[0-9]\.)[0-9]|(?<=::)|(?<=[0-9a-fA-F]:)[0-9a-fA-F%])"
)

# Markdown markers by tag name; a closing tag has a leading "/". Tags that are not
# listed vanish. A blank stands where a block begins or ends.
TAG_MARKERS = {
    "p": " ", "/p": " ", "div": " ", "/div": " ", "br": " ",
    "ul": " ", "/ul": " ", "ol": " ", "/ol": " ", "li": " * ", "/li": " ",
    "h1": " # ", "h2": " ## ", "h3": " ### ", "h4": " #### ", "h5": " ##### ", "h6": " ###### ",
    "/h1": " ", "/h2": " ", "/h3": " ", "/h4": " ", "/h5": " ", "/h6": " ",
    "b": "**", "/b": "**", "strong": "**", "/strong": "**",
    "em": "_", "/em": "_", "i": "_", "/i": "_", "u": "_", "/u": "_",
    "del": "~~", "/del": "~~", "strike": "~~", "/strike": "~~", "s": "~~", "/s": "~~",
    "code": "`", "/code": "`", "tt": "`", "/tt": "`", "q": '"', "/q": '"',
    "hr": " * * * ", "blockquote": " > ", "/blockquote": " ", "pre": " ", "/pre": " ",
    "dl": " ", "/dl": " ", "/dt": " ", "dd": " ", "/dd": " ",
    "table": " ", "/table": " ", "tr": " ", "/tr": " ", "td": " ", "th": " ",
}
# ----------------------------------------------------------------------------

# Addresses, one look at each maximal run of host characters. Whether a host can end at a dot
# does not depend on where it began, and a host takes the last dot that will do. So of all
# beginnings in a run only the first matters: what the run has before it is group 1, and if
# none of the run fits from there, none fits from later on.
_RUN_START = (
    rf"(?=[{_HOST_CHARS}])"
    # A run that began within the address before (its port, or the end of an IPv6 one).
    rf"(?:(?<![{_HOST_CHARS}])|\G(?<=[^{_HOST_CHARS}][{_HOST_CHARS}]{{1,16}}))"
    r"(?=[a-z0-9\-\p{Nd}]*+\.)"
)
_BEFORE_HOST = rf"((?<=[{WORD}])[a-z0-9\p{{Nd}}]*+|(?<![{WORD}])[.\-]*+)"
# The addresses of numbers are short, so they can be tried at every word boundary.
_NUMBERS = rf"(?:(?=[0-9]{{1,3}}\.){_IPV4}|(?=[0-9a-fA-F]{{0,4}}+:)(?:{_IPV6}))"
_NUMBERS_START = rf"(?:(?=[0-9a-fA-F])(?<![{WORD}])|(?=:)(?<=[{WORD}]))"
_SCHEME = rf"(?=h)(?<![{WORD}])https?://"
_URL = (
    # Nothing begins between two letters; most places are out at once.
    "(?!(?<=[a-z])[a-z])"
    f"(?:{_SCHEME}(?:{_HOST}|{_NUMBERS}){_TAIL}"
    f"|{_RUN_START}{_BEFORE_HOST}{_HOST}{_TAIL}"
    f"|{_NUMBERS_START}{_NUMBERS}{_TAIL})"
)

# The rest of a tag after its name. A quoted value may hold angle brackets; where quotes do
# not balance, the tag ends at the first bracket.
_REST = r"""(?:[^<>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=++)*+>"""
_TAG = f"<[/!?]?[A-Za-z]{_REST}"
_ELEMENT = f"<[A-Za-z]{_REST}"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"

_HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<script\b{_REST}.*?(?:</script\s*+>|\z)"
    rf"|<style\b{_REST}.*?(?:</style\s*+>|\z)"
)
_HEAD = r"(?is)<head(?:\s[^<>]*+)?>.*?(?:</head\s*+>|(?=<body\b)|\z)"

# From the name of a link's tag to its address: attributes before it may hold brackets in
# quotes, or the word href.
_TO_HREF = (
    r"<a(?:\s++(?!href\s*+=)[^\s<>=]++"
    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>]*+))?+)*+\s++href\s*+=\s*+"""
)
_SELF_LINK = rf"(?i){_TO_HREF}([\"'])([a-z+]++://[^\"'<>]++)\1{_REST}\2</a\s*+>"
_LINK = (
    rf"(?i){_TO_HREF}(?![\"']?#)"
    rf"""(?:"([^"<>]*+)"|'([^'<>]*+)'|([^\s"'<>]++)){_REST}"""
    r"((?:[^<]++|<(?!/?a\b))*+)</a\s*+>"
)

_LIST_TAG = rf"(?i)</?(?:ol|ul|li)\b{_REST}"
_CELL_TAG = rf"(?i)<t[dh]\b{_REST}"

_CHARREF = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_CHARREF_HEAD = r"&[^\t\n\f <&;]"
_BUCKET, _FIELD, _ENTRY = "\x03", "\x02", "\x01"


def unescape(text: Column) -> Column:
    """Replace character references, once: named ones of the full HTML table, also
    the old ones written without ``;``, and numeric ones with HTML's corrections.
    """

    def decode_all(cell: Column) -> Column:
        refs = F.regexp_extract_all(cell, F.lit(_CHARREF), F.lit(0))
        decoded = F.transform(refs, _decode_ref)
        replaced = _interleave(F.split(cell, _CHARREF, -1), decoded)
        return F.when(cell.rlike(_CHARREF_HEAD), replaced).otherwise(cell)

    return _where_held(text, ["&"], decode_all)


def br_to_newline(text: Column) -> Column:
    """``<br>`` in any spelling becomes a newline."""
    return F.regexp_replace(text, LINE_BREAK, "\n")


def has_element(text: Column) -> Column:
    """Whether the text holds an opening tag outside its comments."""

    def without_comments(cell: Column) -> Column:
        return F.regexp_replace(cell, _COMMENT, "")

    return _where_held(text, ["<!--"], without_comments).rlike(_ELEMENT)


def strip_tags(text: Column) -> Column:
    """Render HTML as Markdown-like text.

    Comments, scripts, styles and the document head go with their content; links and
    images keep their targets; other tags become their marker, or nothing.
    """
    text = F.regexp_replace(text, _HIDDEN, "")
    text = F.regexp_replace(text, _HEAD, "")
    text = _where_held(text, ["://"], lambda cell: F.regexp_replace(cell, _SELF_LINK, "$2"))
    text = F.regexp_replace(text, _LINK, r"[$4]($1$2$3)")

    def lay_out(cell: Column) -> Column:
        laid_out = bind(_number_lists(cell), _rule_tables)
        return F.when(cell.rlike(r"(?i)<(?:ol|table)\b"), laid_out).otherwise(cell)

    def mark_all(cell: Column) -> Column:
        marks = F.transform(F.regexp_extract_all(cell, F.lit(_TAG), F.lit(0)), _tag_marker)
        return _interleave(F.split(cell, _TAG, -1), marks)

    return unescape(bind(bind(text, lay_out), mark_all))


def delete_urls(text: Column) -> Column:
    """Delete web addresses: host names, IPv4 and IPv6, with port and path. A query
    string is not part of the match, nor is a trailing ``/``."""

    def without(cell: Column) -> Column:
        return F.when(cell.rlike(_ANY_URL), F.regexp_replace(cell, _URL, "$1")).otherwise(cell)

    return bind(text, without)


def delete_emails(text: Column) -> Column:
    """Delete e-mail addresses where they stand."""
    return _where_held(text, [EMAIL.needs], lambda cell: F.regexp_replace(cell, EMAIL.regex, ""))


def delete_url_tokens(text: Column) -> Column:
    """Delete every ``<``, ``>``, ``url_start`` and ``url_end``."""
    return _delete_tokens(text, "url_start", "url_end")


def delete_email_tokens(text: Column) -> Column:
    """Delete every ``<``, ``>``, ``email_start`` and ``email_end``."""
    return _delete_tokens(text, "email_start", "email_end")


def delete_tokens(text: Column) -> Column:
    """Delete angle brackets and the names of the URL and e-mail placeholder tokens."""
    return delete_email_tokens(delete_url_tokens(text))


def split_sentences(text: Column) -> Column:
    """Split at one whitespace character after ``.``, ``!`` or ``?``."""
    return F.split(text, f"(?<=[.!?])[{SPACE}]", -1)


def drop_marked(sentences: Column) -> Column:
    """Keep the sentences that hold none of the markers."""

    def unmarked(sentence: Column) -> Column:
        return ~reduce(operator.or_, (F.contains(sentence, F.lit(m)) for m in SENTENCE_MARKERS))

    return F.filter(sentences, unmarked)


def cut_see_more(sentences: Column) -> Column:
    """Cut each sentence at "see more"."""

    def cut(sentence: Column) -> Column:
        for phrase in SEE_MORE:
            sentence = F.substring_index(sentence, phrase, 1)
        return sentence

    return F.transform(sentences, cut)


def html_to_text(text: Column) -> Column:
    """The whole chain. Text without an element is only unescaped and its line breaks
    turned into newlines."""

    def render(cell: Column) -> Column:
        plain = delete_urls(clean_space(strip_tags(cell)))
        plain = delete_email_tokens(delete_emails(delete_url_tokens(plain)))
        kept = cut_see_more(drop_marked(split_sentences(plain)))
        joined = F.replace(clean_space(F.array_join(kept, " ")), F.lit(" !"), F.lit(""))
        return F.when(has_element(cell), joined).otherwise(cell)

    return bind(br_to_newline(unescape(text)), render)


def _where_held(
    text: Column, needles: Sequence[str], rewrite: Callable[[Column], Column]
) -> Column:
    """``rewrite`` the cells that hold one of ``needles``; the others are none of its
    business, and finding that out is much cheaper than a regex scan."""

    def rewritten(cell: Column) -> Column:
        held = reduce(operator.or_, (F.contains(cell, F.lit(needle)) for needle in needles))
        return F.when(held, rewrite(cell)).otherwise(cell)

    return bind(text, rewritten)


def _delete_tokens(text: Column, start: str, end: str) -> Column:
    """Angle brackets and ``start`` in one pass, then ``end``: a name that only comes
    about by a deletion goes if a later pass looks for it."""

    def without(cell: Column) -> Column:
        return F.replace(F.regexp_replace(cell, f"[<>]|{start}", ""), F.lit(end), F.lit(""))

    return _where_held(text, ["<", ">", start, end], without)


def _interleave(between: Column, replacements: Column) -> Column:
    """Put a text split at a pattern together again, with the matches replaced."""
    pairs = F.zip_with(between, replacements, lambda b, r: F.concat(b, F.coalesce(r, F.lit(""))))
    return F.array_join(pairs, "")


#: Tags numbered at once. What a tag costs grows with it, what a block costs with the number
#: of blocks; any value gives the same numbers.
_LIST_BLOCK = 64


def _number_lists(cell: Column) -> Column:
    """Bullets for the items of ``<ul>``, numbers for those of ``<ol>``: the list tags in
    order change a stack of open lists (the last number given, or the bullet).

    Stacks and marks are arrays, and an array is copied whenever it grows. So tags are taken
    in blocks: a block sees no more of the stack than its tags can reach, and only its own
    marks; between blocks the stack is put together again.
    """
    bullet, blank = F.lit(-(2**31)), F.lit(-(2**31) + 1)

    def coded(tag: Column) -> Column:
        """What a tag does, and the number before the first of the list it opens."""
        first = F.coalesce(_attribute(tag, "start").try_cast("int"), F.lit(1)) - 1
        return bind(
            F.lower(F.regexp_extract(tag, "^<(/?[A-Za-z]+)", 1)),
            lambda name: F.struct(
                name.alias("name"),
                F.when(name == "ol", first).when(name == "ul", bullet).alias("opened"),
            ),
        )

    def step(state: Column, tag: Column) -> Column:
        name, lists = tag["name"], state["lists"]
        last = F.get(lists, F.size(lists) - 1)
        outer = _without_last(lists, F.lit(1))
        numbered = (name == "li") & (last > bullet)
        now = (
            F.when(tag["opened"].isNotNull(), F.concat(lists, F.array(tag["opened"])))
            .when(name.isin("/ol", "/ul"), outer)
            .when(numbered, F.concat(outer, F.array(last + 1)))
            .otherwise(lists)
        )
        mark = F.when(numbered, last + 1).when(name == "li", bullet).otherwise(blank)
        marks = F.concat(state["marks"], F.array(mark))
        return F.struct(now.alias("lists"), marks.alias("marks"))

    def block(state: Column, tags: Column) -> Column:
        lists = state["lists"]
        reach = F.least(F.size(lists), F.lit(_LIST_BLOCK))
        top = F.slice(lists, F.size(lists) - reach + 1, reach)
        nothing = F.from_json(F.lit("[]"), "array<int>")
        inner = F.aggregate(
            tags, F.struct(top.alias("lists"), nothing.alias("marks")), step, lambda end: end
        )
        return bind(
            inner,
            lambda end: F.struct(
                F.concat(_without_last(lists, reach), end["lists"]).alias("lists"),
                F.concat(state["marks"], F.array(end["marks"])).alias("marks"),
            ),
        )

    start = F.from_json(
        F.lit('{"lists": [], "marks": []}'), "lists array<int>, marks array<array<int>>"
    )

    def blocks(tags: Column) -> Column:
        last = F.greatest(F.size(tags) - 1, F.lit(0))
        begins = F.sequence(F.lit(0), F.floor(last / _LIST_BLOCK).cast("int"))
        return F.transform(
            begins, lambda i: F.slice(tags, i * _LIST_BLOCK + 1, F.lit(_LIST_BLOCK))
        )

    def written(mark: Column) -> Column:
        number = F.concat(F.lit(" "), mark.cast("string"), F.lit(". "))
        return F.when(mark == blank, " ").when(mark == bullet, TAG_MARKERS["li"]).otherwise(number)

    tags = F.transform(F.regexp_extract_all(cell, F.lit(_LIST_TAG), F.lit(0)), coded)
    numbers = F.aggregate(bind(tags, blocks), start, block, lambda state: F.flatten(state["marks"]))
    marks = F.transform(numbers, written)
    return _interleave(F.split(cell, _LIST_TAG, -1), marks)


def _without_last(items: Column, count: Column) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - count, F.lit(0)))


def _rule_tables(cell: Column) -> Column:
    """Bars between the cells of a table row, a ruler below the first row."""

    def rule_row(row: Column, index: Column) -> Column:
        cells = F.split(row, _CELL_TAG, -1)
        count = F.size(cells) - 1
        barred = F.concat(cells[0], F.lit(" "), F.array_join(F.slice(cells, 2, count), "| "))
        ruler = F.concat(
            F.lit(" "), F.array_join(F.array_repeat(F.lit("---"), count), "|"), F.lit(" ")
        )
        is_head = (index == 0) & row.rlike(r"(?i)</tr>\z")
        line = F.when(count > 0, barred).otherwise(row)
        return F.concat(line, F.when(is_head, ruler).otherwise(F.lit("")))

    def rule_table(piece: Column) -> Column:
        ruled = F.array_join(F.transform(F.split(piece, "(?i)(?<=</tr>)", -1), rule_row), "")
        return F.when(piece.rlike(r"\A(?i)<table\b"), ruled).otherwise(piece)

    return F.array_join(F.transform(F.split(cell, r"(?i)(?=<table\b)", -1), rule_table), "")


def _tag_marker(tag: Column) -> Column:
    name = F.lower(F.regexp_extract(tag, "^</?([A-Za-z][A-Za-z0-9]*)", 1))
    key = F.concat(F.when(F.startswith(tag, F.lit("</")), F.lit("/")).otherwise(F.lit("")), name)
    marker = F.coalesce(F.element_at(_literal_map(TAG_MARKERS), key), F.lit(""))
    source = _attribute(tag, "src")
    image = F.concat(F.lit("!["), _attribute(tag, "alt"), F.lit("]("), source, F.lit(")"))
    return F.when((name == "img") & (source != ""), image).otherwise(marker)


def _attribute(tag: Column, name: str) -> Column:
    value = rf"""(?i)\s{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    return F.regexp_replace(F.regexp_extract(tag, value, 1), "^[\"']|[\"']$", "")


def _decode_ref(ref: Column) -> Column:
    whole = F.when(F.endswith(ref, F.lit(";")), _looked_up(_NAMES, ref))
    usual = F.element_at(_literal_map({name: _NAMES[name] for name in _USUAL}), ref)
    named = F.coalesce(usual, whole, _decode_old(ref))
    return F.when(F.startswith(ref, F.lit("&#")), _decode_number(ref)).otherwise(named)


def _decode_old(ref: Column) -> Column:
    """A reference that begins with one of the names valid without ``;``."""
    old = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
    prefix = F.regexp_extract(ref, "^&(?:" + "|".join(old) + ")", 0)
    decoded = F.concat(_looked_up(_NAMES, prefix), F.substr(ref, F.length(prefix) + 1))
    return F.when(prefix != "", decoded).otherwise(ref)


_USUAL = ("&amp;", "&lt;", "&gt;", "&quot;", "&nbsp;", "&middot;", "&copy;")
_NAMES = {"&" + name: text for name, text in html.entities.html5.items()}


def _looked_up(entries: dict[str, str], key: Column) -> Column:
    """The entry of ``key``, NULL if there is none. A map would be scanned from its beginning;
    here the entries are dealt by a checksum to buckets of about one, and only that of the key
    is looked through."""
    count = 2 * len(entries)
    buckets: list[list[str]] = [[] for _ in range(count)]
    for name, text in entries.items():
        buckets[zlib.crc32(name.encode()) % count].append(name + _FIELD + text)
    table = F.split(F.lit(_BUCKET.join(map(_ENTRY.join, buckets))), _BUCKET, -1)
    bucket = F.get(table, (F.crc32(key.cast("binary")) % count).cast("int"))
    return F.element_at(F.str_to_map(bucket, F.lit(_ENTRY), F.lit(_FIELD)), key)


def _literal_map(entries: dict[str, str]) -> Column:
    """A map of a few entries; finding one scans it."""
    text = _ENTRY.join(key + _FIELD + value for key, value in entries.items())
    return F.str_to_map(F.lit(text), F.lit(_ENTRY), F.lit(_FIELD))


def _decode_number(ref: Column) -> Column:
    hexadecimal = F.regexp_extract(ref, "^&#[xX]0*([0-9a-fA-F]*)", 1)
    decimal = F.regexp_extract(ref, "^&#0*([0-9]*)", 1)
    # Up to 0x10FFFF; anything longer is out of range whatever its value.
    from_hex = F.when(F.length(hexadecimal) <= 6, F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10))
    from_decimal = F.when(F.length(decimal) <= 7, F.concat(F.lit("0"), decimal))
    is_hex = F.lower(F.substring(ref, 3, 1)) == "x"
    number = F.when(is_hex, from_hex).otherwise(from_decimal).cast("int")
    corrections = {str(code): text for code, text in _corrections().items()}

    def character(code: Column) -> Column:
        valid = (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        encoded = F.unhex(F.lpad(F.hex(code), 8, "0"))
        return F.coalesce(
            _looked_up(corrections, code.cast("string")),
            F.when(valid, F.decode(encoded, "UTF-32")),
            F.lit("�"),
        )

    return bind(number, character)


def _corrections() -> dict[int, str]:
    """Code points that a numeric reference may name but does not mean: zero, the C1
    controls read as Windows-1252, and the controls and non-characters that vanish."""
    vanish = [*range(0x1, 0x9), 0xB, *range(0xE, 0x20), 0x7F, *range(0xFDD0, 0xFDF0)]
    vanish += [plane << 16 | low for plane in range(0x11) for low in (0xFFFE, 0xFFFF)]
    c1 = {code: bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(0x80, 0xA0)}
    return {0: "�", **dict.fromkeys(vanish, ""), **c1}
