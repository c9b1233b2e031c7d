from __future__ import annotations

import html
import random
import time

import pytest
from pyspark.sql import functions as F

from scrublens.functions import html as ops
from tests import plain
from tests.conftest import SF_DIR
from tests.test_text import strings


def test_unescape_like_python(apply):
    rng = random.Random(7)
    names = sorted(html.entities.html5)
    pieces = [
        *["&", "&#", "&#x", ";", "#", "a", "B", "1", " ", "\n", "<", "=", "&amp", "&notit;", "&am"],
        *["&#0;", "&#13;", "&#x80;", "&#xD800;", "&#1114112;", "&#65534;", "&#11;", "&#x1F600;"],
        "&#99999999999999999999;",
    ]
    cells = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(800)]
    cells += [f"x&{name}y &{name.rstrip(';')} z" for name in names]
    cells += [f"&#{code}; &#x{code:x} " for code in range(0, 0x110005, 257)]
    cells += [f"&#{code};" for code in range(0x100)]
    assert apply(ops.unescape, cells) == [html.unescape(c) for c in cells]


def test_br_to_newline(apply):
    cells = ["a<br>b</br>c<br/>d< / BR / >e<Br>f", None]
    assert apply(ops.br_to_newline, cells) == ["a\nb\nc\nd\ne<Br>f", None]


def test_has_element(apply):
    cells = ["<p>", "a < b", "</p>", "<!-- x -->", "<img src='x'/>", "", None]
    assert apply(ops.has_element, cells) == [True, False, False, False, True, False, None]


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("a<!-- <b>x</b> -->b<!-- open", "ab"),
        ("<script>if (a<b) '</p>'</script>x<STYLE>y</STYLE >z<script>open", "xz"),
        ("<head><title>t</title></head>x", "x"),
        ("<head><title>t</title><body>x", "x"),
        ("<header>x</header>", "x"),
        ("<h2 class=x>t</h2>", " ## t "),
        ("<ul><li>a<li>b</ul>", "  * a * b "),
        ("<b>x</b><em>y</em><del>z</del><code>w</code><q>v</q>", '**x**_y_~~z~~`w`"v"'),
        ('<a href="/x" title="t">te<b>x</b>t</a>', "[te**x**t](/x)"),
        ("<a class=c href='/x'>t</a> <a href=/y>u</a>", "[t](/x) [u](/y)"),
        ('<a href="#top">t</a> <a name="n">u</a>', "t u"),
        ('<a href="http://e.com/a">http://e.com/a</a>', "http://e.com/a"),
        ('<a href="/x">open <a href="/y">t</a>', "open [t](/y)"),
        ('<img alt="q r" src="a.png"><img alt=x>', "![q r](a.png)"),
        ("a<hr/>b", "a * * * b"),
        ("a < b, c <d", "a < b, c <d"),
        ("<p>&lt;x&gt;</p>", " <x> "),
        ("f<span>o</span>o", "foo"),
        ("<ol><li>a</li><li>b</li></ol>", "  1. a  2. b  "),
        ("<OL START='5'><LI>a<LI>b</OL>", "  5. a 6. b "),
        (
            "<ol><li>a<ul><li>x</ul><li>b<ol start=x><li>y</ol><li>c</ol><ul><li>z</ul><li>w",
            "  1. a  * x  2. b  1. y  3. c   * z  * w",
        ),
        (
            "<table><tr><th>a</th><th>b</th></tr><tr><td>c</td><td>d</td></tr></table>e",
            "   a| b  ---|---   c| d  e",
        ),
        ("<TABLE class=x><TR><TD>a</TR></TABLE>b<table><tr><td>c", "   a  ---  b   c"),
    ],
)
def test_strip_tags(apply, cell, expected):
    assert apply(ops.strip_tags, [cell]) == [expected]


def test_pages_like_parser(spark):
    """Whole pages against the standard library's parser."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    shown = pages.select(
        "html",
        ops.strip_tags(F.col("html")).alias("stripped"),
    )
    for row in shown.collect():
        # A tag cut off by the page's end stays as text here; the parser drops it.
        if row.html.rfind("<") <= row.html.rfind(">"):
            assert row.stripped == plain.strip_tags(row.html)


URL_PIECES = [
    *["http://", "https://", "www.", "a.com", "b-c.org", "x", "1.2.3.4", "256.1.1.1", "::1"],
    *["fe80::1%eth0", "1:2:3:4:5:6:7:8", "a::", "::ffff:1.2.3.4", ":80", "/", "/p.q/r-s", "?a=b"],
    *[" ", ".", ",", "é", "가", "_", "-", "A", "12", "co", "\n", "٣", "²"],
]


def test_urls_like_plain(apply):
    rng = random.Random(8)
    cells = ["".join(rng.choices(URL_PIECES, k=rng.randint(1, 9))) for _ in range(6000)]
    cells += strings(1500, seed=9, alphabet="ab1f:./-é 가_%", longest=30)
    # Runs too long to be looked at from each hyphen, with something before and after.
    runs = strings(300, seed=12, alphabet="ab1F-", longest=150)
    cells += [f"{rng.choice(URL_PIECES)}{r}{''.join(rng.choices(URL_PIECES, k=3))}" for r in runs]
    assert apply(ops.delete_urls, cells) == [plain.URL.sub("", c) for c in cells]


def test_emails_like_plain(apply):
    import re

    cells = strings(2500, seed=10, alphabet="ab.@-+_Z é1", longest=30)
    expected = [re.sub(plain.PATTERNS["email"], "", c) for c in cells]
    assert apply(ops.delete_emails, cells) == expected


def test_tokens(apply):
    cells = ["<|url_start|>x<|url_end|>", "a<email_start>b email_end", "url_<end url_<start", None]
    assert apply(ops.delete_tokens, cells) == ["||x||", "ab ", " url_start", None]


def test_sentences(apply):
    cells = ["a. b! c? d.e.  f", "", "x. y", None]
    assert apply(ops.split_sentences, cells) == [
        ["a.", "b!", "c?", "d.e.", " f"],
        [""],
        ["x.", "y"],
        None,
    ]


@pytest.mark.parametrize("marker", ops.SENTENCE_MARKERS)
def test_each_marker_drops_its_sentence(apply, marker):
    kept = apply(lambda c: ops.drop_marked(ops.split_sentences(c)), [f"a. b{marker}c. d!"])
    assert kept == [["a.", "d!"]]


def test_cut_see_more(apply):
    cells = ["a 더보기 b 더 보기", "c 더 보기 d", "e"]
    got = apply(lambda c: ops.cut_see_more(F.array(c)), cells)
    assert got == [["a "], ["c "], ["e"]]


def test_whole_chain(apply):
    cells = {
        "a &amp; b<br>c": "a & b\nc",
        "<p>본문 더보기 끝</p>": "본문",
        "<p>무단전재 금지. 본문.</p>": "본문.",
        "<p>See www.a.com or x@b.org now !</p>": "See or x@ now",  # addresses go first
        "&lt;p&gt;x  y&lt;/p&gt;": "x y",
        "": "",
        None: None,
    }
    assert apply(ops.html_to_text, list(cells)) == list(cells.values())


def test_long_cells(apply):
    """Megabytes of nesting, of open tags and of references neither overflow the stack
    nor take long."""
    cells = [
        "<a href='x'>" + "<b>x</b>" * 100_000 + "</a>",
        "<div>" * 200_000,
        "<" * 500_000,
        "&amp;" * 100_000,
        "<!--" * 100_000,
        "/a" * 300_000,
        "<p>" + "word " * 200_000,
        "<p>" + "a-" * 500_000,
        "<ol>" + "<li>x" * 10_000,
        "<table>" + "<tr><td>x<td>y</tr>" * 50_000,
    ]
    assert len(apply(ops.html_to_text, cells)) == len(cells)


def test_brackets_in_quoted_attributes(apply):
    cells = {
        '<p title="a>b">text one.</p>': " text one. ",
        'x <img alt="1 > 0" src="u.png"> y': "x ![1 > 0](u.png) y",
        "<p title='a<b'>t</p>": " t ",
        '<p title="a>t</p>': " t ",
    }
    assert apply(ops.strip_tags, list(cells)) == list(cells.values())


def test_elements_in_comments_do_not_count(apply):
    cells = ["<!-- <b>hi</b> --> plain # text", "<!-- <b> -->", "<!-- x --><b>y</b>", "<!-- <b>"]
    assert apply(lambda c: ops.has_element(c).cast("string"), cells) == ["false", "false", "true", "false"]
    assert apply(ops.html_to_text, cells[:1]) == cells[:1]


def test_urls_in_long_runs_take_linear_time(apply):
    """A run of host characters is looked at once, wherever in it an address ends."""
    cells = {
        "a.1." * 250_000: "a.1." * 250_000,
        "a-" * 500_000 + ".": "a-" * 500_000 + ".",
        "Kab.com" + ".1" * 400_000: None,
        "1.2.3.4-" * 120_000: "-" * 120_000,
        "http://a.1." * 90_000: None,
        "x.com " * 150_000: " " * 150_000,
        "1::/" + "." * 900_000: None,
        "K" + "a" * 1_000_000: "K" + "a" * 1_000_000,
    }
    start = time.perf_counter()
    got = apply(ops.delete_urls, list(cells))
    assert time.perf_counter() - start < 40
    assert all(want is None or have == want for have, want in zip(got, cells.values()))


def test_a_host_after_a_numeric_address(apply):
    """It may begin within a run that began in the address before it."""
    cells = ["AB::1.b.com", "1.2.3.4:80.b.com", "fe80::1%abcdefghijklmnopqrstuvw.b.com", "x.com12345", "a.co:8012.b.com"]
    assert apply(ops.delete_urls, cells) == [plain.URL.sub("", c) for c in cells]


def test_links_with_brackets_and_decoys(apply):
    cells = {
        '<a title="1>0" href="http://u.example">t</a>': "[t](http://u.example)",
        "<a title=\"x href=y\" class=b href='z' id=\"i>j\">w</a>": "[w](z)",
        '<a data-a="1>2" href="http://s.com" rel=">">http://s.com</a>': "http://s.com",
        "<A  HREF = u >c</A> <a href=\"#x\">q</a>": "[c](u) q",
        "<a title=\"x>t</a>": "t",
    }
    assert apply(ops.strip_tags, list(cells)) == list(cells.values())


def _numbered(cell: str) -> list[int | None]:
    """The number of each list item, None for a bullet, by a plain stack."""
    import re

    numbers, lists = [], []
    for close, name, start in re.findall(r'<(/?)(ol|ul|li)(?: start="(\d+)")?>', cell):
        if name == "li" and not close:
            numbers.append(lists[-1] if lists else None)
            if lists and lists[-1] is not None:
                lists[-1] += 1
        elif name != "li" and close:
            lists = lists[:-1]
        elif name != "li":
            lists.append(None if name == "ul" else int(start or 1))
    return numbers


@pytest.mark.parametrize("block", [1, 3, 64])
def test_list_numbers_do_not_depend_on_blocks(apply, monkeypatch, block):
    import re

    monkeypatch.setattr(ops, "_LIST_BLOCK", block)
    rng = random.Random(13)
    tags = ["<ol>", "</ol>", "<ul>", "</ul>", '<ol start="7">', "<li>", "<li>", "<li>", "</li>"]
    cells = ["<ol>" + "".join(f"{rng.choice(tags)}x" for _ in range(rng.randint(1, 150))) for _ in range(150)]
    found = [
        [int(n) if n else None for n in re.findall(r"(?:(\d+)\.|\*)(?= x)", text)]
        for text in apply(ops.strip_tags, cells)
    ]
    assert found == [_numbered(cell) for cell in cells]


def test_long_lists_and_references_take_linear_time(apply):
    cells = ["<ol>" + "<li>x" * 200_000, "<ol><li>" * 30_000, "&CounterClockwiseContourIntegral;" * 30_000]
    cells.append("&eacute" * 100_000)
    start = time.perf_counter()
    got = apply(ops.strip_tags, cells)
    assert time.perf_counter() - start < 60
    assert got[0].rstrip().endswith("200000. x") and got[2] == "∳" * 30_000 and got[3] == "é" * 100_000
