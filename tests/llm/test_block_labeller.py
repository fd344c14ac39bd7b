"""The block labeller on pages that its generator cannot make, and on broken ones."""

from __future__ import annotations

import time

import pytest

from recordops.llm import block_labeller

A = "The harbour was closed on Tuesday after the storm tore away part of the old pier, officials said."
B = "Engineers expect the repairs to take at least six weeks, and fishing boats will be moved to the northern basin."
C = "Nobody was hurt, but several small boats sank at their moorings during the night."
#: Pages and the blocks that are their main text.
PAGES = [
    (f"<html><body>{A}<br><br>{B}<br>{C}</body></html>",{f"{A} {B} {C}"}),
    (f"<html><body><a href=/>Home</a> <a href=/n>News</a><h1>Storm closes harbour</h1>{A}<br><br>{B}<hr>Copyright 2020 Harbour Times</body></html>",{"Storm closes harbour",f"{A} {B}"}),
    (f"<html><body><nav><a href=/>Home</a><a href=/b>Sport</a></nav><main><section><h2>Storm closes harbour</h2><p>{A}</p><p>{B}</p></section><section class=x7><p>{C}</p></section></main><footer>Imprint and privacy</footer></body></html>",{"Storm closes harbour",A,B,C}),
    (f"<main><section class=y><p>{A}</p><p>{B}</p></section></main>",{A,B}),
    (f"<table><tr><td><a href=/1>Home</a><br><a href=/2>Archive</a><br><a href=/3>Contact</a></td><td><h1>Storm closes harbour</h1><p>{A}</p><p>{B}</p></td><td><b>Weather</b><br>Rain, 12 degrees</td></tr></table>",{"Storm closes harbour",A,B}),
    (f"<body><header><h1>Harbour Times</h1></header><article><h1>Storm closes harbour</h1><p>{A}</p><p>{C}</p></article><h3>Comments</h3><ul><li>Ann says: what a night, our cellar is full of water. <a href=#>Reply</a></li><li>Bob says: thanks for the report. <a href=#>Reply</a></li></ul></body>",{"Storm closes harbour",A,C}),
    (f"<div><div><div><h2>Storm closes harbour</h2><p>{A}</p><p>{B}</p><ul><li>Ferries are cancelled until Friday.</li><li>The market moves to the square.</li></ul></div></div></div>",{"Storm closes harbour",A,B,"Ferries are cancelled until Friday.","The market moves to the square."}),
    (f"<body><div class=topnav><a href=/>Home</a> <a href=/x>About us</a></div><div id=q3><h1>Storm closes harbour</h1><p>{A}</p><blockquote>{C}</blockquote></div><div class='newsletter'><p>Sign up for our newsletter and get the news every morning.</p><button>Subscribe</button></div><footer><p>All rights reserved.</p></footer></body>",{"Storm closes harbour",A,C}),
    (f"<body><div class=cookie-banner>We use cookies to improve the site. <button>Accept</button></div><div class=content><p>{A}<p>{B}<p>{C}</div><aside><h3>Related</h3><ul><li><a href=/s>Sea level rises</a><li><a href=/t>Old pier turns 100</a></ul></aside></body>",{A,B,C}),
    (f"<body><form action=/s><label>Search</label><input name=q><button>Go</button></form><main><div><div><p>{A}</p><div>{B}</div></div></div></main><section class=comments><h3>2 comments</h3><div class=comment><b>Ann</b> what a night, our cellar is full.</div></section></body>",{A,B}),
    (f"<center><font size=2>{A}<p>{B}<p>{C}</font></center>",{A,B,C}),
    (f"<body><ul><li><a href=/a>Start</a><li><a href=/b>Shop</a><li><a href=/c>Help</a></ul><section><h1>Storm closes harbour</h1><section><p>{A}</p></section><section><p>{B}</p><p>{C}</p></section></section><div class=footer>Contact: info at harbour times. Imprint.</div></body>",{"Storm closes harbour",A,B,C}),
]


def test_hand_written_pages():
    """Bare bodies, tables, sections without names and comments that only their words give away: 95 of 100 blocks."""
    found = [block_labeller.blocks(page) for page, _ in PAGES]
    chances = block_labeller.label(found, block_labeller.trained())
    right = [(p >= 0.5) == (text in main) for f, c, (_, main) in zip(found, chances, PAGES) for (text, *_), p in zip(f, c)]
    assert sum(right) >= 0.95 * len(right)


@pytest.mark.parametrize("bit", ["<a", "<a x ", "<!", '<a "', "<a '", "<a \"'", "<div>x", "</b2>", "<iframe>", "<svg>", "<style>", "&#1", '<a ">"', "<p class=", "<td>x", "<!--"])
def test_a_megabyte_of_broken_text_takes_no_time(bit):
    start = time.perf_counter()
    block_labeller.blocks(bit * (1_000_000 // len(bit)))
    assert time.perf_counter() - start < 2


def test_deep_pages_and_long_numbers():
    start = time.perf_counter()
    assert len(block_labeller.blocks("<div>x" * 30_000 + "</span2>" * 30_000)) == 30_000
    assert block_labeller.blocks("a&#" + "1" * 900_000 + ";b")[0][0] == "a\ufffdb"
    block_labeller.blocks('<a ">"' * 160_000 + '"')
    assert time.perf_counter() - start < 5


def test_tags_of_odd_pages():
    texts = lambda page: [b[0] for b in block_labeller.blocks(page)]
    assert texts('<p a="x>y">t</p>') == ["t"]
    assert texts('<p a="x>t</p>') == ["t"]  # the quote stays open, so the next > ends the tag
    assert texts("a<b c>d") == ["ad"]
    assert texts("1 < 2 <p>3 > 2") == ["1 < 2", "3 > 2"]
    assert texts("<!-- a <p> b") == [] and texts("x <!-- a --> y") == ["x y"]
    assert texts("<") == ["<"] and texts("<a") == ["<a"] and texts("") == []


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, blocks string"
    pages = [(i % 4, f"u{i % 4}", PAGES[i % 4][0] if i % 4 else None, "x", "x", "x") for i in range(12)]
    rows = spark.createDataFrame(pages, schema).repartition(3)
    got = sorted(tuple(r) for r in block_labeller.extract(rows).collect())
    assert len(got) == 12 and got[0] == (0, "u0", "", 0) and got[::3] == got[1::3] == got[2::3]
    assert all(n == len(text) for *_, text, n in got)
    assert block_labeller.extract(rows.limit(0)).count() == 0
