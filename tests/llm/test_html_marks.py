"""Marks, ratios and path sums of HTML extraction, and what redaction leaves alone."""

import re
from xml.etree import ElementTree

import pytest

from roadpulse.llm import html_text, secrets

LONG = "A sentence that is long enough, with words, and signs. " * 4


@pytest.mark.parametrize(
    "opening",
    [
        "<p title='a hidden gem'>", "<section data-id='search'><p>", "<div class='overflow-hidden'><p>",
        "<h2 id='legal-status'>", "<h2 id='comments'>", "<p data-role=menu>", "<div class='no-sidebar'><p>",
        "<p class='legal-status'>", "<div title=\"class='ad'\"><p>", "<div class='x' class='ad'><p>",
    ],
)
def test_values_that_mark_nothing(opening):
    page = f"<article><h1>Head</h1><p>{LONG}</p>{opening}Kept words, all of them.</article>"
    assert html_text.main_text(page) == f"Head\n{LONG.strip()}\nKept words, all of them."


@pytest.mark.parametrize(
    "opening",
    [
        "<div class='site-footer'>", "<div class='wide ad'>", "<div id=comment-list>", "<div role='search'>",
        "<p class='advert'>", "<div class='cookieBanner'>", "<div hidden>", "<div HIDDEN=''>", "<div aria-hidden=true>",
        "<div style='color: red; display: none'>", "<div class='main-nav__links'>", "<div class='ad-300x250'>",
    ],
)
def test_values_that_mark(opening):
    page = f"<article><h1>Head</h1><p>{LONG}</p>{opening}Left out, all of it."
    assert html_text.main_text(page) == f"Head\n{LONG.strip()}"


def test_ratios_decide_inside_the_article(monkeypatch):
    links = "".join(f"<li><a href={i}>Another story, number {i}</a></li>" for i in range(5))
    page = f"<article><h1>Head</h1><p>{LONG}</p><ul class='more'>{links}</ul><ul><li>An item</li></ul><p>{LONG}</p></article>"
    want = ["Head", LONG.strip(), "An item", LONG.strip()]
    assert html_text.main_text(page).split("\n") == want
    monkeypatch.setattr(html_text, "_ratio", lambda *_: 1.0)
    assert len(html_text.main_text(page).split("\n")) == len(want) + 5


def test_path_sums_equal_a_walk_of_the_tree():
    page = (
        "<html><body><div><p>One, two; three.</p><p>Four <a>five</a>!</p></div><div><p>Six.</p></div>"
        "<ul><li><a>seven eight</a></li><li>nine</li></ul><section><p>Ten &amp; more</p></section></body></html>"
    )
    want = {}

    def walk(element, path):
        path = (*path, element.tag)
        if element.tag in ("p", "li"):
            said = " ".join("".join(element.itertext()).split())
            linked = sum(len("".join(a.itertext())) for a in element.iter("a"))
            sums = (len(said), len(re.findall("[,.;:!?]", said)), linked, 1)
            want[path] = [a + b for a, b in zip(want.get(path, (0, 0, 0, 0)), sums)]
        for child in element:
            walk(child, path)

    walk(ElementTree.fromstring(page), ())
    tree = html_text._parse(page)
    steps = {place: (above, label) for (above, label), place in tree.paths.items()}

    def named(place):
        return (*named(steps[place][0]), steps[place][1]) if place else ()

    got = {named(p): t for p, t in html_text._path_totals([b for b in tree.blocks if b.text]).items()}
    assert got == want


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string, text int")
    assert html_text.extract(pages).collect() == []
    assert html_text.extract(pages).columns == ["page_id", "url", "text", "n_chars"]


def test_trigrams_beyond_ascii_demand_nothing():
    rules = (secrets.Rule("key", "cl\u00e9 [a-z]+"), secrets.Rule("whole", "mot de passe\u00a0: [a-z]+"))
    block = ["la cl\u00e9 secrete", "cle secrete", "MOT", "mot de passe\u00a0: abc", ""]
    found = secrets.scan_block(block, rules)
    assert [len(f) for f in found] == [1, 0, 0, 1, 0]


def test_redaction_counts_only_where_it_redacts(spark):
    rows = [(1, "see [SECRET] here", 999), (2, "password=abcdef123 x", 5), (3, None, None), (4, "", 7), (1, "see [SECRET] here", 999)]
    for kind in ("int", "bigint", "string"):
        docs = spark.createDataFrame(rows, "doc_id int, text string, n_chars long").selectExpr(
            "doc_id", "text", f"cast(n_chars AS {kind}) AS n_chars"
        )
        got = sorted((r["doc_id"], r["text"], r["n_chars"] and int(r["n_chars"])) for r in secrets.redact(docs).collect())
        assert got == sorted([rows[0], (2, "[SECRET] x", 10), *rows[2:]])
