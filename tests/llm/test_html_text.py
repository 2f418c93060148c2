"""Main text: the distribution on pages that mark nothing, tags with stray quotes, the registered query."""

import random
import re

import duckdb
import pytest

from tillworks.llm import html_text, queries

PARAGRAPHS = ["A paragraph of the article that says something at some length, as articles do, number %d." % i for i in range(9)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
TEXT = "\n".join(PARAGRAPHS)
LINKS = "<div><ul>" + "".join(f'<li><a href="/{i}">A section of the site {i}</a></li>' for i in range(30)) + "</ul></div>"


@pytest.mark.parametrize("before,after", [
    (LINKS, ""), ("", LINKS), (LINKS, LINKS), ("", "<div>Copyright 2020 the owners of this site</div>"), (LINKS, LINKS + "<p>© the site</p>"),
    ("", "".join(f"<p>tag {i}</p>" for i in range(12))), ("".join(f"<span>Menu {i}</span><br><div>x</div>" for i in range(12)), ""),
    ("<div>" + "".join(f"<div>Nav {i}</div>" for i in range(4)) + "</div>", "<div>" + "".join(f"<div>Foot {i}</div>" for i in range(4)) + "</div>"),
])
def test_unmarked_menus_and_footers_go(before, after):
    assert html_text.main_text(f"<html><body>{before}<h1>The title</h1>{BODY}{after}</body></html>") == f"The title\n{TEXT}"


def test_short_lines_of_the_article_stay():
    short = "<p>By A</p><p>Monday</p>"
    assert html_text.main_text(f"<h1>T</h1>{short}{BODY}<p>End.</p>") == f"T\nBy A\nMonday\n{TEXT}\nEnd."
    listed = "".join(f"<li>item {i}</li>" for i in range(20))
    inner = f"{BODY}<ul>{listed}</ul>{BODY}"
    items = "\n".join(f"item {i}" for i in range(20))
    assert html_text.main_text(f"{LINKS}<article>{inner}</article>{LINKS}") == f"{TEXT}\n{items}\n{TEXT}"
    assert html_text.main_text(f"<article><p>One word.</p></article>{LINKS}") == "One word."
    assert html_text.main_text('<h1><a href="/x">Linked title</a></h1>' + BODY) == f"Linked title\n{TEXT}"
    assert html_text.main_text(f"<p>{PARAGRAPHS[0]} <a href=x>a link</a> goes on.</p>") == f"{PARAGRAPHS[0]} a link goes on."


def test_far_regions_need_the_level_of_the_page():
    low = "<p>a low line</p>"
    far = "<hr>" * 3 + LINKS
    assert html_text.main_text(BODY + far + low) == TEXT
    assert html_text.main_text(BODY + far + BODY) == f"{TEXT}\n{TEXT}"


@pytest.mark.parametrize("tag", ['p data-x=it\'s', 'p title="a > b"', "p title='<p>'", 'p "', "p x='", 'p alt="5" tall"', "p a=b'c\"d", "p\n class = 'x y'"])
def test_stray_quotes_belong_to_the_tag(tag):
    close = "'>" if tag.endswith("='") else ">"
    assert html_text.main_text(f"<{tag}{close}one two</p><p>it's three</p><p>\"four\"</p>") == 'one two\nit\'s three\n"four"'


def test_pages_of_the_given_table(spark):
    """Beside a plain reading of the pages' known form: the article's blocks, in order."""
    found = {r.page_id: r for r in queries.op3_html_text(spark, "/root/testdata/sf0.001").collect()}
    rows = duckdb.sql("SELECT page_id, url, html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()
    import html

    for page, url, source in rows:
        article = re.search(r"<article>(.*?)</article>", source, re.S)
        if article is None:
            continue
        blocks = re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", re.sub(r"<!--.*?-->|<script.*?</script>", "", article[1], flags=re.S))
        clean = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b))).strip() for b in blocks]
        want = "\n".join(x for x in clean if x)
        assert re.sub(r"\s+", "", found[page].text) == re.sub(r"\s+", "", want)
        assert found[page].url == url and found[page].n_chars == len(found[page].text)


def test_long_and_odd_pages():
    draw = random.Random(2)
    for _ in range(200):
        page = "".join(draw.choice(["<p>", "</p>", "<a x='", "'", '"', "<", ">", "<div class=", "ad", "text here ", "&amp", "<!--", "-->", "<script>", "</script>"]) for _ in range(60))
        html_text.main_text(page)
    assert len(html_text.main_text("<p>word word word</p>" * 100_000).split("\n")) == 100_000
    assert html_text.main_text('<p x="' * 20_000) == "" and html_text.main_text("<p =" * 100_000 + " " * 100_000) == ""
    assert html_text.main_text(LINKS).count("\n") == 29
