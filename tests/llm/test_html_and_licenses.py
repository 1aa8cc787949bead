import html
import re

import pytest

from tidemark.llm import queries
from tidemark.llm.html_text import extract_main_text, main_text
from tidemark.llm.licenses import BASE, detect, rules, scan_licenses, scan_text

from .helpers import base_texts, documents

ARTICLE = re.compile(r"<article>(.*?)(?:</article>|\Z)", re.S)


def test_op9_gives_the_article_of_every_page(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op9_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", ARTICLE.search(pages[r.page_id])[1])).split())
        assert r.n_chars == len(r.text)


SITE = """<html><head><title>T</title><style>p{}</style></head><body><header class="masthead"><h2>Site</h2></header>
<nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav><div id="cookie-bar">We use cookies, please accept them all now.</div>
%s<aside class="sidebar"><p>Other stories that you may like to read later on in the week.</p></aside>
<form action=x><label>Mail</label><input name=q><button>Send</button></form>
<section id="comments"><article class="comment"><p>I liked this text a lot and want to say so here at length.</p></article></section>
<footer>&copy; 2024 <a href=l>Legal</a></footer><script>var t="</p><p>no";</script></body></html>"""
BODY = "<h1>The &amp; head</h1><p>First   paragraph of the <b>te</b>xt&nbsp;with quite some words in it for the reader.</p><p>Short.<br>Two.</p><p>Another paragraph that has a good number of words and <a href=q>one link</a> in it.</p>"
TEXT = "The & head First paragraph of the text with quite some words in it for the reader. Short. Two. Another paragraph that has a good number of words and one link in it."


@pytest.mark.parametrize("shell", ["<article>%s</article>", "<main>%s</main>", "<div class='content'>%s</div>", "<article><div class='ad'>Buy things now, they are cheap and good today.</div>%s<ul class='share'><li><a>Mail</a></ul></article>"])
def test_surroundings_go_and_the_text_stays(shell):
    assert main_text(SITE % (shell % BODY)) == TEXT


@pytest.mark.parametrize("page", ["", "plain words only", "<p>unclosed <b>tags <i>here", "<", "<!-- never ends", "<script>x", "<article>", "</p></div></article>", "<p>a<p>b" * 2000, "&#x110000; &bogus; &lt;", "<div " * 60000, "<a b='" * 60000, "<" * 90000, "<a " * 60000 + ">"])
def test_broken_pages_do_not_crash(page):
    main_text(page)


def test_pages_with_odd_rows(spark):
    rows = [(1, "u", None, 5), (None, None, "", 5), (2, "u", "<article><p>x y</p></article>", 5), (2, "u", "<article><p>x y</p></article>", 5), (3, "u", "<article>" + "<p>word word</p>" * 40000 + "</article>", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(extract_main_text(pages).collect(), key=lambda r: (r.page_id or 0, r.n_chars))
    assert [(r.page_id, r.n_chars) for r in got] == [(None, 0), (1, 0), (2, 3), (2, 3), (3, 40000 * 10 - 1)]
    assert extract_main_text(pages.where("false")).count() == 0


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(k, label) for phrase, label in BASE for k in range(len(w)) if tuple(w[k : k + len(phrase)]) == phrase]
    return len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_op10_over_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op10_license_scans(spark, sf_dir).collect()
    assert len(rows) == len(docs) and any(r.n_base for r in rows)
    for r in rows:
        assert tuple(r)[1:6] == base(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def test_licenses_of_odd_rows(spark):
    texts = [*base_texts(), "mit license mit License MIT-LICENSE", "the general public license of the apache license", "permit license", "mit licenses", "é mit license", "GENERAL\nPUBLIC\nLICENSE"]
    docs = documents(spark, texts)
    rows = scan_licenses(docs.unionByName(docs.where("doc_id = 0"))).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert tuple(r)[1:6] == base(texts[r.doc_id // 3])
    assert scan_licenses(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("SPDX-License-Identifier: LGPL-2.1", "lgpl-2.1"),
        ("under the terms of the GNU Affero General Public License v3", "agpl-3.0,gpl"),
        ("BSD 3-Clause license and the Mozilla Public License 2.0", "bsd-3-clause,mpl-2.0"),
        ("Ich gehe mit der Lizenz", ""),
        ("cc me on the mail", ""),
    ],
)
def test_labels(text, labels):
    assert scan_text(text)[5] == labels


def test_rules_are_ordered_and_suppress_what_they_contain():
    assert len(rules()) > 300 and [r.order for r in rules()] == list(range(len(rules())))
    found = detect("licensed under the gnu general public license version 3 or under the mit license")
    assert [d.rule.label for d in found] == ["gpl-3.0", "mit"]
    for a, b in zip(found, found[1:], strict=False):
        assert a.start < b.start and a.end < b.end
