"""Main text of generated pages of many shapes, whose article is known."""

import random

import numpy as np
import pytest

from tidemark.llm import html_text
from tidemark.llm.html_text import DecisionTree, main_text

P20 = " ".join(f"w{k}" for k in range(20))


@pytest.mark.parametrize("page", [f"<html><body><article><p>{P20}</p><p>{P20}</p><p>{P20}</p></article></body></html>", f"<div><p>{P20}</p><p>{P20}</p><p>{P20}</p></div>", f"<p>{P20}</p><p>{P20}</p><p>{P20}</p>"])
def test_the_last_block_stays(page):
    assert main_text(page) == " ".join([P20] * 3)


def test_short_paragraphs_stay():
    short = "one two three four five six"
    assert main_text(f"<p>{short}</p>" * 5) == " ".join([short] * 5)
    assert main_text(f"<p>{short}</p>" * 2) == " ".join([short] * 2)


@pytest.mark.parametrize("name", ["social-studies", "content form-guide", "search-engines", "ad-hoc", "headerless", "post-header", "comment-free-zone", "entry-content", "menu-of-the-day"])
def test_names_that_only_hold_a_marking_word_hide_nothing(name):
    assert main_text(f'<article class="{name}"><h1>A head</h1><p>{P20}</p></article>') == f"A head {P20}"
    assert main_text(f'<article><div class="{name}"><h1>A head</h1></div><p>{P20}</p></article>') == f"A head {P20}"


@pytest.mark.parametrize("name", ["ad", "ad-box", "top-banner", "site-footer", "cookie-notice", "related_links", "main-nav big", "newsletter signup"])
def test_names_that_mark_surroundings_do(name):
    assert main_text(f'<article><p>{P20}</p><div class="{name}">Buy now or read on.</div><p>{P20}</p></article>') == f"{P20} {P20}"


def test_link_lists_and_formulas_of_an_article_stay():
    page = f"<article><p>{P20}</p><ul><li><a href=a>One source</a></li><li><a href=b>Two source</a></li></ul><p>Then <math><mi>x</mi></math> ends.</p></article>"
    assert main_text(page) == f"{P20} One source Two source Then x ends."


def test_neighbours_decide_on_pages_without_an_article():
    links = "".join(f"<div><a href=x>Go there {k}</a></div>" for k in range(3))
    long, short = f"<div>{P20} {P20}</div>", "<div>Some few words</div>"
    assert "Some few words" in main_text(long + short + long)
    assert "Some few words" not in main_text(long + links + short + links)
    table = html_text._TABLE.copy()
    table[:, 6:10] = 0
    blind = DecisionTree(table[:, :-1], table[:, -1])
    rows = html_text._TABLE[:, :-1]
    assert any(blind(z) != html_text.TREE(r) for z, r in zip(np.where(np.arange(10) < 6, rows, 0), rows, strict=True))


def test_generated_pages(seeds=400):
    for seed in range(seeds):
        rng = random.Random(seed)

        def prose(low, high, rng=rng):
            return " ".join(rng.choice("alpha beta gamma delta rho sigma tau phi chi psi".split()) for _ in range(rng.randint(low, high)))

        kept = []

        def block(tag, low, high, kept=kept, prose=prose):
            kept.append(prose(low, high))
            return f"<{tag}>{kept[-1]}</{tag}>"

        inside = [block("h1", 2, 8)]
        for _ in range(rng.randint(2, 8)):
            kind = rng.random()
            if kind < 0.5:
                inside.append(block("p", 1, 60))
            elif kind < 0.6:
                inside.append(block("h2", 1, 6) + block("p", 5, 40))
            elif kind < 0.7:
                inside.append("<ul>" + "".join(block("li", 1, 9) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif kind < 0.8:
                inside.append("<table>" + "".join(f"<tr>{block('td', 1, 4)}{block('td', 1, 4)}</tr>" for _ in range(rng.randint(1, 3))) + "</table>")
            else:
                inside.append(rng.choice([f"<div class='ad'>{prose(2, 20)}</div>", f"<aside><p>{prose(2, 30)}</p></aside>", f"<script>var a = '<p>{prose(2, 5)}</p>';</script>", f"<form><label>{prose(1, 3)}</label></form>", f"<!-- {prose(1, 9)} -->"]))
        inside.append(block("p", 5, 40))
        tag = rng.choice(["article", "main", "article class='post-body'"])
        before = [f"<header><h2>{prose(1, 4)}</h2></header>", f"<nav><ul>{''.join(f'<li><a href=#>{prose(1, 2)}</a>' for _ in range(5))}</ul></nav>", f"<div id=cookie-bar>{prose(4, 20)}</div>", f"<div>{prose(3, 30)}</div>"]
        after = [f"<aside>{prose(3, 30)}</aside>", f"<section class=comments><article class=comment><p>{prose(5, 40)}</p></article></section>", f"<footer>{prose(3, 9)}</footer>", ""]
        page = f"<html><head><title>{prose(2, 5)}</title></head><body>" + "".join(rng.sample(before, rng.randint(0, 4))) + f"<{tag}>" + "".join(inside) + f"</{tag.split()[0]}>" + "".join(rng.sample(after, rng.randint(0, 4))) + "</body></html>"
        assert main_text(page) == " ".join(kept), (seed, page)


def test_what_readers_and_other_pages_add_goes_under_any_of_its_names():
    from tidemark.llm.html_text import main_text

    words = "The engineer described how the bridge was built over many years of patient work."
    for name in ("post-comments", "user-comments", "reader-comments", "commentlist", "related-posts", "comment-list", "article-replies", "related_articles"):
        for tag in ("div", "ol", "section"):
            page = f"<html><body><article><h1>Bridge</h1><p>{words}</p><{tag} class='{name}'><p>I disagree with all of this, said a reader at length.</p></{tag}></article></body></html>"
            assert main_text(page) == f"Bridge {words}", (name, tag)
    for name in ("commentary", "relatedness", "post", "post-body", "user-story", "entry-header", "article-list", "commented-code"):
        page = f"<html><body><article><h1>Bridge</h1><p>{words}</p><div class='{name}'><p>A second part of the story.</p></div></article></body></html>"
        assert main_text(page) == f"Bridge {words} A second part of the story.", name
