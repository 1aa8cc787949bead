"""Attributes count by their names, and skipped elements end where they end."""

import pytest

from tidemark.llm.html_text import main_text

PAGE = "<html><head><title>T</title></head>%s<header><h2>Site</h2></header>%s<article><p>The first paragraph of the text has some words for a reader in it.</p><p>%sAnd here is the second one, which ends it.</p></article><footer>Legal</footer></body></html>"
TEXT = "The first paragraph of the text has some words for a reader in it. And here is the second one, which ends it."


@pytest.mark.parametrize(
    "attrs",
    ["style='overflow:hidden'", 'class="overflow-hidden"', "class=hidden-xs", "data-hidden-count=3", "data-role=navigation", "title='hidden here'", "aria-hidden=false", "style='x-display:none'", 'data-a="aria-hidden=true display:none"'],
)
def test_attributes_that_hide_nothing(attrs):
    assert main_text(PAGE % (f"<body {attrs}>", f"<div {attrs}>", "")) == TEXT


@pytest.mark.parametrize("attrs", ["hidden", 'hidden=""', "HIDDEN", "aria-hidden='true'", "style='color:red; display : none'", 'style="visibility:hidden"', "class='x sidebar'", "role=navigation"])
def test_attributes_that_hide_a_part_but_never_the_page(attrs):
    assert main_text(PAGE % (f"<body {attrs}>", f"<div {attrs}>Words that stand in a part of the page that is not seen at all.</div>", f"<span {attrs}>not this</span>")) == TEXT


@pytest.mark.parametrize(
    "skipped",
    ["<svg viewBox='0 0 1 1' />", "<svg/>", "<svg><path d='M0'/><text>no</text></svg>", "<svg-icon name=x></svg-icon>", "<svg-icon class=social />", "<template-x></template-x>", "<object-list></object-list>", "<canvas />", "<svg>", "<template>", "<script src=a.js></script >", "<script>'<svg>' + \"</p>\"</script>", "<select><option>no</select>"],
)
def test_skipped_elements_swallow_nothing(skipped):
    assert main_text(PAGE % ("<body>", skipped, "")) == TEXT
    assert main_text(PAGE % ("<body>", "", skipped)) == TEXT


def test_formulas_stay_and_their_annotations_go():
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>x = 1</annotation></math> "
    assert main_text(PAGE % ("<body>", "", formula)) == TEXT.replace(" And", " x=1 And")


@pytest.mark.parametrize("page", ["<svg>" * 60000, "<svg/>" * 60000, "<template x='" * 60000, "<script \"" * 30001, "<p x=\"'" * 30000, "<p " + "a='" * 50001 + ">"])
def test_broken_skips_end(page):
    main_text(page)
