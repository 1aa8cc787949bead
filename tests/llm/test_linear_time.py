"""Texts of one repeated piece: ten times the length takes no more than about ten times as long."""

import time

import pytest

from tidemark.llm import html_text, licenses

PIECES = [" ", "\t", "\n", "(", "<", '"', "<a", "<a '\"", '<a "', "<p ", "<!", "<!--", "<script", "<div>", "</section>", "<nav><article>", "<li>", "&amp", "</b>", "<b class=ad>", "license: mit ", "license: mit or (", "spdx-license-identifier: mit or ", "a.", "\n#", "mit license "]


def seconds(f, text):
    best = 1e9
    for _ in range(3):
        began = time.process_time()
        f(text)
        best = min(best, time.process_time() - began)
    return best


@pytest.mark.parametrize("f", [html_text.main_text, licenses.detect], ids=["html", "licenses"])
@pytest.mark.parametrize("piece", PIECES)
def test_one_piece_over_and_over(f, piece):
    short, long = (seconds(f, piece * (n // len(piece))) for n in (30_000, 300_000))
    assert long < 25 * max(short, 0.004), (short, long)


@pytest.mark.parametrize("shape", ["<div>{0}</section>{1}", "<div><article><section>{0}</div>{1}", "license: mit or {2}", "license: {3}"])
def test_opened_and_closed_without_each_other(shape):
    def text(n):
        first, _, rest = shape.partition("{0}")
        if rest:
            opened, closed = first.rsplit("<", 1)[1], rest.replace("{1}", "")
            return first + ("<" + opened) * (n // 16) + closed * (n // 16)
        return shape.replace("{2}", "(" * n).replace("{3}", "a." * (n // 2))

    f = html_text.main_text if "<" in shape else licenses.detect
    short, long = seconds(f, text(30_000)), seconds(f, text(300_000))
    assert long < 25 * max(short, 0.004), (short, long)
