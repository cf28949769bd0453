"""Marks of blocks on pages whose chrome elements have no end tag, or whose class names hold a chrome name as a part."""

import pytest

from slatewright.llm.main_text import MAIN, page_blocks


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><article>text</article></body>",
        "<article class='post comments-open'>text</article>",
        "<div id='content-with-sidebar'><article>text</article></div>",
        "<ul><li class='menu'>Home<li>About</ul><article>text</article>",
        "<p class='notice'>Ad<p>x<article>text</article>",
        "<table><tr><td class='ad'>buy<td>x</table><article>text</article>",
        "<article><div class='ad'><span>buy</span><p>now</div>text</article>",
    ],
)
def test_articles_keep_their_text(page):
    assert [text for text, mark in page_blocks(page) if mark == MAIN] == ["text"]
