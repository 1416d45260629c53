"""Page text: listed class words, attribute values, links-only articles, bare boxes in the article."""

import pytest

from maintspark.llm import html_paths

ONE = "First paragraph, with some text in it, and more. It goes on, for a while."
TWO = "Second one, as long as the first; it has commas, too, and it ends here."
TEXT = f"{ONE} {TWO}"
P = f"<p>{ONE}</p><p>{TWO}</p>"
READERS = "<div class=comments><p>I like it, I do. " + "Really, so I do. " * 40 + "</p></div>"


@pytest.mark.parametrize("body,text", [
    (f"<div id=page class='layout no-sidebar'><h1>Head</h1>{P}</div>", f"Head {TEXT}"),
    (f"<div class='post has-comments'>{P}</div>", TEXT),
    (f"<div class=hasComments>{P}{READERS}</div>", TEXT),
    (f"<main><section class=legal>{P}</section></main>", TEXT),
    (f"<div class=sidebar><p>{ONE} {TWO}</p></div><article><h1>Head</h1><p>Short, this.</p></article>", "Head Short, this."),
    (f"<article><p data-x=it's>{ONE}</p><p>It's the second, isn't it.</p></article>", f"{ONE} It's the second, isn't it."),
    (f"<article><p title='a > b' data-y=\"c > d\">{ONE}</p><p x='>{TWO}</p></article>", None),
    ("<article><p><a href=/a>All of this, is a link.</a></p><p><a href=/b>And this, also is.</a></p></article>", "All of this, is a link. And this, also is."),
    ("<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul>", ""),
    (f"<article>{P}<div class=x>Buy now!</div>{P}<div>Get 20% off</div>{P}<div>Deal of the day</div></article>", f"{TEXT} {TEXT} {TEXT}"),
    (f"<article>{P}<h2>Sub</h2><ul><li>a</li></ul><table><tr><td>1</td></tr></table>{P}</article>", f"{TEXT} Sub a 1 {TEXT}")])
def test_page(body, text):
    got = html_paths.main_text(f"<html><body><nav><a href=/>Home</a></nav>{body}</body></html>")
    assert got.startswith(ONE) if text is None else got == text


def test_unended_markup_and_nesting_are_read_in_linear_time():
    assert html_paths.main_text("<div>" * 20_000 + "deep, text.") == "deep, text."
    assert html_paths.main_text("<p>some text, here.</p><a " + "x=y " * 50_000) .startswith("some text, here.")
    assert html_paths.main_text("<p>some text, here.</p>" + "<a x=\"" * 3_000).startswith("some text, here.")
