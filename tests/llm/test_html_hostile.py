"""Articles with links, hostile markup, and names of comments and adverts."""

import time

import pytest

from sitelens.llm.html import main_text

TEXT = "The first sentence of an article that says something about the world. " * 4


def _article(inside):
    return f"<html><body><nav><a href=1>Home</a></nav><article><h1>Title</h1><p>{TEXT}</p>{inside}</article><footer>end</footer></body></html>"


@pytest.mark.parametrize(("inside", "kept"), [
    ("<p><a href=x>A whole sentence that is a link to another page.</a></p>", ["A whole sentence that is a link to another page."]),
    ("<h2>References</h2><ul><li><a href=1>One source</a></li><li><a href=2>Another source</a></li></ul>", ["References", "One source", "Another source"]),
    ("<table><tr><td>x</td><td>1</td></tr><tr><td><a href=3>a link</a></td><td>2</td></tr></table>", ["x 1", "a link 2"]),
    ("<p title=it's>FIRST</p><p>SECOND don't</p>", ["FIRST", "SECOND don't"]),
    ("<p title='a > b' data-x=\"c > d\">THIRD</p>", ["THIRD"]),
    ('<div class="user-comments"><p>I liked it a lot.</p></div>', []),
    ('<section id="reader-comments"><p>So did I.</p></section>', []),
    ('<div class="adbox"><p>Buy this now.</p></div>', []),
    ('<div class="user-guide"><p>How it is used.</p></div>', ["How it is used."]),
    ('<div id="readers"><p>Who reads it.</p></div>', ["Who reads it."]),
])
def test_inside_an_article(inside, kept):
    assert main_text(_article(inside)) == "\n\n".join(["Title", TEXT.strip(), *kept])


def test_time_is_linear_in_unclosed_tags():
    def seconds(n, piece):
        page = _article("") + piece * n
        start = time.perf_counter()
        assert main_text(page).startswith("Title")
        return time.perf_counter() - start

    for piece in ("<a ", "<!x ", "</p ", "<b x=\"", "<p><b>"):
        seconds(1000, piece)
        small, large = seconds(4000, piece), seconds(32_000, piece)
        assert large < 30 * max(small, 0.01), piece


@pytest.mark.parametrize("tail", ["<!-- never closed <b> and more", "<!-- never closed > and < more < and", "<script>var x = '<a>' < 1 < 2", "<!-- a --> < b <!-- c"])
def test_open_ends_stay_hidden(tail):
    got = main_text(f"<body><p>{TEXT}</p></body>{tail}")
    assert "more" not in got and "var" not in got and "c" not in got.replace(TEXT.strip(), "")
