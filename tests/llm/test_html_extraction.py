import pytest

from stratalake.llm import html_extraction as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:"</p>"}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">a</a></ul></nav><div class="cookie-notice">We use cookies</div>
<!-- <p>no</p> --><article><header><h1>Head &amp; line</h1></header><p>One <b>two</b>
 three&nbsp;four<br>five<p>Short.</p><aside>Read also</aside><div class="ad">Buy</div>
<form><input name="x">Sign <button>up</button></form><ul><li>first<li>second &lt;x&gt;</ul>
<section class="comments"><p>Nice post</p></section></article><footer>&copy; us</footer></body></html>"""


def test_article():
    assert h.main_text(PAGE) == "Head & line\n\nOne two three four five\n\nShort.\n\nfirst\n\nsecond <x>"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("plain words", "plain words"),
        ("<article><p>cut off in <b>the mid", "cut off in the mid"),
        ("<div class='ad'>never closed<article><p>Story</p></article>", "Story"),
        ("<article><p>a</p><div class=ad>x<p>b</article><footer>&am", "a"),
        ('<article><p title="1 > 0">quoted</p></article>', "quoted"),
        ("<article><script>if (a < b) {'</p>'}</script><p>x</p></article>", "x"),
    ],
)
def test_odd_pages(page, text):
    assert h.main_text(page) == text


def test_surge_and_dive_without_an_article():
    menu = "".join(f"<div><a href=#>link {i}</a></div>" for i in range(9))
    body = "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(5))
    text = h.main_text(f"<html><body>{menu}{body}{menu}</body></html>")
    assert text.split("\n\n") == [" ".join(["word"] * 30 + [str(i)]) for i in range(5)]


def test_deep_page_is_quick():
    assert h.main_text("<div>" * 20000 + "<p>deep</p>").endswith("deep")


def test_table(spark):
    rows = spark.createDataFrame(
        [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, None, None, None)],
        "page_id long, url string, html string, text string, N_CHARS int",
    )
    found = h.extract(rows).collect()
    assert [r.n_chars for r in found] == [len(h.main_text(PAGE))] * 2 + [0]
    assert found[0].text == h.main_text(PAGE) and found[2].text == ""
    assert h.extract(rows.limit(0)).count() == 0
