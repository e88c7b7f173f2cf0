import pytest

from stratalake.llm import html_extraction as h

BODY = [" ".join([f"body{i}"] * 25) for i in range(4)]
TEXT = "".join(f"<p>{x}</p>" for x in BODY)


@pytest.mark.parametrize(
    "page",
    [
        f"<article class='post comments-open'>{TEXT}</article>",
        f"<body><div class='layout with-sidebar'><div id='search-page'>{TEXT}</div></div></body>",
        f"<body><div class='search-page'>{TEXT}<div class='sidebar'>Read this too</div></div></body>",
    ],
)
def test_names_do_not_drop_most_of_a_page(page):
    assert h.main_text(page).split("\n\n") == BODY


def test_blank_lines_of_removed_elements_do_not_end_the_text():
    ads = "<div class='ad'>Buy</div><div class='promo'>Now</div>"
    assert h.main_text(f"<body>{TEXT}{ads}<p>The end.</p></body>").split("\n\n") == [*BODY, "The end."]
