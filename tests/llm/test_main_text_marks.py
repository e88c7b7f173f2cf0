from stratalake.llm import html_extraction as h

BODY = [" ".join([f"body{i}"] * 25) for i in range(4)]


def paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


def test_teasers_marked_as_articles_do_not_replace_the_body():
    teasers = "".join(f"<article><p>Teaser {i}</p></article>" for i in range(3))
    menu = "".join(f"<div><a href=#>link {i}</a></div>" for i in range(5))
    found = h.main_text(f"<body><div>{paragraphs(BODY)}</div>{menu}{teasers}</body>")
    assert found.split("\n\n")[:4] == BODY


def test_a_short_marked_line_is_no_article():
    menu = "".join(f"<div><a href=#>link {i}</a></div>" for i in range(5))
    found = h.main_text(f"<body><main><p>Share</p></main>{menu}<div>{paragraphs(BODY)}</div></body>")
    assert found.split("\n\n") == BODY


def test_an_article_keeps_its_short_lines():
    page = f"<body><article><h1>Title</h1><p>By Ann</p><p>3 May</p><p>5 min</p>{paragraphs(BODY)}<p>End.</p></article></body>"
    assert h.main_text(page).split("\n\n") == ["Title", "By Ann", "3 May", "5 min", *BODY, "End."]
