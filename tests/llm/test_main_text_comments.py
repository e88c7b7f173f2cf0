"""Comments in articles, chapters, feet of pages; the windows against a slow version."""

import random
import re

import pytest

from stratalake.llm import html_extraction as h

STORY = ["The first sentence of the story is here.", "And this is the second sentence of it."]
LONG = [" ".join([f"body{i}"] * 25) + "." for i in range(4)]
COMMENTS = [f"Reader {i} says a whole lot about this story, more than it says itself." for i in range(9)]


def paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


def commented(tag, attrs):
    return "".join(f"<{tag} {attrs}><p>{c}</p></{tag}>" for c in COMMENTS)


@pytest.mark.parametrize(
    "page",
    [
        f"<body><article>{paragraphs(STORY)}</article>{commented('article', 'class=comment-body')}</body>",
        f"<body><article>{paragraphs(STORY)}{commented('article', 'class=comment-body')}</article></body>",
        f"<body><article>{paragraphs(STORY)}</article><div id='comments'>{commented('article', '')}</div></body>",
        f"<body><article>{paragraphs(STORY)}</article><ol class='comment-list'>{commented('li', '')}</ol></body>",
        f"<body><article>{paragraphs(STORY)}</article><section class='user-comments'>{commented('article', 'id=c1')}</section></body>",
        f"<body><main>{paragraphs(STORY)}<div id=comments>{commented('div', '')}</div></main></body>",
        f"<body><div>{paragraphs(STORY)}</div><div id='comments'>{commented('div', '')}</div></body>",
        f"<body><article>{paragraphs(STORY)}</article>{commented('article', 'id=reply-12')}</body>",
    ],
)
def test_comments_never_replace_the_article(page):
    assert h.main_text(page).split("\n\n") == STORY


def test_open_comments_are_no_comments():
    for cls in ("post comments-open", "entry has-comments", "no-comments"):
        page = f"<main><article class='{cls}'>{paragraphs(LONG)}</article></main>"
        assert h.main_text(page).split("\n\n") == LONG


def test_all_chapters_stay():
    chapters = [STORY, LONG, [f"Sentence {i} of the third chapter." for i in range(3)]]
    page = "".join(f"<article>{paragraphs(c)}</article>" for c in chapters)
    assert h.main_text(f"<body>{page}</body>").split("\n\n") == sum(chapters, [])


FOOT = ["Filed under general", "© 2024 Foo Inc. All rights reserved.", "Terms apply to all users"]


@pytest.mark.parametrize("tag", ["p", "div", "span"])
@pytest.mark.parametrize("mark", ["div", "article"])
def test_plain_feet_go(tag, mark):
    foot = "".join(f"<div><{tag}>{x}</{tag}></div>" for x in FOOT)
    assert h.main_text(f"<body><{mark}>{paragraphs(LONG)}</{mark}>{foot}</body>").split("\n\n") == LONG


def test_a_short_last_paragraph_stays():
    links = "".join(f"<p><a href=#>Read more {i}</a></p>" for i in range(3))
    assert h.main_text(f"<body><div>{paragraphs(LONG)}{links}<p>That was all.</p></div></body>").split("\n\n") == [*LONG, "That was all."]
    menu = "".join(f"<p><a href=#>Read more {i}</a></p>" for i in range(9))
    assert h.main_text(f"<body><div>{paragraphs(LONG)}{menu}<p>Join us now.</p></div></body>").split("\n\n") == LONG


def test_headings_in_an_unmarked_article_stay():
    body = f"<h2>One</h2>{paragraphs(LONG[:2])}<h2>Two</h2>{paragraphs(LONG[2:])}"
    found = h.main_text(f"<body><div>{body}</div></body>").split("\n\n")
    assert "Two" in found and all(x in found for x in LONG)


def slow(lines):
    """The rules one by one, each line looking at all others anew."""

    def weight(i):
        text, n, region = lines[i]
        return 2 * len(text) if region else n if 2 * n >= len(text) else 0

    def window(i):
        return sum(weight(j) for j in range(i, min(i + h.WINDOW, len(lines))))

    every = [window(i) for i in range(len(lines))]
    surge = min(h.SURGE, max(every, default=0) // 2)

    def dives(i, since):
        text, _, region = lines[i]
        if region or weight(i) > surge or every[i] > max(surge, min(max(every[j] for j in since) // 3, 2 * surge)):
            return False
        return not re.search(h.SENTENCE, text) or bool(re.search(h.NOTICE, text))

    chosen, since = [], []
    for i in range(len(lines)):
        if not weight(i):
            run = 0
            while i - run >= 0 and not weight(i - run):
                run += 1
            if run > h.WINDOW:
                since = []
            continue
        if every[i] > surge:
            since = [*since, i]
        if since and dives(i, since):
            since = []
        if since:
            region, back = lines[i][2], i - 1
            opening = []
            while back >= 0 and back not in chosen:
                if lines[back][2] == region and region and weight(back):
                    opening.insert(0, back)
                back -= 1
            chosen += [*opening, i]
    chosen = sorted(set(chosen))
    marked = sum(lines[i][1] for i in chosen if lines[i][2])
    if marked and 2 * marked >= sum(lines[i][1] for i in chosen):
        chosen = [i for i in chosen if lines[i][2]]
    return [lines[i][0] for i in chosen]


def test_windows_against_a_slow_version():
    random.seed(4)
    for _ in range(2000):
        lines, region = [], 0
        for _ in range(random.randint(0, 14)):
            if random.random() < 0.2:
                region = 0 if region else random.randint(1, 3)
            text = "x" * random.choice([1, 5, 20, 40, 90, 300]) + random.choice(["", ".", "!", " ©"])
            lines.append((text, random.choice([len(text), len(text), 0]), region))
        assert h.main_lines(lines) == slow(lines), lines
