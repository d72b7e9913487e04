"""Main text of generated pages with and without an article, and of names that speak of an article's own sections."""

from __future__ import annotations

import random

import pytest

from cohortloom.llm import html_extract

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
LONG = "some words that are long enough to be a section of its own here"
RIGHTS = ["<p>© 2024 Example Inc. All rights reserved.</p>", "<div>Copyright 2019 by Example</div>", '<p>&copy; 2020 <a href="/">Example</a></p>', "<div>Example Ltd. All Rights Reserved</div>"]


def page(rnd, article):
    """A page and its main text: a list of links, a title with paragraphs and headings of any length, links again, a line about rights."""

    def w(n):
        return " ".join(rnd.choice(WORDS) for _ in range(n))

    def links(n):
        return "<ul>" + "".join(f'<li><a href="#">{w(rnd.randint(1, 3))}</a></li>' for _ in range(n)) + "</ul>"

    out, truth = [], []
    if rnd.random() < 0.5:
        out.append(f"<div>{w(rnd.randint(1, 3))}</div>")
    if rnd.random() < 0.8 or out:
        out.append(links(rnd.randint(2, 6)))
    truth.append(w(rnd.randint(2, 9)))
    body = [f"<h1>{truth[0]}</h1>"]
    for i in range(rnd.randint(2, 8)):
        if i and rnd.random() < 0.2:
            truth.append(w(rnd.randint(1, 6)))
            body.append(f"<h2>{truth[-1]}</h2>")
        n = rnd.choice([1, 2, 4, 8, 15, 30, 60, 91, 92, 120, 200])
        link, rest = (w(2), w(n - 2)) if n >= 8 and rnd.random() < 0.3 else ("", w(n))
        body.append(f'<p><a href="/x">{link}</a> {rest}</p>' if link else f"<p>{rest}</p>")
        truth.append(f"{link} {rest}".strip())
        if article and rnd.random() < 0.2:
            truth.append(w(rnd.randint(1, 4)))
            body.append(f'<p><a href="/y">{truth[-1]}</a></p>')
    out.append(f"<article>{''.join(body)}</article>" if article else f"<div>{''.join(body)}</div>")
    if rnd.random() < 0.7:
        out += [f"<h3>{w(2)}</h3>"] if rnd.random() < 0.4 else []
        out.append(links(rnd.randint(2, 5)))
    if rnd.random() < 0.6:
        out.append(rnd.choice(RIGHTS))
    return f"<body>{chr(10).join(out)}</body>", "\n\n".join(truth)


@pytest.mark.parametrize("article", [False, True])
def test_main_text_of_generated_pages(article):
    """Nothing of the article is lost and nothing else kept, whatever the lengths of its paragraphs and what stands beside them."""
    for seed in range(1180):
        made, truth = page(random.Random(seed), article)
        assert html_extract.main_text(made) == truth, made


def test_last_paragraph_before_links_stays():
    links = '<ul><li><a href="#">one</a></li><li><a href="#">two</a></li></ul>'
    for n in (1, 3, 10, 50, 91, 92, 200):
        last = "LAST" + " word" * (n - 1)
        for end in ("", "<p>© 2024 Example Inc. All rights reserved.</p>"):
            assert html_extract.main_text(f"<div><p>{LONG}</p><p>{last}</p></div>{links}{end}") == f"{LONG}\n\n{last}"


@pytest.mark.parametrize("name", ["discussion", "warning", "social", "menu", "notice", "related"])
@pytest.mark.parametrize("form", ['<section id="{0}">', '<div id="{0}">', '<section class="{0}">'])
def test_sections_of_an_article_stay_whatever_they_are_called(name, form):
    made = f"<article><p>{LONG}</p>{form.format(name)}<h2>Heading</h2><p>{LONG}</p></{form[1:].split()[0]}></article>"
    assert html_extract.main_text(made) == f"{LONG}\n\nHeading\n\n{LONG}"


@pytest.mark.parametrize(
    "part",
    [
        f'<div id="disqus_thread"><p>{LONG}</p></div>', f'<section class="responses"><h3>Responses</h3><p>{LONG}</p></section>',
        f'<section id="discussion"><h3>Comments</h3><div class="comment"><p>{LONG}</p></div></section>', f'<div class="social"><h3>Share</h3><p>{LONG}</p></div>',
        '<section id="social"><h3>Share</h3><ul><li><a href="#">one and more words here</a></li><li><a href="#">two and more words</a></li></ul></section>',
        f'<section id="menu"><p>{LONG}</p></section>', f'<form id="search"><h3>Search</h3><p>{LONG}</p></form>', f'<div id="newsletter"><h3>Letters</h3><p>{LONG}</p></div>',
    ],
)
def test_what_is_no_section_goes(part):
    assert html_extract.main_text(f"<main><p>{LONG}</p>{part}<p>End of it.</p></main>") == f"{LONG}\n\nEnd of it."


@pytest.mark.parametrize("name", ["cc-window cc-banner", "onetrust-consent", "CookiebotDialog", "didomi-popup"])
def test_consent_bars_of_pages_without_an_article_go(name):
    assert html_extract.main_text(f'<div><h1>Title</h1><p>{LONG} {LONG}</p><p>last</p></div><div class="{name}"><p>We use cookies. {LONG}</p></div>') == f"Title\n\n{LONG} {LONG}\n\nlast"


def test_formulas_stay():
    assert html_extract.main_text('<article><p>Area is <math><mi>x</mi><mo>=</mo><mn>5</mn><annotation encoding="tex">x=5</annotation></math> units wide</p></article>') == "Area is x=5 units wide"


def test_lines_about_rights_stay_within_an_article():
    assert html_extract.main_text(f"<article><p>{LONG}</p><p>© 1999 by the author.</p></article>") == f"{LONG}\n\n© 1999 by the author."
