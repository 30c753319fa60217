"""Pages without <article> keep the headline, the lead and short sections."""

import pytest

from kestrel.llm.pages import main_text

BODY = "".join(f"<p>Paragraph {k} of the body, which is long, goes on for a while, and ends here.</p>" for k in range(12))
MENU = "<nav><a href='/'>Home</a></nav><div class=sidebar><p>Other things, as well.</p></div>"
PARTS = "<h1>The headline</h1><div class=lead><p>The lead, in short.</p></div><div class=body>%s</div><section><h2>End</h2><p>A closing word, too.</p></section>"
WANT = ["The headline", "The lead, in short.", *(f"Paragraph {k} of the body, which is long, goes on for a while, and ends here." for k in range(12)),
        "End", "A closing word, too."]


@pytest.mark.parametrize("tag", ["main", "div", "section", "td"])
def test_sections_beside_the_body_stay(tag):
    inner = f"<{tag}>{PARTS % BODY}</{tag}>"
    page = f"<body>{MENU}{'<table><tr>' + inner + '</table>' if tag == 'td' else inner}<footer>End of page.</footer>"
    assert main_text(page).split("\n") == WANT


def test_length_of_other_sections_does_not_matter():
    for times in (1, 5, 40):
        got = main_text(f"<body>{MENU}<main>{PARTS % (BODY * times)}</main>").split("\n")
        assert got[:2] == WANT[:2] and got[-2:] == WANT[-2:] and len(got) == 4 + 12 * times


def test_article_still_bounds():
    page = f"<body><div><p>Teaser.</p></div><article>{PARTS % BODY}</article><div><h3>Elsewhere</h3></div>"
    assert main_text(page).split("\n") == WANT
