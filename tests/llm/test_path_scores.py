"""Scores choose a page's text: wrappers, lists of links, text beside the article, pages without marks of any kind."""

import random

import pytest

from kestrel.llm.pages import extract, main_text

BODY = [f"Paragraph {k} of the body, which is long, goes on for a while, and ends here." for k in range(12)]
ART = "<h1>The headline</h1>" + "".join(f"<p>{x}</p>" for x in BODY)
WANT = ["The headline", *BODY]


@pytest.mark.parametrize("wrap", ['<div class="content with-sidebar">', '<div id="page-with-comments">', '<div class="sidebar">', '<div id="comments">',
                                  '<section class="post has-share no-ads">', '<div class="widget"><div class="popup">'])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<main>%s</main>", "<div>%s</div>"])
def test_a_wrapper_is_no_aside(wrap, inner):
    page = f"<body><nav><a href='/'>Home</a></nav>{wrap}{inner % ART}</div></div></section><footer>End.</footer>"
    assert main_text(page).split("\n") == WANT


def test_a_list_of_links_between_content_stays():
    links = "<ul><li><a href='/a'>First source</a></li><li><a href='/b'>Second source</a></li></ul>"
    page = f"<body><nav><ul><li><a>Menu</a></ul></nav><article>{ART}{links}<p>The sources above, all of them, are worth a look.</p>" \
           f"<div class=related>{links}</div></article>"
    assert main_text(page).split("\n") == [*WANT, "First source", "Second source", "The sources above, all of them, are worth a look."]
    assert main_text(f"<body><article>{ART}</article><ul><li><a>Elsewhere</a></ul>").split("\n") == WANT


def test_content_beside_the_article_stays():
    closing = "A closing paragraph, which stands beside the article, and is as much a part of it, all told."
    page = f"<body><main><article>{ART}</article><p>{closing}</p></main><div><p>Teaser.</p></div>"
    assert main_text(page).split("\n") == [*WANT, closing]


def test_long_comments_go():
    comments = "".join(f"<div class=comment><p>I think, as many do, that this is wrong, and more: {'so, ' * (20 + k)}.</p></div>" for k in range(20))
    for inner in (f"<article>{ART}</article><div id=comments>{comments}</div>", f"<div class=post>{ART}</div><section class='comments'>{comments}</section>",
                  f"<article>{ART}<section id=respond>{comments}</section></article>"):
        assert main_text(f"<body>{inner}").split("\n") == WANT


def bare_pages(n, seed):
    """(html, lines): pages of <div>s without names, with link bars, short boxes and a colophon around the text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9)))
    text = lambda n: ", ".join(" ".join(word() for _ in range(rng.randint(3, 7))) for _ in range(n)).capitalize() + "."
    out = []
    for _ in range(n):
        bar = "".join(f"<span><a href='/{word()}'>{word()}</a></span>" for _ in range(rng.randint(4, 12)))
        box = "".join(f"<div><div><i>{word()} {word()}</i></div></div>" for _ in range(rng.randint(2, 6)))
        body = [text(rng.randint(3, 12)) for _ in range(rng.randint(4, 15))]
        if rng.random() < 0.5:
            body.insert(2, word().capitalize() + ".")  # a short paragraph among long ones
        page = f"<body><div>{bar}</div><div>{box}</div><div><h1>{(title := word().capitalize() + ' ' + word())}</h1>" + "".join(
            f"<p>{x}</p>" for x in body) + f"</div><div>{box}</div><div>{bar}</div><div><small>{word()} {rng.randint(1990, 2024)}</small></div>"
        out.append((page, [title, *body]))
    return out


def test_pages_without_marks():
    """Precision and recall of lines against the pages' own text; without the threshold, precision falls."""
    def measure(strictness):
        kept = right = wanted = 0
        for page, lines in bare_pages(150, 5):
            got = main_text(page, strictness).split("\n")
            kept, right, wanted = kept + len(got), right + len(set(got) & set(lines)), wanted + len(lines)
        return right / kept, right / wanted

    precision, recall = measure(0.5)
    assert precision >= 0.95 and recall >= 0.95
    assert measure(-1.0)[0] < precision - 0.1


def test_bytes_that_are_no_text(spark):
    page = spark.sql("SELECT 1L AS page_id, 'u' AS url, concat(cast(unhex('3C703E61FF62') AS string), ', c.</p>') AS html")
    assert extract(page).first()["text"] == "a�b, c."
