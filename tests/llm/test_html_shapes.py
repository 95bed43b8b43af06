"""Page shapes with their labelled main text, names that tell of other parts, and
long broken pages."""

import time
from collections import Counter

import pytest

from mercato.llm.html_extract import main_text

PROSE = [f"Paragraph {i} has some words, and then it goes on for a while; this is how prose of an article reads, sentence {i} after sentence." for i in range(8)]
REMARKS = ["I do not agree with this at all, since it leaves out what matters; others have said so, too, and at some length.",
           "Thanks for the piece, it was good to read, and I will come back; please write more of this kind in the future.",
           "This is wrong, as the numbers in the third paragraph show, and I wonder why nobody has checked them before now."]
P, R = "".join(f"<p>{p}</p>" for p in PROSE), "".join(f"<p>{r}</p>" for r in REMARKS)
MENU = "".join(f'<li><a href="/{x}">{x} things</a></li>' for x in ("Home", "News", "Sport", "Culture", "Travel", "More"))
CARDS = "".join(f'<div class="card"><a href="/{i}"><h3>Another story {i}</h3></a><p><a href="/{i}">Read it, now.</a></p></div>' for i in range(5))
TEXT = ["T", *PROSE]
NAMES = ("user-comments comment-thread comment-body reader-comments commentary-section responses disqus_thread fb-comments sponsored-content advert-text promo-text cookie-policy-message "
         "newsletter-form-text sidebar-inner site-notice alert-message related-articles commentList userComments notice").split()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("page", [
    '<body><article><h1>T</h1>{p}<div class="{n}">{r}</div></article></body>', '<body><article><h1>T</h1>{p}</article><div id="{n}">{r}</div></body>',
    '<body><div id="content"><h1>T</h1>{p}<div class="x {n}">{r}</div></div></body>', '<body><div id="content"><h1>T</h1>{p}</div><section class="{n}">{r}</section></body>'])
def test_names_of_other_parts(page, name):
    assert main_text(page.format(p=P, r=R, n=name)) == "\n".join(TEXT)


@pytest.mark.parametrize("attribute", ['style="display:none"', 'style="color:red; visibility : hidden"', 'aria-hidden="true"', "hidden"])
def test_hidden_elements(attribute):
    assert main_text(f"<body><article><h1>T</h1>{P}<div {attribute}>{R}</div></article></body>") == "\n".join(TEXT)


def test_a_short_article_beside_long_promotion():
    page = f"<body><article><h1>Short</h1><p>One line.</p></article><div><p>{' '.join(REMARKS * 4)}</p></div></body>"
    assert main_text(page) == "Short\nOne line."


@pytest.mark.parametrize("name", ["has-sidebar", "with-header", "comments-open", "no-ads", "share-price", "promotion-history"])
def test_states_and_topics_are_no_other_parts(name):
    page = f'<body><article><h1>T</h1>{P}<div class="{name}"><p>{PROSE[0]}</p></div><p>{PROSE[1]}</p></article></body>'
    assert main_text(page) == "\n".join([*TEXT, PROSE[0], PROSE[1]])


SHAPES = [  # (page, blocks of its main text)
    (f"<body><nav><ul>{MENU}</ul></nav><article><h1>T</h1>{P}</article><footer>Imprint, 2024.</footer></body>", TEXT),
    (f"<body><header><h2>Site</h2><ul>{MENU}</ul></header><main><h1>T</h1>{P}</main></body>", TEXT),
    (f'<body><div class="menu"><ul>{MENU}</ul></div><div class="content"><h1>T</h1>{P}</div><div class="footer">Imprint, 2024.</div></body>', TEXT),
    (f'<body><table><tr><td class="left">{MENU}</td><td><h1>T</h1>{P}</td></tr></table></body>', TEXT),
    (f'<body><div id="wrap" class="has-sidebar"><div class="post"><h1>T</h1>{P}</div><div id="sidebar">{CARDS}</div></div></body>', TEXT),
    (f'<body><main><h1>T</h1>{P}</main><aside>{CARDS}</aside></body>', TEXT),
    (f'<body><article class="post comments-open"><h1>T</h1>{P}</article><div class="comments">{R}</div></body>', TEXT),
    (f'<body><article><header><h1>T</h1></header>{P}<footer>By somebody, today.</footer></article></body>', TEXT),
    (f'<body><article><h1>T</h1>{P}<form><label>Your mail</label><input name=m><button>Send, please.</button></form></article></body>', TEXT),
    (f'<body><div class="cookie-banner"><p>We use cookies, as all do; you may accept or decline.</p></div><article><h1>T</h1>{P}</article></body>', TEXT),
    (f'<body><article><h1>T</h1>{"".join(f"<section><h2>Part {i}</h2><p>{p}</p></section>" for i, p in enumerate(PROSE))}</article></body>',
     ["T", *(x for i, p in enumerate(PROSE) for x in (f"Part {i}", p))]),
    (f"<body><article><h1>T</h1>{P}<ul><li>one<li>two, too<li>three</ul></article></body>", [*TEXT, "one", "two, too", "three"]),
    (f"<body><article><h1>T</h1>{P}<blockquote><p>{REMARKS[0]}</p></blockquote><p>{REMARKS[1]}</p></article></body>", [*TEXT, *REMARKS[:2]]),
    (f"<body><article><h1>T</h1>{P}<table><tr><th>Year<th>Value<tr><td>1999<td>12.5</table></article></body>", [*TEXT, "Year", "Value", "1999", "12.5"]),
    (f"<body><article><h1>T</h1><figure><img src=x><figcaption>A view of it all.</figcaption></figure>{P}</article></body>", ["T", "A view of it all.", *PROSE]),
    (f"<body><article><h1>T</h1>{P}<pre>code(x,\n     y);</pre><p>{REMARKS[0]}</p></article></body>", [*TEXT, "code(x, y);", REMARKS[0]]),
    ("<body><article><h1>T</h1>" + "<br><br>".join(PROSE) + "</article></body>", ["T", " ".join(PROSE)]),
    (f"<html><head><title>T - Site</title><script>var a='<p>no</p>';</script></head><body><div><div><div><h1>T</h1>{P}</div></div></div></body></html>", TEXT),
    (f'<body><div class="ad">Buy, buy, buy.</div><article><h1>T</h1>{P[:500]}<div class="ad">Buy, now; it is cheap.</div>{P[500:]}</article></body>', None),
    (f'<body><article><h1>T</h1>{P}</article><div class="related-posts">{CARDS}</div><div class="pagination"><a href=1>1</a> <a href=2>2</a></div></body>', TEXT),
    (f'<body><article><h1>T</h1>{P}<div class="share"><a href=f>Share it</a></div><div class="tags"><a href=a>one</a> <a href=b>two</a></div></article></body>', TEXT),
    (f'<body><dl>{"".join(f"<dt>Question {i}<dd>{p}" for i, p in enumerate(PROSE))}</dl></body>', [x for i, p in enumerate(PROSE) for x in (f"Question {i}", p)]),
    (f'<body><div class="thread"><div class="post"><p>{PROSE[0]}</p></div><div class="post"><p>{PROSE[1]}</p></div><div class="post"><p>{PROSE[2]}</p></div></div></body>', PROSE[:3]),
    (f'<body><main><p>{PROSE[0]}</p><article class="one">{P}</article><article class="two"><h2>More</h2><p>{REMARKS[0]}</p></article></main></body>', [PROSE[0], *PROSE, "More", REMARKS[0]]),
]


def test_labelled_shapes():
    right = found = wanted = 0
    for page, blocks in SHAPES:
        want = Counter(" ".join(blocks or TEXT).split())
        got = Counter(main_text(page).split())
        right, found, wanted = right + sum((want & got).values()), found + sum(got.values()), wanted + sum(want.values())
        if blocks:
            assert sum((want & got).values()) > 0.9 * max(sum(want.values()), sum(got.values())), page
    assert len(SHAPES) >= 20 and right > 0.97 * found and right > 0.97 * wanted


@pytest.mark.parametrize("page", [
    "<a " * 350_000, '<a "' * 250_000, "<a '" * 250_000 + ">", "<div>x " * 140_000, "<ul><li>a" * 110_000, "<b>x " * 200_000, '<div class="ad">x ' * 60_000, "<div>" * 20_000 + "</b>" * 100_000,
    "<b><li>" + "<span>" * 50_000 + "</b>" * 100_000, '<p a="' * 150_000, "<!-" * 300_000, "<" * 1_000_000, "<script>" * 100_000, "<p " + "a=1 " * 250_000 + ">x", "<table><tr><td>" * 60_000])
def test_long_broken_pages_take_linear_time(page):
    begin = time.process_time()
    main_text(page)
    assert time.process_time() - begin < 12
