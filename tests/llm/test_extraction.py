"""Main text: markup that pages break, names that mislead, pages of another rule, and all labellings of small pages."""

import itertools
import math
import random

import pytest

from tessella.llm import html_extraction as X

FIRST, SECOND = "The first paragraph is here, and it is long enough to count.", "The second paragraph follows, with more words than the one before."
PROBES = {
    "an empty comment": f"<article><p>{FIRST}</p><!--><p>{SECOND}</p></article>",
    "an empty comment with a dash": f"<article><p>{FIRST}</p><!---><p>{SECOND}</p></article>",
    "a comment that ends with a bang": f"<article><p>{FIRST}</p><!-- unseen --!><p>{SECOND}</p></article>",
    "a comment with a start inside": f"<article><p>{FIRST}</p><!-- a <!-- b --><p>{SECOND}</p></article>",
    "character data outside foreign elements": f"<article><p>{FIRST}</p><![CDATA[x><p>{SECOND}</p></article>",
    "a post with tags in its class": f'<div class="post-1 post hentry tag-city category-news"><p>{FIRST}</p><p>{SECOND}</p></div><div class="sidebar"><a href=1>One</a> <a href=2>Two</a></div>',
    "an article that has comments in its id": f'<div id="comments-on-art" class="article"><p>{FIRST}</p><p>{SECOND}</p></div><div class="footer">Copyright 2020</div>',
    "a body that says what it lacks": f'<body class="no-sidebar has-cookie-notice"><nav><a href=1>One</a> <a href=2>Two</a></nav><main><p>{FIRST}</p><p>{SECOND}</p></main></body>',
    "comments beside the article": f'<article class="post"><p>{FIRST}</p><p>{SECOND}</p></article><div class="comments post-comments"><h3>Comments</h3><div class="comment"><p>Ann</p><p>I liked this very much. Thanks for it.</p></div></div>',
}


@pytest.mark.parametrize("name", PROBES)
def test_probes(name):
    assert X.main_text(PROBES[name], X.trained()) == f"{FIRST}\n{SECOND}"


def test_an_open_comment_hides_the_rest():
    assert X.main_text(f"<article><p>{FIRST}</p><!-- <p>{SECOND}</p></article>", X.trained()) == FIRST


def test_an_article_of_the_same_words_over_and_over():
    lines = "".join("<p>Une même ligne.</p>" for _ in range(300))
    text = X.main_text(f'<nav><a href=1>One</a></nav><div class="ad">Buy this now.</div><article><h1>{FIRST}</h1>{lines}</article><footer>&copy; them</footer>', X.trained())
    assert text.split("\n") == [FIRST, *["Une même ligne."] * 300]


def other_page(r):
    """A page of another rule than the one that pages to learn from are written by, and its main text."""
    vocabulary = ["harbour", "weather", "council", "quietly", "seven", "opened", "market", "because", "although", "river", "engine", "painted", "under", "market", "of", "the", "and", "to"]
    words = lambda a, b: " ".join(r.choice(vocabulary) for _ in range(r.randint(a, b)))
    said = lambda a=6, b=22: words(a, b).capitalize() + r.choice([".", ".", "?", "!"])
    prose = lambda n: " ".join(said() for _ in range(n))
    blocks = [words(3, 8).title()]
    body = [f"<h1>{blocks[0]}</h1>"]
    for _ in range(r.randint(2, 7)):
        kind = r.random()
        if kind < 0.7:
            a, b, c = prose(r.randint(1, 4)), words(1, 4), said()
            blocks.append(f"{a} {b} {c}")
            body.append(f'<p class="{r.choice(["", "lead", "css-1x2"])}">{a} <a href="/x/{r.randint(1, 99)}"><em>{b}</em></a> {c}</p>')
        elif kind < 0.85:
            items = [said(3, 9) for _ in range(r.randint(2, 5))]
            blocks += items
            body.append("<ol>" + "".join(f"<li>{i}" for i in items) + "</ol>")
        else:
            head = words(2, 5).capitalize()
            blocks.append(head)
            body.append(f"<h2>{head}</h2>")
    name = r.choice(['article', 'div class="story-body"', 'div id="content" class="col-8"', 'main role="main"', 'section class="entry-content clearfix"', 'div class="article__body js-article"'])
    menu = "".join(f'<li class="menu-item"><a href="/{words(1, 1)}">{words(1, 2)}</a></li>' for _ in range(r.randint(3, 12)))
    teasers = "".join(f'<div class="card"><a href="/t"><h4>{words(3, 7)}</h4></a></div>' for _ in range(r.randint(2, 6)))
    around = [
        f'<header class="site-header"><a class="logo" href="/">{words(1, 2)}</a><nav class="main-nav"><ul>{menu}</ul></nav></header>',
        f'<div class="cookie-banner" role="dialog">We use cookies. {said()} <button>Accept</button></div>',
    ]
    after = [
        f'<aside class="sidebar-right"><h3>Most read</h3>{teasers}</aside>',
        f'<section id="comments"><h3>{r.randint(2, 40)} comments</h3><div class="comment"><b>{words(1, 1)}</b><p>{prose(1)}</p></div></section>',
        f'<div class="newsletter-signup"><form><label>{words(2, 5)}</label><input><button>Go</button></form></div>',
        f'<footer id="page-footer"><ul>{menu}</ul><small>&copy; 2021 {words(1, 3)}</small></footer>',
    ]
    keep = lambda parts: "".join(p for p in parts if r.random() < 0.8)
    return f'<!doctype html><html><head><title>{words(2, 4)}</title></head><body class="single no-js">{keep(around)}<div class="wrap"><{name}>{"".join(body)}</{name.split()[0]}>{keep(after[:3])}</div>{keep(after[3:])}<script>var a="<p>{words(3, 3)}</p>"</script></body></html>', "\n".join(blocks)


def test_right_words_on_pages_of_another_rule():
    r, model = random.Random(20), X.trained()
    found = right = wanted = empty = 0
    for _ in range(300):
        page, truth = other_page(r)
        text = X.main_text(page, model)
        a, b = text.split("\n"), truth.split("\n")
        both = sum(len(x.split()) for x in set(a) & set(b))
        found, right, wanted, empty = found + sum(len(x.split()) for x in set(a)), right + both, wanted + sum(len(x.split()) for x in set(b)), empty + (not text)
    assert empty == 0 and right / wanted > 0.98 and right / found > 0.98, (empty, right / wanted, right / found)


def enumerated(model, page):
    """Marginals from all labellings."""
    rows, n = page.features(), len(page.tag)
    own, total, good = model.evidence(page, rows), 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n):
        weight = math.exp(model.root[labels[0]] + sum(own[i][y] for i, y in enumerate(labels)) + sum(model.step[rows[i][0]][labels[page.parent[i]]][labels[i]] for i in range(1, n)))
        total += weight
        for i, y in enumerate(labels):
            good[i] += weight * y
    return [g / total for g in good]


def test_query_gives_what_all_labellings_give(spark, tmp_path):
    model = X.trained()
    pages = [
        f"<div class=menu><a href=1>One</a></div><article><p>{FIRST}</p><p>{SECOND}<b>!</b></p></article><div class=footer>&copy; 2020 &lt;them&gt;</div>",
        f"<main><h1>Title</h1><ul><li>a b c<li>d e f</ul><p>{FIRST}</p></main><aside><p>{SECOND}</p></aside>",
        "<p>Only&nbsp;one", "", None, "no markup at all", f"<div><div class=ad>{FIRST}</div><div class=story>{SECOND}</div></div>",
    ]
    rows = [(i, f"u{i}", h, "x", 1) for i, h in enumerate(pages)] + [(1, "u1", pages[1], "x", 1), (None, None, pages[0], "x", 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").write.parquet(f"{tmp_path}/pages.parquet")
    want = []
    for i, url, source, *_ in rows:
        text = ""
        if source:
            page = X.Page(source)
            assert len(page.tag) < 16
            good, lines = enumerated(model, page), {}
            for element, block, run in page.runs:
                if good[element] >= 0.5:
                    lines[block] = lines.get(block, "") + run
            text = "\n".join(t for t in (" ".join(v.split()) for v in lines.values()) if t)
        want.append((i, url, text, len(text)))
    got = [tuple(r) for r in X.op1_html_extraction(spark, str(tmp_path)).select("page_id", "url", "text", "n_chars").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
