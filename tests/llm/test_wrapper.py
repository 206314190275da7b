"""Wrapper induction: what decides, what is kept, and trees of any shape."""

import itertools
import json
import random

import pytest
from pulsebook.llm import wrapper

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows, schema=SCHEMA):
    return {r.key: (r.text, r.decided_by) for r in wrapper.extract(spark.createDataFrame(rows, schema)).collect()}


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


@pytest.mark.parametrize("page, want", [
    ('<body class="single right-sidebar comments-open"><article><p>Text</article>', "Text"),
    ('<body class="has-menu"><main><p>Text</main>', "Text"),
    ('<article class="post related-topic"><p>Text</article>', "Text"),
    ('<main id="search-results"><p>Text</main>', "Text"),
    ('<form action="/"><div><article><p>Text</article></div><p>Send</p></form>', "Text"),
    ('<div class="sidebar-left"><main><p>Text</main></div>', "Text"),
    ('<article><p>Text<figure class="share-price"><figcaption class="share-price">Graph</figcaption></figure></article>', "Text\nGraph"),
    ('<article><p>Text<div class="share">Send</div><form><p>Mail</p></form></article>', "Text"),
    ('<article><p>Text</article><div class="related"><article><p>Other</article></div>', "Text"),
])
def test_marks_never_empty_the_article(page, want):
    assert wrapper.main_text(page, None) == want


def test_slots_decide_without_article_elements(spark):
    page = ('<body><div><ul><li><a href="/a">{a}</a></li><li><a href="/b">{b}</a></li></ul></div><div id="x"><h2>{t}</h2><p>{p}</p>'
            '<blockquote>{q}</blockquote></div><div class="z1">{f}</div><p>Same on all</p></body>')
    rows, want = [], {}
    for i in range(8):
        t, p, q = words(i, 5), words(100 + i, 80), words(200 + i, 20)
        rows.append((i, f"http://h.example/{i}", page.format(a=words(300 + i, 2), b=words(400 + i, 2), t=t, p=p, q=q, f=words(500 + i, 3))))
        want[i] = (f"{t}\n{p}\n{q}", "wrapper")
    assert texts(spark, rows) == want


def test_copies_make_no_template(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><h1>T{i}</h1><p>{words(i, 40)}</p></article>") for i in range(4)]
    copy = f"<article><h1>T</h1><p>{words(9, 40)}</p><blockquote>Only here</blockquote></article>"
    rows += [(10 + i, f"http://h.example/c{i}", copy) for i in range(5)]
    out = texts(spark, rows)
    assert all(out[10 + i][0] == f"T\n{words(9, 40)}\nOnly here" for i in range(5))
    # Four different pages that share it are less than half of the host's.
    rows = [(i, "http://h.example/", f"<article><p>{words(i, 40)}</p></article>") for i in range(6)]
    rows += [(10 + i, "http://h.example/", f"<article><p>{words(50 + i, 40)}</p><blockquote>Quoted</blockquote></article>") for i in range(4)]
    assert all(texts(spark, rows)[10 + i][0].endswith("\nQuoted") for i in range(4))


def test_constant_slots_are_template(spark):
    page = "<body><h3>Follow the news</h3><p>{}</p><p>{}</p><h4>Last words</h4></body>"
    rows = [(i, "http://h.example/", page.format(words(i, 30), words(90 + i, 30))) for i in range(5)]
    out = texts(spark, rows)
    assert out == {i: (f"{words(i, 30)}\n{words(90 + i, 30)}", "marks") for i in range(5)}


def test_pages_of_many_nodes(spark):
    wide = "".join(f'<div class="k{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}"><p>Box</p></div>' for i in range(2100))
    rows = [(i, "http://h.example/", f"<body>{wide}<div id=t><h2>{words(i, 3)}</h2><p>{words(70 + i, 50)}</p></div></body>") for i in range(5)]
    assert texts(spark, rows) == {i: (f"{words(i, 3)}\n{words(70 + i, 50)}", "wrapper") for i in range(5)}


def test_deep_and_long_pages(spark):
    deep = "<div>" * 3000 + "<p>{}</p>" + "</div>" * 3000
    rows = [(i, "http://d.example/", deep.format(words(i, 30))) for i in range(5)]
    long = [[words(1000 * i + k, 60) for k in range(1500)] for i in range(5)]
    rows += [(10 + i, "http://l.example/", "<article>" + "".join(f"<h2>{k}</h2><p>{p}</p>" for k, p in enumerate(ps)) + "</article>") for i, ps in enumerate(long)]
    out = texts(spark, rows)
    assert all(out[i][0] == words(i, 30) for i in range(5))
    assert all(out[10 + i][0] == "\n".join(f"{k}\n{p}" for k, p in enumerate(ps)) for i, ps in enumerate(long))


def test_nothing_and_clashing_names(spark):
    assert texts(spark, []) == {}
    rows = [(1, None, "<p>A</p>", "a", 2), (None, "http://x.example/", None, "b", 3), (2, "", "", None, 4)]
    out = texts(spark, rows, "page_id long, url string, html string, host string, mark int")
    assert out == {1: ("A", "marks"), None: ("", "marks"), 2: ("", "marks")}


def test_heaviest_against_all_sequences():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 8)
        places, weights = rng.sample(range(12), n), [rng.randint(1, 6) for _ in range(n)]
        weight, taken = wrapper.heaviest(places, weights)
        rising = (c for k in range(n + 1) for c in itertools.combinations(range(n), k) if all(places[a] < places[b] for a, b in zip(c, c[1:])))
        assert weight == max(sum(weights[i] for i in c) for c in rising) == sum(weights[i] for i in taken)
        assert all(places[a] < places[b] for a, b in zip(taken, taken[1:]))


def test_wrapper_has_what_an_eighth_of_all_pages_has(spark):
    """Of 64 pages each box is on eight, and one box more on a single page."""
    boxes = ["".join(random.Random(k).sample("abcdefghijklm", 5)) for k in range(16)]
    rows = []
    for i in range(64):
        own = "".join(f'<div class="{b}"><p>{words(100 * i + k, 5)}</p></div>' for k, b in enumerate(boxes) if (i + k) % 8 == 0)
        rows.append((i, "http://h.example/", f"<body>{own}{'<div class=once><p>One</p></div>' if i == 9 else ''}<article><p>{words(i, 30)}</p></article></body>"))
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("'h' AS host", "html")
    kinds = json.loads(wrapper.wrappers(pages).first().wrapper)[0]
    assert {k for k in kinds if k.startswith("div")} == {f"div.class={b}" for b in boxes}
    assert {i: t for i, (t, _) in texts(spark, rows).items()} == {i: words(i, 30) for i in range(64)}


def test_letters_of_nodes_outside_the_wrapper_count(spark):
    """Each article lies in an element of a class of its own, beside a list that varies."""
    names = ["".join(random.Random(k).sample("abcdefghijklm", 6)) for k in range(40)]
    page = '<body><div class="x"><section><div class="{n}"><p>{p}</p></div></section></div><div class="y"><ul><li>{q}</li></ul></div></body>'
    rows = [(i, "http://h.example/", page.format(n=n, p=words(i, 60), q=words(900 + i, 4))) for i, n in enumerate(names)]
    assert texts(spark, rows) == {i: (words(i, 60), "wrapper") for i in range(40)}
