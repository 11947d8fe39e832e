import html
import random
import re

import pytest

from pitchline.llm import html_host as h
from pitchline.llm import queries


def main(page):
    return " ".join(t for z, t in h.blocks(page) if z == h.MAIN)


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">We use</div><main><article><header><h1>Head &amp; line</h1></header>
    <p>One <b>two</b>three&nbsp;four<br>five<script>var x="</p>";</script> six</p><!-- gone <p>x</p> --><div class='ad'><p>Buy</p></div>
    <form><label>Mail</label><input></form><p>caf&eacute; &lt;b&gt; &#233;&#x41;</p><aside>Side</aside><footer>By me</footer>
    <section id="comments"><p>First!</p></section><p hidden>no</p><ul><li>x</li><li>y</li></ul></article></main><p>stray</p><footer>&copy;</footer>"""
    assert main(page) == "Head & line One twothree four five six café <b> éA x y"


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain text", ""), ("<article>open", "open"), ("<article><p><b>x<br><p>y</p><p>z</article><footer>f", "x y z"),
    ("<article>a < b & c &am", "a < b & c &am"), ("<article><a title='>'>q</a> <i>r</i></article>", "q r"), ("<ARTICLE>Up</ARTICLE>", "Up"),
    ("<article>one</article><article>two</article>", "one two"), ("<div role=main>r</div>", "r"), ("<article>" + "w " * 50_000, ("w " * 50_000).strip()),
    ("<article><p>a</b></p><p>b</p></article>c", "a b"), ("<article><p title=don't>it's</p> x='y'</article>", "it's x='y'"), ("<article><a href=/x/>l</a><p class=\"ad>z</article>", "l z"),
    ("<article><p " + "a='b' " * 20_000 + ">x</article>", "x"), ("<article>" + "<a '" * 3000, ""), ("<article><!-- open", ""), ("<article>x<script>never closed", "x")])
def test_odd_pages(page, want):
    assert main(page or "") == want


def brute_covered(pages, run, least=2):
    """Token positions in runs that ``least`` pages of the host have."""
    heads = {}
    for host, page, words in pages:
        for i in range(len(words) - run + 1):
            heads.setdefault((host, tuple(words[i:i + run])), set()).add(page)
    out = []
    for host, page, words in pages:
        got = set()
        for i in range(len(words) - run + 1):
            if len(heads[host, tuple(words[i:i + run])]) >= least:
                got.update(range(i, i + run))
        out.append(got)
    return out


def test_repetition_decides_without_main_element(spark):
    rng = random.Random(4)
    menus = {"a.com": "Home News Sport Weather Shop About", "b.com": "Start Blog Contact Terms Help More Links"}
    rows, plain = [], []
    for i in range(120):
        host = rng.choice(list(menus))
        body = [f"w{rng.randrange(9000)}" for _ in range(rng.randint(20, 60))]
        tail = "All rights reserved by the owner of the site"
        rows.append((i, f"http://{host}/p{i}", f"<body><div>{menus[host]}</div><p>{' '.join(body)}</p><div>{tail}</div>", "x"))
        plain.append((host, i, menus[host].split() + body + tail.split()))
    rows.append((500, "http://a.com/copy", rows[0][2], "x"))
    rows += [(501, None, None, "x"), (502, "http://c.com/", "", "x"), (None, "http://c.com/", "<p>only one", "x"), (503, "http://d.com/", "<p>a b c d e f g h", "x"), (503, "http://d.com/", "<p>a b c d e f g h", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {}
    for r in h.extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    plain.append(("a.com", 500, plain[0][2]))  # a copy loses its menu like any other page
    covered = brute_covered(plain, h.RUN, 40)
    for (host, i, words), c in zip(plain, covered):
        assert got[i] == [" ".join(w for n, w in enumerate(words) if n not in c)]
    assert got[501] == [""] and got[502] == [""] and got[None] == ["only one"] and got[503] == ["a b c d e f g h"] * 2


def test_given_pages(spark):
    """Every page of the small table against a cut by its fixed shape."""
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op5_html_host(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)
        text = re.sub(r"<(/?)(p|h1|br)\b[^>]*>", " ", body[1]) if body else ""
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


def test_empty(spark):
    assert h.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def texts_of(spark, pages, **kw):
    return {r.page_id: r.text for r in h.extract(spark.createDataFrame(pages, "page_id long, url string, html string"), **kw).collect()}


def bodies(rng, n, size):
    return [" ".join(f"w{rng.randrange(9000)}" for _ in range(size)) for _ in range(n)]


def test_repeats_inside_the_main_element_go(spark):
    """A notice without telling tag or class, in the article: as a block, in small blocks and within a block."""
    body = bodies(random.Random(1), 160, 40)
    notice = "Our readers keep this site alive so give what you can today"
    within = " ".join(f"terms{i}" for i in range(30))
    pages, want = [], {}
    for i in range(40):
        a, b, c, d = body[4 * i:4 * i + 4]
        inner = [f"<p>{notice}</p>", "".join(f"<p>{w}</p>" for w in notice.split()), within, f"<p>{notice}</p>"][i // 10]
        if i // 10 == 2:
            page = f"<article><p>{a} {b}</p><p>{c} {inner} {d}</p></article>"
        else:
            page = f"<article><p>{a}</p>{inner}<p>{b}</p><p>{c} {d}</p></article>"
        pages.append((i, f"http://{i // 10}.com/", page if i < 30 else page.replace("article>", "div>")))
        want[i] = f"{a} {b} {c} {d}"
    assert texts_of(spark, pages) == want


def test_names_inside_an_article_must_say_nothing_else():
    page = """<article><p>a</p><section class='related-work'><h2>Related work</h2><p>b</p></section><p class='social history'>c</p>
    <div class='social-share'>Tweet</div><div class="ad_box left">Buy</div><div class="newsletter signup">Mail</div><div class='shared-memory'>d</div>
    <div id=comments class=list>First</div></article>"""
    assert main(page) == "a Related work b c d"


def test_a_host_of_four_pages_tells_its_menu(spark):
    body = bodies(random.Random(7), 8, 30)
    menu = "Home News Sport Weather Shop About us and more"
    four = [(i, "http://four.com/", f"<div>{menu}</div><div>{body[i]}</div>") for i in range(4)]
    two = [(10 + i, "http://two.com/", f"<div>{menu}</div><div>{body[4 + i]}</div>") for i in range(2)]
    got = texts_of(spark, four + two)
    assert [got[i] for i in range(4)] == body[:4]
    assert [got[10 + i] for i in range(2)] == [f"{menu} {body[4 + i]}" for i in range(2)]  # two pages can't tell


def test_batches_give_what_the_whole_host_gives(spark):
    """Repeats on few, half and most pages of hosts of any size, in one batch a host or in many."""
    rng = random.Random(8)
    parts = bodies(rng, 5, 30)
    pages = []
    for i in range(90):
        host = "big.com" if i < 70 else f"small{i % 4}.com"
        chosen = [p for n, p in enumerate(parts) if rng.random() < (0.05, 0.3, 0.5, 0.55, 0.9)[n]]
        inner = "".join(f"<p>{x}</p>" for x in chosen) if i % 2 else " ".join(chosen)
        pages.append((i, f"http://{host}/", f"<article><p>{bodies(rng, 1, 25)[0]}</p>{inner}<p>{bodies(rng, 1, 9)[0]}</p></article>"))
    pages += [(i, u, p) for i, u, p in pages[:9]]  # rows of one page
    whole = texts_of(spark, pages)
    assert texts_of(spark, pages, batch_pages=4) == whole == texts_of(spark, pages, batch_bytes=2000)
    words = {i: re.sub("<[^>]*>", " ", p).split() for i, _, p in pages}
    on = [sum(p in " ".join(words[i]) for i in range(70)) for p in parts]
    for i in range(70):
        for p, n in zip(parts, on):
            if p in " ".join(words[i]):
                assert (p not in whole[i]) == (n >= 35)


def test_suffix_array_is_sorted_with_common_prefixes():
    import numpy as np

    rng = random.Random(9)
    for _ in range(60):
        texts = ["\n".join("+-"[rng.random() < 0.3] + " ".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 4)))
                 for _ in range(rng.randint(1, 6))]
        one = h.Streams(texts, np.arange(len(texts)))
        array = h.SuffixArray(one)
        suffix = [[int(x) for x in one.codes[i:array.end[i]]] for i in range(len(one.tokens))]
        got = array.order.tolist()
        assert sorted(got) == list(range(len(suffix))) and [suffix[i] for i in got] == sorted(suffix)
        common = array.common().tolist()
        for n in range(1, len(got)):
            a, b = suffix[got[n - 1]], suffix[got[n]]
            assert common[n] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        for size in (1, 2, 3, 5):
            at = np.array([i for i in range(len(suffix)) if len(suffix[i]) >= size], np.int64)
            if len(at):
                same = array.equal(at, np.full(len(at), size))
                by, interval = {}, array.interval(size)
                for i, g in zip(at.tolist(), same.tolist()):
                    by.setdefault(tuple(suffix[i][:size]), set()).add((g, int(interval[i])))
                assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)


def test_long_pages_and_ties(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    pages = [(i, "http://l.com/", f"<article><p>{long}</p><p>own{i} text</p></article>") for i in range(3)]  # a text that all pages copy is kept
    got = texts_of(spark, pages)
    assert all(got[i] == f"{long} own{i} text" for i in range(3))
    tie = bodies(random.Random(3), 4, 20)
    notice = "n1 n2 n3 n4 n5 n6 n7"
    pages = [(i, "http://t.com/", f"<article><p>{t}</p><p>{notice if i < 2 else 'other words'}</p></article>") for i, t in enumerate(tie)]
    got = texts_of(spark, pages)
    assert got[0].endswith("n7") and texts_of(spark, pages, least=2)[0] == tie[0]  # exactly half of the pages are enough


def test_phrases_and_partial_copies_stay(spark):
    """Ordinary phrases inside blocks, bodies that share most of their text and exact copies, with and without main element."""
    rng = random.Random(2)
    phrases = bodies(rng, 12, 9)
    body, shared = bodies(rng, 100, 30), bodies(rng, 1, 70)[0]
    for tag in ("article", "div"):
        pages, want = [], {}
        for i in range(100):
            text = f"{body[i]} {rng.choice(phrases)} {body[(i * 7 + 3) % 100][:40]} {rng.choice(phrases)} end{i}"
            text += f" {shared}" if i in (5, 50, 90) else ""
            pages.append((i, "http://b.com/", f"<{tag}><p>{text}</p></{tag}>"))
            want[i] = " ".join(text.split())
        pages += [(200 + i, "http://b.com/copy", pages[7][2]) for i in range(20)]
        want |= {200 + i: want[7] for i in range(20)}
        assert texts_of(spark, pages) == want


def test_windows_equal_brute_force(spark):
    """Long repeats against all windows of all pages: anchors lose none."""
    rng = random.Random(3)
    parts = bodies(rng, 6, 33)
    pages = []
    for i in range(60):
        ws = " ".join(x for k in range(3) for x in (bodies(rng, 1, 12 + k)[0], " ".join(rng.choice(parts).split()[rng.randrange(9):])))
        pages.append((i, "http://c.com/", f"<article><p>start{i} {ws} end{i}</p></article>"))
    seen = {}
    words = {i: re.sub("<[^>]*>", "", p).split() for i, _, p in pages}
    for i, ws in words.items():
        for k in range(len(ws) - h.LONG + 1):
            seen.setdefault(tuple(ws[k:k + h.LONG]), set()).add(i)
    got = texts_of(spark, pages, copy=2.0, share=0.1)
    for i, ws in words.items():
        gone = {k + j for k in range(len(ws) - h.LONG + 1) if len(seen[tuple(ws[k:k + h.LONG])]) >= 6 for j in range(h.LONG)}
        assert gone and got[i].split() == [w for k, w in enumerate(ws) if k not in gone]
