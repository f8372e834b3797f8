"""HTML extraction: blocks by markup, repeats by brute force, pages with and without an article."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from tokenloom.llm import html_extract as H  # noqa: E402
from tokenloom.llm.html_blocks import ARTICLE, MAIN, OUTSIDE, page_blocks  # noqa: E402


def test_suffixes_are_in_order():
    rng = random.Random(2)
    for _ in range(200):
        depth, sizes = rng.randint(1, 9), [rng.randint(0, 25) for _ in range(rng.randint(1, 4))]
        pages = [[rng.randrange(3) for _ in range(n)] for n in sizes]
        tokens = np.array(sum(pages, []), np.int64)
        stop = np.repeat(np.cumsum(sizes), sizes)
        order, agree = H.suffix_order(tokens, stop, depth)
        heads = [tuple(tokens[i:i + depth]) for i in order]
        assert heads == sorted(heads) and sorted(order) == [i for i in range(len(tokens)) if stop[i] - i >= depth]
        assert agree.tolist() == [k > 0 and heads[k] == heads[k - 1] for k in range(len(heads))]


def brute(pages, least, min_pages, share):
    """Covered tokens of each page."""
    enough = max(min_pages, -(-len(set(map(tuple, pages))) * share // 1))
    on = {}
    for p in pages:
        for k in range(len(p) - least + 1):
            on.setdefault(tuple(p[k:k + least]), set()).add(tuple(p))
    out = []
    for p in pages:
        hit = [False] * len(p)
        for k in range(len(p) - least + 1):
            if len(on[tuple(p[k:k + least])]) >= enough:
                hit[k:k + least] = [True] * least
        k = 0
        while k < len(p):
            e = k
            while e < len(p) and hit[e]:
                e += 1
            if 2 * (e - k) > len(p):
                hit[k:e] = [False] * (e - k)
            k = max(e, k + 1)
        out += hit
    return out


@pytest.mark.parametrize("share", [0.0, 0.3])
def test_repeats_by_brute_force(share):
    rng = random.Random(4)
    parts = [[rng.randrange(40) for _ in range(rng.randint(2, 12))] for _ in range(6)]
    for _ in range(100):
        pages = [sum((rng.choice(parts) if rng.random() < 0.5 else [rng.randrange(40) for _ in range(9)] for _ in range(rng.randint(0, 6))), [])
                 for _ in range(rng.randint(1, 9))]
        pages += pages[:2]
        tokens, number = np.array(sum(pages, []), np.int64), np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        same = {}
        content = np.array([same.setdefault(tuple(p), len(same)) for p in pages])
        assert H.repeated_tokens(tokens, number, content, 5, 3, share).tolist() == brute(pages, 5, 3, share)


PAGE = """<!DOCTYPE html><html><head><title>t &amp; <b></title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies</div><main><article class="post"><header><h1>Real &lt;title&gt;</h1><p>by Bob</p></header>
<p>First <b>bold</b>&nbsp; text<br>line</p><aside>side</aside><div class="ad-slot">Buy</div><p class="notice">notice</p><ul><li>one<li>two</ul>
<form><label>f</label><input></form><article><p>comment</p></article><span class="share">tweet</span><footer>f</footer><div>open</div>
<p>a<i>b</i>c 1 < 2 &amp; &am &#8364;</article><p>after</main><section id="comments"><p>hi</p></section><footer>&copy;</footer>
<script>if (a<b) "</article>"</script><p hidden>gone</p><!-- <p>no</p> --><p style="display: none">gone</p></body></html>"""


def test_markup_decides_what_an_article_is():
    blocks = page_blocks(PAGE)
    kept = [b.text for b in blocks if b.place == ARTICLE and not b.chrome]
    assert kept == ["Real <title>", "First bold text", "line", "one", "two", "open", "abc 1 < 2 & &am €"]
    assert [b.text for b in blocks if b.place == MAIN] == ["after"]
    assert all(b.chrome for b in blocks if b.place == OUTSIDE)


@pytest.mark.parametrize("page, texts", [
    ("", []), (" \n", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("a<!-- x", ["a"]), ("a<!-->b", ["ab"]), ("<p>a<b", ["a"]),
    ("a<p title='x>y'>b", ["a", "b"]), ("</div></p>x</b>", ["x"]), ("<div>a</div>b<div>c", ["a", "b", "c"]), ("<script>x", []),
    ("1<2 &lt;b&gt;", ["1<2 <b>"]), ("<td>a<td>b<tr><td>c", ["a", "b", "c"]), ("<![CDATA[x]]>y<?php z?>w", ["yw"]), ("<P CLASS=x>Up</P>", ["Up"]),
])
def test_odd_markup(page, texts):
    assert [b.text for b in page_blocks(page)] == texts


@pytest.mark.parametrize("page, kept", [
    ("<div class='layout has-sidebar'><article><p>a</p></article></div>", "a"),
    ("<div class='sidebar-right'><article><p>a</p><div class=ad>x</div></article></div>", "a"),
    ("<form id=f><main><p>a</p><nav>m</nav></main></form>", "a"),
    ("<form><article><p>a</p><article><p>c</p></article></article></form>", "a"),
    ("<article><p>a</p></article><div class=related><article><p>b</p></article></div><aside><article>c</article></aside>", "a"),
    ("<div class=related><article><p>b</p></article></div><main><p>a</p></main>", "a"),
    ("<article class='comment'><p>c</p></article><article><h1>t</h1>a</article><footer><article>f</article></footer>", "t a"),
    ("<div id=content><p>a</p><div class='share-bar'>s</div></div><div id=footer>f</div>", "a"),
    ("<section role=main><h1>t</h1><p>a</p></section><p>b</p>", "t a"),
])
def test_the_main_part_of_a_page(page, kept):
    assert H._judge([page_blocks(page)], 8, 3, 0.0)[0][0] == kept


@pytest.mark.parametrize("junk", ["<b>" * 50000, "<" * 50000, '<p a="' * 20000, "<!--" * 20000, "</b>" * 30000 + "<i>" * 30000, "<div><article></i>" * 10000])
def test_junk_takes_linear_time(junk):
    page_blocks(junk)


def page(k, main):
    return f"<body><div>Our shop has all that you need at small prices</div>{main}<div>All rights are with the owner of this site</div></body>"


def test_repeats_decide_where_markup_does_not(spark):
    rng = random.Random(6)
    own = [" ".join(rng.choice("abcdefghijklm") + str(rng.randrange(99)) for _ in range(40)) for _ in range(6)]
    rows = [(k, f"http://Host.example/{k}", page(k, f"<div>{own[k]}</div>"), 1, "x") for k in range(6)]
    rows.append((6, "http://host.example/6", page(6, f"<article><p>{own[0]}</p><div>Our shop has all that you need at small prices</div></article>"), 1, "x"))
    rows.append((7, "http://other.example/1", page(7, f"<div>{own[1]}</div>"), 1, "x"))
    rows += [(8, None, None, 1, "x"), (8, None, None, 1, "x"), (None, "no scheme", "<p>hi</p>", 1, "x"), (9, "http://copy/", f"<div>{own[2]}</div>", 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, id long, text string").repartition(4)
    out = H.html_extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars", "n_tokens", "n_repeated"]
    got = out.collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by_id = {r["page_id"]: r for r in got}
    for k in range(6):
        assert by_id[k]["text"] == own[k] and by_id[k]["n_repeated"] == 22  # eleven words and element marks twice
    assert by_id[6]["text"] == own[0]  # the article's open block is boilerplate of the host, its paragraph is not
    assert own[1] in by_id[7]["text"] and "Our shop" in by_id[7]["text"]  # one page alone repeats nothing
    assert by_id[8]["text"] == "" and by_id[None]["text"] == "hi" and by_id[9]["text"] == own[2]
    assert H.html_extract(df.limit(0)).count() == 0


def test_repeated_paragraphs_of_articles_stay(spark):
    text = " ".join(f"word{k}" for k in range(30))
    rows = [(k, f"http://h/{k}", f"<article><h1>t{k}</h1><p>{text}</p><p>own {k} " + "x " * k + "</p></article>") for k in range(5)]
    rows += [(9, "http://h/9", rows[0][2])] * 3
    got = H.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 8 and all(text in r["text"] for r in got)


def test_a_large_host_is_split_by_content(spark):
    rng = random.Random(8)
    rows = [(k, "http://big.example/", page(k, "<div>" + " ".join(str(rng.randrange(10**6)) for _ in range(30)) + "</div>")) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    parts = H.html_extract(df, group_chars=4000).collect()
    assert len(parts) == 60
    whole = {r["page_id"]: r["text"] for r in H.html_extract(df).collect()}
    assert all(re.fullmatch(r"[\d ]+", t) for t in whole.values()) and {r["page_id"]: r["text"] for r in parts} == whole


@pytest.mark.parametrize("share", [0.01, 0.05, 0.15])
def test_a_large_host_is_judged_as_a_whole(spark, share):
    """Footers on two to a third of the pages: each is rare in its part, or common there alone."""
    rng = random.Random(12)
    foot = {k: " ".join(f"foot{k}x{i}" for i in range(12)) for k in (2, 3, 4, 5, 7, 11)}
    rows = []
    for k in range(90):
        own = " ".join(str(rng.randrange(10**6)) for _ in range(60))
        feet = "".join(f"<div>{t}</div>" for every, t in foot.items() if k % (90 // every) == 0 or every > 4 and k % every == 0)
        rows.append((k, "http://big.example/", f"<body><div>{own}</div>{feet}</body>"))
    rows += [(100 + k, "http://big.example/", rows[0][2]) for k in range(9)]  # copies are one distinct page
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(map(tuple, H.html_extract(df, share=share).collect()))
    assert {r[5] for r in whole} != {0}
    for size in (20_000, 6000, 900):
        assert sorted(map(tuple, H.html_extract(df, share=share, group_chars=size).collect())) == whole


def test_rare_heads_are_left_out():
    rng = random.Random(3)
    for _ in range(200):
        depth, often, sizes = rng.randint(1, 9), rng.randint(1, 4), [rng.randint(0, 25) for _ in range(rng.randint(1, 4))]
        tokens = np.array([rng.randrange(3) for _ in range(sum(sizes))], np.int64)
        stop = np.repeat(np.cumsum(sizes), sizes)
        whole, _ = H.suffix_order(tokens, stop, depth)
        heads = [tuple(tokens[i:i + depth]) for i in whole]
        order, agree = H.suffix_order(tokens, stop, depth, often)
        left = [h for h in heads if heads.count(h) >= often]
        some = [tuple(tokens[i:i + depth]) for i in order]
        assert [h for h in some if heads.count(h) >= often] == left and len(set(order)) == len(order)
        assert agree.tolist() == [k > 0 and some[k] == some[k - 1] for k in range(len(some))]


@pytest.mark.parametrize("share", [0.0, 0.1, 0.4])
def test_what_a_group_tells_and_what_it_is_asked_for(share):
    rng = random.Random(5)
    parts = [" ".join(rng.choice("abcdé") for _ in range(rng.randint(4, 9))) for _ in range(5)]
    for _ in range(20):
        pages = [[H.Block("p", 0, False, rng.choice(parts)) for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(1, 12))]
        assert [H._unpack(H._pack(b)) for b in pages] == pages
        on = {}
        streams = [" ".join(f"<{b.tag} {b.text}" for b in p).split() for p in pages]
        for s in streams:
            for k in range(len(s) - 4):
                on.setdefault(tuple(s[k:k + 5]), set()).add(tuple(s))
        distinct, slack, keys, counts = H._told(pages, 5, share)
        assert distinct == len(set(map(tuple, streams))) and (slack == 0 or slack < share * distinct)
        assert sorted(counts) == sorted(len(x) for x in on.values() if len(x) > slack)
        every = H._told(pages, 5, 0.0)[2]
        asked = np.concatenate([every, every[:3] ^ 1, every[:3] ^ np.array([0, 1])])  # of other groups; two of one first half
        less, fewer = H._untold(pages, asked, 5, share)
        assert sorted(fewer) == sorted(len(x) for x in on.values() if len(x) <= slack)
        assert {*map(tuple, keys.tolist())} | {*map(tuple, less.tolist())} == {*map(tuple, every.tolist())}
        assert H._judge(pages, 5, 1, 0.0, asked) == H._judge(pages, 5, 1, 0.0)


def test_pages_of_large_hosts_are_cut_once(spark, monkeypatch):
    """Telling, looking up and judging share one shuffle of the pages."""
    rng = random.Random(9)
    foot = " ".join(f"foot{i}" for i in range(12))
    rows = [(k, "http://big.example/", "<body><div>" + " ".join(str(rng.randrange(10**6)) for _ in range(60)) + "</div>"
             + f"<div>{foot}</div>" * (k % 7 == 0) + "</body>") for k in range(90)]
    rows += [(100, "http://small.example/", "<p>a</p>")]
    cuts = spark.sparkContext.accumulator(0)

    def counted(text):
        cuts.add(1)
        return page_blocks(text)

    monkeypatch.setattr(H, "page_blocks", counted)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = H.html_extract(df, share=0.15, group_chars=3000).collect()
    assert len(got) == len(rows) and cuts.value == len(rows)
