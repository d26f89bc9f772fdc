"""URL filter against a plain-Python model; HTML extraction on held-out layouts."""

import math
import os
import random
import time
from collections import Counter

import pytest

from loglens.llm import html_extract as hx
from loglens.llm import url_filter as uf

SF = "/root/testdata/sf0.001"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def judge(urls):
    rows = []
    for u in urls:
        host, path = split(u)
        fits = [r for r in uf.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else "0" if c in "0123456789" else c for c in u or "")
        s = [uf.ALPHABET.find(c) + 1 or uf.SYMBOLS for c in low]
        rows.append((host, path, best, s))
    grams = lambda s: [(a, b, c) for a, b, c in zip([0, 0, *s], [0, *s], s)]
    every = {g for r in rows for g in grams(r[3])}
    prob = {}
    for kind in ("allow", "block"):
        n = Counter(g for r in rows if r[2] and r[2][2] == kind for g in grams(r[3]))
        tables = []
        for k in range(3):
            c, t, d = Counter(), Counter(), {}
            for g, x in n.items():
                c[g[2 - k:]] += x
                t[g[2 - k:2]] += x
                d.setdefault(g[2 - k:2], set()).add(g[2])
            tables.append((c, t, d))
        for g in every:
            p = 1 / uf.SYMBOLS
            for k, (c, t, d) in enumerate(tables):
                u = g[2 - k:2]
                if t[u]:
                    p = (c[g[2 - k:]] + len(d[u]) * p) / (t[u] + len(d[u]))
            prob[kind, g] = p
    ratio = {g: math.log(prob["allow", g] / prob["block", g]) * uf.UNIT for g in every}
    return [(h, p, b and b[0] + b[1], sum(ratio[g] for g in grams(s)) / len(s) if s else 0.0, b and b[2]) for h, p, b, s in rows]


def test_url_filter_brute_force(spark):
    rng = random.Random(1)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['www.', '', 'Blog.'])}{rng.choice(['spam-win', 'garden', 'rivers', 'pills'])}."
            f"{rng.choice(['example.net', 'example.com', 'example.org', 'other.net', 'NET'])}/{rng.choice(['en', 'de', 'fr'])}/{rng.randint(1, 999)}{rng.choice(['', '?q=1', '#t', '/é'])}"
            for _ in range(150)]
    urls += [None, "", "no scheme", "http://example.net", "http://EXAMPLE.NET/en/?x", "ftp://net/a://b", "x://notnet/en/", "a\nb://net/\n", urls[0], urls[0]]
    got = uf.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).orderBy("page_id").collect()
    want = judge(urls)
    for g, w in zip(got, want, strict=True):
        assert (g["host"], g["path"], g["rule"]) == w[:3]
        assert abs(g["score"] - w[3]) <= 2
        if w[4]:
            assert g["verdict"] == w[4]
    free = [(g["score"], g["verdict"]) for g in got if g["rule"] is None]
    assert max((s for s, v in free if v == "block"), default=-1e18) < min((s for s, v in free if v == "allow"), default=1e18)
    plan = uf.filter_urls(spark.createDataFrame([(1, "u", 1)], "page_id bigint, url string, s int"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_filter_empty_and_one_sided(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert uf.filter_urls(empty).collect() == []
    one = uf.filter_urls(spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, "http://b.com/")], "page_id bigint, url string"))
    assert sorted(r["verdict"] for r in one.collect())[-2:] == ["block", "block"]


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body><nav><ul><li><a href="/a>b">Home</a><li>News</ul></nav><!-- <p>no</p> --><div class="ad">Buy now</div><article><h1>A&nbsp;title &amp; more</h1>
<p><b>First  one,
with &lt;marks&gt;.<br>Second line<p>An open paragraph follows here.</p><div class="comments"><p>nice, thanks</p></div></article><footer>&copy; x</footer>"""


def test_leaf_blocks():
    got = [b[0] for b in hx.leaf_blocks(PAGE)]
    assert got == ["Home", "News", "Buy now", "A title & more", "First one, with <marks>. Second line",
                   "An open paragraph follows here.", "nice, thanks", "© x"]
    assert hx.leaf_blocks(None) == hx.leaf_blocks("") == hx.leaf_blocks("<script>x") == []
    assert [b[0] for b in hx.leaf_blocks("a < b <i>c</i> d")] == ["a < b c d"]
    assert hx.landmark_labels(hx.leaf_blocks(PAGE)) == [0, 0, 0, 1, 1, 1, 0, 0]


@pytest.mark.parametrize("start", ["<body>", "<body class=x>", "", "<div>", "<br>", "<img src=x>"])
def test_leaf_blocks_without_head_end(start):
    page = f"<html><head><title>No</title><meta name=a><link rel=b><script>no</script><style>no</style>\n{start}"
    blocks = hx.leaf_blocks(page + "<article><p>Hello, <b>head</b></article>")
    assert [b[0] for b in blocks] == ["Hello, head"]
    assert "head" not in [t for t, _ in blocks[0][2]] and hx.landmark_labels(blocks) == [1]
    assert [b[0] for b in hx.leaf_blocks(page + "Hello, <i>head</i><p>More")] == ["Hello, head", "More"]
    assert hx.leaf_blocks("<head><noframes><p>no</p></noframes><title>no</title></head>") == []


def test_signs_anywhere_in_a_block():
    long = "Some words of a long notice, " * 10
    for c in "©|»@":
        assert [f"sign{c}" in f for f in hx.block_features([(x, 0, []) for x in (long + c, c + long, long)])] == [True, True, False]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_extraction_held_out(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = [r["html"] for r in pages.orderBy("page_id").collect()]
    half = len(html) // 2
    model = hx.train(hx.training_pages(html[:half]))
    own = [(b, hx.landmark_labels(b)) for b in map(hx.leaf_blocks, html[half:])]
    assert sum(model.viterbi(b) == y for b, y in own) >= 0.98 * len(own)
    other = hx.training_pages(html[half:], seed=99)
    wrong = sum(u != v for b, y in other for u, v in zip(model.viterbi(b), y, strict=True))
    assert wrong <= 0.01 * sum(len(y) for _, y in other)
    rows = hx.extract_text(pages, sample_pages=half).collect()
    assert len(rows) == len(html) and all(r["n_chars"] == len(r["text"]) for r in rows)


def test_extraction_odd_cases(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", PAGE, "x"), (3, "u", PAGE, "x"), (3, "u", PAGE, "x"),
            (4, "u", "<p>" + "long text, and so on. " * 20_000, "x")]
    got = hx.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6 and [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert hx.extract_text(spark.createDataFrame([], schema)).collect() == []


def test_viterbi_is_the_best_chain():
    rng = random.Random(5)
    blocks = hx.leaf_blocks("".join(f"<p>{'word ' * rng.randint(1, 30)}</p>" for _ in range(7)))
    names = sorted({x for f in hx.block_features(blocks) for x in f})
    model = hx.ChainModel({x: rng.uniform(-1, 1) for x in names}, [[rng.uniform(-1, 1) for _ in "ab"] for _ in "ab"])

    def worth(y):
        e = sum(sum(model.weights.get(x, 0) for x in f) for f, on in zip(hx.block_features(blocks), y, strict=True) if on)
        return e + sum(model.changes[a][b] for a, b in zip(y[:-1], y[1:], strict=True))

    best = max(([int(c) for c in f"{i:07b}"] for i in range(128)), key=worth)
    assert model.viterbi(blocks) == best


#: Pages written by hand, without landmark tags, in layouts that the training ones cannot have, and their article blocks.
BY_HAND = [
    ("""<html><body bgcolor=white><center><font size=6>The Lighthouse Pages</font></center><table width=760><tr><td width=140 valign=top>
<a href=i.html>Index</a><br><a href=m.html>Map</a><br><a href=g.html>Guest book</a></td><td valign=top><h3>How the lamp was kept</h3>
The lamp had to be trimmed every four hours, and the keeper slept in a chair beside it through most of the winter.
<p>Oil came by boat in spring, when the sea allowed it, and was carried up the stairs in cans of five gallons each.
<p>In 1911 the station was rebuilt, and the old lens, which weighed two tons, was sold to a museum on the mainland.</td></tr></table>
<hr><center><font size=1>Best viewed at 800 x 600. Last change: May 1999</font></center></body></html>""",
     ["How the lamp was kept", "The lamp had", "Oil came by", "In 1911 the"]),
    ("""<div id=wrap><div id=top><a href=/>Granary Kitchen</a><ul><li><a href=/r>Recipes</a><li><a href=/s>Seasons</a><li><a href=/a>About us</a></ul></div>
<div id=page><h1>Barley soup with leeks</h1><p>This is what we cook on the first cold evening of the year, because it asks for little and keeps for days.</p>
<h2>What you need</h2><ul><li>200 g of pearl barley, rinsed well</li><li>three leeks, white and pale green parts only, sliced</li></ul>
<p>Soften the leeks slowly in butter, add the barley and a litre and a half of stock, and leave it alone for forty minutes.</p>
<p>Season at the end, since the stock thickens and what seemed mild at first may turn out to be salty.</p></div>
<div id=bottom><p>Granary Kitchen 2019. <a href=/c>Contact</a> <a href=/p>Privacy</a></p></div></div>""",
     ["Barley soup", "This is what", "What you need", "200 g", "three leeks", "Soften the", "Season at"]),
    ("""<body><div class=masthead>The Valley Courier</div><div class=tabs><a href=/1>Local</a> | <a href=/2>Sport</a> | <a href=/3>Weather</a></div>
<div class=col1><div class=hd>Bridge to close for repairs in June</div><div class=by>By a staff writer, 12 April</div>
<div class=txt>The council decided on Tuesday to close the old stone bridge for six weeks, the third time in ten years.</div>
<div class=txt>Shop owners on the east bank said that they had not been asked, and that the detour of nine miles would keep customers away.</div>
<div class=txt>Work begins on 3 June. Buses will run over the northern crossing, and the footpath is to stay open.</div></div>
<div class=col2><div class=ttl>Most read</div><a href=/x>Fire at mill</a><br><a href=/y>School wins cup</a><div class=sponsor>Sponsored: cheap tyres here</div></div>
<div class=legal>All rights reserved. Valley Courier Ltd.</div></body>""",
     ["Bridge to close", "By a staff writer", "The council decided", "Shop owners on", "Work begins on"]),
    ("""<html><title>x</title><body><p><a href=..>Up</a> <a href=n>Next</a> <a href=p>Previous</a></p><h2>4.2 Reading a configuration</h2>
<p>A configuration is read once, when the program starts, from the first file that exists in the list given below.</p>
<pre>/etc/tool.conf
~/.toolrc</pre><p>Later files do not override earlier ones; use an include line where a value must come from elsewhere.</p>
<blockquote>Note that names are compared without regard to case, but values are not.</blockquote>
<form action=/q><input name=q><button>Search the manual</button></form><p><small>Copyright 2004 the tool authors</small></p></body></html>""",
     ["4.2 Reading", "A configuration is", "/etc/tool.conf", "Later files", "Note that names"]),
    ("""<body><div class="x1 popup"><p>We value your privacy. Accept all or choose settings.</p><button>Accept</button></div><div class=x2>
<p>When the river froze in February, people walked across it to the market, and for one week nobody paid the ferryman.</p>
<p>He sat in his hut, it was said, and carved spoons; some of them can still be seen in the town hall.</p></div>
<div class=x3><div class=reply><b>anna</b><p>My grandfather had one of these spoons!</p></div><div class=reply><b>tom</b><p>Great story, thanks.</p></div></div></body>""",
     ["When the river", "He sat in"]),
]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_extraction_of_pages_by_hand(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(hx.SAMPLE_PAGES)
    model = hx.train(hx.training_pages([r["html"] for r in pages.select("html").collect()]))
    right = found = wanted = 0
    for page, starts in BY_HAND:
        blocks = hx.leaf_blocks(page)
        want = [any(b[0].startswith(x) for x in starts) for b in blocks]
        assert sum(want) == len(starts) and hx.landmark_labels(blocks) is None
        got = model.viterbi(blocks)
        right += sum(w and g for w, g in zip(want, got, strict=True))
        found, wanted = found + sum(got), wanted + sum(want)
        print([(b[0][:30], g, int(w)) for b, g, w in zip(blocks, got, want, strict=True) if g != w])
    print(f"precision {right / max(1, found):.2f}, recall {right / wanted:.2f} of {wanted} blocks")
    assert right >= 0.7 * wanted and right >= 0.7 * found


def test_nested_pages_take_time_in_proportion():
    model = hx.ChainModel({"in:div": 0.5, "in:span": 0.25, "name:a": 1.0, "bias": -0.7}, [[0.0, 0.0], [0.0, 0.0]])
    page = "".join(f"<div class=a><span>word {i} " for i in range(4000))
    start = time.perf_counter()
    blocks = hx.leaf_blocks(page)
    assert model.viterbi(blocks) == [1] * 4000
    assert time.perf_counter() - start < 2
    assert sum(len(n.new) for n in blocks[-1][2].upwards()) == 3
    shallow = hx.leaf_blocks("".join(f"<div class=a><span>word {i} " for i in range(9)))
    assert [sorted(f) for f in hx.block_features(shallow)] == [
        sorted([*own, "in:div", "in:span", "name:a"]) for own in hx.block_features(shallow, inherited=False)]
