"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags, each
with its open ancestors.  Every block gets features of its ancestors (tags, words of
their class and id) and of its text (length, links, marks, place); the chain has
two labels, article or not, and a weight for each change between them.  It is
trained on labelled pages by the gradient of the log-likelihood (forward-backward)
and decoded by Viterbi.

Labelled pages are made of a bounded sample of the given ones (``SAMPLE_PAGES``):
pages that mark their article with a landmark tag are labelled by it, and their
texts are set again in other layouts (marked by class or not at all, with menus,
notices, forms, adverts and reader comments around), where the label is known.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import bounded_sample, read

SAMPLE_PAGES, LAYOUTS, STEPS = 150, 4, 150
PARAGRAPHS, AROUND_CHARS = 30, 300  # of a training article and a training text around it in a made layout

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME = re.compile(r"[a-z]+")
#: Tags whose text is never shown, tags without content, tags inside a line.
HIDDEN = frozenset("script style template noscript head title svg iframe object math".split())
#: Start tags that leave an open head open; any other one, or a visible character, ends it.
IN_HEAD = frozenset("base link meta noframes noscript script style template title".split())
RAW = frozenset("script style title textarea iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr del".split())
#: Tags that an open tag of the same family ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table div section article main aside nav header footer form body html td th blockquote".split())
#: Landmarks that tell an article from the rest on a page that uses them.
ARTICLE, AROUND = frozenset(("article", "main")), frozenset("nav header footer aside form button select dialog menu".split())
AROUND_WORDS = frozenset("ad ads advert advertisement banner sponsor promo cookie consent notice newsletter subscribe comment comments reply share social related sidebar widget menu nav navbar breadcrumb footer header popup modal login search".split())


class Node:
    """An open tag: its parent, and what a block inside it inherits.

    ``new`` holds the features that no tag around it has, so a page's tags hold
    together no more than the page does."""

    __slots__ = ("tag", "names", "parent", "new", "inner", "hidden", "linked", "article", "around")

    def __init__(self, tag: str, names: tuple[str, ...], parent: Node | None, new: tuple[str, ...]):
        self.tag, self.names, self.parent, self.new = tag, names, parent, new
        self.inner = tag if tag not in INLINE else parent.inner if parent else "none"
        self.hidden = tag in HIDDEN or bool(parent and parent.hidden)
        self.linked = tag == "a" or bool(parent and parent.linked)
        self.article = tag in ARTICLE or bool(parent and parent.article)
        self.around = tag in AROUND or not AROUND_WORDS.isdisjoint(names) or bool(parent and parent.around)

    def upwards(self) -> Iterator[Node]:
        node: Node | None = self
        while node is not None:
            yield node
            node = node.parent

    def __iter__(self) -> Iterator[tuple[str, tuple[str, ...]]]:
        """Tags and the words of their class and id, outermost first."""
        return iter([(n.tag, n.names) for n in self.upwards()][::-1])


Block = tuple[str, int, Node | None]  # text, characters inside links, innermost open tag


def tag_features(tag: str, names: tuple[str, ...]) -> set[str]:
    out = {f"in:{tag}", *(f"name:{w}" for w in names)}
    if not AROUND_WORDS.isdisjoint(names):
        out.add("around")
    if tag in ARTICLE:
        out.add("landmark")
    return out


class OpenTags:
    """The open tags of a page, how often each tag and each feature is among them."""

    def __init__(self):
        self.nodes: list[Node] = []
        self.tags: Counter[str] = Counter()
        self.features: set[str] = set()

    @property
    def top(self) -> Node | None:
        return self.nodes[-1] if self.nodes else None

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        new = tuple(sorted(tag_features(tag, names) - self.features))
        self.features.update(new)
        self.tags[tag] += 1
        self.nodes.append(Node(tag, names, self.top, new))

    def end(self, i: int) -> None:
        """End the tag at place ``i`` and what is open in it."""
        while len(self.nodes) > i:
            node = self.nodes.pop()
            self.features.difference_update(node.new)
            self.tags[node.tag] -= 1


def leaf_blocks(page: str | None) -> list[Block]:
    """Leaf blocks with a visible text, in page order: character references decoded,
    white space in one space, trimmed."""
    out: list[Block] = []
    stack = OpenTags()
    parts: list[str] = []
    linked: list[str] = []
    page = page or ""
    endless: set[str] = set()  # tags with no end tag in the rest of the page

    def in_head() -> bool:
        return bool(stack.nodes) and stack.nodes[-1].tag == "head"

    def text(lo: int, hi: int) -> None:
        if in_head() and page[lo:hi].strip():
            stack.end(len(stack.nodes) - 1)
        if hi > lo and not (stack.nodes and stack.nodes[-1].hidden):
            parts.append(page[lo:hi])
            if stack.nodes and stack.nodes[-1].linked:
                linked.append(page[lo:hi])

    def flush() -> None:
        if parts:
            joined = " ".join(html.unescape("".join(parts)).split())
            if joined:
                links = len(" ".join(html.unescape(" ".join(linked)).split())) if linked else 0
                out.append((joined, links, stack.top))
            parts.clear()
            linked.clear()

    at = 0
    while m := TOKEN.search(page, at):
        text(at, m.start())
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        close = bool(m[1] or m[4])
        if not close and tag not in IN_HEAD and in_head():
            stack.end(len(stack.nodes) - 1)
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if close:
            for i in range(len(stack.nodes) - 1 if stack.tags[tag] else -1, -1, -1):
                if stack.nodes[i].tag == tag:
                    stack.end(i)
                    break
                if tag in INLINE and stack.nodes[i].tag not in INLINE:
                    break  # a stray end tag inside a line ends nothing outside it
            continue
        attrs = m[3] if m[2] else m[6]
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag not in INLINE:  # a new block ends an open paragraph and what is open in it
            ends = ENDS.get(tag, ())
            for i in range(len(stack.nodes) - 1 if stack.tags["p"] or any(stack.tags[t] for t in ends) else -1, -1, -1):
                t = stack.nodes[i].tag
                if t == "p" or t in ends:
                    stack.end(i)
                    break
                if t in SCOPE:
                    break
        names = tuple(w for a in ATTRIBUTE.finditer(attrs) for w in NAME.findall(a[2].lower())) if "=" in attrs else ()
        if tag in RAW:
            end = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if not end:
                endless.add(tag)
            if tag == "textarea" and not end:
                continue
            at = end.end() if end else len(page)
            continue
        stack.push(tag, names)
    text(at, len(page))
    flush()
    return out


def block_features(blocks: list[Block], inherited: bool = True) -> list[list[str]]:
    """Names of the features of each block, its neighbours' lengths included; those of its
    open tags only if ``inherited``."""
    sizes = [len(t) for t, _, _ in blocks]
    n = len(blocks)
    out = []
    for i, (text, links, node) in enumerate(blocks):
        words = text.count(" ") + 1
        f = ["bias", f"len{min(9, sizes[i].bit_length())}", f"words{min(7, words.bit_length())}",
             f"links{min(4, 4 * links // max(1, sizes[i]))}", f"end{text[-1] if text[-1] in '.!?:,;…' else ''}",
             f"commas{min(3, text.count(','))}", f"place{4 * i // n}", f"first{min(i, 3)}", f"last{min(n - 1 - i, 3)}"]
        f.append(f"before{min(9, sizes[i - 1].bit_length()) if i else 'none'}")
        f.append(f"after{min(9, sizes[i + 1].bit_length()) if i + 1 < n else 'none'}")
        f += [f"sign{c}" for c in "©|»@" if c in text]
        f.append(f"parent:{node.inner if node else 'none'}")
        if inherited and node:
            f += sorted(x for above in node.upwards() for x in above.new)
        out.append(f)
    return out


class ChainModel:
    """Weights for the label article against the rest, and changes[i][j] from label i to j."""

    def __init__(self, weights: dict[str, float], changes: np.ndarray | list[list[float]]):
        self.weights = weights
        self.changes = [[float(x) for x in row] for row in changes]

    def viterbi(self, blocks: list[Block]) -> list[int]:
        get, (c0, c1) = self.weights.get, self.changes
        worth: dict[Node, float] = {}  # weights of a tag's features and of those around it

        def of(node: Node | None) -> float:
            path = []
            while node is not None and node not in worth:
                path.append(node)
                node = node.parent
            total = worth[node] if node is not None else 0.0
            for x in reversed(path):
                total = worth[x] = total + sum([get(y, 0.0) for y in x.new])
            return total

        rest, main, back = 0.0, 0.0, []
        for i, f in enumerate(block_features(blocks, inherited=False)):
            w = sum([get(x, 0.0) for x in f]) + of(blocks[i][2] or None)
            if i:
                a, b = rest + c0[0], main + c1[0]
                c, d = rest + c0[1], main + c1[1]
                back.append((int(b > a), int(d > c)))
                rest, main = max(a, b), max(c, d)
            main += w
        label = int(main > rest)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1] if blocks else []


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, penalty: float = 0.004) -> ChainModel:
    """Penalised maximum likelihood; all chains run through forward-backward together,
    padded to the longest.  Features on one page only have no weight."""
    pages = [p for p in pages if p[0]]
    feats = [block_features(b) for b, _ in pages]
    on: dict[str, int] = {}
    for page in feats:
        for x in {x for f in page for x in f}:
            on[x] = on.get(x, 0) + 1
    number = {x: i for i, x in enumerate(sorted(x for x, c in on.items() if c > 1))}
    n, longest = len(pages), max((len(f) for f in feats), default=0)
    if not n or not number:
        return ChainModel({}, np.zeros((2, 2)))
    cell, idx = [], []
    real, gold = np.zeros((n, longest), bool), np.zeros((n, longest), int)
    for p, (page, (_, labels)) in enumerate(zip(feats, pages, strict=True)):
        real[p, :len(page)] = True
        gold[p, :len(page)] = labels
        for i, f in enumerate(page):
            own = [number[x] for x in f if x in number]
            idx += own
            cell += [p * longest + i] * len(own)
    cell, idx = np.array(cell), np.array(idx)
    w, change = np.zeros(len(number)), np.zeros((2, 2))
    mw, vw, mc, vc = np.zeros_like(w), np.zeros_like(w), np.zeros_like(change), np.zeros_like(change)
    both = real[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for t in range(1, steps + 1):
        s = np.zeros((n, longest, 2))
        s[:, :, 1] = np.bincount(cell, w[idx], n * longest).reshape(n, longest)
        fore, back = s.copy(), np.zeros_like(s)
        for i in range(1, longest):
            step = lse(fore[:, i - 1, :, None] + change, 1) + s[:, i]
            fore[:, i] = np.where(real[:, i, None], step, fore[:, i - 1])
        for i in range(longest - 2, -1, -1):
            step = lse(change + (s[:, i + 1] + back[:, i + 1])[:, None, :], 2)
            back[:, i] = np.where(real[:, i + 1, None], step, 0)
        z = lse(fore[:, -1], 1)
        p1 = np.exp(fore[:, :, 1] + back[:, :, 1] - z[:, None])
        gw = np.bincount(idx, ((gold - p1) * real).ravel()[cell], len(w)) / n - penalty * w
        pair = np.exp(fore[:, :-1, :, None] + change + (s[:, 1:] + back[:, 1:])[:, :, None, :] - z[:, None, None, None])
        gc = (seen - (pair * both[:, :, None, None]).sum((0, 1))) / n - penalty * change
        for x, g, a, b in ((w, gw, mw, vw), (change, gc, mc, vc)):
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            x += 0.15 * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)
    return ChainModel({x: float(w[i]) for x, i in number.items()}, change)


def landmark_labels(blocks: list[Block]) -> list[int] | None:
    """1 for blocks in an article landmark and in nothing around it; None without landmarks."""
    if not any(node and node.article for _, _, node in blocks):
        return None
    return [int(bool(node) and node.article and not node.around) for _, _, node in blocks]


#: Furniture texts set around training articles.
MENU = "Home News About Contact Blog Archive Products Services Login Register Help Imprint Privacy Terms Sitemap".split()
NOTICES = ["We use cookies to improve your experience. Accept", "This site uses cookies. Learn more.", "Subscribe to our newsletter!",
           "Please enable JavaScript to view this page.", "Sign up for free and get the latest updates in your inbox."]
ADVERTS = ["Advertisement", "Sponsored", "Buy now and save 50%", "Limited offer: order today!"]
SMALL = ["Share", "Tweet", "Print", "Search", "Submit", "Reply", "Related posts", "Recent comments", "Tags", "Follow us", "Read more"]
RIGHTS = ["© 2024 All rights reserved.", "Copyright 2023", "Powered by a content system", "Terms | Privacy | Contact"]
WRAPS = ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
         '<div class="post-body">{}</div>', '<div id="main-content"><div class="entry">{}</div></div>', "<div>{}</div>",
         '<section class="story">{}</section>', "<table><tr><td>{}</td></tr></table>", '<div class="article-text">{}</div>']


def layout(rng: random.Random, title: str, paragraphs: list[str], others: list[str]) -> tuple[str, set[str]]:
    """A page with the given article in a random layout, and the texts of its article blocks."""
    esc = html.escape
    pick = lambda xs: esc(rng.choice(xs))
    other = lambda: pick(others) if others and rng.random() < 0.6 else pick(NOTICES + SMALL)
    items = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(MENU, rng.randint(3, 8)))
    menu = rng.choice(["<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul id="topnav">{}</ul>', '<div class="navbar">{}</div>']).format(items)
    head = rng.choice(["", f"<header><h2>{pick(MENU)}</h2><p>{other()}</p></header>", f'<div class="header"><span>{other()}</span></div>'])
    advert = rng.choice(["", f'<div class="ad">{pick(ADVERTS) if rng.random() < 0.5 else other()}</div>', f'<div class="banner-ad"><a href="/x">{other()}</a></div>',
                         f'<aside class="promo">{other()}</aside>'])
    notice = rng.choice(["", f'<div class="cookie-notice"><p>{pick(NOTICES)}</p><button>OK</button></div>', f'<div id="consent">{pick(NOTICES)}</div>', f'<p class="notice">{other()}</p>'])
    form = rng.choice(["", f'<form><label>{pick(SMALL)}</label><input name="q"><button>{pick(SMALL)}</button></form>',
                       f'<form class="newsletter"><p>{pick(NOTICES)}</p><input><button>Go</button></form>'])
    side = rng.choice(["", f'<aside><h3>{pick(SMALL)}</h3><ul>{items}</ul><p>{other()}</p></aside>', f'<div class="sidebar"><h4>{pick(SMALL)}</h4><p>{other()}</p><p>{other()}</p></div>'])
    says = "".join(f'<div class="comment"><b>{pick(MENU)}</b> <p>{esc(rng.choice(others or SMALL))}</p></div>' for _ in range(rng.randint(1, 4)))
    said = rng.choice(["", f'<section class="comments"><h3>Comments</h3>{says}</section>', f'<div id="comments"><h3>{pick(SMALL)}</h3>{says}</div>', f'<ul class="commentlist"><li>{says}</li></ul>'])
    share = rng.choice(["", f'<div class="share"><a href="/s">{pick(SMALL)}</a> <a href="/t">{pick(SMALL)}</a></div>'])
    foot = rng.choice(["<footer><p>{}</p></footer>", '<div class="footer">{}</div>', '<div id="footer"><p>{}</p></div>']).format(esc(rng.choice(RIGHTS)) + " " + other())
    body = "".join(f"<p>{esc(x)}</p>" for x in paragraphs)
    top = rng.choice(["<h1>{}</h1>", "<h2>{}</h2>"]).format(esc(title)) if title else ""
    inner = [top, body]
    if rng.random() < 0.3:
        inner.insert(1, share)
    if rng.random() < 0.2:
        inner.append(said)
        said = ""
    page = rng.choice(WRAPS).format("".join(inner))
    before, after = [menu, head, advert, notice], [share, side, said, form]
    rng.shuffle(before)
    rng.shuffle(after)
    return (f"<html><body>{''.join(before)}{page}{''.join(after)}{foot}</body></html>",
            {" ".join(x.split()) for x in [title, *paragraphs]})


def training_pages(pages: list[str], layouts: int = LAYOUTS, seed: int = 5, paragraphs: int = PARAGRAPHS,
                   around_chars: int = AROUND_CHARS) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: the given ones that have landmarks, whole, and their texts in other layouts: at most
    ``paragraphs`` blocks of an article, and around it texts of at most ``around_chars`` characters."""
    rng = random.Random(seed)
    out, articles, others = [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = landmark_labels(blocks)
        if labels:
            out.append((blocks, labels))
            texts = [b[0] for b, y in zip(blocks, labels, strict=True) if y]
            others += [b[0] for b, y in zip(blocks, labels, strict=True) if not y]
            if texts:
                articles.append(texts)
    if not articles:  # nothing to learn from in the pages: plain prose in the layouts below
        articles = [[f"Title {i}", *["A plain sentence with some words, and one more. " * (2 + (i + j) % 5) for j in range(1 + i % 6)]] for i in range(50)]
    for texts in articles:
        for _ in range(layouts):
            page, main = layout(rng, texts[0] if len(texts[0]) < 200 else "", texts[1:][:paragraphs] or texts,
                                others + [t[:around_chars] for t in rng.choice(articles)])
            blocks = leaf_blocks(page)
            inside = [any("comment" in w for _, names in s or () for w in names) for _, _, s in blocks]
            out.append((blocks, [int(b[0] in main and not c and not any(t in AROUND for t, _ in b[2] or ())
                                     and not any("sidebar" in n or "ad" in n or "notice" in n for _, n in b[2] or ()))
                                 for b, c in zip(blocks, inside, strict=True)]))
    return out


def extract(model: ChainModel, page: str | None) -> str:
    """The article's blocks, joined by one space."""
    blocks = leaf_blocks(page)
    return " ".join(b[0] for b, y in zip(blocks, model.viterbi(blocks), strict=True) if y)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",),
                 sample_pages: int = SAMPLE_PAGES, paragraphs: int = PARAGRAPHS, around_chars: int = AROUND_CHARS) -> DataFrame:
    """Per row: ``<id_col>``, the columns in ``keep``, ``text`` and ``n_chars`` (code points).

    The field is trained on ``sample_pages`` of the pages, those with the smallest hash
    of their id, and on layouts made of them (``paragraphs``, ``around_chars``: see
    :func:`training_pages`); every page is read whole.  Defined cases: a null or empty page, or one without an article,
    has an empty text; repeated rows are read each; a page cut short is read as
    far as it goes; other columns are ignored.
    """
    sample = bounded_sample(pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
                            .where("html is not null"), "id", sample_pages).select("html").collect()
    model = train(training_pages([r[0] for r in sample], paragraphs=paragraphs, around_chars=around_chars))
    held = pages.sparkSession.sparkContext.broadcast((model.weights, model.changes))
    names = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ChainModel(*held.value)
        for b in batches:
            texts = [extract(model, x.as_py()) for x in b.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(names)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*names, "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("bigint"), *[F.col(c).cast("string") for c in keep], F.col(html_col).cast("string"))
    schema = ", ".join([f"{id_col} bigint", *[f"{c} string" for c in keep], "text string", "n_chars bigint"])
    return rows.mapInArrow(run, schema)


def query(spark, sf_dir) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))
