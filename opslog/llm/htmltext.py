"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of block elements and text leaves. Every node gets
features of its own subtree (words, link density, punctuation, words an
element), its place (depth, position, siblings), its element kind, its
ancestors' kinds, and its attribute words and those of its ancestors. Boosted
trees give each node the odds of holding main text, and a top-down consistent
choice of highest likelihood is decoded: a node can only be main text if its
parent is, so a kept leaf never hangs under a dropped ancestor, and a dropped
subtree stays dropped as a whole. Kept leaves are joined in page order.

Training needs no outside data. On a bounded sample of the pages that have an
``article`` or ``main`` element (``SAMPLE_PAGES``, by a hash of the id) the text
under these elements is main text and the rest is not, nor is what class names
inside them call comments, adverts and the like (``OTHER_WORDS``). Where no page
has text under such an element, the sample is of all pages and every ``p`` text
of it, wherever it stands, serves as main text of made layouts only: a
weaker rule, as notices and comments in ``p`` count too. Each of the pages is also rebuilt in
random layouts, with other elements and attribute words around the same text
and with menus, sidebars, notices, adverts, forms, footers and reader comments
added, so that the trees learn structure beyond one template.

Defined cases: null and empty pages, and pages without main text, give an
empty text and 0 characters; null ids and urls are kept; repeated rows come out
as they came in; broken markup is read as far as it goes; pages of any length
are read whole; without any page to learn from nothing is main text.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm import boosting
from opslog.llm.dom import Page, attribute_words, name_parts

SAMPLE_PAGES = 300
# Longer pages do not train: bounds what the driver collects to some 150 MB.
SAMPLE_PAGE_BYTES = 1 << 19
LAYOUTS = 3
SEED = 3

KINDS = {t: i for i, ts in enumerate((
    "article", "main", "section", "div", "p", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol menu dl dir", "li dd dt", "table tbody thead tfoot tr",
    "td th caption", "nav", "aside", "header", "footer", "form fieldset legend dialog", "blockquote pre", "figure figcaption",
    "address details summary center hr", "html body #root")) for t in ts.split()}
ABOVE = {t: i for i, t in enumerate("article main nav aside header footer form ul table blockquote figure h1 p".split())}
ABOVE_BIT = {t: 1 << i for t, i in ABOVE.items()} | {f"h{k}": 1 << ABOVE["h1"] for k in range(1, 7)}
NUMBERS = 24
WIDTH = NUMBERS + len(set(KINDS.values())) + len(ABOVE)


def node_features(page: Page, words_odds: dict[str, float]) -> np.ndarray:
    """One row of features for every node of a page."""
    n, parent, tag = len(page.tag), page.parent, page.tag
    words, chars, links, leaves, marks, elements, kids = ([0] * n for _ in range(7))
    for i in range(n - 1, 0, -1):
        if tag[i] == "#":
            t = page.text[i]
            words[i], chars[i], links[i], leaves[i] = t.count(" ") + 1, len(t), page.links[i], 1
            marks[i] = t.count(". ") + t.count(",") + t.count("? ") + t.count("! ") + (t[-1] in ".!?\"”")
        else:
            elements[i] += 1
        p = parent[i]
        for c in (words, chars, links, leaves, marks, elements):
            c[p] += c[i]
        kids[p] += 1
    low, high, index = [0.0] * n, [0.0] * n, [0] * n
    above: list[int] = [0] * n
    seen = [0] * n
    left = [0] * n  # words before the node in its parent
    before = [0] * n  # characters before the node in the page
    sums: list[Counter] = [Counter() for _ in range(n)]
    last = [0] * n
    follows = [0] * n
    for i in range(1, n):
        sums[parent[i]][tag[i]] += 1
        if last[parent[i]]:
            follows[last[parent[i]]] = i
        last[parent[i]] = i
    total_chars, total_words = max(1, chars[0]), max(1, words[0])
    rows, kinds, read = [], [], 0
    for i in range(n):
        p = parent[i]
        t = tag[i] if tag[i] != "#" else tag[p]
        a = b = 0.0
        if page.attrs[i]:
            own = [words_odds[w] for w in attribute_words(page.attrs[i]) if w in words_odds]
            if own:
                a, b = min(own), max(own)
        prev = 0
        if i:
            low[i], high[i] = min(low[p], a), max(high[p], b)
            above[i] = above[p] | ABOVE_BIT.get(tag[p], 0)
            index[i] = seen[p]
            seen[p] += 1
            prev, left[p] = left[p], words[i]
            same = sums[p][tag[i]] / kids[p]
            siblings, mean = kids[p], (words[p] - words[i]) / max(1, kids[p] - 1)
        else:
            same, siblings, mean = 1.0, 1, 0.0
        before[i] = read
        if tag[i] == "#":
            read += chars[i]
        w, c = words[i], max(1, chars[i])
        rows.append((tag[i] == "#", page.depth[i], w, links[i] / c, chars[i], c / max(1, w), marks[i] / max(1, w), w / total_words,
                     (before[i] + chars[i] / 2) / total_chars, kids[i], w / max(1, leaves[i]), index[i] / max(1, siblings),
                     siblings, mean, same, prev, words[follows[i]] if follows[i] else 0, w / (1 + elements[i]), a, b, low[i], high[i],
                     "©" in page.text[i][:200] or "©" in page.text[i][-200:], total_words))
        kinds.append(KINDS.get(t, KINDS["div"]))
    x = np.zeros((n, WIDTH), np.float32)
    x[:, :NUMBERS] = rows
    x[np.arange(n), NUMBERS + np.array(kinds)] = 1
    x[:, -len(ABOVE):] = np.array(above)[:, None] >> np.arange(len(ABOVE)) & 1
    return x


@dataclass
class Extractor:
    trees: boosting.Boosted | None
    words: dict[str, float]

    def texts(self, pages: list[Page]) -> list[str]:
        if self.trees is None or not pages:
            return [""] * len(pages)
        xs = [node_features(p, self.words) for p in pages]
        z = self.trees.logit(np.concatenate(xs))
        ends = np.cumsum([len(x) for x in xs])
        return [decode(p, z[e - len(x):e].tolist()) for p, x, e in zip(pages, xs, ends)]


def decode(page: Page, z: list[float]) -> str:
    """Leaves kept by the likeliest labelling in which no kept node has a dropped parent."""
    n, parent = len(z), page.parent
    # gain of keeping a node instead of dropping its whole subtree: its own log odds and its children's gains
    gain = list(z)
    gain[0] = 0.0  # the root itself is no choice
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[parent[i]] += gain[i]
    keep = [False] * n
    keep[0] = True
    out = []
    for i in range(1, n):
        keep[i] = keep[parent[i]] and gain[i] > 0
        if keep[i] and page.tag[i] == "#":
            out.append(page.text[i])
    return "\n\n".join(out)


# Words that page authors put into class, id and role attributes.
MAIN_WORDS = ("article content entry post story body text main page blog news detail prose copy single hentry articlebody "
              "maincontent postcontent entrycontent markdown reader read document container wrapper center column primary").split()
OTHER_WORDS = {
    "menu": "nav menu navbar navigation topnav mainmenu breadcrumb breadcrumbs tabs links toolbar pagination pager",
    "header": "header masthead banner top branding logo sitehead hero topbar",
    "footer": "footer bottom copyright colophon legal siteinfo credits foot",
    "sidebar": "sidebar side widget aside rail secondary related popular trending recommended archive tags",
    "notice": "cookie notice consent alert gdpr popup modal banner warning message overlay privacy announcement paywall",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsense banner commercial partner",
    "form": "form search login newsletter subscribe signup contact register input",
    "comments": "comments comment discussion respond reply replies disqus thread reader feedback responses commentlist",
    "share": "share social sharing follow buttons tools meta byline author print",
}


class Layouts:
    """Random pages around given main text, with labels in ``data-y``."""

    def __init__(self, prose: list[str], seed: int):
        self.r, self.prose = random.Random(seed), prose

    def some(self, low: int, high: int) -> str:
        """A run of words from other pages."""
        words = self.r.choice(self.prose).split()
        n = self.r.randint(low, high)
        at = self.r.randint(0, max(0, len(words) - n))
        return escape(" ".join(words[at:at + n]))

    def attrs(self, words: list[str], chance: float) -> str:
        r = self.r
        if r.random() > chance:
            return ""
        own = r.choice(words)
        more = r.choice(["", "", "-" + r.choice(words), "_" + str(r.randint(1, 9)), " " + r.choice(("clearfix", "row", "col", "inner", "box", "wrap"))])
        return f' {r.choice(("class", "class", "id", "class"))}="{own}{more}"'

    def box(self, kind: str, tags: tuple[str, ...], inner: str, chance: float = 0.9) -> str:
        """A labelled block of other text; it always shows what it is by its element or its words."""
        tag = self.r.choice(tags)
        if tag in ("div", "section", "ul", "p", "li", "ol", "table"):
            chance = 1.0
        return f'<{tag} data-y="0"{self.attrs(OTHER_WORDS[kind].split(), chance)}>{inner}</{tag}>'

    def menu(self) -> str:
        r = self.r
        items = [f'<a href="/{i}">{self.some(1, 3)}</a>' for i in range(r.randint(3, 9))]
        inner = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if r.random() < 0.7 else r.choice((" | ", " ", " &gt; ")).join(items)
        return self.box("menu", ("nav", "div", "ul") if inner[1] != "u" else ("nav", "div"), inner, 0.6)

    def prose_p(self, low: int = 8, high: int = 60) -> str:
        return f"<p>{self.some(low, high)}</p>"

    def header(self) -> str:
        r = self.r
        inner = r.choice((f"<h1>{self.some(1, 4)}</h1>", f"<a href='/'>{self.some(1, 3)}</a>", f"<div>{self.some(1, 5)}</div>"))
        if r.random() < 0.5:
            inner += r.choice((f"<p>{self.some(3, 12)}</p>", self.menu()))
        return self.box("header", ("header", "div"), inner, 0.5)

    def footer(self) -> str:
        r = self.r
        inner = r.choice((f"&copy; {self.some(1, 3)} &middot; {self.some(4, 25)}", f"<p>{self.some(5, 30)}</p>",
                          f"<p>&copy; {r.randint(1999, 2025)} {self.some(2, 8)}</p>{self.menu()}", self.some(3, 30)))
        return self.box("footer", ("footer", "footer", "div"), inner, 0.4)

    def sidebar(self) -> str:
        r = self.r
        parts = [f"<h3>{self.some(1, 4)}</h3>"] * (r.random() < 0.6)
        parts += [self.prose_p(5, 50) for _ in range(r.randint(0, 3))]
        if r.random() < 0.6 or not parts:
            parts.append("<ul>" + "".join(f'<li><a href="#">{self.some(2, 9)}</a></li>' for _ in range(r.randint(2, 8))) + "</ul>")
        return self.box("sidebar", ("aside", "aside", "div", "section"), "".join(parts), 0.5)

    def notice(self) -> str:
        inner = self.r.choice((self.some(6, 40), self.prose_p(6, 40), self.prose_p(6, 30) + "<button>OK</button>"))
        return self.box("notice", ("div", "div", "section", "aside", "dialog", "p"), inner)

    def advert(self) -> str:
        inner = self.r.choice((self.some(3, 30), self.prose_p(3, 30), f'<a href="#">{self.some(3, 15)}</a>'))
        return self.box("advert", ("div", "div", "aside", "section", "p"), inner)

    def form(self) -> str:
        inner = f"<label>{self.some(1, 4)}</label><input name=q>" + self.r.choice(("", self.prose_p(4, 25), f"<button>{self.some(1, 2)}</button>"))
        if self.r.random() < 0.7:
            return f'<form data-y="0" action="/x"{self.attrs(OTHER_WORDS["form"].split(), 0.5)}>{inner}</form>'
        return self.box("form", ("div", "section"), f"<form>{inner}</form>")

    def comments(self) -> str:
        r = self.r
        own = OTHER_WORDS["comments"].split()
        each = [f'<{(t := r.choice(("div", "li", "article", "p")))}{self.attrs(own, 0.7)}>' + r.choice(("", f"<b>{self.some(1, 2)}</b> "))
                + (self.prose_p(5, 80) if t != "p" and r.random() < 0.7 else self.some(5, 80)) + f"</{t}>" for _ in range(r.randint(1, 6))]
        title = r.choice(("", f"<h2>{self.some(1, 3)}</h2>", f"<h3>{self.some(1, 3)}</h3>"))
        return self.box("comments", ("div", "section", "section", "ol", "ul"), title + "".join(each))

    def share(self) -> str:
        return self.box("share", ("div", "ul", "p"), " ".join(f'<a href="#">{self.some(1, 2)}</a>' for _ in range(self.r.randint(2, 5))))

    def main(self, blocks: list[tuple[str, str]]) -> str:
        r = self.r
        out = []
        for k, (tag, text) in enumerate(blocks):
            text = escape(text)
            if r.random() < 0.1:
                words = text.split(" ")
                text = f'<{r.choice(("b", "em", "span", "i"))}>{words[0]}</a> ' + " ".join(words[1:])
            if r.random() < 0.08:
                text += f' <a href="#">{self.some(1, 3)}</a>'
            kind = r.random()
            if tag.startswith("h") or kind > 0.14:
                out.append(f"<{tag}>{text}</{tag}>")
            elif kind < 0.04:
                cut = text.split(". ")
                out.append("<ul>" + "".join(f"<li>{c}</li>" for c in cut) + "</ul>")
            elif kind < 0.07:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.11:
                out.append(f"<h{r.randint(2, 4)}>{self.some(1, 8)}</h3><p>{text}</p>")
            else:
                out.append(f"<div>{text}</div>")
            if k and r.random() < 0.12:
                out.append(r.choice((self.advert, self.share, self.sidebar, self.notice, self.form))())
        inner = "".join(out)
        if r.random() < 0.35:
            inner = f"<div{self.attrs(MAIN_WORDS, 0.5)}>{inner}</div>"
        if r.random() < 0.3:
            inner += r.choice((self.comments, self.share, self.sidebar))()
        tag = r.choice(("article", "article", "main", "div", "div", "section"))
        return f'<{tag} data-y="1"{self.attrs(MAIN_WORDS, 0.6)}>{inner}</{tag}>'

    def page(self, blocks: list[tuple[str, str]]) -> str:
        r = self.r
        if r.random() < 0.1:  # a bare page: nothing but its text
            return "<body>" + "".join(f"<{tag}>{escape(text)}</{tag}>" for tag, text in blocks) + "</body>"
        before = [f() for f in (self.header, self.menu, self.notice, self.advert, self.form, self.sidebar) if r.random() < 0.5]
        after = [f() for f in (self.comments, self.sidebar, self.advert, self.form, self.share, self.menu, self.notice) if r.random() < 0.45]
        r.shuffle(before)
        r.shuffle(after)
        body = "".join(before) + self.main(blocks) + "".join(after)
        for _ in range(r.randint(0, 2)):
            body = f'<div{self.attrs(["page", "container", "wrapper", "site", "layout", "root", "app", "outer"], 0.7)}>{body}</div>'
        if r.random() < 0.8:
            body += self.footer()
        return f"<html><head><title>x</title></head><body>{body}</body></html>"


# Words of an element inside an article that name it as something else; those for headers may be the article's own.
_NAMED = {w for kind, ws in OTHER_WORDS.items() if kind != "header" for w in ws.split()} - set(MAIN_WORDS)


def names_other(attrs: str) -> bool:
    """Whether a class, id or role begins or ends with a word for other text ("has-sidebar" is a remark, no name)."""
    for part in name_parts(attrs):
        if not {"has", "with", "no", "without"} & set(part) and {part[0], part[-1], "".join(part)} & _NAMED:
            return True
    return False


def _labels(page: Page, semantic: bool) -> np.ndarray:
    """1 for nodes whose subtree holds main text; by data-y marks, or by article and main elements."""
    y = np.zeros(len(page.tag), np.int8)
    bare = not semantic and not any("data-y" in a for a in page.attrs)
    state = [int(bare)] * len(page.tag)
    named = [False] * len(page.tag)
    for i in range(1, len(page.tag)):
        state[i] = state[page.parent[i]]
        attrs = page.attrs[i]
        if semantic:
            named[i] = named[page.parent[i]] or bool(state[i] and attrs and names_other(attrs))
            if named[i]:
                state[i] = 0
            elif page.tag[i] in ("article", "main"):
                state[i] = 1
            elif page.tag[i] in ("nav", "aside", "footer", "form"):
                state[i] = 0
        elif "data-y" in attrs:
            state[i] = int('data-y="1"' in attrs)
        y[i] = page.tag[i] == "#" and state[i]
    for i in range(len(y) - 1, 0, -1):
        y[page.parent[i]] |= y[i]
    return y


def fit(htmls: list[str], layouts: int = LAYOUTS, seed: int = SEED) -> Extractor:
    """Train on a list of pages."""
    pages = [p for p in map(Page, htmls) if len(p.tag) > 1]
    marked = [(p, _labels(p, True)) for p in pages]
    marked = [(p, y) for p, y in marked if y.any()]
    main = [[("p" if p.tag[p.parent[i]] != "h1" else "h1", p.text[i]) for i in range(len(y)) if y[i] and p.tag[i] == "#"] for p, y in marked]
    if not main:  # no page says where its text is: learn from the paragraphs there are
        main = [b for p in pages if (b := [("p", p.text[i]) for i in range(len(p.tag)) if p.tag[p.parent[i]] == "p" and p.tag[i] == "#"])]
    if not main:
        return Extractor(None, {})
    prose = [t for b in main for _, t in b]
    made = Layouts(prose, seed)
    rows = list(marked)
    for blocks in main * layouts:
        k = made.r.randint(1, len(blocks))
        at = made.r.randint(0, len(blocks) - k) if made.r.random() < 0.5 else 0
        p = Page(made.page(blocks[at:at + k]))
        rows.append((p, _labels(p, False)))
    # odds of main text by attribute word, each counted once a page
    seen: dict[str, list[float]] = {}
    for p, y in rows:
        for i, a in enumerate(p.attrs):
            for w in set(attribute_words(a)) if a else ():
                seen.setdefault(w, [0, 0])[int(y[i])] += 1
    words = {w: float(np.log((a[1] + 0.5) / (a[0] + 0.5))) for w, a in seen.items() if sum(a) >= 3}
    x = np.concatenate([node_features(p, words) for p, _ in rows])
    y = np.concatenate([y for _, y in rows])
    weight = np.concatenate([np.full(len(y), 20 / len(y)) + 0.3 for _, y in rows])
    return Extractor(boosting.fit(x, y.astype(np.float64), weight), words)


def _draw(src: DataFrame, sample_pages: int) -> list[str]:
    """At most ``sample_pages`` texts of at most ``SAMPLE_PAGE_BYTES``, those with the smallest hash."""
    src = src.where(F.octet_length("t") <= SAMPLE_PAGE_BYTES)
    # a hash threshold first, at about twice the sample, so that tasks do not each send a sample of their own
    span, n = 1 << 30, max(1, src.count())
    rows = (src.where(F.pmod("h", F.lit(span)) < min(span, 2 * span * sample_pages // n))
            .orderBy(F.pmod("h", F.lit(span)), "h", F.xxhash64("t")).limit(sample_pages).collect())
    return [r["t"] for r in rows]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Extractor:
    """Fit on at most ``sample_pages`` pages with an ``article`` or ``main``; on any pages where none has text in one."""
    src = pages.select(F.xxhash64(id_col).alias("h"), F.col(html_col).cast("string").alias("t")).where(F.col("t").isNotNull())
    htmls = _draw(src.where(F.col("t").rlike(r"(?i)<(?:article|main)[\s/>]")), sample_pages)
    if not any(_labels(Page(t), True).any() for t in htmls):
        htmls = _draw(src, sample_pages)
    return fit(htmls)


def extract(pages: DataFrame, model: Extractor, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                texts = shared.value.texts([Page(t.as_py()) for t in b.column(2)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
