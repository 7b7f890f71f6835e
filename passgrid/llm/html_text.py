"""Main text of pages by a tree-structured graphical model.

Each element of a page is content or not. An element's features give its own potential; a 2 x 2 table for the kind of
element ties it to its parent. Sum-product passes messages upward and downward once each and yields exact marginals;
text goes with the element that holds it. The model is trained on labelled pages by the likelihood of their labels,
with the marginals' help.

Labels come from pages that mark their main text up themselves (``article`` or ``main``), a bounded sample of the pages
given, drawn from all that do so. Each is also used in disguise, with the telling elements renamed and with the usual surroundings of other sites
added, so that the model learns how content looks where nothing says so.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from math import exp, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.llm.columns import quoted, without
from passgrid.llm.dom import INLINE, Page, blocks, read_page

SAMPLE_PAGES = 120
SAMPLE_CHARS = 6_000_000
TURNS = 12

# ---- Fixed values: names that sites give to parts of a page --------------------------------------------------------
CLUTTER = {
    "menu": "nav navbar navigation menu topbar breadcrumb breadcrumbs pagination pager toolbar tabs skip",
    "head": "header masthead banner logo branding hero",
    "foot": "footer foot copyright legal colophon",
    "side": "sidebar side aside rail widget related recommended recommendations popular trending tags teaser more",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe subscription signup paywall",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion",
    "form": "form search login register contact field input",
    "talk": "comment comments reply replies discussion respond disqus thread review reviews",
    "share": "share sharing social follow tweet byline author meta",
}
MAIN = frozenset("article main content post entry story body text page prose".split())
_KIND = {word: kind for kind, words in CLUTTER.items() for word in words.split()}
_NAME = re.compile(r"[a-z]+")
_PARTS = frozenset("nav header footer aside form button select dialog menu label option fieldset legend input".split())
_TYPES = {"article": "main", "main": "main", "nav": "part", "header": "part", "footer": "part", "aside": "part",
          "form": "part", "button": "part", "select": "part", "dialog": "part", "menu": "part"}


def _level(x: float, steps: tuple) -> int:
    return sum(x >= s for s in steps)


_SIZES = (1, 10, 25, 60, 150, 400, 1000)
_SHARES = (0.01, 0.1, 0.3, 0.5, 0.8)


def features(page: Page) -> list[list[str]]:
    """Indicator features of every element."""
    elements = page.elements
    total = max(1, elements[0].text)
    out = []
    kinds_of: list[frozenset] = []
    for e in elements:
        named = {_KIND.get(w) for w in _NAME.findall(e.names)} - {None} if e.names else set()
        main = bool(e.names) and bool(MAIN.intersection(_NAME.findall(e.names)))
        if main and named - {"share"}:
            main = False
        parent = elements[e.parent].tag if e.parent >= 0 else "-"
        own = [f"tag={e.tag}", f"tag={e.tag} in {parent}"]
        own += [f"named {k}" for k in named]
        if named:
            own.append("named as clutter")
        if main:
            own.append("named as main")
        if e.tag in _PARTS:
            own.append("part")
        if e.hidden:
            own.append("hidden")
        if e.text:
            links = e.linked / e.text
            own.append(f"links={_level(links, (0.05, 0.2, 0.5, 0.9))}")
            own.append(f"size={_level(e.text, _SIZES)}")
            own.append(f"own={_level(e.own_text, _SIZES)}")
            own.append(f"stops={_level(e.stops / (e.words or 1), (0.02, 0.06, 0.12, 0.3))}")
            own.append(f"share={_level(e.text / total, _SHARES)}")
            if e.children:
                own.append(f"spread={_level(e.text / e.children, _SIZES)}")
        else:
            own.append("empty")
        kinds_of.append(frozenset(named))
        out.append(own)
    return out


def edge_kind(tag: str) -> str:
    return "inline" if tag in INLINE else _TYPES.get(tag, "block")


class TreeModel:
    """Weights of features, and for each kind of element a 2 x 2 table of parent and child."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.edges: dict[str, list[list[float]]] = {
            k: [[1.0, 0.0], [0.0, 1.0]] for k in ("inline", "main", "part", "block")
        }

    def potentials(self, found: list[list[str]]) -> list[float]:
        """Log-odds of content by features alone."""
        get = self.weights.get
        return [sum([get(f, 0.0) for f in own]) for own in found]

    def marginals(self, page: Page, odds: list[float], pairs: list | None = None) -> list[float]:
        """Probability of content of each element; ``pairs`` gets the joint table of each element and its parent."""
        elements = page.elements
        tables = {k: [[exp(x) for x in row] for row in t] for k, t in self.edges.items()}
        n = len(elements)
        up = [(1.0, exp(max(-30.0, min(30.0, o)))) for o in odds]
        sent: list = [None] * n
        for i in range(n - 1, 0, -1):
            e = elements[i]
            t = tables[edge_kind(e.tag)]
            a, b = up[i]
            m0, m1 = t[0][0] * a + t[0][1] * b, t[1][0] * a + t[1][1] * b
            s = m0 + m1
            sent[i] = (m0 / s, m1 / s)
            a, b = up[e.parent]
            a, b = a * m0 / s, b * m1 / s
            s = a + b
            up[e.parent] = (a / s, b / s)
        whole: list = [None] * n
        a, b = up[0]
        whole[0] = (a / (a + b), b / (a + b))
        for i in range(1, n):
            e = elements[i]
            t = tables[edge_kind(e.tag)]
            p0, p1 = whole[e.parent]
            # What the parent knows without this child.
            p0, p1 = p0 / max(sent[i][0], 1e-300), p1 / max(sent[i][1], 1e-300)
            a, b = up[i]
            joint = (p0 * t[0][0] * a, p0 * t[0][1] * b, p1 * t[1][0] * a, p1 * t[1][1] * b)
            s = sum(joint) or 1.0
            if pairs is not None:
                pairs.append((edge_kind(e.tag), [j / s for j in joint], i))
            whole[i] = ((joint[0] + joint[2]) / s, (joint[1] + joint[3]) / s)
        return [w[1] for w in whole]

    def fit(self, labelled: list[tuple[Page, list[bool]]], *, turns: int = TURNS, l2: float = 1e-4) -> TreeModel:
        """Gradient steps on the likelihood, page by page; steps shrink as a weight's gradients add up."""
        work = [(page, features(page), gold) for page, gold in labelled]
        seen: dict[str, float] = {}
        seen_edges = {k: [[1.0, 1.0], [1.0, 1.0]] for k in self.edges}
        for _ in range(turns):
            for page, found, gold in work:
                pairs: list = []
                chance = self.marginals(page, self.potentials(found), pairs)
                scale = 1 / log1p(len(gold))
                slope: dict[str, float] = {}
                for own, p, y in zip(found, chance, gold):
                    for f in own:
                        slope[f] = slope.get(f, 0.0) + (y - p) * scale
                for f, g in slope.items():
                    g -= l2 * self.weights.get(f, 0.0)
                    seen[f] = seen.get(f, 0.1) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + 0.5 * g / seen[f] ** 0.5
                turn = {k: [[0.0, 0.0], [0.0, 0.0]] for k in self.edges}
                for kind, joint, i in pairs:
                    p, c = gold[page.elements[i].parent], gold[i]
                    for a in (0, 1):
                        for b in (0, 1):
                            turn[kind][a][b] += ((a == p and b == c) - joint[2 * a + b]) * scale
                for kind, table in turn.items():
                    for a in (0, 1):
                        for b in (0, 1):
                            g = table[a][b]
                            seen_edges[kind][a][b] += g * g
                            self.edges[kind][a][b] += 0.5 * g / seen_edges[kind][a][b] ** 0.5
        return self

    def extract(self, html: str) -> str:
        page = read_page(html)
        chance = self.marginals(page, self.potentials(features(page)))
        return blocks(page, [c >= 0.5 for c in chance])


def own_labels(page: Page) -> list[bool] | None:
    """Labels of a page that marks its main text up; None for others."""
    inside = [False] * len(page.elements)
    for i, e in enumerate(page.elements):
        if i == 0:
            continue
        kinds = {_KIND.get(w) for w in _NAME.findall(e.names)} - {None}
        start = e.tag in ("article", "main") or "kept-main" in e.names
        inside[i] = (inside[e.parent] or start) and e.tag not in _PARTS and not kinds and not e.hidden
    return inside if any(inside) else None


_SURROUNDINGS = [
    '<header class="site-header"><div class="logo"><a href="/">{a}</a></div><p>{b}</p></header>',
    '<div class="cookie-notice"><p>{c}</p><button>{a}</button></div>',
    '<div id="sidebar"><h3>{a}</h3><ul><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul></div>',
    '<aside><h2>{a}</h2><p>{c}</p><p>{d}</p></aside>',
    '<div class="menu"><a href="#">{a}</a> <a href="#">{b}</a> <a href="#">{a}</a></div>',
    '<form action="/s"><label>{a}</label><input name="q"><button>{b}</button></form>',
    '<section class="comments"><h3>{a}</h3><div class="comment"><p>{d}</p></div><div class="comment"><p>{c}</p></div></section>',
    '<div class="advert"><p>{c}</p></div>',
    '<div class="related-posts"><h4>{a}</h4><a href="#">{b}</a><a href="#">{c}</a></div>',
    '<ul class="breadcrumb"><li><a href="#">{a}</a></li><li>{b}</li></ul>',
    '<div class="share"><a href="#">{a}</a><a href="#">{b}</a></div>',
    '<div role="banner"><p>{b}</p></div>',
    '<div class="newsletter"><p>{c}</p><form><input name="e"><button>{a}</button></form></div>',
    '<footer><p>&copy; {a}</p><ul><li><a href="#">{b}</a></li></ul></footer>',
    '<div id="footer"><p>{c}</p></div>',
]
_INSIDE = [3, 6, 7, 8, 10, 12]


def disguised(html: str, rng: random.Random) -> str:
    """The page with its marks renamed and other sites' surroundings around and inside its main text."""
    words = re.findall(r"\w{2,}", re.sub(r"<[^>]*>", " ", html))[:300] or ["text"]

    def some(low: int, high: int) -> str:
        picked = " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))
        return picked.capitalize() + rng.choice(["", ".", "."])

    def clutter(which: str) -> str:
        return which.format(a=some(1, 2), b=some(1, 5), c=some(4, 18), d=some(8, 40))

    mark = rng.choice(['div class="kept-main"', 'div class="kept-main content"', 'div class="kept-main post"',
                       'main class="kept-main"', 'article class="kept-main"', 'section class="kept-main"'])
    name = mark.split()[0]
    html = re.sub(r"<(article|main)\b[^>]*>", f"<{mark}>", html)
    html = re.sub(r"</(article|main)>", f"</{name}>", html)
    if rng.random() < 0.5:
        html = html.replace("<nav>", '<div class="nav">').replace("</nav>", "</div>")
    if rng.random() < 0.5:
        html = html.replace("<footer>", '<div class="footer">').replace("</footer>", "</div>")
    parts = re.split(rf"(<{re.escape(mark)}>|</{name}>)", html)
    if len(parts) < 5:
        return html
    before = "".join(clutter(rng.choice(_SURROUNDINGS)) for _ in range(rng.randint(0, 3)))
    after = "".join(clutter(rng.choice(_SURROUNDINGS)) for _ in range(rng.randint(0, 3)))
    body = parts[2]
    for _ in range(rng.randint(0, 2)):
        cuts = [m.end() for m in re.finditer("</p>", body)]
        if cuts:
            cut = rng.choice(cuts)
            body = body[:cut] + clutter(_SURROUNDINGS[rng.choice(_INSIDE)]) + body[cut:]
    extras = [
        f"<h2>{some(2, 6)}</h2>", f"<ul><li>{some(4, 12)}</li><li>{some(4, 12)}</li></ul>",
        f"<blockquote><p>{some(8, 30)}</p></blockquote>", f"<p>{some(5, 20)} <a href='#'>{some(1, 3)}</a> {some(5, 20)}</p>",
        f"<table><tr><td>{some(1, 4)}</td><td>{some(1, 4)}</td></tr></table>", f"<div><p>{some(10, 40)}</p></div>",
        f"<p>{some(1, 3)}</p>", f"<pre>{some(4, 12)}</pre>", f"<figure><figcaption>{some(3, 9)}</figcaption></figure>",
    ]
    for extra in rng.sample(extras, rng.randint(0, 4)):
        cuts = [m.end() for m in re.finditer("</p>", body)]
        if cuts:
            cut = rng.choice(cuts)
            body = body[:cut] + extra + body[cut:]
    return "".join([parts[0], before, parts[1], body, parts[3], after, *parts[4:]])


def _blind(page: Page) -> Page:
    """The page without the mark that only labels it."""
    for e in page.elements:
        e.names = e.names.replace("kept-main", "").strip()
    return page


def fit_pages(pages: DataFrame, *, html_col: str = "html", id_col: str = "page_id", sample: int = SAMPLE_PAGES) -> TreeModel:
    """A model from ``sample`` of the pages with marks, the first by a hash of id and page, copies once.

    They may have ``SAMPLE_CHARS`` characters in all: a page longer than what is left is passed over, and if all are
    longer, the shortest of them is taken. Only where no page has usable marks, a built-in one stands in.
    """
    html = quoted(html_col).cast("string")
    keyed = pages.select(
        html.alias("html"), F.xxhash64(quoted(id_col).cast("string"), F.crc32(html.cast("binary"))).alias("h")
    )
    # Hashes and lengths are ordered first; only pages that are taken leave their tasks.
    marked = keyed.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    first = marked.groupBy("h").agg(F.max(F.length("html")).alias("n")).orderBy("h").limit(sample).collect()
    left, taken = SAMPLE_CHARS, []
    for row in first:
        if row["n"] <= left:
            taken.append(row["h"])
            left -= row["n"]
    if first and not taken:
        taken = [min(first, key=lambda row: row["n"])["h"]]
    chosen = keyed.filter(F.col("h").isin(taken)).dropDuplicates(["h"]).orderBy("h").collect() if taken else []
    rng = random.Random(9)
    labelled: list[tuple[Page, list[bool]]] = []
    for original in [*(row["html"] for row in chosen), _PLAIN]:
        if original is _PLAIN and labelled:
            break
        for html in (original, disguised(original, rng), disguised(original, rng)):
            page = read_page(html)
            gold = own_labels(page)
            if gold is not None:
                labelled.append((_blind(page), gold))
    rng.shuffle(labelled)
    return TreeModel().fit(labelled)


# Stands in for labelled pages where there are none.
_PLAIN = (
    "<html><body><nav><ul><li><a href='#'>Home</a></li><li><a href='#'>News</a></li></ul></nav><article><h1>A title of some "
    "words</h1><p>A paragraph of some length, with a comma and a stop. And one more sentence, to make it longer.</p><p>"
    "Another paragraph, as long as the first one, and with as many commas, that ends here.</p></article><footer>A footer"
    "</footer></body></html>"
)


def _extract(html: str, keep: list[str], shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [model.extract(value.as_py() or "") for value in batch.column(html)]
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *columns], [*keep, "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, model: TreeModel, *, html_col: str = "html") -> DataFrame:
    """The pages with ``text`` and ``n_chars`` (code points); columns of those names are replaced.

    Null and empty pages give an empty text, as do pages without content. Text outside any element belongs to the page
    itself. Broken markup is read as browsers mostly do. Equal pages give equal texts. Whole pages are read.
    """
    if html_col.lower() in ("text", "n_chars"):
        raise ValueError(f"the page's column must not be called {html_col}")
    kept = pages.select(*without(pages, ["text", "n_chars"]))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([
        *kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())
    ])
    return kept.mapInArrow(_extract(html_col, kept.columns, shared), schema)
