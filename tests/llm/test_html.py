import math
import random

import pytest

from passgrid.llm import html_text
from passgrid.llm.dom import Element, Page, blocks, read_page
from passgrid.llm.html_text import TreeModel, disguised, edge_kind, extract_text, fit_pages

LINES = ["The title of it", "A first paragraph, of some words. It goes on & on, as they do, with more to say.",
         "Another one, which is a bit longer than the first; it has commas, stops, and an end. Then a second sentence.",
         "Short end."]


def page(before="", after="", mark=("article", "article"), lines=LINES):
    body = "".join(f"<p>{x.replace('&', '&amp;')}</p>" for x in lines[1:])
    return (
        "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><!-- no -->"
        f"{before}<{mark[0]}><h1>{lines[0]}</h1>{body}</{mark[1]}>{after}<footer>&copy; site</footer></body></html>"
    )


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    words = "la ra ti no ve mi so du ke pa lor men tal ris".split()

    def line(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))

    rows = [(i, f"http://h/{i}", page(lines=[line(5), *[line(rng.randint(4, 60)) for _ in range(rng.randint(1, 8))]]))
            for i in range(60)]
    return fit_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"))


def test_main_text_without_the_rest(model):
    want = "\n".join(LINES)
    assert model.extract(page()) == want
    clutter = [
        "<aside><h3>Related</h3><p>Read this too</p></aside>", "<div class='sidebar'><a href='#'>one</a> <a href='#'>two</a></div>",
        "<div class='cookie-banner'><p>We use cookies, you know.</p><button>OK</button></div>",
        "<form><label>Name</label><input><button>Send</button></form>", "<div class='ad'>Buy it now, it is cheap.</div>",
        "<section id='comments'><h3>Comments</h3><div class='comment'><p>I think so, too, and more.</p></div></section>",
    ]
    for x in clutter:
        assert model.extract(page(before=x)) == want, x
        assert model.extract(page(after=x)) == want, x
    for mark in ("div class='content'", "main", "div id='main-content'", "section class='post'"):
        assert model.extract(page(mark=(mark, mark.split()[0]))) == want, mark


def test_disguises_keep_the_text_findable():
    rng = random.Random(2)
    for _ in range(20):
        html = disguised(page(), rng)
        assert "kept-main" in html and all(x.replace("&", "&amp;") in html for x in LINES)


def test_reading():
    got = read_page("<p>a<p>b &lt;c&gt;<br>d <b>e</b>f<ul><li>g<li>h</ul><script>x<y</script>i<textarea>no</textarea>"
                    "<div>j<!-- k --> \n l</div></p>m<img src='>'>n <td>o&nbsp;p&#233;")
    assert blocks(got, [True] * len(got.elements)) == "a\nb <c>\nd ef\ng\nh\ni\nj l\nmn\no pé"
    assert blocks(read_page(""), [True]) == ""
    for broken in ("<", "<p", "<!-- x", "</p></div>", "<script>", "a < b > c", "<p class=>x", "<div " + "a" * 50):
        read_page(broken)
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert blocks(read_page(deep), [True] * 5001) == "x"


def test_marginals_against_all_labellings():
    rng = random.Random(4)
    tags = ["#page", "div", "p", "b", "article", "nav", "li"]
    for _ in range(5):
        elements = [Element("#page", -1)] + [Element(rng.choice(tags[1:]), rng.randrange(i)) for i in range(1, 7)]
        tree = Page(elements)
        model = TreeModel()
        model.edges = {k: [[rng.uniform(-2, 2) for _ in "ab"] for _ in "ab"] for k in model.edges}
        odds = [rng.uniform(-2, 2) for _ in elements]
        total, marks = 0.0, [0.0] * 7
        for labels in range(1 << 7):
            y = [labels >> i & 1 for i in range(7)]
            score = sum(o * v for o, v in zip(odds, y))
            score += sum(model.edges[edge_kind(e.tag)][y[e.parent]][y[i]] for i, e in enumerate(elements) if i)
            total += math.exp(score)
            for i, v in enumerate(y):
                marks[i] += v * math.exp(score)
        assert model.marginals(tree, odds) == pytest.approx([m / total for m in marks])


def test_odd_tables(spark, model):
    schema = "page_id bigint, url string, html string, n_chars string, extra int"
    assert extract_text(spark.createDataFrame([], schema), model).count() == 0
    long = page(lines=[LINES[0], *[LINES[2]] * 20_000])
    rows = [(1, "u", page(), "x", 1)] * 2 + [(None, None, None, None, None), (2, "u", "", "x", 1), (3, "u", long, "x", 1)]
    got = extract_text(spark.createDataFrame(rows, schema), model)
    assert got.columns == ["page_id", "url", "html", "extra", "text", "n_chars"]
    by_id = {r["page_id"]: r for r in got.collect()}
    assert by_id[1]["text"] == "\n".join(LINES) and by_id[None]["text"] == "" == by_id[2]["text"]
    assert by_id[3]["n_chars"] == len("\n".join([LINES[0], *[LINES[2]] * 20_000]))
    empty = fit_pages(spark.createDataFrame([], "page_id bigint, html string"))
    assert "first paragraph" in empty.extract(page())


@pytest.mark.parametrize("markup, want", [
    ("<header><svg class='i'/></header><p>a</p><svg><text>x</text></svg><p>b</p>", "a\nb"),
    ("<header><svg class='i'><path d=''></header><p>a</p>", "a"),
    ("<p>a</p><svg><svg><text>x</text></svg><title/><text>y</text></svg><p>b</p>", "a\nb"),
    ("<object data='f'><p>a</p><object data='g'>x<object>y</object>z</object><p>b</p>", "a\nb"),
    ("<title-bar>a</title-bar><p>b</p><object-viewer>c</object-viewer><svg-icon>d</svg-icon>", "a\nb\nc\nd"),
    ("<noscript><iframe src='x'></noscript><p>a</p><noscript><p>b</p>", "a\nb"),
    ("<template><p>x</p><!-- </template> --><template>y</template>z</template><p>a</p>", "a"),
    ("<script>var s = '<svg>';</script><p>a</p><svg data-x='/>'><text>x</text></svg><p>b</p><script>'</svg>'</script><p>c", "a\nb\nc"),
    ("<style media='x'>p{}</style ><title>t</title\n><p>a</p><textarea>no</textarea x><p>b", "a\nb"),
])
def test_unseen_elements_hide_no_more_than_themselves(markup, want):
    got = read_page(markup)
    assert blocks(got, [True] * len(got.elements)) == want


def learned_from(monkeypatch, spark, rows):
    seen = []
    monkeypatch.setattr(html_text, "disguised", lambda html, rng: seen.append(html) or html)
    fit_pages(spark.createDataFrame(rows, "page_id bigint, html string"))
    assert seen[::2] == seen[1::2]
    return seen[::2]


def test_all_marked_pages_can_be_learned_from(spark, monkeypatch):
    plain = [(i, f"<div><p>page {i}</p></div>") for i in range(3000)]
    long = page(lines=[LINES[0], *[LINES[2]] * 300])
    few = [(5000 + i, page(before=f"<p>{i}</p>")) for i in range(10)] + [(6000, long)] * 3
    got = learned_from(monkeypatch, spark, plain + few)
    assert len(long) > 20_000 and sorted(got) == sorted({html for _, html in few})
    many = [(7000 + i, page(before=f"<p>{i}</p>")) for i in range(400)]
    assert len(set(learned_from(monkeypatch, spark, plain + many))) == html_text.SAMPLE_PAGES


def test_sample_is_bounded_by_characters(spark, monkeypatch):
    rows = [(i, page(before=f"<p>{i}</p>")) for i in range(9)] + [(50, page(lines=[LINES[0], *[LINES[2]] * 30]))]
    monkeypatch.setattr(html_text, "SAMPLE_CHARS", len(rows[0][1]) * 3)
    assert len(learned_from(monkeypatch, spark, rows)) == 3
    assert learned_from(monkeypatch, spark, rows[-1:]) == [rows[-1][1]]
    hidden = [(1, "<article hidden><p>a</p></article>")]
    assert learned_from(monkeypatch, spark, hidden) == [hidden[0][1], html_text._PLAIN]


def plain_text(html):
    from passgrid.llm.dom import read_page

    return " ".join("".join(" " if t is None else t for _, t in read_page(html).pieces).split())


def test_quotes_open_values_after_an_equals_sign_only():
    html = "<div><p don't>Hello world</p><p>More text.</p><p>It's here</p></div>"
    assert plain_text(html) == "Hello world More text. It's here"
    assert plain_text("<p title=\"a > b\" x='c>d' y=e\"f>one</p><p a= 'x>y'>two</p>") == "one two"
    assert plain_text("<p class=\"x>Hello</p><p>there</p>") == "Hello there"
    assert plain_text("5 < 6 and <3 <p>a</p") == "5 < 6 and <3 a</p"
    assert plain_text("<p>a<!-- <b> --></p><!-- never ends <p>b") == "a"


@pytest.mark.parametrize("piece", ["<a x", "<a x='>'", "<a x=\"", "<svg x", "<svg x=\"'>", "<!", "</", "<p =", "<object '\"=", "<a b="])
def test_long_odd_pages_are_read_forward_only(piece):
    import time

    begin = time.perf_counter()
    for html in (piece * (1_000_000 // len(piece)), piece * (500_000 // len(piece)) + ">" + "<svg>x</svg>"):
        plain_text(html)
    assert time.perf_counter() - begin < 10
