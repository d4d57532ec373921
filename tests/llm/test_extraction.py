import math
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telar.llm.extraction import extract, extracted

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var a="</p>";</script></head><body class="single">
<header class="site-header"><h2>Brand news of today, and more.</h2></header><nav><ul><li><a href=/x>Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies, a lot of them.</div><main><article><header><h1>Title &amp; more</h1></header><p>First   <b>bold</b> text, with
a break<br>here.<p>Second &lt;tag&gt; &eacute; paragraph, unclosed<ul><li>one<li>two</ul><aside class="related">Related stories here, read on.</aside></article>
<section id="comments"><p>A reader says: this is a long comment, with marks, and so on.</p></section></main>
<form><label>Search</label><input></form><footer>&copy; all</footer></body></html>"""


def test_page():
    assert extract(PAGE) == "Title & more\nFirst bold text, with a break here.\nSecond <tag> é paragraph, unclosed\none\ntwo"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain text, no markup", "plain text, no markup"), ("<p>a<p>b", "a\nb"), ("<div>x &amp y</div>", "x & y"), ("<script>only", ""), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<article><p><b>open bold<br></article><footer>foot</footer>", "open bold"), ("</p></div>text", "text"), ("<p title='a>b'>t</p>", "t"), ("<p>a  b</p>", "a b"),
    ],
)
def test_cases(html, text):
    assert extract(html) == text


def test_ratios_without_article():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(30))
    body = "".join(f"<p>Sentence number {i}, which is long enough to count; it has marks, too.</p>" for i in range(8))
    got = extract(f"<body><div class=x><ul>{links}</ul></div><div class=y>{body}</div></body>")
    assert "Link" not in got
    assert got.count("\n") == 7


TEXT = "A sentence of some length, with marks; it goes on and on, and then ends. " * 4
DATA = "<table><tbody><tr><th>Year</th><td>12</td></tr><tr><th>Sum</th><td><b>7</b> kg</td></tr></tbody></table><ul><li>first<ul><li>in one</li><li><a href=/y>in two</a></li></ul></li><li>last</li></ul>"
CELLS = ["Year", "12", "Sum", "7 kg", "first", "in one", "in two", "last"]
LINKS = "<div class=x><ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(20)) + "</ul></div>"


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><div><article>{}</article></div></main>", "<div role=main>{}</div>", "<div class=y>{}</div>", "<div class=y><div>{}</div></div>", "{}"])
def test_tables_and_nested_lists(around):
    """Nothing beneath the content subtree is lost for being short or deep; link lists beside it stay out."""
    got = extract(f"<body>{LINKS}{around.format(f'<h1>Title</h1><p>{TEXT}</p>{DATA}<p>{TEXT}</p>')}<footer>foot</footer></body>")
    assert got.split("\n") == ["Title", TEXT.strip(), *CELLS, TEXT.strip()]


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'>{}</div>", "<div id='page' class='no-sidebar'>{}</div>", "<article class='post comments-open'>{}</article>", "<div class='sidebar-left'><main>{}</main></div>", "<div class='page sidebar-right'><article>{}</article></div>",
        "<div id='page' class='sidebar-left'><div class=entry>{}</div></div>", "<form id=all><div>{}</div></form>", "<form id=all><main class=search-page>{}</main></form>", "<div class='sidebar-left'><article class='search-result'>{}</article><div id=comments><article class=comment>%s</article></div></div>" % TEXT,
    ],
)
def test_noisy_wrappers(page):
    """A wrapper whose name holds a word of noise does not take the text with it; real noise stays out."""
    rest = f"<div class='cookie-notice'>{TEXT}</div><nav>Menu</nav><div class='sidebar widget-area'>Archive</div>"
    assert extract(f"<body>{page.format(f'<h1>Title</h1><p>{TEXT}</p>' + '<div class=share>Share it</div>')}</body>").split("\n")[:2] == ["Title", TEXT.strip()]
    if "main" in page or "article" in page or "has-" in page or "no-" in page:
        assert extract(f"<body>{rest}{page.format(f'<h1>Title</h1><p>{TEXT}</p>' + '<div class=share>Share it</div>')}</body>") == f"Title\n{TEXT.strip()}"


@pytest.mark.parametrize("noise", ["<aside><article>{}</article></aside>", "<div id=comments><article class=comment>{}</article></div>", "<div class='cookie-notice'>{}</div>", "<section class='comments-area'>{}</section>", "<div class='related_posts'>{}</div>"])
def test_noise_stays_out(noise):
    assert extract(f"<body><div class=entry><h1>Title</h1><p>{TEXT}</p></div>{noise.format(f'<p>{TEXT}</p>')}</body>") == f"Title\n{TEXT.strip()}"


@pytest.mark.parametrize("name", "social-history share-price navy promontory noticeable comment-on-law form-factor menuet related-work widgets banner-image ads-b navigator formation commentary subscript footers-of-law cookie-recipe".split())
@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div class=entry>{}</div>"])
def test_names_that_only_resemble_noise(name, around):
    """Words that begin like a word of noise, or hold one beside others, delete nothing."""
    part = f"<section class={name}><p>{TEXT}</p></section>"
    assert extract(f"<body>{LINKS}{around.format(f'<h1>Title</h1><p>{TEXT}</p>{part}')}<footer>foot</footer></body>") == f"Title\n{TEXT.strip()}\n{TEXT.strip()}"


@pytest.mark.parametrize("name", "ad ads-2 ad-slot sidebar-left main-menu site_nav navbar share-buttons related-posts comments commentlist comment-list cookie-banner newsletter-signup social-links footer-links widget-area recommended-articles".split())
@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>"])
def test_known_noise_in_the_article(name, around):
    part = f"<div class={name}><p>{TEXT}</p></div>"
    assert extract(f"<body>{around.format(f'<h1>Title</h1><p>{TEXT}</p>{part}')}</body>") == f"Title\n{TEXT.strip()}"


def test_generated_pages(spark, sf):
    import html
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in extracted(pages).collect()}
    for p in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", inside))
        assert got[p.page_id] == "\n".join(b for b in blocks if b)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>x</p>", 2), (1, "u", "<p>x</p>", 2), (2, None, "<p>" + "long text. " * 100_000, 3)], "page_id long, url string, html string, text int")
    got = sorted(extracted(df).collect(), key=lambda r: (r.page_id or 0))
    assert [r.n_chars for r in got] == [0, 1, 1, len("long text. " * 100_000) - 1]
    assert extracted(df.limit(0)).count() == 0


WORDS = st.sampled_from(["a", "word", "and more, here.", "one; two! three?", "a much longer run of words that goes on, and on, and on until it ends at last."])
TREES = st.recursive(
    WORDS | st.builds(lambda t: ("p", "", [t]), WORDS),
    lambda kids: st.tuples(st.sampled_from(["div", "section", "blockquote", "table", "a", "span"]), st.sampled_from(["", "x", "y", "legal", "share-price", "navy"]), st.lists(kids, max_size=5)),
    max_leaves=30,
)


def written_out(node):
    if isinstance(node, str):
        return node
    tag, cls, kids = node
    return f"<{tag}{f' class={cls}' if cls else ''}>{''.join(map(written_out, kids))}</{tag}>"


def flat(node):
    """Blocks within inline elements and paragraphs within paragraphs would be closed by the reader: those trees are left out."""
    if isinstance(node, str):
        return True
    tag, _, kids = node
    return all(flat(k) and (tag not in ("a", "span", "p") or isinstance(k, str) or k[0] in ("a", "span")) for k in kids)


def brute(tree):
    """All pairs of paths, by definition; no page is read."""
    texts, runs, block, run = [], [], 0, 0

    def walk(node, path):
        nonlocal block, run
        if isinstance(node, str):
            texts.append((path, node, block))
            runs.append(run)
            return
        tag, cls, kids = node
        block += tag not in ("a", "span")
        run += 1
        for k in kids:
            walk(k, (*path, (tag, cls)))
        block += tag not in ("a", "span")
        run += 1

    walk(tree, ())
    paths = sorted({p for p, _, _ in texts})
    if not paths:
        return ""
    own = {p: [(len(t), sum(c in ".,;!?" for c in t)) for q, t, _ in texts if q == p] for p in paths}
    # characters come as one node if no tag stands between them, not even that of an empty element
    joined = {p: [] for p in paths}
    last = None
    for (p, t, _), r in zip(texts, runs, strict=True):
        if last == r:
            joined[p][-1] += t
        else:
            joined[p].append(t)
        last = r
    own = {p: [(len(t), sum(c in ".,;!?" for c in t)) for t in ts] for p, ts in joined.items()}
    fused = {p: (0.1 if any(c == "legal" for _, c in p) else 1) * sum(a for a, _ in x) / len(x) * (1 + sum(b for _, b in x) / len(x)) for p, x in own.items()}

    def common(p, q):
        return next((i for i, (a, b) in enumerate(zip(p, q, strict=False)) if a != b), min(len(p), len(q)))

    smooth = {}
    for p in paths:
        near = [(q, len(p) + len(q) - 2 * common(p, q)) for q in paths]
        w = [(q, math.exp(-(d**2) / 2)) for q, d in near if d <= 6]
        smooth[p] = sum(k * fused[q] for q, k in w) / sum(k for _, k in w)
    on = [p for p in paths if smooth[p] >= 0.2 * max(smooth.values()) - 1e-12]
    tops = {p[: next((i for i in range(len(p) - 1, -1, -1) if p[i][0] not in ("a", "span")), 0)] for p in on}
    tops.add(on[0][: min(common(on[0], q) for q in on)])
    length = {p: sum(a for a, _ in own[p]) for p in paths}
    keep = set(on)
    for t in tops:
        for p in paths:
            if p[: len(t)] == t:
                group = [q for q in paths if q[: len(t) + 1] == p[: len(t) + 1] and (len(p) > len(t) or q == p)]
                linked = sum(length[q] for q in group if any(tag == "a" for tag, _ in q))
                if 2 * linked < sum(length[q] for q in group):
                    keep.add(p)
    lines = {}
    for p, t, b in texts:
        if p in keep:
            lines.setdefault(b, []).append(t)
    return "\n".join(x for x in (" ".join("".join(v).split()) for v in lines.values()) if x)


@settings(max_examples=400, deadline=None)
@given(st.lists(TREES.filter(flat), max_size=6))
def test_same_as_brute_force(kids):
    page = ("body", "", [k if isinstance(k, tuple) else ("div", "", [k]) for k in kids])
    assert extract(written_out(page)) == brute(page)


def test_pages_without_article(spark, sf):
    """The driver's pages with a neutral element for the article: ratios find the same text. With a neutral advert, most."""
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    plain = [h.replace("<article>", "<div>").replace("</article>", "</div>") for h in pages]
    assert [extract(h) for h in plain] == [extract(h) for h in pages]
    assert sum(extract(h.replace('class="ad"', "class=z")) == extract(o) for h, o in zip(plain, pages, strict=True)) > 0.7 * len(pages)


def test_names_that_decide_nothing():
    """Elements of doubtful name stay within the content."""
    for around in ("<article>{}</article>", "<div class=y>{}</div>"):
        rest = "<div class='legal'>A law, of 1990.</div><div class='search-results'><p>Found it, at last.</p></div>"
        assert extract(f"<body>{around.format(f'<p>{TEXT}</p>{rest}<p>{TEXT}</p>')}</body>").split("\n") == [TEXT.strip(), "A law, of 1990.", "Found it, at last.", TEXT.strip()]


@pytest.mark.parametrize("tag", ["svg", "noscript", "template", "math", "title", "textarea", "svg class=icon", "iframe src=x"])
def test_unclosed_elements(tag):
    """The rest of the page is not lost."""
    assert extract(f"<body><article><p>Before it, text.</p><{tag}><p>After it, more.</p></article></body>") == "Before it, text.\nAfter it, more."


def test_linear_time():
    """Paths, quotes and depth that would cost the square of the page's length."""
    began = time.time()
    for html in ("".join(f"<div id=b{i}><div class=c{i}>text, {i}</div></div>" for i in range(50_000)), '<a "' * 250_000, '<a "><a "' * 100_000, "<div>" * 100_000 + "x", "<!" * 300_000, "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000, "<svg>" * 50_000 + "<p>x", "<title>a" * 50_000, "<main>" * 50_000):
        extract(html)
    assert time.time() - began < 60
