import random
import time

import pytest

from quillmill.llm import html

PAGE = (
    "<!doctype html><html><head><title>No</title><style>p{{}}</style><script>var a = '</p>';</script></head><body class=x>"
    "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Menu</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "<div id=sidebar><p>Side</p></div><article><h1>Title {0} &amp; more</h1><p>First  {0}\n para<b>gra</b>ph&nbsp;end<br>next<p>Second {0} &lt;x&gt; &#233;</p>"
    "<div class=\"ad banner\">Buy</div><ul><li>one<li>two</ul><form><input><label>Mail</label><button>Send</button></form>"
    "<section id='comments'><p>Reader {0}</p></section></article><aside>Also</aside><!-- <p>gone</p> --><footer>&copy; foot</footer></body></html>"
)
SCHEMA = "page_id long, url string, html string"


def test_article_only(spark):
    rows = [(i, f"https://h.example.com/{i}", PAGE.format(i)) for i in range(300)]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, url, _ in rows:
        assert got[i].text == f"Title {i} & more\nFirst {i} paragraph end\nnext\nSecond {i} <x> é\none\ntwo"
        assert got[i].n_chars == len(got[i].text) and got[i].url == url


def test_no_named_container():
    page = "<body><div class=top><ul><li><a href=/>Home</a></ul></div><div class=wrap><div class=text><p>Long text number {0} that says something.</p><p>More words {0}.</p></div><div class=more><a href=/n>Next</a></div></div></body>"
    for n in (1, 5):
        assert html.extract_block([page.format(i) for i in range(n)])[0] == "Long text number 0 that says something.\nMore words 0."


OPAQUE = (
    "<body><div class=x1><a href=/>Home</a> <a href=/b>News</a></div><div class=x2>Advert {2} for number {0} and words</div>"
    "<div class=x3><h1>Title {0}</h1><p>Text {1} of {0}.</p><p>And {1} more {0}.</p><div class=x7>Buy {2} now</div><p>Last of {0}.</p></div>"
    "<div class=x4><p>Reader {2} says {0}</p></div><div class=x5>Foot {0}</div></body>"
)


def opaque(n):
    rng = random.Random(5)
    return [OPAQUE.format(i, " ".join(f"w{rng.randrange(99)}" for _ in range(40)), f"a{rng.randrange(99)}") for i in range(n)]


def test_opaque_classes_need_the_template(monkeypatch):
    pages = opaque(20)
    for page, text in zip(pages, html.extract_block(pages), strict=True):
        lines = text.split("\n")
        assert len(lines) == 4 and lines[0].startswith("Title") and lines[3].startswith("Last of")
    # A page alone has no slots that go from inside its container.
    assert "Buy" in html.extract_page(pages[3], None)
    monkeypatch.setattr(html, "LEAST_SHARE", 2.0)
    assert html.host_template(pages) is None and "Buy" in html.extract_block(pages)[3]


def test_text_in_the_class_of_its_element_is_template():
    page = "<body><div class=a><h1>T {0}</h1><p>Body {0} {1}</p><p class=z>Write to us</p></div><div class=b>Menu</div></body>"
    rng = random.Random(1)
    got = html.extract_block([page.format(i, " ".join(rng.choices("abcdefgh", k=30))) for i in range(6)])
    assert all(t.startswith(f"T {i}\nBody {i} ") and "Write" not in t for i, t in enumerate(got))


@pytest.mark.parametrize("wrap", ['<div class="layout has-sidebar">{}</div>', '<div class="col side-by-side">{}</div>', '<div id="page-with-sidebar">{}</div>', '<div class=share>{}</div>', '<form id=all>{}</form>', '<div class="notice alert">{}</div>'])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_wrappers_hide_no_article(wrap, tag):
    inner = f"<{tag}><h1>T {{0}}</h1><p>Text {{0}}</p></{tag}><div class=sidebar>Side {{0}}</div>"
    pages = [("<body><nav>Menu</nav>" + wrap.format(inner) + "</body>").format(i) for i in range(4)]
    assert html.extract_block(pages) == [f"T {i}\nText {i}" for i in range(4)]
    assert html.extract_page(pages[0], None) == "T 0\nText 0"


def test_articles_of_readers_stay_out():
    page = "<body><article><h1>T</h1><p>Text {0}</p></article><div id=comments><article class=c><p>Reader {0}</p></article></div></body>"
    assert html.extract_page(page.format(1), None) == "T\nText 1"


def test_copies_make_no_template():
    """Pages with the same prose are one, so that a text is not its own template."""
    page = "<body><ul><li><a>{0}</a></ul><div class=t><p>Only this one text is here.</p></div></body>"
    assert html.extract_block([page.format(f"menu{i}") for i in range(9)]) == ["Only this one text is here."] * 9


def test_odd_pages(spark):
    rows = [(1, None, None, "h"), (1, None, None, "h"), (2, "nonsense", "", "h"), (3, "http://a/", "plain only", "h"), (4, "http://b/", "<p>open <b>tags <i>all", "h"), (5, "http://c/", "<" * 3000, "h"), (6, "http://d/", "<div>" * 30000 + "deep" + "</div><p>er" * 20000, "h")]
    got = [(r.page_id, r.text) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()]
    assert sorted(got)[:5] == [(1, ""), (1, ""), (2, ""), (3, "plain only"), (4, "open tags all")] and dict(got)[5] == "<" * 3000 and dict(got)[6].count("er") >= 18000
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("bit", ["<a ", '<a "<b >"', "<a '", "<!-", "</", "<b><div></b>", "<li><div><ul>", "<p><i>", "<td><b>", "&amp", "<div><li></li>"])
def test_time_is_linear(bit):
    def seconds(n):
        start = time.perf_counter()
        html.extract_page(bit * n, None)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 60 * (seconds(2_000) + 0.02)


def random_pages(seed):
    rng = random.Random(seed)
    layouts = [
        "<body><div class=q{k}>{a}</div><div class=r{k}><h1>{t}</h1>{p}<div class=s>{b}</div></div><footer>{c}</footer></body>",
        "<body><nav><ul><li>{a}</ul></nav><main>{p}<section class=comments>{c}</section></main></body>",
        "<table><tr><td>{a}<td class=content>{p}<td>{b}</table>",
        "<body><article>{p}</article><article>{c}</article><div>same</div></body>",
    ]
    out = []
    for i in range(60):
        def words(n):
            return " ".join(f"w{rng.randrange(50)}" for _ in range(n))

        shared = rng.random() < 0.2
        part = {"k": rng.randrange(2), "a": words(3), "b": "fixed words" if rng.random() < 0.7 else words(2), "c": words(4), "t": "T" if shared else words(3), "p": "<p>one text" if shared else "".join(f"<p>{words(9)}</p>" for _ in range(rng.randint(0, 4)))}
        out.append((i, f"http://host{rng.randrange(5)}/p", rng.choice(layouts).format(**part)))
    return [*out, *out[:7], (99, None, None)]


@pytest.mark.parametrize("parts", [1, 7])
def test_distributed_templates_equal_the_definition(spark, parts, monkeypatch):
    """Vectors over all pages of a host by plain counting give the same texts, however rows are dealt."""
    rows = random_pages(3)
    if parts == 7:
        monkeypatch.setattr(html, "BROADCAST_BYTES", -1)
    got = html.extract(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    by = {}
    for i, url, page in rows:
        by.setdefault(url, []).append((i, page or ""))
    want = [(i, t) for pages in by.values() for (i, _), t in zip(pages, html.extract_block([p for _, p in pages]), strict=True)]
    assert sorted((r.page_id, r.text) for r in got) == sorted(want)


def test_classes_by_brute_force():
    """Tokens of one class are those with equal vectors, written out in full."""
    pages = [p for _, u, p in random_pages(4) if u == "http://host1/p"]
    made = html.host_template(pages)
    distinct = {}
    for page in pages:
        nodes, found = html.parse(page)
        own = distinct.setdefault(html.signature(found), {})
        for k, t in html.page_tokens(nodes, found).items():
            own[k] = max(own.get(k, 0), t.times)
    vector = {k: tuple(own.get(k, 0) for own in distinct.values()) for own in distinct.values() for k in own}
    for members in made.classes:
        assert len({vector[k] for k in members}) == 1 and set(vector[members[0]]) <= {0, 1} and sum(vector[members[0]]) * 2 >= len(distinct)
    in_classes = [k for c in made.classes for k in c]
    assert len(in_classes) == len(set(in_classes)) and html.ROOT in in_classes
    assert len({vector[c[0]] for c in made.classes}) == len(made.classes)


def test_order_of_a_class():
    assert html.valid([1, 2, 3], [9, 1, 2, 9, 3]) and html.valid([1, 2, 3], [2, 3]) and not html.valid([1, 2], [2, 1]) and not html.valid([1, 2], [1, 1, 2])


def test_hosts(spark):
    urls = ["https://A.example.com:80/x", "http://u:p@b.example/", "none", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(html.host_of().alias("h"))
    assert [r.h for r in df.collect()] == ["a.example.com", "b.example", "", ""]
