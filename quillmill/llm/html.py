"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its element paths (tags with their classes) and, with its path, the text of
each block.  A token's occurrence vector says how often it stands on each distinct page of the
host; tokens with the same vector form an equivalence class.  Vectors are compared by a
fingerprint that is summed up over all pages of a host, wherever they lie, so no task ever holds
a host.  Pages with the same prose count once.

Tokens that stand on at least half of a host's distinct pages, and once on each, make up its
template, if their elements nest: their parents are in it, too.  Between them are slots.  From
the root the deduction goes down into the slot that holds most of the running text and stops at
the article: that slot is the container.  Names of tags and classes only weigh slots.  Slots of
their own inside the container that hold little and come after its text go; so does text that is
in the equivalence class of its own element, for it is part of the template, not data.  On each
page a class is used only if its tokens come in the host's order there; a page without the
container falls back on named elements and, at last, on its own paths as a template of one page.

Sizes: one pass sends a few numbers per token to two small aggregations; a host's template has
at most twice as many tokens as its mean page.  Templates go to all tasks if they are small
(``BROADCAST_BYTES``), else pages and templates are joined by host.  Time is linear in a page.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import materialise, table

#: Least number of distinct pages, and least share of a host's, on which a token of its template stands.
LEAST_PAGES, LEAST_SHARE = 2, 0.5
#: Share of its parent's weighed text that a slot must hold to be gone into, and share of the
#: container's text below which a slot of its own inside goes.
MAIN_SHARE, SMALL_SHARE = 0.5, 0.2
#: ``MAIN_SHARE`` for a page that stands alone: nothing shows there which slots other pages have.
ALONE_SHARE = 0.9
#: Templates of at most so many bytes in all go to every task.
BROADCAST_BYTES = 64 << 20

_SPACE = re.compile(r"\s+")
_TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"""([a-zA-Z_:@-][\w:.-]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "math", "title")}

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol",
    "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PROSE = {"p", "li", "dd", "dt", "blockquote", "pre", "th", "figcaption", "caption", "summary"} | _HEADINGS
#: Elements that can be slots of a layout.
_GROUPS = _BLOCK - _PROSE - {"br", "hr", "ul", "ol", "dl", "figure", "thead", "tfoot"}
#: Elements whose content is never the article's text.
_CHROME_TAGS = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "head", "object", "label", "fieldset"}
_CHROME_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "sidebar", "side", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "breadcrumb",
    "breadcrumbs", "comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "menu", "nav", "navbar", "navigation",
    "pagination", "pager", "toolbar", "widget", "footer", "masthead", "topbar", "skip", "hidden", "copyright", "disclaimer", "paywall",
}
#: Parts of a class that say how a wrapper is laid out, not what it holds ("has-sidebar").
_LAYOUT_WORDS = {"has", "with", "no", "without", "by", "is", "not", "layout", "page", "wrapper", "wrap", "container", "content", "main", "body", "enabled"}
_CHROME_ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "alert", "dialog", "alertdialog", "menu", "menubar", "form"}
_MAIN_WORDS = {"article", "articlebody", "post", "entry", "story", "content", "main", "maincontent"}
#: Below these an article is not the page's own.
_OTHERS = {"nav", "aside", "footer"}
_OTHER_WORDS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "related", "recommended"}
#: A start tag closes open elements of these names that no list or table holds together.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = {"ul", "ol", "dl", "table"}
_ENDS_P = _BLOCK - {"br", "html", "body"}

_MASK = (1 << 64) - 1


def _hash(text: str, seed: int = 0) -> int:
    """64 bits as a signed number."""
    import xxhash

    value = xxhash.xxh3_64_intdigest(text, seed & _MASK)
    return value - (1 << 64) if value >> 63 else value


ROOT = 1


def _parts(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]


@dataclass(frozen=True)
class Said:
    """What an element's tag and attributes say about it."""

    key: str
    chrome: bool
    other: bool
    #: 3 for article, 2 for main or its role, 1 for a telling class.
    main: int


def _said(tag: str, attrs: str) -> Said:
    found = {a.lower(): _html.unescape(v1 or v2 or v3) for a, v1, v2, v3 in _ATTR.findall(attrs)} if attrs else {}
    role, classes = found.get("role", "").lower(), found.get("class", "").split()
    names = [_parts(name) for name in [*classes, *found.get("id", "").split()]]
    known = {w for n in names for w in n[:1] + n[-1:]}
    chrome_names = {w for n in names if not _LAYOUT_WORDS & set(n) for w in n[:1] + n[-1:] if w in _CHROME_WORDS}
    chrome = tag in _CHROME_TAGS or role in _CHROME_ROLES or "hidden" in found or found.get("aria-hidden") == "true" or (bool(chrome_names) and tag not in ("article", "main", "body", "html"))
    named = tag in ("div", "section", "td") and bool(known & _MAIN_WORDS)
    main = 3 if tag == "article" else 2 if tag == "main" or role in ("main", "article") else 1 if named else 0
    return Said(f"{tag}.{'.'.join(sorted(c.lower() for c in classes))}", chrome, tag in _OTHERS or bool(chrome_names & _OTHER_WORDS), main)


_TELLS = re.compile(r"class|id|role|hidden", re.IGNORECASE)
_KNOWN: dict[tuple[str, str], Said] = {}


def said(tag: str, attrs: str) -> Said:
    """``_said``, remembered for the elements met lately."""
    if attrs and not _TELLS.search(attrs):
        attrs = ""
    got = _KNOWN.get((tag, attrs))
    if got is None:
        if len(_KNOWN) >= 50_000:
            _KNOWN.clear()
        got = _KNOWN[tag, attrs] = _said(tag, attrs)
    return got


_PATHS: dict[tuple[int, str], int] = {}


def _path(parent: int, key: str) -> int:
    got = _PATHS.get((parent, key))
    if got is None:
        if len(_PATHS) >= 200_000:
            _PATHS.clear()
        got = _PATHS[parent, key] = _hash(key, parent)
    return got


class Node:
    """An element: its path's hash, what its names say, and the element that holds it."""

    __slots__ = ("tag", "path", "parent", "own_chrome", "chrome", "other", "main", "article", "linked", "chars", "inside", "out", "below")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent, self.chars = tag, parent, 0
        if parent is None:
            self.path, self.own_chrome, self.chrome, self.other, self.main, self.article, self.linked = ROOT, False, False, False, 0, False, False
            return
        info = said(tag, attrs)
        self.path = _path(parent.path, info.key)
        top = tag == "article" or tag == "main"
        self.own_chrome = info.chrome
        self.other = parent.other or info.other
        # The page's own article is found below whatever wraps it.
        freed = info.main >= 2 and not parent.article and not parent.other
        self.article = parent.article or top
        self.chrome = info.chrome or (parent.chrome and not freed) or (tag == "header" and not self.article)
        self.main = 0 if self.chrome else info.main
        self.linked = parent.linked or tag == "a"


class _Open:
    """The open elements, with what is needed to find in constant time whether one can close."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.blocks = [0]
        self.inline = [Counter()]
        self.count: Counter[str] = Counter()
        self.scopes = [Counter()]

    def push(self, node: Node) -> None:
        tag = node.tag
        if tag in _BLOCK:
            self.blocks.append(len(self.stack))
            self.inline.append(Counter())
        else:
            self.inline[-1][tag] += 1
        self.stack.append(node)
        self.count[tag] += 1
        self.scopes[-1][tag] += 1
        if tag in _SCOPES:
            self.scopes.append(Counter())

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            if tag in _SCOPES:
                self.scopes.pop()
            self.scopes[-1][tag] -= 1
            self.count[tag] -= 1
            if tag in _BLOCK:
                self.blocks.pop()
                self.inline.pop()
            else:
                self.inline[-1][tag] -= 1

    def close(self, tags: tuple[str, ...]) -> None:
        at = len(self.stack) - 1
        while self.stack[at].tag not in tags:
            at -= 1
        self.cut(at)

    def end_tag(self, tag: str) -> None:
        # An inline end tag closes no block that was opened inside it.
        if self.count[tag] if tag in _BLOCK else self.inline[-1][tag]:
            self.close((tag,))

    def start_tag(self, tag: str) -> None:
        if tag in _ENDS_P and self.stack[self.blocks[-1]].tag == "p":
            # A new block ends an open paragraph, with whatever inline elements it left open.
            self.cut(self.blocks[-1])
        if tag in _CLOSES and any(self.scopes[-1][t] for t in _CLOSES[tag]):
            self.close(_CLOSES[tag])


def _markup(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, "") and ("start" or "end", tag, attributes), in one pass.

    An unclosed comment or raw element reaches to the end.  If quotes swallow the end of a tag,
    quotes mean nothing from there on; a tag that does not end at all is text.
    """
    at, n, quotes = 0, len(page), True
    while at < n:
        low = page.find("<", at)
        if low < 0:
            yield "text", page[at:], ""
            return
        if low > at:
            yield "text", page[at:low], ""
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(page, low + 1)
        if m is None and page[low + 1 : low + 2] not in ("!", "?", "/"):
            yield "text", "<", ""
            at = low + 1
            continue
        end = -1
        if quotes and m:
            stop = _STOP.search(page, m.end())
            while stop and stop[0] != ">":
                closed = page.find(stop[0], stop.end())
                stop = _STOP.search(page, closed + 1) if closed >= 0 else None
            end = stop.start() if stop else -1
            quotes = end >= 0
        if end < 0:
            end = page.find(">", low)
        if end < 0:
            yield "text", page[low:], ""
            return
        at = end + 1
        if m is None:
            continue
        tag, attrs = m[2].lower(), page[m.end() : end]
        if m[1]:
            yield "end", tag, ""
            continue
        if tag in _RAW and not attrs.endswith("/"):
            closed = _RAW[tag].search(page, at)
            at = closed.end() if closed else n
            continue
        yield "start", tag, attrs


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """All elements and, in page order, (innermost element where the block begins, its text)."""
    root = Node("#root", "", None)
    nodes, out, parts = [root], [], []
    open_ = _Open(root)
    stack, held = open_.stack, root

    def flush():
        nonlocal parts
        if parts:
            text = _SPACE.sub(" ", _html.unescape("".join(parts))).strip()
            if text:
                out.append((held, text))
                held.chars += len(text)
            parts = []

    for kind, name, attrs in _markup(page):
        if kind == "text":
            if not parts:
                held = stack[-1]
            elif stack[-1].chrome != held.chrome:
                flush()
                held = stack[-1]
            parts.append(name)
            continue
        if name in _BLOCK:
            flush()
        if kind == "end":
            open_.end_tag(name)
            continue
        if name in _VOID:
            continue
        open_.start_tag(name)
        node = Node(name, attrs, stack[-1])
        nodes.append(node)
        if not attrs.rstrip().endswith("/"):
            open_.push(node)
    flush()
    return nodes, out


@dataclass
class Token:
    """What is known of a token over the distinct pages of a host."""

    parent: int
    tag: str
    is_text: bool
    pages: int = 0
    times: int = 0
    vector: int = 0
    #: Running text below an element, outside links; pages on which names call it chrome; best rank by name.
    chars: int = 0
    chrome: int = 0
    main: int = 0
    #: Mean place on the page.
    place: float = 0.0


@dataclass
class Template:
    """What a host's pages share.  ``classes``: tokens in order, by equivalence class."""

    container: int | None = None
    dropped: set[int] = field(default_factory=set)
    texts: set[int] = field(default_factory=set)
    classes: list[list[int]] = field(default_factory=list)


def page_tokens(nodes: list[Node], found: list[tuple[Node, str]]) -> dict[int, Token]:
    """The tokens of one page, with their counts there."""
    for n in nodes:
        n.below = 0 if n.linked else n.chars
    for n in reversed(nodes):
        if n.parent is not None and not n.linked:
            n.parent.below += n.below
    out: dict[int, Token] = {}
    for place, n in enumerate(nodes):
        t = out.get(n.path)
        if t is None:
            t = out[n.path] = Token(n.parent.path if n.parent else 0, n.tag, False, pages=1, chrome=int(n.chrome), place=float(place))
        t.times += 1
        t.chars += n.below
        t.main = max(t.main, n.main)
    for place, (n, text) in enumerate(found):
        token = _hash(text, n.path)
        t = out.get(token)
        if t is None:
            t = out[token] = Token(n.path, n.tag, True, pages=1, place=float(place))
        t.times += 1
    return out


def signature(found: list[tuple[Node, str]]) -> int:
    """Pages that agree in it count once: the hash of the prose, or of all text if there is none."""
    prose = [t for n, t in found if n.tag in _PROSE and not n.chrome] or [t for _, t in found]
    return _hash("\n".join(prose))


def deduce(tokens: dict[int, Token]) -> Template:
    """The template of a host from its tokens (those below the least share may be left out)."""
    n_pages = tokens[ROOT].pages
    alone = n_pages < LEAST_PAGES
    often = {k: t for k, t in tokens.items() if t.times == t.pages and (alone or t.pages >= max(LEAST_PAGES, LEAST_SHARE * n_pages))}
    # An element nests if its parents do; text nests if its element is in the template.
    nests: dict[int, bool] = {ROOT: True}
    for k in often:
        line = []
        while k not in nests and k in often:
            line.append(k)
            k = often[k].parent
        good = nests.get(k, False)
        nests.update(dict.fromkeys(line, good))
    chosen = {k: t for k, t in often.items() if nests.get(k)}
    inner: dict[int, list[int]] = defaultdict(list)
    for k, t in chosen.items():
        if not t.is_text and t.tag in _GROUPS and k != ROOT:
            inner[t.parent].append(k)
    constant = {t.parent for t in chosen.values() if t.is_text and not alone and t.parent in chosen and t.vector == chosen[t.parent].vector}
    headed = {t.parent for k, t in tokens.items() if t.tag in ("h1", "h2") and not t.is_text and k not in constant}

    # What holds a named article is weighed as it is.
    leads: set[int] = set()
    for k, t in chosen.items():
        while k in chosen and k not in leads and (t.main >= 2 and not t.is_text):
            leads.add(k)
            k = chosen[k].parent

    def weight(k: int) -> float:
        t = chosen[k]
        return 50.0 if k in leads else 0.02 if 2 * t.chrome > t.pages else 5.0 if t.main else 1.0

    at, rest, share = ROOT, chosen[ROOT].chars, ALONE_SHARE if alone else MAIN_SHARE
    while chosen[at].tag != "article" and at not in headed and inner[at]:
        scores = {k: weight(k) * chosen[k].chars for k in inner[at]}
        own = max(0, chosen[at].chars - sum(chosen[k].chars for k in inner[at]))
        best = max(scores, key=lambda k: (scores[k], -chosen[k].place, k))
        # Of its parent's text by weight, and unless it is named of all text that names don't call chrome.
        rest -= sum(chosen[k].chars for k in inner[at] if weight(k) < 1)
        if scores[best] <= 0 or scores[best] < share * (sum(scores.values()) + own) or (weight(best) == 1 and chosen[best].chars < share * rest):
            break
        at = best
    template = Template(at)
    if not alone:
        # Slots of their own inside the container, after its first running text.
        total = chosen[at].chars
        prose = [t.place for t in tokens.values() if t.parent == at and not t.is_text and (t.tag in _PROSE and t.tag not in _HEADINGS or t.tag in _GROUPS and t.chars >= SMALL_SHARE * total)]
        first = min(prose, default=float("inf"))
        template.dropped = {k for k in inner[at] if chosen[k].chars < SMALL_SHARE * total and chosen[k].place > first}
        template.texts = {k for k, t in chosen.items() if t.is_text and t.parent in constant and t.vector == chosen[t.parent].vector and t.tag != "h1"}
    classes: dict[int, list[int]] = defaultdict(list)
    for k, t in chosen.items():
        if not t.is_text:
            classes[t.vector].append(k)
    template.classes = [sorted(c, key=lambda k: (chosen[k].place, k)) for _, c in sorted(classes.items())]
    return template


def valid(order: list[int], page: list[int]) -> bool:
    """Whether the tokens of a class stand on a page in the class's order, each once."""
    place = {k: i for i, k in enumerate(order)}
    met = [place[k] for k in page if k in place]
    return all(a < b for a, b in zip(met, met[1:], strict=False))


def extract_page(page: str, template: Template | None) -> str:
    """The main text of a page of a host with this template (None: the page stands alone)."""
    nodes, found = parse(page)
    if not found:
        return ""
    paths = [n.path for n in nodes]
    if template is None:
        template = deduce(page_tokens(nodes, found))
    times = Counter(paths)
    used = {k for c in template.classes if valid(c, paths) for k in c if times[k] == 1}
    container = template.container if template.container in used else None
    rank = max((n.main for n in nodes), default=0)
    if container is None and not rank:
        template = deduce(page_tokens(nodes, found))
        used, container = {k for c in template.classes for k in c}, template.container
    for n in nodes:
        up = n.parent
        start = n.path == container if container is not None else n.main == rank
        n.inside = start or (up is not None and up.inside)
        if start and not (up is not None and up.inside):
            # What wraps the container does not hide it.
            n.out = False
        else:
            n.out = (up is not None and up.out) or n.own_chrome or (n.path in template.dropped and n.path in used) or (n.tag == "header" and not n.article and container == ROOT)
    inside = [n for n in nodes if n.inside and not n.out]
    if container is not None and rank == 3 and not any(n.article for n in nodes if n.path == container) and any(n.main == 3 for n in inside):
        # Articles inside the container say more than it does.
        for n in nodes:
            n.inside = (n.main == 3 and n.inside) or (n.parent is not None and n.parent.inside and n.parent.article)
    return "\n".join(t for n, t in found if n.inside and not n.out and not (template.texts and _hash(t, n.path) in template.texts and n.path in used))


def extract_block(pages: list[str]) -> list[str]:
    """The main text of each of some pages of one host, by the same steps on one machine."""
    return [extract_page(p, t) for p, t in zip(pages, [host_template(pages)] * len(pages), strict=True)]


def host_template(pages: list[str]) -> Template | None:
    """The template of a host's pages, by the definition: vectors over all distinct pages."""
    by: dict[int, dict[int, Token]] = {}
    for page in pages:
        nodes, found = parse(page)
        own = by.setdefault(signature(found), {})
        for k, t in page_tokens(nodes, found).items():
            had = own.setdefault(k, t)
            had.times, had.chars, had.chrome, had.main, had.place = max(had.times, t.times), max(had.chars, t.chars), max(had.chrome, t.chrome), max(had.main, t.main), min(had.place, t.place)
    if len(by) < LEAST_PAGES:
        return None
    total: dict[int, Token] = {}
    vectors: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for sig, own in sorted(by.items()):
        for k, t in own.items():
            all_ = total.setdefault(k, Token(t.parent, t.tag, t.is_text))
            all_.pages += 1
            all_.times, all_.chars, all_.chrome, all_.main, all_.place = all_.times + t.times, all_.chars + t.chars, all_.chrome + t.chrome, max(all_.main, t.main), all_.place + t.place
            vectors[k].append((sig, t.times))
    for k, t in total.items():
        t.vector = _hash(str(vectors[k]))
        t.place = round(t.place / t.pages, 6)
    often = {k: t for k, t in total.items() if t.pages >= max(LEAST_PAGES, LEAST_SHARE * len(by))}
    return deduce(often) if ROOT in often else None


def host_of(url: str = "url") -> Column:
    """The host in lower case; empty for a null or odd address."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


_TOKENS = "host string, sig long, token long, parent long, tag string, is_text boolean, times long, chars long, chrome int, main int, place int"
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
#: Pages by signature that a task remembers so as not to send copies.
_REMEMBERED = 200_000


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _TOKENS.split(", ")]
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        rows: list[tuple] = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            nodes, found = parse(page)
            sig = signature(found)
            if len(seen) >= _REMEMBERED:
                seen.clear()
            key = (host, _hash(str([(n.path, t) for n, t in found])))
            if not found or key in seen:
                continue
            seen.add(key)
            rows += [(host, sig, k, t.parent, t.tag, t.is_text, t.times, t.chars, t.chrome, t.main, int(t.place)) for k, t in page_tokens(nodes, found).items()]
            if len(rows) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=names)


_TEMPLATE = "host string, container long, dropped array<long>, texts array<long>, classes array<array<long>>"


def _deduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got = {t["token"]: Token(t["parent"], t["tag"], t["is_text"], t["pages"], t["times"], t["vector"], t["chars"], t["chrome"], t["main"], t["place"]) for t in tokens}
            if ROOT in got:
                made = deduce(got)
                rows.append((host, made.container, sorted(made.dropped), sorted(made.texts), made.classes))
        longs = pa.list_(pa.int64())
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), longs, longs, pa.list_(longs)), strict=True)], names=[x.split()[0] for x in _TEMPLATE.split(", ")])


def templates(pages: DataFrame) -> DataFrame:
    """(host, container, dropped, texts, classes) of the hosts in ``pages`` (host, html) that
    have LEAST_PAGES distinct pages or more."""
    rows = pages.select("host", "html").mapInArrow(_tokens, _TOKENS)
    # Pages with the same prose are one; then vectors and sums over a host's pages.
    one = rows.groupBy("host", "sig", "token").agg(
        *(F.first(c).alias(c) for c in ("parent", "tag", "is_text")), *(F.max(c).alias(c) for c in ("times", "chars", "chrome", "main")), F.min("place").alias("place")
    )
    sums = one.groupBy("host", "token").agg(
        *(F.first(c).alias(c) for c in ("parent", "tag", "is_text")),
        F.count("*").alias("pages"), F.sum("times").alias("times"), F.bit_xor(F.xxhash64("sig", "times")).alias("vector"), F.sum("chars").alias("chars"),
        F.sum("chrome").alias("chrome"), F.max("main").alias("main"), F.round(F.avg("place"), 6).alias("place"),
    )
    sums = materialise(sums.where(F.col("pages") >= LEAST_PAGES))
    size = sums.where(F.col("token") == ROOT).select("host", F.col("pages").alias("n"))
    often = sums.join(size, "host").where(F.col("pages") >= LEAST_SHARE * F.col("n"))
    fields = ("token", "parent", "tag", "is_text", "pages", "times", "vector", "chars", "chrome", "main", "place")
    return often.groupBy("host").agg(F.collect_list(F.struct(*fields)).alias("tokens")).mapInArrow(_deduce, _TEMPLATE)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, template = None, None
    for b in batches:
        at = {name: b.column(i) for i, name in enumerate(b.schema.names)}
        texts = []
        for i, (host, page) in enumerate(zip(at["host"].to_pylist(), at["html"].to_pylist(), strict=True)):
            if host != last:
                last, template = host, None
                if (container := at["container"][i].as_py()) is not None:
                    template = Template(container, set(at["dropped"][i].as_py()), set(at["texts"][i].as_py()), at["classes"][i].as_py())
            texts.append(extract_page(page, template))
        yield pa.RecordBatch.from_arrays([at["page_id"], at["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of ``pages`` (page_id, url, html).

    Null html counts as empty and gives the empty text; pages without a host are one host;
    repeated rows give repeated results; an empty table gives an empty result.  The result does
    not depend on how rows are dealt to tasks.
    """
    rows = pages.select(host_of().alias("host"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    made = materialise(templates(rows))
    size = made.agg(F.coalesce(F.sum(8 * (F.size("dropped") + F.size("texts") + F.size(F.flatten("classes"))) + F.length("host") + 64), F.lit(0)).alias("n")).first().n
    return rows.join(F.broadcast(made) if size <= BROADCAST_BYTES else made, "host", "left").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
