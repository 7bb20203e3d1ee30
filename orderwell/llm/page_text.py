"""The main text of web pages, by wrapper induction over the pages of a host.

A page becomes a tree of its blocks; those of one signature (tag and class or id) in one
block are one node, as are their children in turn, so a list of a thousand items is a
list of one kind.  A host's *wrapper* is a tree aligned with all of its pages by simple
tree matching, each adding what the others lack.  Pages of one shape count as one tree,
nodes on too few pages to hold a constant (headings with a name of their own) are left
out of them, and a host's trees are united part by part.  All pages of the host are
then aligned with it, and Spark counts which text stands at which node: a text on most
pages at one node is template and dropped, the others fill varying slots.  Slots that
vary but are no content (menus, adverts, forms, notices, comments ...) are told by
what their elements call themselves and, outside an article, by being links.

Pages are never shuffled: their shapes are, without texts, and wrappers and constants,
small tables by host, come to them.
A host with a third of all pages is as many counts as it has different texts, added up
inside map tasks first.
"""

from __future__ import annotations

import html as html_entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.llm.text import blocks
from orderwell.sources.tables import stage

#: Trees of a host that one task unites at a time, about.
UNITED = 32
#: Bytes of shapes that a task counts before it tells of them.
SHAPE_BYTES = 4 << 20
#: A text is template if it stands at one node on so many pages of its host at least,
#: and on such a share of those that have the node; inside an article on more.
LEAST_PAGES, SHARE, SHARE_IN_ARTICLE = 4, 0.8, 0.95
#: Outside an article, a block whose text is links to this share is a menu.
LINK_SHARE = 0.6
#: Blocks nested deeper belong to the one at this depth.
MAX_DEPTH = 64
#: Elements open at a time; what opens beyond is read as if it were not there.
MAX_OPEN = 512
#: Wrappers and constants sent to every executor at most; beyond, Spark chooses the join.
BROADCAST_BYTES = 32 << 20

# HTML's elements by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: What ends an open element of a kind, and where the search for it stops.
ENDED_BY_SIBLING = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# Elements, names and roles of what surrounds an article.
ASIDE_TAGS = frozenset(
    "nav footer aside form head script style noscript template iframe svg canvas object button select textarea input "
    "dialog menu".split()
)
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner billboard sponsor sponsored sponsors promo "
    "promotion nav navbar navigation navi menu menubar topbar sidebar sidebars aside rail footer foot colophon "
    "copyright breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login comment comments commentlist respond disqus reply replies "
    "share sharing social related recommended recommendations teaser teasers widget widgets toolbar skip masthead "
    "search hidden".split()
)
HEADER_NAMES = frozenset("header head topheader siteheader pageheader".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar note".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S,
)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?(?=[\s/]|\Z)", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _called(names: str) -> tuple[set[str], set[str]]:
    """The words that an element's names begin with, and all words in them.  A name is
    also taken as one word, so that ``sideBar`` is a sidebar."""
    first, words = set(), set()
    for name in names.split():
        parts = [w.lower() for w in WORDS.findall(name)]
        whole = name.lower().rstrip("0123456789-_")
        first |= {whole, *parts[:1]}
        words |= {*parts, *re.split("[^a-z]+", name.lower())}
    return first, words


class Scope:
    """An element that matters to what is below it.

    An aside is ``firm`` if its tag says so, and ``vague`` if it only has a name such as
    ``content-with-ads``, where the telling word does not come first.
    """

    __slots__ = ("above", "aside", "firm", "vague", "main", "closed", "held")

    def __init__(self, above: Scope | None, aside: bool, firm: bool, vague: bool, main: bool):
        self.above, self.aside, self.firm, self.vague, self.main = above, aside, firm, vague, main
        self.closed, self.held = False, 0


class Node:
    """Blocks of one signature inside blocks that are one, in order of the first."""

    __slots__ = ("sign", "kids", "signs", "number")

    def __init__(self, sign: str):
        self.sign, self.kids, self.signs, self.number = sign, [], [], -1

    def add(self, at: int, node: Node) -> None:
        self.kids.insert(at, node)
        self.signs.insert(at, node.sign)


class Open:
    """An element that is not closed yet; ``at``: place of its node's last child."""

    __slots__ = ("tag", "node", "at", "scope", "link")

    def __init__(self, tag: str, node: Node, scope: Scope | None, link: bool):
        self.tag, self.node, self.at, self.scope, self.link = tag, node, 0, scope, link


class Page:
    """The tree of a page, and its pieces of text in order: node, then runs of text with
    the scope they are in and whether they are a link's."""

    def __init__(self, source: str):
        self.root = Node("")
        self.pieces: list[tuple[Node, list[tuple[str, Scope | None, bool]]]] = []
        self.mains: list[Scope] = []
        self._runs: list[tuple[str, Scope | None, bool]] = []
        self._open = [Open("", self.root, None, False)]
        self._beyond = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, lower = 0, None
        while found := TOKEN.search(source, at):
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if found["end"] or found["end2"]:
                self._end(tag)
                continue
            attrs = found["attrs"] or found["attrs2"] or ""
            if tag in RAW:
                if not attrs.endswith("/"):
                    lower = lower or source.lower()
                    if len(lower) != len(source):  # a letter whose lower case is longer
                        lower = re.sub("[A-Z]", lambda m: m[0].lower(), source)
                    end = lower.find(f"</{tag}", at)
                    at = len(source) if end < 0 else end
                continue
            self._start(tag, attrs)
        if at < len(source):
            self._text(source[at:])
        self._flush()

    def _text(self, text: str) -> None:
        top = self._open[-1]
        self._runs.append((html_entities.unescape(text) if "&" in text else text, top.scope, top.link))

    def _flush(self) -> None:
        if any(not text.isspace() for text, _, _ in self._runs):
            self.pieces.append((self._open[-1].node, self._runs))
        self._runs = []

    def _start(self, tag: str, attrs: str) -> None:
        if tag in VOID:
            if tag == "br":
                self._text(" ")
            elif tag == "hr":
                self._flush()
            return
        names: dict[str, str] = {}
        if attrs:
            names = {name.lower(): value.strip("\"'") for name, value in ATTR.findall(attrs)}
        block = tag in BLOCK
        if block:
            self._flush()
        if len(self._open) >= MAX_OPEN:
            self._beyond += 1
            return
        if block:
            self._close({"p"}, {"article", "section", "div", "td", "li", "body", "blockquote", "main"})
            if tag in ENDED_BY_SIBLING:
                self._close(*ENDED_BY_SIBLING[tag])
        top = self._open[-1]
        scope = self._scope(tag, names, top.scope)
        node = self._node(top, tag, names) if block and len(self._open) < MAX_DEPTH else top.node
        entry = Open(tag, node, scope, top.link or tag == "a")
        if node is top.node:
            entry.at = top.at
        self._open.append(entry)

    def _scope(self, tag: str, names: dict[str, str], above: Scope | None) -> Scope | None:
        inside = above
        while inside and not inside.main:
            inside = inside.above
        role = names.get("role", "").lower()
        main = tag in ("article", "main") or role in ("main", "article") or names.get("itemprop") == "articleBody"
        firm = tag in ASIDE_TAGS and tag != "form"
        first, words = _called(f"{names.get('class', '')} {names.get('id', '')}")
        telling = ASIDE_NAMES if inside else ASIDE_NAMES | HEADER_NAMES
        plain = (
            firm
            or tag == "form"
            or bool(first & telling)
            or role in ASIDE_ROLES
            or ("hidden" in names and tag != "html")
            or names.get("aria-hidden") == "true"
            or (not inside and tag == "header")
        )
        aside = plain or bool(words & telling)
        if tag in ("html", "body") or (main and not firm):
            aside = False
        if not aside and not main:
            return above
        scope = Scope(above, aside, firm, not plain, main)
        if main:
            self.mains.append(scope)
        return scope

    def _node(self, top: Open, tag: str, names: dict[str, str]) -> Node:
        called = " ".join(sorted(names.get("class", "").split())) or names.get("id", "")
        sign = f"{tag}.{re.sub('[0-9]+', '0', called)}" if called else tag
        parent = top.node
        if sign not in parent.signs:
            top.at = min(top.at + 1, len(parent.kids))
            parent.add(top.at, Node(sign))
            return parent.kids[top.at]
        at = parent.signs.index(sign)
        top.at = max(top.at, at)
        return parent.kids[at]

    def _pop(self) -> None:
        gone = self._open.pop()
        if gone.node is self._open[-1].node:
            self._open[-1].at = max(self._open[-1].at, gone.at)

    def _close(self, tags: set[str], until: set[str]) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            tag = self._open[k].tag
            if tag in tags:
                while len(self._open) > k:
                    self._pop()
                return
            if tag in until:
                return

    def _end(self, tag: str) -> None:
        if self._beyond:
            self._beyond -= 1
            return
        block = tag in BLOCK
        if block:
            self._flush()
        for k in range(len(self._open) - 1, 0, -1):
            entry = self._open[k]
            if entry.tag == tag:
                own = entry.scope
                if own and self._open[k - 1].scope is not own:
                    own.closed = True
                while len(self._open) > k:
                    self._pop()
                return
            if not block and entry.tag in BLOCK:
                return

    def content(self) -> list[tuple[Node, str, bool]]:
        """Pieces of the article with their nodes, and whether it is marked as one.

        The article is what ``article`` or ``main`` elements hold that no aside holds;
        failing these, such as only loosely named or never closed asides hold; failing
        these, all of the page but asides and menus.
        """

        def surrounding(scope: Scope | None) -> Iterator[Scope]:
            while scope:
                yield scope
                scope = scope.above

        self._forgive(surrounding)
        loose = {
            above
            for main in self.mains
            for above in surrounding(main.above)
            if above.aside and not (above.firm and above.closed)
        }
        for forgiven in (set(), loose):
            mains = {
                m for m in self.mains if not any(s.aside and s not in forgiven for s in surrounding(m))
            }
            known: dict[Scope | None, bool] = {None: False}

            def inside(scope: Scope | None, mains=mains, forgiven=forgiven, known=known) -> bool:
                if scope not in known:
                    held = scope in mains or inside(scope.above)
                    known[scope] = held and not (scope.aside and scope not in forgiven)
                return known[scope]

            found = [(node, text, True) for node, text, _ in self._kept(inside)] if mains else []
            if found:
                return found
        clear: dict[Scope | None, bool] = {None: True}

        def outside(scope: Scope | None) -> bool:
            if scope not in clear:
                clear[scope] = not scope.aside and outside(scope.above)
            return clear[scope]

        return [(n, text, False) for n, text, linked in self._kept(outside) if linked < LINK_SHARE * len(text)]

    def _forgive(self, surrounding) -> None:
        """A vaguely named element that holds most of what its surroundings hold is no
        aside."""
        whole = 0
        for _, runs in self.pieces:
            for text, scope, _ in runs:
                whole += len(text)
                for s in surrounding(scope):
                    s.held += len(text)
        for scope in {s for _, runs in self.pieces for _, own, _ in runs for s in surrounding(own) if s.vague}:
            around = next((s.held for s in surrounding(scope.above) if s.main), whole)
            if 2 * scope.held > around:
                scope.aside = False

    def _kept(self, wanted) -> Iterator[tuple[Node, str, int]]:
        for node, runs in self.pieces:
            kept = [(text, link) for text, scope, link in runs if wanted(scope)]
            text = " ".join("".join(text for text, _ in kept).split())
            if text:
                yield node, text, sum(len(t) for t, link in kept if link)


class Outline(Page):
    """The tree of a page alone, without its texts."""

    def _text(self, text: str) -> None:
        pass

    def _flush(self) -> None:
        pass

    def _scope(self, tag: str, names: dict[str, str], above: Scope | None) -> None:
        return None


def shape(node: Node) -> list:
    """A tree as nested lists, without its texts."""
    return [node.sign, [shape(kid) for kid in node.kids]]


def built(tree: list) -> Node:
    node = Node(tree[0])
    for kid in tree[1]:
        node.add(len(node.kids), built(kid))
    return node


def match(a: Node, b: Node, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: how many nodes of two trees can be paired, roots with
    roots and children in order, and the pairs of children that do it."""
    if a.sign != b.sign:
        return 0, []
    key = id(a), id(b)
    if key in known:
        return known[key]
    rows, cols = len(a.kids), len(b.kids)
    best = [[0] * (cols + 1) for _ in range(rows + 1)]
    for i, x in enumerate(a.kids, 1):
        above, row = best[i - 1], best[i]
        for j, y in enumerate(b.kids, 1):
            both = above[j - 1] + match(x, y, known)[0] if x.sign == y.sign else 0
            row[j] = max(above[j], row[j - 1], both)
    pairs, i, j = [], rows, cols
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    known[key] = best[rows][cols] + 1, pairs[::-1]
    return known[key]


def aligned(wrapper: Node, page: Node, grow: bool = False) -> dict[int, Node]:
    """The wrapper's node for each node of the page (by ``id``) that has one.  With
    ``grow``, what the wrapper lacks is put into it, after what it follows."""
    known: dict = {}
    found, todo = {id(page): wrapper}, [(wrapper, page)]
    while todo:
        w, p = todo.pop()
        pairs = {j: w.kids[i] for i, j in match(w, p, known)[1]}
        if grow:
            known = {}  # places change
            last = None
            for j, kid in enumerate(p.kids):
                if j not in pairs:
                    at = next((k for k, x in enumerate(w.kids) if x is last), -1) + 1
                    w.add(at, built(shape(kid)))
                    last = w.kids[at]
                else:
                    last = pairs[j]
        for j, kid in pairs.items():
            found[id(p.kids[j])] = kid
            todo.append((kid, p.kids[j]))
    return found


def numbered(wrapper: Node) -> Node:
    """Numbers for all nodes, from the top in order."""
    todo, n = [wrapper], 0
    while todo:
        node = todo.pop()
        node.number, n = n, n + 1
        todo += node.kids[::-1]
    return wrapper


def united(trees: list[list]) -> list:
    """One tree that has a place for every node of the given ones."""
    wrapper = Node("")
    for tree in trees:
        aligned(wrapper, built(tree), grow=True)
    return shape(wrapper)


def wrapper_of(pages: list[str]) -> list:
    """One tree for all the given pages."""
    return united([shape(Outline(page).root) for page in pages])


def paths(tree: list, above: int = 0) -> Iterator[int]:
    """A hash for each node of a tree, of the signatures that lead to it."""
    own = _digest(f"{above} {tree[0]}")
    yield own
    for kid in tree[1]:
        yield from paths(kid, own)


def pruned(tree: list, wanted: frozenset[int], above: int = 0) -> list | None:
    """A tree without the nodes whose path is not wanted, nor what is below them."""
    own = _digest(f"{above} {tree[0]}")
    if own not in wanted:
        return None
    kids = (pruned(kid, wanted, own) for kid in tree[1])
    return [tree[0], [kid for kid in kids if kid]]


class Host:
    """A host's wrapper and constants, as one task uses them."""

    def __init__(self, wrapper: str | None, constants: list | None):
        self.wrapper = numbered(built(json.loads(wrapper))) if wrapper else None
        self.constants = {(c["node"], c["text"]) for c in constants or ()}
        self._numbers: dict[str, list[int]] = {}

    def numbers(self, page: Page) -> dict[int, int]:
        """The wrapper's number for the nodes of the page that it has."""
        if not self.wrapper:
            return {}
        order, todo = [], [page.root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.kids[::-1]
        form = json.dumps(shape(page.root))
        if form not in self._numbers:  # pages of a host have few shapes
            if len(self._numbers) > 500:
                self._numbers.clear()
            found = aligned(self.wrapper, page.root)
            self._numbers[form] = [found[id(n)].number if id(n) in found else -1 for n in order]
        return {id(node): number for node, number in zip(order, self._numbers[form]) if number >= 0}


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, node, text (a hash; null for any) and whether in an article, with the
    number of pages that have it there."""
    counts: Counter = Counter()
    hosts: dict[str, Host] = {}

    def told() -> pa.RecordBatch:
        columns = zip(*((*key, n) for key, n in counts.items()))
        types = pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()
        names = ["host", "node", "text", "marked", "pages"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in blocks(batches, "html"):
        for host, source, wrapper in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper"))):
            page = Page(source or "")
            own = _host(hosts, host, wrapper, None)
            numbers = own.numbers(page)
            here = set()
            for node, text, marked in page.content():
                if (number := numbers.get(id(node))) is not None:
                    here |= {(host, number, _digest(text), marked), (host, number, None, marked)}
            counts.update(here)
        if len(counts) > 50_000:
            yield told()
            counts.clear()
    if counts:
        yield told()


def _host(hosts: dict, name: str | None, wrapper: str | None, constants: list | None) -> Host:
    if name not in hosts:
        if len(hosts) > 200:
            hosts.clear()
        hosts[name] = Host(wrapper, constants)
    return hosts[name]


def main_text(source: str | None, host: Host) -> str:
    """The text of one page, its host's template taken away.  Where all of it is
    template, as where a host has copies of one page only, nothing is."""
    page = Page(source or "")
    pieces = page.content()
    if host.constants:
        numbers = host.numbers(page)
        slots = [p for p in pieces if (numbers.get(id(p[0])), _digest(p[1])) not in host.constants]
        pieces = slots or pieces
    return " ".join(text for _, text, _ in pieces)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; null if it has none."""
    found = F.regexp_extract(F.trim(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def _small(stored: DataFrame, size: Column) -> DataFrame:
    """Marked for broadcast if what it holds is small."""
    held = stored.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first().n
    return F.broadcast(stored) if held <= BROADCAST_BYTES else stored


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host and shape (a tree as JSON), with the number of pages that have it."""
    counts: Counter = Counter()
    held = 0

    def told() -> pa.RecordBatch:
        hosts, trees = zip(*counts)
        return pa.RecordBatch.from_pydict({"host": hosts, "tree": trees, "pages": list(counts.values())})

    for batch in blocks(batches, "html"):
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if source:
                key = host, json.dumps(shape(Outline(source).root))
                held += 0 if key in counts else len(key[1])
                counts[key] += 1
        if held > SHAPE_BYTES:
            yield told()
            counts.clear()
            held = 0
    if counts:
        yield told()


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host and path of every node, with the number of pages that have it."""
    counts: Counter = Counter()

    def told() -> pa.RecordBatch:
        hosts, places = zip(*counts)
        return pa.RecordBatch.from_pydict({"host": hosts, "path": places, "pages": list(counts.values())})

    for batch in blocks(batches, "tree"):
        for host, tree, pages in zip(*(batch.column(c).to_pylist() for c in ("host", "tree", "pages"))):
            for path in paths(json.loads(tree)):
                counts[host, path] += pages
            if len(counts) > 50_000:
                yield told()
                counts.clear()
    if counts:
        yield told()


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted: dict[str, frozenset[int]] = {}
    for batch in blocks(batches, "tree"):
        trees = []
        for host, tree, often in zip(batch.column("host").to_pylist(), batch.column("tree"), batch.column("often")):
            if host not in wanted:
                if len(wanted) > 200:
                    wanted.clear()
                wanted[host] = frozenset(often.as_py())
            trees.append(json.dumps(pruned(json.loads(tree.as_py()), wanted[host])))
        kept = batch.column("host"), pa.array(trees, pa.string()), batch.column("pages")
        yield pa.RecordBatch.from_arrays(list(kept), names=["host", "tree", "pages"])


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for host, trees, pages in zip(batch.column("host"), batch.column("trees"), batch.column("pages")):
            tree = json.dumps(united([json.loads(tree) for tree in trees.as_py()]))
            yield pa.RecordBatch.from_pydict({"host": [host.as_py()], "tree": [tree], "pages": [pages.as_py()]})


TREE = "host string, tree string, pages long"


def wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (a tree as JSON) of every host, from all of its pages;
    ``pages`` has host and html.  Stored.

    Nodes on fewer than ``LEAST_PAGES`` pages are left out: no text is constant there.
    A host's trees are united about ``UNITED`` at a time, the most frequent ones first,
    until one is left, so no task holds all shapes of a host.
    """
    shapes = stage(
        pages.filter("host is not null").select("host", "html").mapInArrow(_shapes, TREE)
        .groupBy("host", "tree").agg(F.sum("pages").alias("pages")),
        "shapes",
    )
    often = stage(
        shapes.mapInArrow(_places, "host string, path long, pages long")
        .groupBy("host", "path").agg(F.sum("pages").alias("pages"))
        .filter(F.col("pages") >= LEAST_PAGES)
        .groupBy("host").agg(F.collect_list("path").alias("often")),
        "frequent-nodes",
    )
    size = F.octet_length("host") + 8 * F.size("often")
    trees = stage(
        shapes.join(_small(often, size), "host").mapInArrow(_pruned, TREE)
        .groupBy("host", "tree").agg(F.sum("pages").alias("pages")),
        "trees",
    )
    while True:
        held = stage(trees.groupBy("host").agg(F.count("*").alias("held")), "trees-held")
        if (held.agg(F.max("held").alias("most")).first().most or 0) <= 1:
            return trees.select("host", F.col("tree").alias("wrapper"))
        part = F.pmod(F.xxhash64("tree"), F.ceil(F.col("held") / UNITED)).alias("part")
        in_order = F.array_sort(F.collect_list(F.struct((-F.col("pages")).alias("rare"), "tree")))
        lists = (
            trees.join(_small(held, F.octet_length("host") + 8), "host")
            .select("host", part, "tree", "pages")
            .groupBy("host", "part")
            .agg(F.transform(in_order, lambda t: t["tree"]).alias("trees"), F.sum("pages").alias("pages"))
            .drop("part")
        )
        trees = stage(lists.mapInArrow(_united, TREE), "trees")


def templates(pages: DataFrame, made: DataFrame) -> DataFrame:
    """``host`` and ``constants``: the texts that stand at one node of the wrapper on most
    of the host's pages.  Counted over all pages; stored."""
    size = F.octet_length("host") + F.octet_length("wrapper")
    rows = pages.select("host", "html").join(_small(made, size), "host")
    counted = stage(
        rows.mapInArrow(_seen, "host string, node long, text long, marked boolean, pages long")
        .groupBy("host", "node", "text", "marked")
        .agg(F.sum("pages").alias("pages")),
        "template-counts",
    )
    everywhere = counted.filter("text is null").select("host", "node", "marked", F.col("pages").alias("all_pages"))
    share = F.when(F.col("marked"), SHARE_IN_ARTICLE).otherwise(SHARE)
    often = (
        counted.filter(F.col("text").isNotNull() & (F.col("pages") >= LEAST_PAGES))
        .join(everywhere, ["host", "node", "marked"])
        .filter(F.col("pages") >= share * F.col("all_pages"))
    )
    return stage(
        often.groupBy("host").agg(F.collect_list(F.struct("node", "text")).alias("constants")), "templates"
    )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id and address columns, ``text`` and ``n_chars``.

    The text is the article's: character references decoded, white space inside a block
    one space, blocks in page order joined by one space.  Null or empty html, and a page
    without an article's text, give an empty text.  Pages without a host (null or odd
    addresses) are read without a wrapper, and hosts of fewer than ``LEAST_PAGES`` pages
    have no constants.  Repeated rows are pages of their own; ids may be null or
    repeated.  An empty table gives no rows.  Other columns are not read.
    """
    id_kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    made = wrappers(rows)
    constants = templates(rows, made)
    known = made.join(constants, "host")  # of the others no wrapper is needed
    known = stage(known, "page-templates")
    size = F.octet_length("host") + F.octet_length("wrapper") + 16 * F.size("constants")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str, Host] = {}
        for batch in blocks(batches, "html"):
            texts = []
            columns = (batch.column(c) for c in ("host", "html", "wrapper", "constants"))
            for host, source, wrapper, own in zip(*columns):
                known = hosts.get(host.as_py()) or _host(hosts, host.as_py(), wrapper.as_py(), own.as_py())
                texts.append(main_text(source.as_py(), known))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["id", "url", "text", "n_chars"],
            )

    joined = rows.join(_small(known, size), "host", "left")
    found = joined.mapInArrow(run, f"id {id_kind}, url {url_kind}, text string, n_chars long")
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
