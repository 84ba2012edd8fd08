"""HTML extraction with wrappers inferred per host and kind of page.

Pages of a host that name their article alike (by an article element, a main
one, a class or id, or not at all) share a wrapper. A wrapper is a union-free
regular expression over those pages: elements in
order, each with a quantifier (once, optional, repeated), its children, and a
text slot. Pages become such expressions first (neighbouring elements of one
label fold into a repeated group), and expressions are aligned level by level:
labels on a longest common subsequence are merged, the others become
optional. Alignment runs over all pages: within partitions, then over salted
groups of a host, then per host, so a hot host never meets in one task.

Slots carry counts over those pages (text, text in links, whether pages of
different texts always have the same here). They and the labels decide once
per wrapper which part is the article; a page's text is read by aligning it
with its wrapper. A page with little of its text in that part is judged by
its own elements.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from .common import col, fresh, worker_state, written
from .url_filter import host_of

# Elements of HTML and words that name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY_OWN = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
NOISE_TAGS = frozenset(
    "nav footer aside form menu dialog button select input head title script style noscript iframe template "
    "textarea svg math object canvas audio video map".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer foot header masthead topbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login register search share sharing social comment comments commentlist reply replies respond disqus related "
    "recommended recommendations pagination pager toolbar skip hidden copyright tags byline".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
ARTICLE_WORDS = frozenset("article content post entry story main text body maincontent".split())

DEPTH = 150  # deeper elements belong to the one at this depth
HOLDS = 0.2  # share of the text that makes elements the article
NEAR = 4  # siblings back that a repeated group may span
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    """An element of a page or wrapper, with its text slot."""

    __slots__ = ("label", "kids", "optional", "repeated", "pages", "chars", "linked", "same")  # pages: up to 3 different texts' hashes

    def __init__(self, label: str, kids=(), optional=False, repeated=False, pages=(), chars=0, linked=0, same=None):
        self.label, self.kids = label, list(kids)
        self.optional, self.repeated = optional, repeated
        self.pages, self.chars, self.linked, self.same = pages, chars, linked, same

    def pack(self) -> list:
        own = [self.label, int(self.optional), int(self.repeated), self.pages, self.chars, self.linked, self.same]
        return [*own, [k.pack() for k in self.kids]]

    @staticmethod
    def unpack(x: list) -> Node:
        return Node(x[0], [Node.unpack(k) for k in x[7]], bool(x[1]), bool(x[2]), x[3], x[4], x[5], x[6])

    def total(self) -> int:
        return self.chars + sum(k.total() for k in self.kids)


def label_of(tag: str, attributes: str) -> str:
    """Tag with the words of class, id and role, numbers left out."""
    if not attributes:
        return tag
    found = []
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            found.append("hidden")
        elif name == "role":
            found.append("role=" + value.lower())
        elif name in ("class", "id", "itemprop"):
            found += [w.lower() for w in NAME_PARTS.findall(value) if not w.isdigit()]
    return tag + "".join("." + w for w in sorted(set(found)))


def parse(page: str) -> tuple[Node, list[tuple[Node, int, str]]]:
    """The page's expression and its text in order: (element, block, text).
    Unclosed and misplaced tags, cut pages and raw elements are borne."""
    root = Node("#root")
    stack, seen = [(root, "#root")], {}
    texts: list[tuple[Node, int, str]] = []
    block, links, at, n = 0, 0, 0, len(page)
    slots: dict[int, int] = {}
    while at < n:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else n]
        if m is None and (cut := text.rfind("<")) >= 0 and re.match(r"</?[a-zA-Z]|<!|<\?", text[cut:]):
            text = text[:cut]
        if text and not text.isspace():
            node = stack[-1][0]
            text = html.unescape(text)
            texts.append((node, block, text))
            size = len(text)
            node.chars += size
            if links:
                node.linked += size
            slots[id(node)] = zlib.crc32(text.strip().encode("utf-8", "surrogatepass"), slots.get(id(node), 0))
            seen[id(node)] = node
        elif text:
            texts.append((stack[-1][0], block, " "))
        if m is None:
            break
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):  # end tag
            if tag in INLINE:
                if tag == "a" and links:
                    links -= 1
                continue
            block += 1
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] == tag:
                    del stack[depth:]
                    links = 0
                    break
            continue
        if tag in INLINE:
            if tag == "a":
                links = 1
            elif tag == "br":
                texts.append((stack[-1][0], block, " "))
            continue
        block += 1
        links = 0
        if tag in CLOSES_P and any(t == "p" for _, t in stack[-3:]):
            while stack[-1][1] != "p":
                stack.pop()
            stack.pop()
        for other in CLOSED_BY_OWN.get(tag, ()):
            for depth in range(len(stack) - 1, max(0, len(stack) - 4), -1):
                if stack[depth][1] in ("ul", "ol", "dl", "table"):
                    break
                if stack[depth][1] == other:
                    del stack[depth:]
                    break
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            continue
        parent = stack[-1][0]
        if len(stack) >= DEPTH:
            stack.append((parent, tag))
            continue
        label = label_of(tag, m.group(3))
        # A group repeats where its label comes again among the last siblings.
        node = next((k for k in reversed(parent.kids[-NEAR:]) if k.label == label), None)
        if node is None:
            node = Node(label)
            parent.kids.append(node)
        else:
            node.repeated = True
        stack.append((node, tag))
    for key, node in seen.items():
        node.same = slots[key]
    return root, texts


def aligned(a: list[Node], b: list[Node]) -> list[tuple[int | None, int | None]]:
    """Positions of both lists in one order; equal labels on a longest common subsequence meet."""
    if [k.label for k in a] == [k.label for k in b]:
        return [(i, i) for i in range(len(a))]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].label == b[j].label else max(best[i + 1][j], best[i][j + 1])
    out: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < n and j < m:
        if a[i].label == b[j].label:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out + [(x, None) for x in range(i, n)] + [(None, y) for y in range(j, m)]


def merge(a: Node, b: Node) -> Node:
    """The expression that fits what either fits. Changes and returns ``a``."""
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.same = a.same if a.same == b.same else -1 if a.same is not None and b.same is not None else (a.same or b.same)
    if len(a.pages) < 3 and a.pages != b.pages:
        a.pages = sorted({*a.pages, *b.pages})[:3]
    a.chars, a.linked = a.chars + b.chars, a.linked + b.linked
    kids = []
    for i, j in aligned(a.kids, b.kids):
        if i is not None and j is not None:
            kids.append(merge(a.kids[i], b.kids[j]))
        else:
            one = a.kids[i] if i is not None else b.kids[j]
            one.optional = True
            kids.append(one)
    # Groups that came to stand near one of their label are one repeated group.
    a.kids = []
    for k in kids:
        twin = next((x for x in reversed(a.kids[-NEAR:]) if x.label == k.label), None)
        if twin is None:
            a.kids.append(k)
        else:
            merge(twin, k).repeated = True
    return a


def noise(label: str, inside: bool) -> bool:
    """Whether an element of this label is no part of an article (``inside``: it lies within one)."""
    tag, *words = label.split(".")
    if tag in NOISE_TAGS or tag == "header" and not inside:
        return True
    if any(w in NOISE_WORDS or w.startswith("role=") and w[5:] in NOISE_ROLES for w in words):
        return tag not in ("html", "body", "article", "main") or "comment" in words
    return False


KINDS = (
    lambda k: k.label.split(".")[0] == "article" or "articlebody" in k.label.replace(".", ""),
    lambda k: k.label.split(".")[0] == "main" or ".role=main" in k.label,
    lambda k: bool(ARTICLE_WORDS & set(k.label.split(".")[1:])),
)


def size(node: Node) -> int:
    """Text outside links and noise."""
    return node.chars - node.linked + sum(size(k) for k in node.kids if not noise(k.label, True))


def tops(root: Node, wanted: Callable[[Node], bool]) -> list[Node]:
    """The outermost wanted elements with text."""

    def find(node: Node) -> Iterator[Node]:
        for k in node.kids:
            if noise(k.label, False):
                continue
            if wanted(k):
                yield k
            else:
                yield from find(k)

    return [k for k in find(root) if size(k) > 0]


def kind_of(page: Node) -> int:
    """The first of ``KINDS`` that the page has; their number where it has none."""
    return next((i for i, wanted in enumerate(KINDS) if tops(page, wanted)), len(KINDS))


def article_nodes(wrapper: Node) -> list[Node]:
    """The elements of a wrapper or page that hold the article."""
    whole = size(wrapper) or 1
    for wanted in KINDS:
        found = tops(wrapper, wanted)
        if found and sum(map(size, found)) >= HOLDS * whole:
            return found
    node = wrapper
    while True:  # the smallest element that holds nearly all of the text
        kids = [k for k in node.kids if not noise(k.label, False)]
        best = max(kids, key=size, default=None)
        if best is None or size(best) < 0.7 * size(node) or best.label.split(".")[0] in ("p", "li", "h1", "h2"):
            return [node]
        node = best


def prepared(packed: str) -> dict[str, tuple[Node, list[Node], set[int], set[int]]]:
    """By kind, a host's wrapper, its article's elements, its lists of links
    and its text that never changes; remembered for some hosts."""
    made = worker_state().setdefault("wrappers", {})
    if packed not in made:
        if len(made) >= 512:
            made.clear()
        made[packed] = {kind: _prepare(x) for kind, x in json.loads(packed).items()}
    return made[packed]


def _prepare(packed: list) -> tuple[Node, list[Node], set[int], set[int]]:
    wrapper = Node.unpack(packed)
    lists, fixed = set(), set()

    def mark(node: Node) -> tuple[int, int]:
        total, linked = node.chars, node.linked
        for k in node.kids:
            of_kid = mark(k)
            total, linked = total + of_kid[0], linked + of_kid[1]
        if total and linked > 0.6 * total:
            lists.add(id(node))
        if len(node.pages) >= 3 and node.same not in (None, -1) and not node.kids and not node.repeated:
            fixed.add(id(node))
        return total, linked

    mark(wrapper)
    return wrapper, article_nodes(wrapper), lists, fixed


def extract(page: str, packed: str) -> str:
    """The page's article by the wrapper of its kind: one line per block."""
    root, texts = parse(page)
    wrapper, article, lists, fixed = prepared(packed)[str(kind_of(root))]
    twins: dict[int, Node | None] = {}

    def match(node: Node, model: Node | None) -> None:
        twins[id(node)] = model
        pairs = aligned(node.kids, model.kids) if model is not None else [(i, None) for i in range(len(node.kids))]
        for i, j in pairs:
            if i is None:
                continue
            kid = node.kids[i]
            twin = model.kids[j] if j is not None else None
            if twin is None and model is not None:
                twin = next((k for k in model.kids if k.label == kid.label), None)
            match(kid, twin)

    match(root, wrapper)
    chosen = {id(t) for t in article}

    def held(node: Node) -> list[Node]:
        if id(twins[id(node)]) in chosen:
            return [node]
        return [x for k in node.kids if not noise(k.label, False) for x in held(k)]

    own = held(root)
    if sum(map(size, own)) < HOLDS * size(root):  # unlike the other pages
        own = article = article_nodes(root)
    begins = {id(x) for x in own}
    named = any(t.label.split(".")[0] in ("article", "main") for t in article)

    def wanted(leave: set[int]) -> set[int]:
        """The page's elements whose own text belongs to the article."""
        found = set()

        def mark(node: Node, inside: bool) -> None:
            if inside:
                found.add(id(node))
            for k in node.kids:
                inner = (inside or id(k) in begins) and not noise(k.label, inside)
                if inner and inside and not named:
                    # Without an article element, lists of links and text that never changes are not the article's.
                    inner = id(twins[id(k)]) not in leave
                mark(k, inner)

        mark(root, id(root) in begins)
        return found

    def chars(of: set[int]) -> int:
        return sum(len(text) for node, _, text in texts if id(node) in of and not text.isspace())

    taken = wanted(lists | fixed)
    if not named and chars(taken) < HOLDS * chars(free := wanted(lists)):
        taken = free  # what never changes is nearly all there is: copies
    blocks: dict[int, list[str]] = {}
    for node, block, text in texts:
        if id(node) in taken:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def stamp(root: Node, texts: list[tuple[Node, int, str]]) -> None:
    """Give the elements of a page the hash of its text outside noise."""
    clean: set[int] = set()
    nodes = []

    def walk(node: Node, inside: bool) -> None:
        nodes.append(node)
        if inside:
            clean.add(id(node))
        for k in node.kids:
            walk(k, inside and not noise(k.label, True))

    walk(root, True)
    said = " ".join("".join(text for node, _, text in texts if id(node) in clean).split())
    of = [zlib.crc32(said.encode("utf-8", "surrogatepass"))]
    for node in nodes:
        node.pages = of


def wrappers(pages: DataFrame, host: str, html_column: str, salts: int = 32) -> DataFrame:
    """(``host``, ``wrapper``) of every host, written to the shared folder:
    its wrappers by kind of page."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % salts
        held: dict[tuple[str, int], Node] = {}

        def out() -> pa.RecordBatch:
            packed = [json.dumps(w.pack(), separators=(",", ":")) for w in held.values()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name for name, _ in held], pa.string()),
                    pa.array([kind for _, kind in held], pa.int32()),
                    pa.array([salt] * len(held), pa.int32()),
                    pa.array(packed, pa.string()),
                ],
                names=["host", "kind", "salt", "wrapper"],
            )

        for batch in batches:
            for name, page in zip(batch["host"].to_pylist(), batch["html"]):
                root, texts = parse(page.as_py())
                stamp(root, texts)
                key = name, kind_of(root)
                held[key] = merge(held[key], root) if key in held else root
                if len(held) >= 2_000:
                    yield out()
                    held.clear()
        if held:
            yield out()

    def merged(packed: list[str]) -> Node:
        packed = sorted(packed)
        whole = Node.unpack(json.loads(packed[0]))
        for x in packed[1:]:
            whole = merge(whole, Node.unpack(json.loads(x)))
        return whole

    def join(key: tuple, group: pa.Table) -> pa.Table:
        whole = json.dumps(merged(group["wrapper"].to_pylist()).pack(), separators=(",", ":"))
        return pa.table({"host": [key[0].as_py()], "kind": pa.array([key[1].as_py()], pa.int32()), "wrapper": [whole]})

    def gather(key: tuple, group: pa.Table) -> pa.Table:
        kinds: dict[int, list[str]] = {}
        for kind, packed in zip(group["kind"].to_pylist(), group["wrapper"].to_pylist()):
            kinds.setdefault(kind, []).append(packed)
        whole = {kind: merged(kinds[kind]).pack() for kind in sorted(kinds)}
        return pa.table({"host": [key[0].as_py()], "wrapper": [json.dumps(whole, separators=(",", ":"))]})

    rows = pages.where(col(html_column).isNotNull()).select(col(host).alias("host"), col(html_column).alias("html"))
    parts = rows.mapInArrow(first, "host string, kind int, salt int, wrapper string")
    salted = parts.groupBy("host", "kind", "salt").applyInArrow(join, "host string, kind int, wrapper string")
    return written(salted.groupBy("host").applyInArrow(gather, "host string, wrapper string"), "wrappers")


def extract_pages(
    pages: DataFrame, url: str = "url", html_column: str = "html", text: str = "text", n_chars: str = "n_chars"
) -> DataFrame:
    """Every row of ``pages`` with its article as ``text`` and the article's
    code points as ``n_chars``.

    A null page, an empty one or one without an article's text gives an empty
    string. Pages without a host (null url, or no ``://``) share the wrappers
    of the empty host. Repeated rows stay; an empty table gives an empty
    result; columns named like a new one are replaced."""
    keep = [c for c in pages.columns if c.lower() not in {text.lower(), n_chars.lower()}]
    host, body, of, wrapper = fresh(pages, "host_", "html_", "of_", "wrapper_")
    named = pages.select(*[col(c) for c in keep], host_of(col(url)).alias(host), col(html_column).alias(body))
    found = wrappers(named, host, body).select(F.col("host").alias(of), F.col("wrapper").alias(wrapper))
    joined = named.join(found, F.col(host) == F.col(of), "left").drop(host, of)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [extract(p, w) if p else "" for p, w in zip(batch[body].to_pylist(), batch[wrapper].to_pylist())]
            rest = batch.drop_columns([body, wrapper])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                names=[*rest.schema.names, text, n_chars],
            )

    kept = [f for f in joined.schema.fields if f.name not in (body, wrapper)]
    return joined.mapInArrow(read, StructType(kept).add(text, StringType()).add(n_chars, LongType()))
