"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page is read as a stream of block tags and text; inline tags are part of the text. Streams of one
host are aligned, iteratively: where both have the same tag it stays required, a part that only one of
them has becomes optional, neighbouring parts with the same tags become one repeated group, and
different texts at one place become a text slot. The result is a union-free regular expression
``( .. )?``, ``( .. )+`` over tags and slots, kept as a tree. It records for each slot how many pages
have it, whether its text differs between pages, and how much of it is links.

A slot is main text if it is inside the article or main element (where the wrapper has one with text),
not under a menu, header, footer, sidebar, form, advert, notice, comment section or the like (by tag,
role, class or id; inside an article a word of a longer name decides only if the wrapper shows the place to be
the same on all pages or links; a form that holds most of a page's text is its body), and, outside an article element, neither mostly links nor the same on all of three
or more different pages (pages with the same texts are copies of one). Pages are read again with their host's wrapper; parts that it does not have follow
their own tags.

Inference adds up partial wrappers per task, then per host and salt, then per host, so that a host
with a third of all pages is spread over all tasks. Pages are read at any depth; a wrapper has
``MAX_DEPTH`` levels and at most ``MAX_NODES`` nodes: what is deeper is cut, leaving its totals. Where a
host's wrapper is cut, the same rules are decided by an aggregation over host and path (labels from the
root, with the number of the run among its neighbours). The wrapper table is broadcast only if
its measured size is below ``BROADCAST_BYTES``, and joined otherwise.

Null or empty html gives the empty text. A page without a url belongs to the host "". Unclosed tags
and cut pages are read to their end.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidepool.llm.rows import map_rows
from tidepool.session import stage_table

MAX_NODES, MAX_DEPTH, MAX_PERIOD = 3_000, 100, 3
ALIGN_CELLS = 250_000
BROADCAST_BYTES = 32 << 20
SALTS = 64
HELD_HOSTS = 2_000
FEW_PAGES = 3

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.DOTALL)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas select".split())
RAW_ENDS = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}
RAW_NEXT = {tag: re.compile(rf"<(/?){tag}\b", re.IGNORECASE | re.ASCII) for tag in RAW}
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s
samp small span strike strong sub sup time tt u var""".split())
IN_HEAD = frozenset("title meta link base script style noscript template".split())
#: An element that ends an open element of these names, as HTML lets their end tags be left out.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section main div body nav aside footer header form".split())
OTHER_TAGS = frozenset("head nav aside footer form menu dialog button fieldset".split()) | RAW
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
OTHER_NAMES = frozenset("""nav navbar navigation menu masthead footer sidebar aside ad ads advert adverts advertisement
banner promo promoted sponsor sponsored cookie cookies consent notice notices gdpr comment comments disqus replies share
sharing social related recommended breadcrumb breadcrumbs pager pagination popup modal overlay newsletter subscribe
subscription signup login toolbar widget widgets copyright legal""".split())
#: Names that are enough inside an article if they are the whole name; others are only suspected there.
SURE_NAMES = frozenset("""nav navbar navigation masthead footer sidebar ad ads advert adverts advertisement cookie cookies gdpr
comments disqus breadcrumb breadcrumbs pager pagination newsletter popup modal promoted sponsored""".split())
KEPT, SUSPECTED, OTHER = 0, 1, 2
#: A form with one of these and most of a page's text is the page's body.
BODY_TAGS = frozenset("article main h1 p".split())
SLOT, GROUP = "#", "()"


class Node:
    """An element of a page, or of a wrapper: label, quantifier, children; slots carry counts."""

    __slots__ = ("article", "children", "cut", "label", "links", "pages", "repeated", "size", "optional", "mark", "varies", "texts")

    def __init__(self, label: str):
        self.label, self.children = label, []
        self.optional = self.repeated = self.varies = False
        self.cut = self.article = False
        self.size, self.links, self.mark = 0, 0, ""
        #: Of a slot: marks of different pages that have it, the FEW_PAGES smallest of them.
        self.pages: tuple[int, ...] = ()
        self.texts: list[str] = []

    def dump(self) -> list:
        flags = self.optional + 2 * self.repeated + 4 * self.varies + 8 * self.cut + 16 * self.article
        return [self.label, flags, self.pages, self.size, self.links, self.mark, [c.dump() for c in self.children]]

    @staticmethod
    def load(data: list) -> Node:
        node = Node(data[0])
        node.optional, node.repeated, node.varies = bool(data[1] & 1), bool(data[1] & 2), bool(data[1] & 4)
        node.cut, node.article = bool(data[1] & 8), bool(data[1] & 16)
        node.pages, node.size, node.links, node.mark = tuple(data[2]), *data[3:6]
        node.children = [Node.load(c) for c in data[6]]
        return node

    def expression(self) -> str:
        """The wrapper as a regular expression over tags and slots."""
        if self.label == SLOT:
            body = "#TEXT" if self.varies else "#SAME"
        elif self.label == GROUP:
            body = "".join(c.expression() for c in self.children)
        else:
            body = f"<{self.label}>" + "".join(c.expression() for c in self.children) + "</>"
        mark = {(0, 0): "", (1, 0): "?", (0, 1): "+", (1, 1): "*"}[self.optional, self.repeated]
        return f"({body}){mark}" if mark else body


def _label(tag: str, attributes: str) -> str:
    """Tag, then role, class and id names that can tell what an element is for."""
    names = []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role":
            names.append(f"@{value}")
        elif name in ("class", "id"):
            names += sorted({re.sub(r"\d+", "", x) for x in value.split()})
        elif name == "hidden" or value == "true":
            names.append("@hidden")
    return " ".join([tag, *names])


def _inside_article(label: str) -> bool:
    parts = label.split(" ")
    return parts[0] in ("article", "main") or "@main" in parts or "@article" in parts


@lru_cache(maxsize=100_000)
def kind_of(label: str, in_article: bool) -> int:
    """Whether an element is page furniture by its own tag, role, class or id, or only suspected of it.

    Inside an article a word in a longer name, or a word that articles use themselves, decides nothing alone.
    """
    tag, *names = label.split(" ")
    if tag in OTHER_TAGS or tag == "header" and not in_article:
        return OTHER
    found = KEPT
    for name in names:
        if name.startswith("@"):
            if name[1:] in OTHER_ROLES or name == "@hidden":
                return OTHER
        elif tag not in ("html", "body", "article", "main"):
            parts = re.split(r"[-_]+", name)
            if not in_article and ("header" in parts or not OTHER_NAMES.isdisjoint(parts)) or name in SURE_NAMES:
                return OTHER
            if not OTHER_NAMES.isdisjoint(parts):
                found = SUSPECTED
    return found


class _Reader:
    """Builds the tree of a page from its tag stream."""

    def __init__(self):
        self.root = Node("")
        self.stack = [self.root]
        self.open: Counter[str] = Counter()
        self.run: list[str] = []
        self.link_from: int | None = None
        self.linked = 0

    def flush(self) -> None:
        text = " ".join(entities.unescape("".join(self.run)).split())
        if text:
            slot = Node(SLOT)
            slot.texts, slot.size = [text], len(text)
            if self.link_from is not None:
                self.linked += sum(map(len, self.run[self.link_from:]))
            slot.links = min(self.linked, len(text))
            self.stack[-1].children.append(slot)
        self.run, self.linked = [], 0
        self.link_from = None if self.link_from is None else 0

    def close(self, names: set[str], scopes: frozenset = SCOPES) -> None:
        """End the innermost open element of these names inside the scope, and what is in it."""
        if not any(self.open[name] for name in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].label.partition(" ")[0]
            if tag in names:
                self.flush()
                self.open.subtract(n.label.partition(" ")[0] for n in self.stack[i:])
                del self.stack[i:]
                return
            if tag in scopes:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.link_from = len(self.run)
            return
        if tag in VOID:
            if tag == "br" or tag == "hr":
                self.run.append(" ")
            return
        if tag not in IN_HEAD and tag not in ("html", "head"):
            self.close({"head"}, frozenset())
        if tag in ENDS:
            self.close(ENDS[tag])
        else:
            self.close({"p"})
        self.flush()
        node = Node(_label(tag, attributes))
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.open[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "a" and self.link_from is not None:
            self.linked += sum(map(len, self.run[self.link_from:]))
            self.link_from = None
        if tag not in INLINE and tag not in VOID:
            self.close({tag}, frozenset() if tag in SCOPES else SCOPES)


def _has_end(tag: str, text: str, at: int) -> bool:
    """Whether the next tag of this name is an end tag."""
    m = RAW_NEXT[tag].search(text, at)
    return bool(m and m[1])


def read_page(source: str | None) -> Node:
    """The tree of block elements and texts of a page."""
    reader, at, text = _Reader(), 0, source or ""
    while True:
        m = TAG.search(text, at)
        reader.run.append(text[at:m.start() if m else len(text)])
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, attributes = name.lower(), m[3] if m[2] else m[6]
        if m[1] or m[4]:
            reader.end(tag)
        elif tag in RAW:
            if tag in ("iframe", "svg", "math", "canvas", "object", "select"):
                reader.flush()
            if attributes.rstrip().endswith("/") and (tag in ("svg", "math") or not _has_end(tag, text, at)):
                continue  # it ends itself
            end = RAW_ENDS[tag].search(text, at)
            stop = end.start() if end else -1
            if stop < 0 and tag in ("title", "textarea"):
                stop = text.find("<", at)  # left open: it ends at the next tag
            at = len(text) if stop < 0 else stop
        else:
            reader.start(tag, attributes)
    reader.flush()
    return reader.root


def _totals(node: Node) -> tuple[int, int]:
    """Characters of text, and of those in links, in an element."""
    size, links, todo = 0, 0, [node]
    while todo:
        n = todo.pop()
        size, links = size + n.size, links + n.links
        todo += n.children
    return size, links


def cut_below(node: Node) -> None:
    """Forget what is in an element, but for its totals and whether an article with text is there."""
    if node.children:
        node.article = node.article or any(map(_has_article, node.children))
        node.size, node.links = _totals(node)
        node.children, node.cut = [], True


def page_mark(page: Node) -> int:
    """Pages with the same texts are copies of one page."""
    digest, todo = blake2b(digest_size=6), [page]
    while todo:
        node = todo.pop()
        for text in node.texts:
            digest.update(text.encode("utf-8", "surrogatepass") + b"\0")
        todo += reversed(node.children)
    return int.from_bytes(digest.digest())


def as_wrapper(page: Node, depth: int = 0, mark: int | None = None) -> Node:
    """The expression of a single page: repeated neighbours folded, texts replaced by slots."""
    mark = page_mark(page) if mark is None else mark
    node = Node(page.label)
    node.size, node.links = page.size, page.links
    if page.label == SLOT:
        node.mark = blake2b(page.texts[0].encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()
        node.pages = (mark,)
    if depth == MAX_DEPTH:
        node.children = page.children
        cut_below(node)
    else:
        node.children = fold([as_wrapper(c, depth + 1, mark) for c in page.children])
    return node


def _same(a: Node, b: Node) -> bool:
    if a.label != b.label:
        return False
    return a.label != GROUP or [c.label for c in a.children] == [c.label for c in b.children]


def fold(children: list[Node]) -> list[Node]:
    """Neighbouring runs of the same tags become one repeated element or group."""
    for period in range(1, MAX_PERIOD + 1):
        out: list[Node] = []
        for child in children:
            out.append(child)
            while len(out) >= 2 * period and all(_same(out[-i], out[-i - period]) for i in range(1, period + 1)):
                second, first = out[-period:], out[-2 * period:-period]
                del out[-2 * period:]
                merged = [join(a, b) for a, b in zip(first, second, strict=True)]
                if period == 1:
                    merged[0].repeated = True
                    out += merged
                else:
                    group = Node(GROUP)
                    group.children, group.repeated = merged, True
                    out.append(group)
            if period > 1 and len(out) > period and out[-period - 1].label == GROUP:
                group, tail = out[-period - 1], out[-period:]
                if len(group.children) == period and all(map(_same, group.children, tail)):
                    group.children = [join(a, b) for a, b in zip(group.children, tail, strict=True)]
                    del out[-period:]
        children = out
    return children


def join(a: Node, b: Node) -> Node:
    """One element for two aligned ones."""
    node = Node(a.label)
    node.optional, node.repeated = a.optional or b.optional, a.repeated or b.repeated
    node.pages = a.pages if a.pages == b.pages else tuple(sorted({*a.pages, *b.pages})[:FEW_PAGES])
    node.size, node.links = a.size + b.size, a.links + b.links
    node.mark, node.varies = a.mark, a.varies or b.varies or a.mark != b.mark
    node.cut, node.article = a.cut or b.cut, a.article or b.article
    if node.cut:
        node.children = [*a.children, *b.children]
        cut_below(node)
    else:
        node.children = align(a.children, b.children)
    return node


def _optional(node: Node) -> Node:
    node.optional = True
    return node


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Common subsequence of two streams; what only one has becomes optional."""
    if len(a) == len(b) and all(map(_same, a, b)):
        return [join(x, y) for x, y in zip(a, b, strict=True)]
    head = 0
    while head < min(len(a), len(b)) and _same(a[head], b[head]):
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and _same(a[-1 - tail], b[-1 - tail]):
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    out = [join(p, q) for p, q in zip(a[:head], b[:head], strict=True)]
    i = j = 0
    for p, q in _common(x, y):
        out += [_optional(n) for n in x[i:p]] + [_optional(n) for n in y[j:q]] + [join(x[p], y[q])]
        i, j = p + 1, q + 1
    out += [_optional(n) for n in x[i:]] + [_optional(n) for n in y[j:]]
    out += [join(p, q) for p, q in zip(a[len(a) - tail:], b[len(b) - tail:], strict=True)]
    return fold(out)


def _common(x: list[Node], y: list[Node]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; of very long streams, the greedy one."""
    if len(x) * len(y) > ALIGN_CELLS:
        found, j = [], 0
        places: dict[str, list[int]] = {}
        for q, node in enumerate(y):
            places.setdefault(node.label, []).append(q)
        for p, node in enumerate(x):
            q = next((q for q in places.get(node.label, ()) if q >= j and _same(node, y[q])), None)
            if q is not None and q - j <= 8:
                found.append((p, q))
                j = q + 1
        return found
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for p in range(len(x) - 1, -1, -1):
        for q in range(len(y) - 1, -1, -1):
            best[p][q] = best[p + 1][q + 1] + 1 if _same(x[p], y[q]) else max(best[p + 1][q], best[p][q + 1])
    found, p, q = [], 0, 0
    while p < len(x) and q < len(y):
        if _same(x[p], y[q]) and best[p][q] == best[p + 1][q + 1] + 1:
            found.append((p, q))
            p, q = p + 1, q + 1
        elif best[p + 1][q] >= best[p][q + 1]:
            p += 1
        else:
            q += 1
    return found


def shrink(wrapper: Node) -> Node:
    """Cut the deepest levels until the wrapper is of bounded size; what was below is read from the spilled paths."""
    levels, nodes = [], [wrapper]
    while nodes:
        levels.append(nodes)
        nodes = [c for n in nodes for c in _flat(n.children)]
    if sum(map(len, levels)) <= MAX_NODES:
        return wrapper
    total = 0
    for depth, nodes in enumerate(levels):
        total += len(nodes)
        if total > MAX_NODES:
            break
    for node in levels[max(depth - 1, 0)]:
        cut_below(node)
    return wrapper


def _any_cut(wrapper: Node) -> bool:
    todo = [wrapper]
    while todo:
        node = todo.pop()
        if node.cut:
            return True
        todo += node.children
    return False


def _has_article(node: Node) -> bool:
    todo = [(node, False)]
    while todo:
        n, inside = todo.pop()
        inside = inside or _inside_article(n.label)
        if n.article or inside and n.size > 0:
            return True
        todo += [(c, inside) for c in n.children]
    return False


def _is_template(node: Node) -> bool:
    """Mostly links, or one and the same on every one of several pages."""
    if node.label == SLOT:
        return node.links * 2 > node.size or not node.varies and len(node.pages) >= FEW_PAGES
    return False


def _mostly_links(node: Node) -> bool:
    size, links = _totals(node)
    return links * 2 > size > 0


def _is_furniture(node: Node, place: Node | None) -> bool:
    """Whether a suspected element is furniture by what the wrapper knows of its place: the same on all pages, or links."""
    if _mostly_links(node) or place is not None and _mostly_links(place):
        return True
    todo, slots = [place] if place is not None else [], []
    while todo:
        n = todo.pop()
        if n.cut:
            return False
        slots += [n] if n.label == SLOT else []
        todo += n.children
    return bool(slots) and all(map(_is_template, slots))


def _is_body(form: Node, totals: dict[int, tuple[int, int]], page: Node) -> bool:
    """Whether a form holds most of a page's text, with paragraphs or an article: then it is no form to fill in."""
    if form.label.split(" ")[0] != "form" or totals[id(form)][0] * 2 <= totals[id(page)][0]:
        return False
    todo = [form]
    while todo:
        n = todo.pop()
        if n.label.split(" ")[0] in BODY_TAGS:
            return True
        todo += n.children
    return False


def _flat(nodes: list[Node]) -> list[Node]:
    return [n for node in nodes for n in (_flat(node.children) if node.label == GROUP else [node])]


def _path(parent: int, label: str, run: int) -> int:
    """Place of an element or slot: its parent's, its label, and which run of that label it is in there."""
    return xxh64_intdigest(f"{parent} {run} {label}".encode("utf-8", "surrogatepass")) - (1 << 63)


def _element_totals(page: Node) -> dict[int, tuple[int, int]]:
    """By identity: characters of text, and of those in links, in every element and slot."""
    order, todo = [], [page]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.children
    out: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        inner = [out[id(c)] for c in node.children]
        out[id(node)] = node.size + sum(s for s, _ in inner), node.links + sum(k for _, k in inner)
    return out


def main_text(page: Node, wrapper: Node | None, dropped: frozenset[int] | None = None,
              record: Callable[[int, Node], None] | None = None) -> str:
    """The blocks of a page that its host's wrapper marks as main text, joined by one space.

    Where the wrapper is cut, the paths in ``dropped`` are template; ``record`` is told those met there.
    """
    out: list[str] = []
    wanted = wrapper is not None and _has_article(wrapper) and _has_article(page) or wrapper is None and _has_article(page)
    tracked = dropped is not None or record is not None
    totals: dict[int, tuple[int, int]] = {}

    def frame(node: Node, place: Node | None, inside: bool, path: int, lost: bool) -> list:
        """Children to come, the wrapper's places for them, the last place met; runs of each label so far, the last label."""
        flat = _flat(place.children) if place else []
        return [iter(node.children), flat, 0, inside, path, lost or tracked and place is not None and place.cut, Counter(), None]

    todo = [frame(page, wrapper, False, 0, False)]
    while todo:
        children, flat, at, in_article, path, lost, runs, before = todo[-1]
        child = next(children, None)
        if child is None:
            todo.pop()
            continue
        if tracked:
            if child.label != before:
                runs[child.label] += 1
                todo[-1][7] = child.label
            path = _path(path, child.label, runs[child.label])
        order = [*range(at, len(flat)), *range(at)]
        found = next((i for i in order if flat[i].label == child.label), None)
        place = None if found is None else flat[found]
        if found is not None:
            todo[-1][2] = found
        inside = in_article or _inside_article(child.label)
        kind = KEPT if child.label == SLOT else kind_of(child.label, in_article)
        if kind == OTHER and child.label.startswith("form"):
            totals = totals or _element_totals(page)
            kind = KEPT if _is_body(child, totals, page) else OTHER
        if kind == OTHER or kind == SUSPECTED and _is_furniture(child, place):
            continue
        if lost and not inside and record:
            record(path, child)
        template = lost and dropped is not None and path in dropped
        if child.label == SLOT:
            template = template or place and _is_template(place)
            if in_article or not wanted and not template and child.links * 2 <= child.size:
                out.extend(child.texts)
            continue
        template = template or place and _mostly_links(place)
        if inside or not template or record:
            todo.append(frame(child, place, inside, path, lost))
    return " ".join(out)


def _dumped(wrapper: Node) -> str:
    return json.dumps(shrink(wrapper).dump(), ensure_ascii=False, separators=(",", ":"))


def _partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of the pages of one task, per host."""
    held: dict[str, Node] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([_dumped(w) for w in held.values()], pa.string())],
            names=["host", "wrapper"])

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            wrapper = as_wrapper(read_page(source))
            held[host] = shrink(join(held[host], wrapper)) if host in held else wrapper
            if len(held) >= HELD_HOSTS:
                yield out()
                held.clear()
    yield out()


def _met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes and text hashes by path, of what lies where a host's wrapper is cut."""
    names = ["host", "page", "copy", "path", "size", "links", "text"]
    types = [pa.string(), *[pa.int64()] * 6]

    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("host", "page", "html", "wrapper"))
        for host, number, source, wrapper in zip(*columns, strict=True):
            page = read_page(source)
            copy, totals, rows = page_mark(page), _element_totals(page), []

            def record(path: int, node: Node) -> None:
                text = xxh64_intdigest(node.texts[0].encode("utf-8", "surrogatepass")) - (1 << 63) if node.texts else None
                rows.append((host, number, copy, path, *totals[id(node)], text))

            main_text(page, _loaded(wrapper), None, record)
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def template_paths(pages: DataFrame) -> DataFrame:
    """(__host, __page, dropped): paths of a page that are template, for pages (host, page, html, wrapper) whose wrapper is cut.

    The rules are those for the wrapper's places, counted over all pages of a host.
    """
    met = stage_table(pages.mapInArrow(_met, "host string, page long, copy long, path long, size long, links long, text long"), "paths")
    counts = met.groupBy("host", "path").agg(
        F.sum("size").alias("size"), F.sum("links").alias("links"), F.min("text").alias("low"), F.max("text").alias("high"),
        F.count_distinct("copy").alias("copies"))
    template = counts.where((F.col("links") * 2 > F.col("size")) | (F.col("low") == F.col("high")) & (F.col("copies") >= FEW_PAGES))
    own = met.select("host", "page", "path").distinct().join(template.select("host", "path"), ["host", "path"], "left_semi")
    return own.groupBy(F.col("host").alias("__host"), F.col("page").alias("__page")).agg(F.collect_set("path").alias("dropped"))


def _combined(rows):
    """One wrapper for the partial wrappers of a group."""
    import pandas as pd

    total = None
    for text in sorted(rows["wrapper"]):
        wrapper = Node.load(json.loads(text))
        total = wrapper if total is None else shrink(join(total, wrapper))
    text = _dumped(total)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [text], "cut": [_any_cut(total)]})


def infer_wrappers(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(host, wrapper, cut): the expression of each host as text, and whether parts of it were cut."""
    schema = "host string, wrapper string"
    parts = (pages.where(F.col(html).isNotNull()).select(F.col(host).alias("host"), F.col(html).alias("html"))
             .mapInArrow(_partial, schema))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    fewer = salted.groupBy("host", "salt").applyInPandas(_combined, f"{schema}, cut boolean")
    return fewer.groupBy("host").applyInPandas(_combined, f"{schema}, cut boolean")


@lru_cache(maxsize=256)
def _loaded(text: str) -> Node:
    return Node.load(json.loads(text))


def host_of(url: str):
    """Host part of an absolute URL, lower-cased; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1), F.lit(""))


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars): the main text of every page."""
    slim = pages.select(F.col(key), F.col(url), F.col(html).alias("__html"), host_of(url).alias("__host"))
    wrappers = stage_table(infer_wrappers(slim, "__host", "__html"), "wrappers").withColumnRenamed("host", "__host")
    size, cut = wrappers.agg(F.sum(F.length("wrapper") + 64), F.max("cut")).first()
    side = F.broadcast(wrappers) if (size or 0) <= BROADCAST_BYTES else wrappers
    joined = slim.join(side, "__host", "left").withColumn("dropped", F.lit(None).cast("array<bigint>"))
    if cut:
        lost = joined.where("cut").drop("dropped").withColumn("__page", F.xxhash64("__html"))
        paths = template_paths(lost.select(F.col("__host").alias("host"), F.col("__page").alias("page"), F.col("__html").alias("html"), "wrapper"))
        lost = lost.join(paths, ["__host", "__page"], "left")
        joined = joined.where("NOT coalesce(cut, false)").unionByName(lost.drop("__page"))

    def make():
        def run(values):
            texts = [main_text(read_page(v["html"]), _loaded(v["wrapper"]) if v["wrapper"] else None,
                               None if v["dropped"] is None else frozenset(v["dropped"])) for v in values]
            return {"text": texts, "n_chars": [len(t) for t in texts]}
        return run

    both = F.struct(F.col("__html").alias("html"), "wrapper", "dropped").alias("__both")
    return map_rows(joined.select(F.col(key), F.col(url), both), "__both", make, "text string, n_chars long")
