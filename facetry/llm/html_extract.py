"""Main text of web pages by wrapper induction.

For each host one page (the smallest page_id) is the reference. All other pages of the host are aligned to it by simple
tree matching. For each text node of the reference it is counted on how many pages its counterpart has the same text, and
how much text of its own the pages have there. What is constant over the host is the template, the varying slots are
content; the wrapper's content region is the innermost container that holds most of the varying text outside links. Pages
with the reference's article say nothing about the template and don't count.

The text of template nodes goes on every page, within an explicit article too (there, from three pages on, and unless it
would take more than half of the article). A page with an article or main element has its content there, any other page
has it where the wrapper's region is. Menus, headers, footers, sidebars, notices, adverts, forms and comments inside the
content go by tag or role, and by a class (outside headings and running text) all of whose words name such a part.

A host may hold any share of the pages: counts are summed per task before they meet, and the reference pages are
broadcast only if they are small (`broadcast_bytes`), else joined. Parsing and matching use no recursion, so any depth
of nesting will do.

Defined cases: null or empty html gives the empty text; a page without host, or the only one of its host, is extracted by
its own marks; broken markup is closed as browsers do; an incomplete tag at the end is dropped; repeated rows stay.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import written

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*(?:>|\Z)|/?[a-zA-Z][^>]*\Z)""", re.DOTALL)
_ATTRS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")

# Elements by their part in a page, and words in a class or role that name a part other than the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption html body dd dt li".split())
OUT = frozenset("head nav aside footer form button dialog menu script style textarea title noscript template iframe svg select".split())
OUT_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar sidenav ad ads adv advert adverts advertisement advertorial sponsor sponsored promo promotion banner cookie cookies consent notice gdpr comment comments commentlist respond reply replies disqus share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay pagination pager widget toolbar masthead complementary contentinfo alert search".split())
BESIDE_WORDS = frozenset("site page main global top bottom left right inner outer section area box bar block container wrapper wrap list item items links link buttons button form unit slot panel thread row post article user reader footer header fixed sticky mobile desktop".split())
NEVER_BY_CLASS = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body div section main article center table tbody tr td".split())
SAME_CLOSE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


class Node:
    """own: the text outside inner elements; shape and full: equal for equal subtrees, without and with their text; size: nodes; chars: text that isn't out."""

    __slots__ = ("tag", "sig", "out", "kids", "at", "main", "own", "shape", "full", "size", "chars")

    def __init__(self, tag: str, sig: str, out: bool, main: bool):
        self.tag, self.sig, self.out, self.main, self.kids, self.at = tag, sig, out, main, [], -1

    def below(self) -> list[Node]:
        return [k for k in self.kids if type(k) is not str]


def _names_part(value: str) -> bool:
    """Whether a class or role names a part of a page other than the article, by all of its words."""
    for token in value.split():
        words = _WORDS.findall(token)
        if any(w in OUT_WORDS for w in words) and all(w in OUT_WORDS or w in BESIDE_WORDS or w.isdigit() for w in words):
            return True
    return False


def _made(tag: str, attrs: str) -> Node:
    out, main, sig = tag in OUT, tag in ("article", "main"), tag
    if "=" in attrs:
        for name, a, b, c in _ATTRS.findall(attrs):
            value, name = (a or b or c).lower(), name.lower()
            if name != "id":
                sig += "." + value
            if tag in BLOCKS and (tag not in NEVER_BY_CLASS or (tag == "article" and "comment" in value)):
                # an id names a part only of a bare container, and as a whole
                out = out or (value in OUT_WORDS and tag in CONTAINERS if name == "id" else _names_part(value))
            main = main or (name == "role" and value == "main")
    return Node(tag, sig, out, main)


def parse(html: str) -> Node:
    """The element tree; text is decoded, comments and raw elements are left out."""
    root = Node("#root", "#root", False, False)
    stack, at, skip_to = [root], 0, None
    standing: Counter = Counter()
    for m in _TAG.finditer(html):
        if skip_to is not None and m.start() < skip_to:
            continue
        if m.start() > at:
            t = html[at : m.start()]
            stack[-1].kids.append(unescape(t) if "&" in t else t)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1) if standing[tag] else ():
                if stack[i].tag == tag:
                    _cut(stack, i, standing)
                    break
                if stack[i].tag in ("article", "body", "table") and tag not in BLOCKS:
                    break
            continue
        attrs = m[3] or m[6] or ""
        if tag in RAW:
            if not attrs.endswith("/") or tag not in ("svg", "iframe"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = skip_to = end.end() if end else len(html)
            continue
        if standing["p"] and tag in CLOSES_P:
            _close(stack, {"p"}, BLOCKS - {"p"}, standing)
        if tag in SAME_CLOSE:
            _close(stack, SAME_CLOSE[tag], SCOPE[tag], standing)
        if tag == "br":
            stack[-1].kids.append(" ")
            continue
        node = _made(tag, attrs)
        stack[-1].kids.append(node)
        if tag not in VOID:
            stack.append(node)
            standing[tag] += 1
    if at < len(html):
        t = html[at:]
        stack[-1].kids.append(unescape(t) if "&" in t else t)
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.at = len(order)
        order.append(node)
        todo += reversed(node.below())
    for node in reversed(order):
        kids = node.below()
        node.own = " ".join(" ".join([k for k in node.kids if type(k) is str]).split()) if len(kids) < len(node.kids) else ""
        node.shape = hash((node.sig, *[k.shape for k in kids]))
        node.full = hash((node.sig, node.own, *[k.full for k in kids]))
        node.size = 1 + sum([k.size for k in kids])
        node.chars = len(node.own) + sum([k.chars for k in kids if not k.out])
    return root


def _cut(stack: list[Node], i: int, standing: Counter) -> None:
    for n in stack[i:]:
        standing[n.tag] -= 1
    del stack[i:]


def _close(stack: list[Node], tags: set[str], scope, standing: Counter) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            _cut(stack, i, standing)
            return
        if stack[i].tag in scope:
            return


_FEW, _MANY = 400, 4_000_000


def _scores(w: np.ndarray, ix: np.ndarray, iy: np.ndarray, fx: np.ndarray, fy: np.ndarray, whole: bool) -> np.ndarray:
    """Best scores of aligning the first i of x with the first j of y: all rows if `whole`, else the last."""
    row = np.zeros(len(iy) + 1, np.int64)
    rows = np.zeros((len(ix) + 1, len(iy) + 1), np.int64) if whole else None
    for i, (k, f) in enumerate(zip(ix, fx)):
        pair = w[k][iy]
        pair = row[:-1] + np.where(pair > 0, pair + (fy == f), 0)
        row = np.concatenate([[0], np.maximum.accumulate(np.maximum(row[1:], pair))])
        if whole:
            rows[i + 1] = row
    return rows if whole else row


def _aligned(w: np.ndarray, ix: np.ndarray, iy: np.ndarray, fx: np.ndarray, fy: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of the best alignment that keeps order; long lists are halved, so that memory stays in bounds."""
    n, m = len(ix), len(iy)
    if n > 1 and n * m > _MANY:
        h = n // 2
        ahead = _scores(w, ix[:h], iy, fx[:h], fy, False)
        back = _scores(w, ix[h:][::-1], iy[::-1], fx[h:][::-1], fy[::-1], False)[::-1]
        c = int(np.argmax(ahead + back))
        return _aligned(w, ix[:h], iy[:c], fx[:h], fy[:c]) + [(i + h, j + c) for i, j in _aligned(w, ix[h:], iy[c:], fx[h:], fy[c:])]
    t, out = _scores(w, ix, iy, fx, fy, True), []
    while n and m:
        if t[n, m] == t[n - 1, m]:
            n -= 1
        elif t[n, m] == t[n, m - 1]:
            m -= 1
        else:
            n, m = n - 1, m - 1
            out.append((n, m))
    return out[::-1]


def _trimmed(x: list[Node], y: list[Node], key: str) -> tuple[int, int]:
    """How many nodes at the start and at the end agree in `key`; to pair these is part of a best alignment."""
    get, n = attrgetter(key), min(len(x), len(y))
    a = b = 0
    while a < n and get(x[a]) == get(y[a]):
        a += 1
    while b < n - a and get(x[-1 - b]) == get(y[-1 - b]):
        b += 1
    return a, b


class Weights:
    """How many pairs the best matching of two subtrees has; kept by the kinds of subtrees."""

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}

    def get(self, p: Node, q: Node) -> int | None:
        """The weight, if it is plain or known."""
        if p.shape == q.shape:
            return p.size
        return 0 if p.sig != q.sig else self.known.get((p.shape, q.shape))

    def all(self, pairs: list[tuple[Node, Node]]) -> None:
        """Make the weights of these pairs known: those of inner pairs first, by a stack instead of recursion."""
        todo = [(p, q) for p, q in pairs if self.get(p, q) is None]
        while todo:
            p, q = todo[-1]
            if (p.shape, q.shape) in self.known:
                todo.pop()
                continue
            x, y = p.below(), q.below()
            i, j = _trimmed(x, y, "shape")
            sure = sum(k.size for k in x[:i]) + sum(k.size for k in x[len(x) - j :])
            kx, ky = ({k.shape: k for k in z[i : len(z) - j]} for z in (x, y))
            lacking = [(a, b) for a in kx.values() for b in ky.values() if self.get(a, b) is None]
            if lacking:
                todo += lacking
            else:
                self.known[p.shape, q.shape] = 1 + sure + self.best(x[i : len(x) - j], y[i : len(y) - j])
                todo.pop()

    def best(self, x: list[Node], y: list[Node]) -> int:
        if not x or not y:
            return 0
        if len(x) * len(y) > _FEW:
            w, ix, iy = self.table(x, y)
            return int(_scores(w, ix, iy, np.zeros(len(x), np.int64), np.ones(len(y), np.int64), False)[-1])
        above = [0] * (len(y) + 1)
        for p in x:
            row = [0]
            for j, q in enumerate(y):
                row.append(max(above[j + 1], row[j], above[j] + self.get(p, q)))
            above = row
        return above[-1]

    def table(self, x: list[Node], y: list[Node]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of the kinds of subtrees in x and y, and the kind of each."""
        kx, ky = {k.shape: k for k in x}, {k.shape: k for k in y}
        self.all([(p, q) for p in kx.values() for q in ky.values()])
        w = np.array([[self.get(p, q) for q in ky.values()] for p in kx.values()], np.int64)
        at_x, at_y = {k: i for i, k in enumerate(kx)}, {k: i for i, k in enumerate(ky)}
        return w, np.array([at_x[k.shape] for k in x]), np.array([at_y[k.shape] for k in y])


def simple_tree_matching(a: Node, b: Node, weights: Weights | None = None) -> list[tuple[Node, Node]]:
    """Pairs of matched nodes: the matching that keeps order and levels and has the most pairs.

    Among the best alignments of two lists of children that with the most equal subtrees, text and all, is taken.
    """
    weights = weights or Weights()
    out: list[tuple[Node, Node]] = []
    todo = [(a, b)]
    while todo:
        p, q = todo.pop()
        out.append((p, q))
        x, y = p.below(), q.below()
        i, j = _trimmed(x, y, "full")
        todo += list(zip(x[:i], y[:i])) + list(zip(x[len(x) - j :], y[len(y) - j :]))
        x, y = x[i : len(x) - j], y[i : len(y) - j]
        if not x or not y:
            continue
        sigs = [k.sig for k in x]
        if len(set(sigs)) == len(sigs) and sigs == [k.sig for k in y]:  # each has one partner, in order
            todo += zip(x, y)
            continue
        fx, fy = ([k.full for k in z] for z in (x, y))
        if not set(fx).intersection(fy):  # no equal subtrees to prefer: pairs of one shape at the ends are part of a best alignment
            i, j = _trimmed(x, y, "shape")
            todo += list(zip(x[:i], y[:i])) + list(zip(x[len(x) - j :], y[len(y) - j :]))
            x, y, fx, fy = x[i : len(x) - j], y[i : len(y) - j], fx[i : len(fx) - j], fy[i : len(fy) - j]
            if not x or not y:
                continue
            if len({k.shape for k in x + y}) == 1:
                todo += zip(x, y)
                continue
        w, ix, iy = weights.table(x, y)
        todo += [(x[i], y[j]) for i, j in _aligned(w * (min(len(x), len(y)) + 1), ix, iy, np.array(fx), np.array(fy))]
    return out


def content_root(root: Node) -> tuple[Node, bool]:
    """The article (the longest, if there are several), else the main element, else the page; and whether it is marked."""
    found, todo = {"article": [], "main": []}, [root]
    while todo:
        n = todo.pop()
        for k in n.kids:
            if type(k) is not str and not k.out:
                if k.main:
                    found["article" if k.tag == "article" else "main"].append(k)
                    if k.tag == "article":
                        continue
                todo.append(k)
    for kind in ("article", "main"):
        if found[kind]:
            return max(found[kind], key=lambda n: n.chars), True
    return root, False


def blocks(node: Node, template: set[int] | frozenset[int] = frozenset(), marked: bool = True) -> list[str]:
    """The text blocks below a node in page order. template: nodes (by number) whose own text goes."""
    out: list[str] = []
    cur: list[str] = []

    def flush() -> None:
        if cur and (s := " ".join("".join(cur).split())):
            out.append(s)
        cur.clear()

    todo: list = [("in", node)]
    while todo:
        what, n = todo.pop()
        if what == "text":
            cur.append(n)
            continue
        if what == "out":
            flush()
            continue
        if n is not node and (n.out or (not marked and (n.tag == "header" or (n.tag in BLOCKS and n.sig.endswith("header")))) or (not marked and n.tag in ("ul", "ol") and _links(n))):
            if n.tag in BLOCKS:
                flush()
            continue
        if n.tag in BLOCKS:
            flush()
            todo.append(("out", n))
        gone = n.at in template
        todo += [("text", k) if type(k) is str else ("in", k) for k in reversed(n.kids) if type(k) is not str or not gone]
    flush()
    return out


def _links(node: Node) -> bool:
    """Whether most of the text stands in links."""
    total = linked = 0
    todo = [(node, False)]
    while todo:
        n, inside = todo.pop()
        for k in n.kids:
            if type(k) is str:
                total += (c := len(k.strip()))
                linked += c * inside
            else:
                todo.append((k, inside or k.tag == "a"))
    return linked * 2 > total


class Wrapper:
    """A host's reference tree, its template nodes with the number of pages that speak for each, and the content region."""

    def __init__(self, reference: str, template: dict[int, int], region: int):
        self.tree, self.template, self.region, self.weights = parse(reference), template, region, Weights()

    def match(self, root: Node) -> list[tuple[Node, Node]]:
        if len(self.weights.known) > 100_000:
            self.weights = Weights()
        return simple_tree_matching(self.tree, root, self.weights)


def page_text(html: str | None, wrapper: Wrapper | None = None) -> str:
    root = parse(html or "")
    node, marked = content_root(root)
    whole = blocks(node, frozenset(), marked)
    if wrapper is None or (marked and not wrapper.template):
        return "\n".join(whole)
    pairs = wrapper.match(root)
    gone = {q.at for p, q in pairs if p.own == q.own and wrapper.template.get(p.at, 0) >= (2 if marked else 1)}
    if not marked:
        node = next((q for p, q in pairs if p.at == wrapper.region), node)
        return "\n".join(blocks(node, gone, False))
    left = blocks(node, gone, True)
    # the marks check the template: what takes most of an article is no template of it
    return "\n".join(whole if 2 * sum(map(len, left)) < sum(map(len, whole)) else left)


def _kept(make, limit: int = 64):
    """What make() gives for a host, for a few hosts at a time."""
    held: dict = {}

    def get(host: str, *args):
        if host not in held:
            if len(held) >= limit:
                held.clear()
            held[host] = make(*args)
        return held[host]

    return get


def evidence(wrapper: Wrapper, root: Node) -> list[tuple[int, int, int]]:
    """What a page says on the wrapper: (reference node, 1 if its text is the same, the page's own plain text there).

    Node -1 stands for the page. Nothing, if the page has the reference's article: half of its text, or without marks all text.
    """
    pairs = wrapper.match(root)
    (ref, ref_marked), (mine, marked) = content_root(wrapper.tree), content_root(root)
    same = {q.at: p.own == q.own for p, q in pairs if p.own or q.own}
    owner = {q.at: p.at for p, q in pairs}
    if ref_marked and marked:
        inside = sum(len(q.own) for _, q in pairs if same.get(q.at) and mine.at <= q.at < mine.at + mine.size)
        if 2 * inside >= mine.chars:
            return []
    elif wrapper.tree.full == root.full or (all(same.values()) and wrapper.tree.chars == root.chars):
        return []
    out = [(-1, 1, 0)]
    todo = [(root, 0, False)]
    while todo:
        n, above, linked = todo.pop()
        at = owner.get(n.at, above)
        linked = linked or n.tag == "a" or n.out
        if n.own:
            eq = n.at in owner and same[n.at]
            if eq or not linked:
                out.append((at, int(eq), 0 if eq or linked else len(n.own)))
        todo += [(k, at, linked) for k in n.below()]
    return out


def region_of(tree: Node, plain: dict[int, int], share: float = 0.7) -> int:
    """The innermost container that holds this share of the varying plain text of what is around it."""
    order, todo = [], [tree]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += n.below()
    total: dict[int, int] = {}
    for n in sorted(order, key=lambda n: -n.at):
        total[n.at] = plain.get(n.at, 0) + sum(total[k.at] for k in n.below())
    node = tree
    while inner := [k for k in node.below() if k.tag in CONTAINERS and total[k.at] and total[k.at] >= share * total[node.at]]:
        node = inner[0]
    return node.at


def induce(pages: DataFrame, *, share: float = 0.8, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One wrapper per host with at least two pages: host, reference (html), nodes and their pages (the template), region."""
    refs = written(pages.where("host is not null and html is not null").groupBy("host").agg(F.min_by("html", "page_id").alias("reference"), F.min("page_id").alias("ref_id"), F.count(F.lit(1)).alias("n")).where("n > 1"), "references")
    both = _with(pages.where("html is not null").select("page_id", "host", "html"), refs.select("host", "reference", "ref_id"), broadcast_bytes, "inner").where("not page_id <=> ref_id").select("host", "html", "reference")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0])
        wrapper = _kept(lambda ref: Wrapper(ref, {}, 0))

        def out() -> pa.RecordBatch:
            rows = [(h, k, *v) for (h, k), v in seen.items()]
            seen.clear()
            h, k, e, c = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(h, pa.string()), *(pa.array(x, pa.int64()) for x in (k, e, c))], ["host", "node", "equal", "plain"])

        for b in batches:
            for at in range(0, b.num_rows, 64):
                for host, html, ref in zip(*(c.to_pylist() for c in b.slice(at, 64).columns)):
                    for node, equal, plain in evidence(wrapper(host, ref), parse(html)):
                        c = seen[host, node]
                        c[0] += equal
                        c[1] += plain
                if len(seen) > 200_000:
                    yield out()
        yield out()

    counted = both.mapInArrow(run, "host string, node long, equal long, plain long").groupBy("host", "node").agg(F.sum("equal").alias("equal"), F.sum("plain").alias("plain"))
    # at most one row a node of the reference page
    per_host = counted.groupBy("host").agg(F.collect_list("node").alias("nodes"), F.collect_list("equal").alias("equal"), F.collect_list("plain").alias("plain"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, ref, nodes, equal, plain in zip(*(c.to_pylist() for c in b.columns)):
                pages_seen = dict(zip(nodes, equal)).get(-1, 0)
                template = {k: e for k, e in zip(nodes, equal) if k >= 0 and e and e >= share * pages_seen}
                rows.append((host, ref, list(template), list(template.values()), region_of(parse(ref), dict(zip(nodes, plain)))))
            cols = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["host", "reference", "nodes", "pages", "region"])

    return written(refs.join(per_host, "host").select("host", "reference", "nodes", "equal", "plain").mapInArrow(settle, "host string, reference string, nodes array<long>, pages array<long>, region long"), "wrappers")


def _with(pages: DataFrame, side: DataFrame, broadcast_bytes: int, how: str) -> DataFrame:
    """Join by host; the side is broadcast if its checked size allows."""
    size = side.agg(F.sum(F.octet_length("reference"))).first()[0] or 0
    return pages.join(F.broadcast(side) if size <= broadcast_bytes else side, "host", how)


def extract(pages: DataFrame, *, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", F.lower(F.expr("try_parse_url(url, 'HOST')")))
    wrappers = induce(rows, broadcast_bytes=broadcast_bytes)
    joined = _with(rows, wrappers, broadcast_bytes, "left").select("page_id", "url", "html", "host", "reference", "nodes", "pages", "region")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper = _kept(lambda ref, nodes, pages, region: Wrapper(ref, dict(zip(nodes, pages)), region))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = []
                for html, host, ref, *rest in zip(*(part.column(i).to_pylist() for i in range(2, 8))):
                    texts.append(page_text(html, wrapper(host, ref, *rest) if ref else None))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
