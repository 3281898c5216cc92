"""Main text of web pages by wrapper induction.

Each page becomes a tree of its block elements and text blocks.  Per host, the
page whose length is nearest to the host's mean is the reference (the smaller id on
a tie); every page's tree is aligned with the reference's by simple tree matching.
Over all pages of the host an aligned text block is *constant* when it reads the
same on every page that has it, on ``MIN_PAGES`` different pages or more; constant
blocks are template, varying slots are content.  Pages of the same text count once, and
so do the reference and its near copies (``NEAR`` of the unmarked text in equal blocks):
an article that is there in several versions is no template.
Slots that the page itself marks as navigation, header, footer, sidebar, notice,
advert, form or reader comments (elements, roles, class and id words) vary from page
to page too and are no content; inside an article or main element a class or id counts
only as a whole (``related-posts``, not ``related-work``).

Statistics are one small row for each host and block, summed on the map side, so
a host with a third of all pages is no hot spot; the references (one for each
host) meet the pages in a join that Spark broadcasts when they are small and
splits when a host is hot.

Defined results: null and empty html and pages without content give an empty text.
Character references are decoded, white space in a block is one space, blocks are
joined by a line feed.  A page that is alone on its host, or whose host's pages all
read (nearly) the same, keeps all that is not marked.  Pages may be nested to any depth.  Rows with a null url share the empty host.
Repeated rows are rows of their own; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Different pages on which a block must read the same to be template.
MIN_PAGES = 3
#: Common part of the unmarked text from which a page is a near copy of its reference.
NEAR = 0.8
#: Pairs of subtree shapes that a task remembers.
_MEMO = 100_000
#: Cells from which an alignment of two lists of children is worked out row by row.
_TABLE = 4096

# Element names and the words that mark a region.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
            "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
            "main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr "
            "ul".split())
SKIP = set("aside button canvas datalist dialog dir footer form head iframe input label math menu meta nav noembed "
           "noframes noscript object option output script search select style svg template textarea title".split())
#: Elements of SKIP that are part of the text inside an article or main element.
INLINE_TEXT = set("label math object output".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
            "toolbar".split())
MARKED = set("ad ads advert adverts advertisement advertisements adsense aside banner breadcrumb breadcrumbs "
             "comment comments commentlist cookie cookies consent copyright disclaimer disqus footer footnotebar "
             "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification "
             "pager pagination paywall popup promo promoted promotion related reply replies share sharing sidebar "
             "sidebars signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split())
CONTENT = set("article body content entry main post story".split())
#: Inside an article a class or id marks a region only if it says nothing but marks and these.
LAYOUT = set("area articles bar block box button buttons container form group icons inner item items link links list "
             "outer panel posts section slot unit wrap wrapper".split())

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"""
                  r"""(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>|[!?/][^>]*>)""", re.S)
_LOOSE = re.compile(r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)>", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PARENTS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
            "td": {"tr"}, "th": {"tr"}, "option": {"select"}, "tbody": {"table"}, "thead": {"table"},
            "tfoot": {"table"}}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
         "thead": {"tbody", "thead"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}


class Node:
    """A block element or, without children, a text block."""

    __slots__ = ("label", "children", "text", "marked")

    def __init__(self, label: str, marked: bool, text: str = ""):
        self.label, self.marked, self.text = label, marked, text
        self.children: list[Node] = []


def _attributes(attrs: str) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) if v else "" for k, v in _ATTR.findall(attrs)}


def _is_marked(name: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is no content; ``inside``: it stands in an article or main element."""
    if name in SKIP and not (inside and name in INLINE_TEXT) or name == "header" and not inside:
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if name in ("article", "main", "body", "html"):
        return False
    words = [w.lower() for w in _WORDS.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")]
    told = [w for w, before in zip(words, ["", *words]) if w in MARKED and before not in
            ("no", "without", "has", "with")]
    if not told:
        return False
    if inside and not any(
            set(token) & MARKED and set(token) <= MARKED | LAYOUT
            for token in ([w.lower() for w in _WORDS.findall(t)]
                          for t in f"{attrs.get('class', '')} {attrs.get('id', '')}".split())):
        return False
    return not (name.startswith("h") and name[1:].isdigit() or set(told) <= {"header", "body"} and set(words) & CONTENT)


def parse(html: str) -> Node:
    """The block tree of a page: elements, and text blocks in page order."""
    root = Node("html", False)
    stack: list[tuple[str, Node, bool]] = [("html", root, True)]  # name, block node, is a block
    words: list[str] = []
    hidden = 0  # inline elements that hide their text
    articles = 0  # open article and main elements

    def flush() -> None:
        text = " ".join(" ".join(words).split()) if words else ""
        if text:
            top = stack[-1][1]
            top.children.append(Node("#text", top.marked, text))
        words.clear()

    def close_to(depth: int) -> None:
        nonlocal hidden, articles
        while len(stack) > depth:
            name, _, block = stack[-1]
            articles -= name in ("article", "main")
            if block is True:
                flush()
            elif block is None:
                hidden -= 1
            stack.pop()

    def add(text: str) -> None:
        if not hidden and text:
            text = unescape(text)
            # Parts that touch without white space stay one word.
            if words and not words[-1][-1:].isspace() and not text[:1].isspace():
                words[-1] += text
            else:
                words.append(text)

    at = 0
    while True:
        low = html.find("<", at)
        if low < 0:
            add(html[at:])
            break
        add(html[at:low])
        tag = _TAG.match(html, low) or _LOOSE.match(html, low)
        if not tag:
            add("<")
            at = low + 1
            continue
        at = tag.end()
        name = tag["name"]
        if not name:
            continue
        name = name.lower()
        if tag["close"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            # An inline end tag does not close blocks.
            if depth and (name in BLOCK or not any(s[2] is True for s in stack[depth + 1:])):
                close_to(depth)
            continue
        if name == "br" or name in ("img", "wbr", "input"):
            add(" " if name != "wbr" else "")
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        attrs = _attributes(tag["attrs"]) if "=" in tag["attrs"] or "hidden" in tag["attrs"] else {}
        if name in BLOCK:
            # Implied end tags: a block ends a paragraph; list items and cells end their like.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" and name not in ("option",):
                    close_to(i)
                    break
                if stack[i][0] in ("td", "th", "div", "li", "article", "section", "body", "main"):
                    break
            if name in _SAME:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in _PARENTS[name]:
                        break
                    if stack[i][0] in _SAME[name]:
                        close_to(i)
            if name in ("html", "body"):
                flush()
                continue
            flush()
            parent = stack[-1][1]
            node = Node(f"{name}.{attrs['class']}" if attrs.get("class") else name,
                        parent.marked or _is_marked(name, attrs, articles > 0))
            parent.children.append(node)
            if name != "hr":
                articles += name in ("article", "main")
                stack.append((name, node, True))
        elif name not in VOID and not tag["attrs"].rstrip().endswith("/"):
            gone = _is_marked(name, attrs, articles > 0)
            hidden += gone
            stack.append((name, stack[-1][1], None if gone else False))
    close_to(1)
    flush()
    return root


class Shapes:
    """Subtrees by shape: equal shapes share a number."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.sizes: list[int] = []
        self.parts: list[tuple[str, tuple[int, ...]]] = []
        self.matched: dict[tuple[int, int], int] = {}

    def of(self, node: Node) -> tuple:
        """``(number, parts)`` of the subtree."""
        stack, done = [(node, False)], {}
        while stack:
            n, ready = stack.pop()
            if ready or not n.children:
                key = (n.label, tuple(done[id(c)][0] for c in n.children))
                if key not in self.numbers:
                    self.numbers[key] = len(self.sizes)
                    self.sizes.append(1 + sum(self.sizes[c] for c in key[1]))
                    self.parts.append(key)
                done[id(n)] = (self.numbers[key], [done[id(c)] for c in n.children])
            else:
                stack.append((n, True))
                stack += [(c, False) for c in n.children]
        return done[id(node)]

    def weight(self, a: int, b: int) -> int:
        """Size of the simple tree matching of two shapes."""
        todo = [(a, b)]
        while todo:  # a pair waits until the pairs of its children are known
            x, y = (self.parts[shape][1] for shape in todo[-1])
            open_pairs = [] if self._known(*todo[-1]) is not None else [
                p for p in self._middle_pairs(x, y) if self._known(*p) is None]
            if open_pairs:
                todo += open_pairs
                continue
            pair = todo.pop()
            if self._known(*pair) is None:
                self.matched[pair] = 1 + self._best(x, y)
        return self._known(a, b)

    def _known(self, a: int, b: int) -> int | None:
        if a == b:
            return self.sizes[a]
        if self.parts[a][0] != self.parts[b][0]:
            return 0
        return self.matched.get((a, b))

    def _middle_pairs(self, x: tuple[int, ...], y: tuple[int, ...]) -> list[tuple[int, int]]:
        """Different shapes that the alignment of two lists of children compares."""
        head, tail = _ends(x, y)
        right: dict[str, set[int]] = {}
        for j in y[head:len(y) - tail]:
            right.setdefault(self.parts[j][0], set()).add(j)
        return [(i, j) for i in set(x[head:len(x) - tail]) for j in right.get(self.parts[i][0], ())]

    def _weights(self, y: tuple[int, ...]) -> Callable[[int], np.ndarray]:
        """For a long list ``y``: the weights of a shape with each of its members."""
        places: dict[str, list[int]] = {}
        for j, b in enumerate(y):
            places.setdefault(self.parts[b][0], []).append(j)
        like = {label: (np.array(at), *np.unique([y[j] for j in at], return_inverse=True))
                for label, at in places.items()}
        known: dict[int, np.ndarray] = {}

        def row(a: int) -> np.ndarray:
            out = np.zeros(len(y), dtype=np.int64)
            label = self.parts[a][0]
            if label in like:
                at, shapes, number = like[label]
                if a not in known:
                    known[a] = np.array([self.weight(a, b) for b in shapes.tolist()], dtype=np.int64)
                out[at] = known[a][number]
            return out

        return row

    def _best(self, x: tuple[int, ...], y: tuple[int, ...]) -> int:
        """Weight of the best ordered matching of two lists; their pairs are known."""
        head, tail = _ends(x, y)
        equal = sum(self.sizes[i] for i in x[:head]) + sum(self.sizes[i] for i in x[len(x) - tail:])
        x, y = x[head:len(x) - tail], y[head:len(y) - tail]
        if not x or not y:
            return equal
        if len(x) * len(y) > _TABLE:
            weights = self._weights(y)
            below = np.zeros(len(y) + 1, dtype=np.int64)
            for a in reversed(x):
                below = _row_above(below, weights(a))
            return equal + int(below[0])
        below = [0] * (len(y) + 1)
        for a in reversed(x):
            row = [0] * (len(y) + 1)
            for j in range(len(y) - 1, -1, -1):
                both = self._known(a, y[j])
                row[j] = max(below[j], row[j + 1], below[j + 1] + both if both else 0)
            below = row
        return equal + below[0]

    def pairs(self, x: tuple[int, ...], y: tuple[int, ...]) -> list[tuple[int, int]]:
        """The best ordered matching of two lists of children.  Equal children at
        both ends match each other in some best matching."""
        head, tail = _ends(x, y)
        out = [(i, i) for i in range(head)]
        left, right = x[head:len(x) - tail], y[head:len(y) - tail]
        if left and right:
            out += [(head + i, head + j) for i, j in (
                self._pairs_by_rows if len(left) * len(right) > _TABLE else self._pairs_by_table)(left, right)]
        return out + [(len(x) - t, len(y) - t) for t in range(tail, 0, -1)]

    def _pairs_by_table(self, x: tuple[int, ...], y: tuple[int, ...]) -> list[tuple[int, int]]:
        m, n = len(x), len(y)
        best = [[0] * (n + 1) for _ in range(m + 1)]
        for i in range(m - 1, -1, -1):
            for j in range(n - 1, -1, -1):
                both = self.weight(x[i], y[j])
                best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + both if both else 0)
        out, i, j = [], 0, 0
        while i < m and j < n:
            if best[i][j] == best[i + 1][j]:
                i += 1
            elif best[i][j] == best[i][j + 1]:
                j += 1
            else:
                out.append((i, j))
                i, j = i + 1, j + 1
        return out

    def _pairs_by_rows(self, x: tuple[int, ...], y: tuple[int, ...]) -> list[tuple[int, int]]:
        """The same for long lists: one row at a time, and only every ``step``-th row is
        kept; the rows between are worked out again where the matching passes them."""
        m, n = len(x), len(y)
        weights = self._weights(y)
        step = int(m ** 0.5) + 1
        kept = {m: np.zeros(n + 1, dtype=np.int64)}
        row = kept[m]
        for i in range(m - 1, -1, -1):
            row = _row_above(row, weights(x[i]))
            if i % step == 0:
                kept[i] = row
        out, j = [], 0
        for first in range(0, m, step):
            last = min(first + step, m)
            rows = [kept[last]]
            for i in range(last - 1, first - 1, -1):
                rows.append(_row_above(rows[-1], weights(x[i])))
            rows.reverse()
            i = first
            while i < last and j < n:
                here, below = rows[i - first], rows[i - first + 1]
                if here[j] == below[j]:
                    i += 1
                elif here[j] == here[j + 1]:
                    j += 1
                else:
                    out.append((i, j))
                    i, j = i + 1, j + 1
        return out


def _ends(x: tuple[int, ...], y: tuple[int, ...]) -> tuple[int, int]:
    """Equal children at the head and at the tail of two lists."""
    short = min(len(x), len(y))
    head = 0
    while head < short and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < short - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    return head, tail


def _row_above(below: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row of the matching table from the row below it and the weights of its cells."""
    best = below.copy()
    np.maximum(best[:-1], np.where(weights > 0, below[1:] + weights, 0), out=best[:-1])
    return np.maximum.accumulate(best[::-1])[::-1]


def aligned(page: Node, reference: Node, shapes: Shapes) -> dict[int, int]:
    """Text blocks of ``page`` (by ``id``) and the reference block each is
    aligned with, numbered in the reference's page order."""
    if len(shapes.matched) > _MEMO:
        shapes.matched.clear()
    number: dict[int, int] = {}
    stack = [reference]
    while stack:
        node = stack.pop()
        number[id(node)] = len(number)
        stack += reversed(node.children)
    out: dict[int, int] = {}
    todo = [(page, shapes.of(page), reference, shapes.of(reference))]
    while todo:
        a, (_, a_parts), b, (_, b_parts) = todo.pop()
        if a.label == "#text":
            out[id(a)] = number[id(b)]
        x, y = tuple(p[0] for p in a_parts), tuple(p[0] for p in b_parts)
        todo += [(a.children[i], a_parts[i], b.children[j], b_parts[j]) for i, j in shapes.pairs(x, y)]
    return out


def text_blocks(root: Node) -> list[Node]:
    """Text blocks in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.label == "#text":
            out.append(node)
        stack += reversed(node.children)
    return out


def _packed(root: Node) -> str:
    """A tree as a flat list in page order: label, number of children, and of text
    blocks the hash and, if not marked, the length."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append([node.label, len(node.children)] if node.label != "#text" else
                   [node.label, 0, _hash(node.text), 0 if node.marked else len(node.text)])
        stack += reversed(node.children)
    return json.dumps(out)


def _unpacked(packed: str) -> tuple[Node, dict[int, int]]:
    """The tree, and the total length of its unmarked text blocks by hash."""
    holder = Node("", False)
    stack, texts = [[holder, 1]], {}
    for label, children, *text in json.loads(packed):
        while not stack[-1][1]:
            stack.pop()
        node = Node(label, False)
        stack[-1][0].children.append(node)
        stack[-1][1] -= 1
        stack.append([node, children])
        if text and text[1]:
            texts[text[0]] = texts.get(text[0], 0) + text[1]
    return holder.children[0], texts


def _is_near(texts: dict[int, int], other: dict[int, int]) -> bool:
    """Whether equal blocks hold ``NEAR`` of the text of two pages together."""
    both = sum(min(n, other.get(key, 0)) for key, n in texts.items())
    return both > 0 and both >= NEAR * (sum(texts.values()) + sum(other.values()) - both)


def _host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:]*://([^/?#]*)", 1)
    return F.lower(host)


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [_packed(parse(h.as_py() or "")) for h in batch.column("html")]
        yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "tree": pa.array(trees, pa.string())})


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


_BLOCKS = "array<struct<slot:int,hash:bigint,marked:boolean,text:string>>"


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[Node, dict[int, int]]] = {}
    shapes = Shapes()
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("hash", pa.int64()), ("marked", pa.bool_()),
                               ("text", pa.string())]))
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            rows, whole = [], []
            for html, host, tree in zip(part.column("html"), part.column("host").to_pylist(), part.column("tree")):
                if len(shapes.sizes) > _MEMO:
                    shapes = Shapes()
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = _unpacked(tree.as_py() or '[["html", 0]]')
                page = parse(html.as_py() or "")
                reference, reference_texts = known[host]
                slots = aligned(page, reference, shapes)
                blocks = [{"slot": slots.get(id(b)), "hash": _hash(b.text), "marked": b.marked,
                           "text": None if b.marked else b.text} for b in text_blocks(page)]
                rows.append(blocks)
                texts: dict[int, int] = {}
                for b in blocks:
                    if not b["marked"]:
                        texts[b["hash"]] = texts.get(b["hash"], 0) + len(b["text"])
                # The reference and its near copies are one piece of evidence.
                whole.append(0 if _is_near(texts, reference_texts) else
                             _hash("\n".join(b["text"] or "" for b in blocks)))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), part.column("host"), pa.array(whole, pa.int64()),
                 pa.array(rows, kind)], names=["id", "url", "host", "whole", "blocks"])


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
              html_column: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """``id_column, url, text, n_chars`` of every page."""
    rows = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").cast("string").alias("url"),
                        F.col(f"`{html_column}`").cast("string").alias("html"))
    rows = rows.withColumn("host", _host(F.col("url"))).withColumn("size", F.length(F.coalesce("html", F.lit(""))))
    # Pages are told by a hash here: no html moves, and the chosen few go to all tasks
    # or, if they are many, meet their pages in a join that splits hot hosts.
    facts = rows.select("host", "size", F.col("id").cast("string").alias("id"), F.xxhash64("html").alias("key"))
    mean = cut(facts.groupBy("host").agg(F.avg("size").alias("mean")))
    nearest = F.min(F.struct(F.abs(F.col("size") - F.col("mean")).alias("off"), "id", "key")).alias("best")
    chosen = cut(facts.join(mean, "host").groupBy("host").agg(nearest).select("host", F.col("best.key").alias("key")))
    source = (rows.withColumn("key", F.xxhash64("html")).join(chosen, ["host", "key"], "left_semi")
              .dropDuplicates(["host", "key"]).select("host", "html"))
    trees = cut(source.mapInArrow(_references, "host string, tree string"))
    id_type = rows.schema["id"].dataType.simpleString()
    seen = cut(rows.select("id", "url", "host", "html").join(trees, "host", "left").mapInArrow(
        _align, f"id {id_type}, url string, host string, whole long, blocks {_BLOCKS}"))

    varied = seen.groupBy("host").agg((F.min("whole") != F.max("whole")).alias("varied"))
    # Copies of a page, and near copies of the reference, are one piece of evidence.
    slots = (seen.select("host", "whole", F.inline("blocks")).where("slot is not null")
             .groupBy("host", "slot", "whole").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi"))
             .groupBy("host", "slot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n"))
             .where((F.col("lo") == F.col("hi")) & (F.col("n") >= min_pages))
             .groupBy("host").agg(F.collect_list("slot").alias("template")))
    template = cut(slots.join(varied.where("varied"), "host", "left_semi"))
    content = F.filter("blocks", lambda b: ~b["marked"] & ~F.coalesce(
        F.array_contains("template", b["slot"]), F.lit(False)))
    text = F.array_join(F.transform(content, lambda b: b["text"]), "\n")
    return (seen.join(template, "host", "left")
            .select(F.col("id").alias(id_column), "url", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
