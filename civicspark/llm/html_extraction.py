"""Main text of web pages by wrapper induction.

The pages of one host come from one template.  Every page's DOM tree is aligned with that of the
host's first page by simple tree matching (the largest common ordered tree from the roots down).  A
text node that is equal to its counterpart in most of the host's pages is part of the template;
what varies is content.  Menus, adverts, notices, forms and the like vary too, so parts with such
tags, roles or names are never content, and the main text is taken from the page's article (or main
part, or else from the part below the body that holds most of what is left).

1. ``host, first page``: an aggregate with one small row a host.
2. Every page is aligned with its host's first page; per text node of that page, the number of
   different texts of pages in which the counterpart is equal is counted over all pages.  Texts
   count as one if their smallest hash of two words is one, so that copies and near copies of an
   article do not turn it into template.
3. Every page is aligned again; nodes whose counterpart is template are left out.

Pages are not shuffled while first pages and templates are small (``SMALL``, checked); beyond
that they are joined by host.  A host may hold any share of the pages: nothing is gathered by host
but counts.

Defined results: null or empty html and pages without a main part give the empty text; pages with
null or unreadable url form a host of their own; cut-off and badly nested markup is read as far
as it goes, and elements nested more than ``DEEPEST`` deep add their contents to the one around.  One row comes out per row of ``pages``."""

from __future__ import annotations

import html
import re
import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.frames import cut, fresh, named

#: Bytes of first pages, or of templates, that are sent to all tasks.
SMALL = 16 << 20
#: Different texts in which a node must be equal, and their share of the host's.
LEAST_PAGES = 4
LEAST_SHARE = 0.5
#: Sibling pairs that are compared one by one; longer lists are aligned row by row, with equal results.
MOST_PAIRS = 40_000
#: Sibling pairs of long lists whose table is kept whole; longer lists are halved first.
TABLE_PAIRS = 1 << 22
#: Depth of a tree; browsers have such a limit too.
DEEPEST = 400
#: Trees of first pages that a task keeps.
TREES_KEPT = 64

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Tags that end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Tags that end open siblings of their kind.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tr"},
    "body": {"head"},
}
_HOLDS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
    "th": {"table"}, "option": {"select"}, "tbody": {"table"}, "body": {"html"},
}
_NEVER = frozenset(
    "head nav aside form footer script style noscript iframe template svg math button select "
    "input textarea dialog menu object embed canvas audio video map".split()
)
_NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar status".split()
)
#: Words in class or id names of parts that are not content.
_NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright disqus footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification pager pagination popup promo "
    "promotion reader-comments related replies reply respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
_MAIN_NAMES = frozenset(
    "article articlebody article-body content entry entry-content main main-content post post-body "
    "post-content story story-body".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(
    r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_NAME = re.compile(r"[a-z]+(?:-[a-z]+)*")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element; ``kids`` are elements and texts in order."""

    __slots__ = ("tag", "name", "attrs", "kids", "parent", "depth")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.name = (tag, attrs.get("class", ""))
        self.kids: list[Node | str] = []
        self.depth: int = parent.depth + 1 if parent else 0

    def elements(self) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node)]


def _attributes(text: str) -> dict[str, str]:
    return {
        m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)
    } if text.strip(" /") else {}


def parse(page: str) -> Node:
    """The page's tree.  Missing end tags are supplied as browsers do in the usual cases."""
    root = Node("", {}, None)
    here, at = root, 0
    # elements too deep to be opened: their contents go to the deepest that is
    shut: dict[str, int] = {}
    while True:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            here.kids.append(html.unescape(text))
        if not found:
            return root
        at = found.end()
        if found["cdata"]:
            here.kids.append(found["cdata"])
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["end"] and shut.get(tag):
            shut[tag] -= 1
            continue
        if found["end"]:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            elif tag == "p" and here is not root:
                here.kids.append(Node("p", {}, here))
            continue
        if tag in _ENDS_P:
            node = here
            while node is not root and (node.tag in _INLINE or node.tag == "p"):
                if node.tag == "p":
                    here = node.parent
                    break
                node = node.parent
        ends = _ENDS.get(tag)
        if ends:
            node, holds, last = here, _HOLDS[tag], None
            while node is not root and node.tag not in holds:
                if node.tag in ends:
                    last = node
                node = node.parent
            if last is not None:
                here = last.parent
        node = Node(tag, _attributes(found["attrs"]), here)
        here.kids.append(node)
        if tag in _RAW:
            close = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif tag not in _VOID and not found["attrs"].endswith("/"):
            if node.depth < DEEPEST:
                here = node
            else:
                shut[tag] = shut.get(tag, 0) + 1


def _leaf(node: Node) -> bool:
    return not any(isinstance(k, Node) for k in node.kids)


def _best_row(weights: list[np.ndarray], start: int, stop: int) -> np.ndarray:
    """The last row of the alignment's table, for the places from ``start`` to ``stop``."""
    row = np.zeros(stop - start + 1, np.int64)
    for own in weights:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + own[start:stop]))
    return row


def _align(weights: list[np.ndarray], first: int, start: int, stop: int) -> list[tuple[int, int]]:
    """The heaviest ordered alignment of rows, numbered from ``first``, with the places from ``start`` to
    ``stop``; memory is linear but for a table of ``TABLE_PAIRS`` (Hirschberg)."""
    if not weights or start == stop:
        return []
    if len(weights) > 1 and len(weights) * (stop - start) > TABLE_PAIRS:
        half = len(weights) // 2
        after = [own[::-1] for own in reversed(weights[half:])]
        size = len(weights[0])
        below = _best_row(after, size - stop, size - start)[::-1]
        cut_at = start + int(np.argmax(_best_row(weights[:half], start, stop) + below))
        return _align(weights[:half], first, start, cut_at) + _align(
            weights[half:], first + half, cut_at, stop
        )
    table = [np.zeros(stop - start + 1, np.int64)]
    for own in weights:
        row = table[-1].copy()
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + own[start:stop]))
        table.append(row)
    i, j, chosen = len(weights), stop - start, []
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            chosen.append((first + i, start + j))
    return chosen[::-1]


def match(one: Node, two: Node) -> dict[Node, Node]:
    """Simple tree matching: nodes of ``one`` with their counterparts in ``two``."""
    sizes: dict[tuple[int, int], tuple[int, list]] = {}
    # nodes of one shape weigh the same
    shapes: dict[tuple, int] = {}
    shape_of: dict[int, int] = {}
    by_shape: dict[tuple[int, int], int] = {}

    def shape(node: Node) -> int:
        found = shape_of.get(id(node))
        if found is None:
            key = (node.name, *map(shape, node.elements()))
            found = shape_of[id(node)] = shapes.setdefault(key, len(shapes))
        return found

    def weights(left: list[Node], right: list[Node]) -> list[np.ndarray]:
        rows: dict[int, np.ndarray] = {}
        kinds = [shape(b) for b in right]
        for a in left:
            if shape(a) not in rows:
                for b, kind in zip(right, kinds, strict=True):
                    pair = shape(a), kind
                    if pair not in by_shape:
                        by_shape[pair] = weigh(a, b) if a.name == b.name else 0
                rows[shape(a)] = np.array([by_shape[shape(a), kind] for kind in kinds], np.int32)
        return [rows[shape(a)] for a in left]

    def weigh(a: Node, b: Node) -> int:
        known = sizes.get((id(a), id(b)))
        if known is not None:
            return known[0]
        left, right = a.elements(), b.elements()
        pairs: list[tuple[Node, Node]] = []
        total = 1
        # equal outer siblings first: what is left to compare is short
        while left and right and left[0].name == right[0].name and (
            _leaf(left[0]) and _leaf(right[0])
        ):
            pairs.append((left.pop(0), right.pop(0)))
            total += 1
        tail: list[tuple[Node, Node]] = []
        while left and right and left[-1].name == right[-1].name and (
            _leaf(left[-1]) and _leaf(right[-1])
        ):
            tail.append((left.pop(), right.pop()))
            total += 1
        if left and right:
            if len(left) * len(right) > MOST_PAIRS:
                found = weights(left, right)
                chosen = _align(found, 0, 0, len(right))
                total += sum(int(found[i][j]) for i, j in chosen)
                pairs += [(left[i], right[j]) for i, j in chosen]
            else:
                table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
                for i, a_kid in enumerate(left):
                    row, above = table[i + 1], table[i]
                    for j, b_kid in enumerate(right):
                        best = row[j] if row[j] > above[j + 1] else above[j + 1]
                        if a_kid.name == b_kid.name:
                            both = above[j] + weigh(a_kid, b_kid)
                            best = both if both > best else best
                        row[j + 1] = best
                total += table[-1][-1]
                i, j, chosen = len(left), len(right), []
                while i and j:
                    if table[i][j] == table[i - 1][j]:
                        i -= 1
                    elif table[i][j] == table[i][j - 1]:
                        j -= 1
                    else:
                        i, j = i - 1, j - 1
                        chosen.append((left[i], right[j]))
                pairs += reversed(chosen)
        sizes[id(a), id(b)] = total, pairs + tail[::-1]
        return total

    out: dict[Node, Node] = {}
    todo = [(one, two)]
    while todo:
        a, b = todo.pop()
        out[a] = b
        if not (_leaf(a) or _leaf(b)):
            weigh(a, b)
            todo += sizes[id(a), id(b)][1]
    return out


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def _never(node: Node, within_article: bool) -> bool:
    """Whether the part cannot be content by its tag, role, name or style."""
    tag, attrs = node.tag, node.attrs
    if tag in _NEVER or (tag == "header" and not within_article):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if attrs.get("role", "").lower() in _NEVER_ROLES:
        return True
    style = attrs.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    label = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if label == " ":
        return False
    label = _CAMEL.sub("-", label).lower().replace("_", "-")
    names = set(_NAME.findall(label))
    if names & _MAIN_NAMES:
        return False
    return bool(set(_WORD.findall(label)) & _NEVER_NAMES)


def _own_text(node: Node) -> str:
    return _squeeze(" ".join(k for k in node.kids if isinstance(k, str)))


def _text(node: Node, template: set[Node], article: bool = False) -> str:
    """Text of the parts that may be content."""
    out: list[str] = []

    def walk(node: Node, article: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                out.append(kid if node not in template else " ")
            elif kid.tag == "br" or kid.tag == "hr":
                out.append(" ")
            elif not _never(kid, article):
                inline = kid.tag in _INLINE
                if not inline:
                    out.append(" ")
                if kid.tag not in _RAW:
                    walk(kid, article or kid.tag in ("article", "main"))
                if not inline:
                    out.append(" ")

    walk(node, article)
    return _squeeze("".join(out))


def _mains(node: Node, wanted, out: list[Node]) -> list[Node]:
    for kid in node.elements():
        if _never(kid, False):
            continue
        if wanted(kid):
            out.append(kid)
        else:
            _mains(kid, wanted, out)
    return out


def _named_main(node: Node) -> bool:
    label = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"
    label = _CAMEL.sub("-", label).lower().replace("_", "-")
    return bool(set(_NAME.findall(label)) & _MAIN_NAMES)


def main_text(page: Node, template: set[Node]) -> str:
    """Text of the article without its template parts."""
    for wanted in (
        lambda n: n.tag == "article" or n.attrs.get("itemprop") == "articleBody",
        lambda n: n.tag == "main" or n.attrs.get("role") == "main",
        _named_main,
    ):
        parts = _mains(page, wanted, [])
        if parts:
            return max((_text(p, template, True) for p in parts), key=len)
    here = page
    whole = _text(here, template)
    while True:
        best = max(
            ((_text(k, template), k) for k in here.elements() if not _never(k, False)),
            key=lambda p: len(p[0]), default=("", None),
        )
        if best[1] is None or best[1].tag in _INLINE or len(best[0]) < 0.7 * len(whole):
            return whole
        if best[1].tag in ("p", "pre", "blockquote", "ul", "ol", "table"):
            return whole
        here, whole = best[1], best[0]


def _smallest_pair(text: str) -> int:
    """The smallest hash of two words in a row."""
    found = text.encode().split()
    pairs = zip(found, found[1:] or found, strict=False)
    return min((zlib.crc32(a + b" " + b) for a, b in pairs), default=-1)


def _walk(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.elements())
    return out


class Trees:
    """Trees of the first pages used last."""

    def __init__(self) -> None:
        self.kept: OrderedDict[str, tuple[Node, dict[Node, int]]] = OrderedDict()

    def get(self, host: str, page: str) -> tuple[Node, dict[Node, int]]:
        if host not in self.kept:
            tree = parse(page)
            self.kept[host] = tree, {node: i for i, node in enumerate(_walk(tree))}
            if len(self.kept) > TREES_KEPT:
                self.kept.popitem(last=False)
        self.kept.move_to_end(host)
        return self.kept[host]


def _small(frame: DataFrame) -> DataFrame:
    """The stored frame, to be sent to all tasks if it is small enough."""
    frame = cut(frame)
    size = sum((F.octet_length(F.to_json(F.struct(c))) for c in frame.columns), F.lit(0))
    total = frame.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(frame) if total <= SMALL else frame


def _with_first_page(pages: DataFrame, url: str, page: str) -> tuple[DataFrame, str, str]:
    """``pages`` with host and the host's first page, and the columns' names."""
    host, first = fresh(pages, "host", "first_page")
    hosted = pages.withColumn(
        host,
        F.coalesce(F.lower(F.try_parse_url(named(url), F.lit("HOST"))), F.lit("")),
    )
    with_html = hosted.filter(F.length(named(page)) > 0)
    keyed = with_html.select(
        named(host).alias(host), F.xxhash64(named(page), named(url)).alias("key")
    )
    firsts = _small(keyed.groupBy(host).agg(F.min("key").alias("key")))
    found = (
        with_html.select(
            named(host), named(page).alias(first), F.xxhash64(named(page), named(url)).alias("key")
        )
        .join(firsts, [host, "key"])
        .groupBy(host)
        .agg(F.min(first).alias(first))
    )
    found = _small(found)
    return hosted.join(found, host, "left"), host, first


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with one more column, whose name is returned too: the main text."""
    joined, host, first = _with_first_page(pages, url, page)

    def equal_nodes(batches):
        trees = Trees()
        for batch in batches:
            hosts, texts, nodes = [], [], []
            columns = (batch.column(c).to_pylist() for c in (host, page, first))
            for h, own, model in zip(*columns, strict=True):
                if not own or not model:
                    continue
                tree = parse(own)
                model_tree, numbers = trees.get(h, model)
                same = [
                    numbers[b] for a, b in match(tree, model_tree).items()
                    if (text := _own_text(a)) and text == _own_text(b)
                ]
                hosts.append(h)
                texts.append(_smallest_pair(main_text(tree, set())))
                nodes.append(sorted(same))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(texts, pa.int64()),
                    pa.array(nodes, pa.list_(pa.int32())),
                ],
                ["host", "content", "nodes"],
            )

    # node -1 stands for the page itself
    equal = joined.select(named(host), named(page), named(first)).mapInArrow(
        equal_nodes, "host string, content long, nodes array<int>"
    )
    counts = (
        equal.select(
            "host", "content", F.explode(F.concat(F.array(F.lit(-1)), "nodes")).alias("node")
        )
        .distinct()
        .groupBy("host", "node")
        .agg(F.count("*").alias("texts"))
    )
    whole = F.max(F.when(F.col("node") == -1, F.col("texts")))
    found = F.collect_list(F.struct("node", "texts"))
    constant, = fresh(joined, "template")
    templates = counts.groupBy("host").agg(whole.alias("all"), found.alias("found")).select(
        F.col("host").alias(host),
        F.transform(
            F.filter(
                "found",
                lambda s: (s["node"] >= 0)
                & (s["texts"] >= LEAST_PAGES)
                & (s["texts"] >= LEAST_SHARE * F.col("all")),
            ),
            lambda s: s["node"],
        ).alias(constant),
    )
    text, = fresh(pages, "text")
    kept = pages.columns
    schema = pages.select("*", F.lit("").alias(text)).schema

    def texts_of(batches):
        trees = Trees()
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in (host, page, first, constant))
            for h, own, model, nodes in zip(*columns, strict=True):
                if not own:
                    out.append("")
                    continue
                tree = parse(own)
                template: set[Node] = set()
                if model and nodes:
                    model_tree, numbers = trees.get(h, model)
                    marked = set(nodes)
                    template = {
                        a for a, b in match(tree, model_tree).items()
                        if numbers[b] in marked and _own_text(a) == _own_text(b)
                    }
                out.append(main_text(tree, template))
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string())], [*kept, text])

    return joined.join(_small(templates), host, "left").mapInArrow(texts_of, schema), text


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    found, text = extract(pages.select("page_id", "url", "html"))
    return found.select(
        "page_id", "url", named(text).alias("text"), F.length(named(text)).cast("long").alias("n_chars")
    )
