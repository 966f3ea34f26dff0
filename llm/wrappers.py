"""HTML extraction by wrapper induction.

The pages of a host are made into trees of block elements.  Simple tree matching aligns
each tree with the host's template so far: two nodes match if their labels are equal, and
the matched pairs below them are the most that keep order (dynamic programming).
Neighbours with one label are one repeating node, so lists of any length align in a few
steps.  Aligned nodes are merged and counted, others join the template as optional ones.
For each node the template keeps which texts it carried, the frequent ones with counts
(lossy at first, with a bound; texts that the bound leaves open are counted exactly in a
pass over the pages of their hosts):
texts that stay the same on most pages are constant and belong to the template, nodes
whose text varies are slots.  The content is the slot region that holds the bulk of the
varying text off links; a page's text is what its own nodes carry there, without its
constants and without elements that are known not to be the article.  Where pages mark their
article themselves, only whole blocks that are the same on ``NOTICE`` of a host's pages are
left out of it, never cells, headings or parts of a block.  A template keeps at most
``NODES`` nodes: optional ones that the fewest pages have go first, and what is matched to
none is a page's own text.

Templates are built where pages are read, one for each host and task, and merged in
levels of bounded groups, so a host with a third of all pages is never gathered.
Templates go to the tasks that extract when their total size is at most ``SENT_BYTES``;
beyond that, pages and templates are joined by host.

Null html is the empty page, with empty text.  A null or odd url is a host of its own.
Rows with a null id are extracted too.  Repeated rows each get a row.  Nesting deeper
than ``DEPTH`` is read as if it were at that depth.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_module
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import Scratch, done, table, tidied

DEPTH = 60
#: Texts of a node from which rare ones are let go, and the most nodes of a template.
TEXTS, NODES = 48, 1500
#: Counts of a node are too low by no more than this share of its pages; where that can matter they are counted again.
LOST = 0.25
#: A text is constant on more than this share of at least so many pages.
SHARE, PAGES = 0.5, 4
#: Inside of an article, a notice is a whole block that is the same on this share of pages; a cell or a heading is none.
NOTICE = 0.9
CELLS = frozenset("td th caption h1 h2 h3 h4 h5 h6 dt".split())
GROUP, SENT_BYTES = 128, 16 << 20

BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote figure figcaption address header footer nav aside form fieldset hr center details summary hgroup search dialog menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold article text.
NEVER = frozenset("script style noscript template iframe object svg canvas audio video head title nav footer aside form button select textarea input datalist dialog menu search map annotation annotation-xml".split())
#: Of these, what stands in a line of text, which goes on behind it.
INLINE = frozenset("svg canvas audio video object map button select annotation annotation-xml".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Words of class, id and role that mark what is not the article.
OUTSIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies share sharing social related recommended recommendations widget widgets login search pagination pager skip toolbar contentinfo complementary tags byline".split()
)
#: Of these, what is not the article inside an article either.
INSIDE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup nav navbar breadcrumb breadcrumbs comment comments disqus respond replies share sharing social pagination pager toolbar".split())
#: What may stand beside such a word in a compound one without changing what it says.
BESIDE = frozenset("site page main left right top bottom inner outer box block bar area section wrap wrapper container list item items link links slot unit group panel module content primary secondary global local fixed sticky mobile desktop".split())
#: Words that mark readers' comments in whatever compound, but for those that only tell whether there can be any, on these elements.
COMMENTS = frozenset("comment comments commentlist commenters disqus".split())
ABOUT_COMMENTS = frozenset("no has open opened closed enabled disabled with without off on allow allowed status".split())
BOXES = frozenset("div section ol ul li dl table aside form footer details".split())
#: Words that mark what is not the article only where the element's text is mostly links.
SOFT = frozenset("menu side rail".split())
HEADER = frozenset(("header", "topbar", "banner"))
CLOSES_P = BLOCKS - {"html", "body", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "figcaption", "summary"} | {"li", "dt", "dd"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


def says_outside(names: list[str], inside: bool, tag: str = "div") -> bool:
    """Whether class, id or role names mark what is not the article: such a word alone, or in a compound with neutral ones; of comments, in any compound."""
    marks = INSIDE if inside else OUTSIDE
    for name in names:
        words = WORD.findall(name)
        if words and any(w in marks for w in words) and all(w in OUTSIDE or w in BESIDE for w in words):
            return True
        if tag in BOXES and not COMMENTS.isdisjoint(words) and ABOUT_COMMENTS.isdisjoint(words):
            return True
    return False


def only_soft(names: list[str]) -> bool:
    """Whether nothing but soft words says that an element is not the article."""
    hard = [n for n in names if SOFT.isdisjoint(WORD.findall(n))]
    return not says_outside(hard, False) and all(w in SOFT or w in BESIDE for n in names if n not in hard for w in WORD.findall(n))


class Node:
    """An element that makes a block, or (tag ``#``) a run of text inside one."""

    __slots__ = ("label", "tag", "items", "text", "links", "outside")

    def __init__(self, label: str, tag: str, outside: bool = False):
        self.label, self.tag, self.outside = label, tag, outside
        self.items: list[Node] = []
        self.text, self.links = "", 0


def parse(page: str) -> Node:
    """The tree of block elements of a page, with decoded, white-space-normalised texts."""
    root = Node("html", "html")
    stack: list[tuple[str, Node]] = [("html", root)]  # open elements, inline ones too
    text: list[str] = []
    opened: Counter[str] = Counter()  # how many of each are in the stack
    softened: list[Node] = []
    linked, in_link, hidden, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html_module.unescape("".join(text)).split())
            text.clear()
            if joined:
                leaf = Node("#", "#")
                leaf.text, leaf.links = joined, min(linked, len(joined))
                stack[-1][1].items.append(leaf)
            linked = 0

    def pop() -> None:
        nonlocal in_link, hidden
        tag, node = stack[-1]
        if tag in BLOCKS and not hidden:
            flush()
        stack.pop()
        opened[tag.lstrip("!")] -= 1
        if tag == "a":
            in_link -= 1
        if tag.startswith("!"):
            hidden -= 1

    def close(tags: set[str] | frozenset[str], stops: set[str]) -> None:
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            name = stack[i][0].lstrip("!")
            if name in tags:
                while len(stack) > i:
                    pop()
                return
            if name in stops:
                return

    skip_to, last = -1, max(page.rfind(">"), page.rfind("<!--"), page.rfind("<![CDATA["))
    for m in MARKUP.finditer(page, 0, last + 1 if page.rfind(">") == last else len(page)):  # what follows the last sign is text
        if m.start() < skip_to:
            continue
        if m.start() > at and not hidden:
            piece = page[at : m.start()]
            text.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        tag = name.lower()
        if m.group(1) or m.group(4):
            if tag == "br":
                text.append(" ")
            elif tag == "p" and not opened["p"]:
                if not hidden:
                    flush()
            elif tag not in ("html", "body"):
                close({tag}, set())
            continue
        attributes = m.group(3) or m.group(6) or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = skip_to = end.end() if end else len(page)
            if not hidden and tag in BLOCKS:
                flush()
            continue
        if tag in VOID:
            if tag in ("br", "wbr") and not hidden:
                text.append(" " if tag == "br" else "")
            elif tag == "hr" and not hidden:
                flush()
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            close({"p"}, {"table", "td", "th", "button"})
        if tag in SIBLINGS:
            close(SIBLINGS[tag], STOPS[tag])
        if attributes.rstrip().endswith("/") and (tag in NEVER or tag == "math"):
            continue
        names: list[str] = []
        if attributes:
            for a in NAMES.finditer(attributes):
                names += (a.group(2) or a.group(3) or a.group(4) or "").lower().split()
        words = [w for n in names for w in WORD.findall(n)]
        inside = bool(opened["article"] or opened["main"])
        outside = tag in NEVER or says_outside(names, inside or tag in ("main", "article"), tag)
        soft = outside and tag in BLOCKS and tag not in NEVER and only_soft(names)
        outside = outside and not soft
        if not outside and not inside and (tag == "header" or HEADER & set(words)):
            outside = True
        if tag in BLOCKS or outside and tag in NEVER and tag not in INLINE:
            if not hidden:
                flush()
            node = Node(tag + ("." + ".".join(sorted(set(words))) if words else ""), tag, outside)
            if soft:
                softened.append(node)
            if not hidden and len(stack) < DEPTH:
                stack[-1][1].items.append(node)
            elif not hidden:
                node = stack[-1][1]
        else:
            node = stack[-1][1]
        if tag == "a":
            in_link += 1
        if outside:
            hidden += 1
        stack.append(("!" + tag if outside else tag, node))
        opened[tag] += 1
    if at < len(page) and not hidden:
        text.append(page[at:])
    while len(stack) > 1:
        pop()
    flush()
    for node in softened:
        own, links = measured(node)
        node.outside = 2 * links >= own
    return root


def measured(node: Node) -> tuple[int, int]:
    """(characters, characters in links) of all text below a node."""
    own, links, left = 0, 0, [node]
    while left:
        n = left.pop()
        own, links = own + len(n.text), links + n.links
        left += n.items
    return own, links


class Slot:
    """A node of a template."""

    __slots__ = ("label", "tag", "outside", "pages", "items", "texts", "varied", "linked", "lost")

    def __init__(self, label: str, tag: str, outside: bool):
        self.label, self.tag, self.outside = label, tag, outside
        self.pages, self.varied, self.linked, self.lost = 0, 0, 0, 0
        self.items: list[Slot] = []
        self.texts: dict[str, int] = {}

    def __reduce__(self):
        return _slot, (self.label, self.tag, self.outside, self.pages, self.items, self.texts, self.varied, self.linked, self.lost)


def _slot(label, tag, outside, pages, items, texts, varied, linked, lost) -> Slot:
    s = Slot(label, tag, outside)
    s.pages, s.items, s.texts, s.varied, s.linked, s.lost = pages, items, texts, varied, linked, lost
    return s


def _key(text: str) -> str:
    """What is remembered of a text: itself, or the digest of a long one."""
    return text if len(text) <= 80 else "\0" + hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def groups(nodes: list[Node]) -> list[tuple[Node, list[Node]]]:
    """Runs of neighbours with one label."""
    out: list[tuple[Node, list[Node]]] = []
    for n in nodes:
        if out and out[-1][0].label == n.label:
            out[-1][1].append(n)
        else:
            out.append((n, [n]))
    return out


def as_slots(nodes: list[Node]) -> list[Slot]:
    """The tree of a page as a template of one page; a run of neighbours is one slot."""
    out = []
    for first, run in groups(nodes):
        s = Slot(first.label, first.tag, first.outside)
        s.pages = 1
        for n in run:
            if n.tag == "#":
                s.texts[_key(n.text)] = 1
                s.varied += len(n.text)
                s.linked += n.links
        inner = [as_slots(n.items) for n in run]
        for more in inner:
            s.items = merge_lists(s.items, more, same_page=True)
        out.append(s)
    return out


def matching(a: list[Slot], b: list[Slot]) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two lists: (matched nodes, matched pairs of these lists)."""
    if len(a) == 1 and len(b) == 1:
        return (1 + matching(a[0].items, b[0].items)[0], [(0, 0)]) if a[0].label == b[0].label else (0, [])
    if not a or not b:
        return 0, []
    weight = [[1 + matching(x.items, y.items)[0] if x.label == y.label else 0 for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        row, up = best[i + 1], best[i]
        for j in range(len(b)):
            row[j + 1] = max(up[j + 1], row[j], up[j] + weight[i][j])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1], pairs[::-1]


def merge(a: Slot, b: Slot, same_page: bool = False) -> Slot:
    a.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    a.varied += b.varied
    a.linked += b.linked
    for t, n in b.texts.items():
        a.texts[t] = max(a.texts.get(t, 0), n) if same_page else a.texts.get(t, 0) + n
    a.lost += b.lost
    if len(a.texts) > TEXTS and not same_page:  # frequent texts stay, with counts too low by what was taken off
        off = min(sorted(a.texts.values(), reverse=True)[TEXTS], int(LOST * a.pages) - a.lost)
        if off > 0:
            a.texts = {t: n - off for t, n in a.texts.items() if n > off}
            a.lost += off
    a.items = merge_lists(a.items, b.items, same_page)
    return a


def merge_lists(a: list[Slot], b: list[Slot], same_page: bool = False) -> list[Slot]:
    if not a:
        return b
    _, pairs = matching(a, b)
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += a[i:x] + b[j:y]
        if x < len(a):
            out.append(merge(a[x], b[y], same_page))
        i, j = x + 1, y + 1
    return out


def prune(slots: list[Slot], pages: int) -> list[Slot]:
    """Without optional nodes that few pages have, if there are too many."""
    def size(s: list[Slot]) -> int:
        return sum(1 + size(x.items) for x in s)

    def without(s: list[Slot], least: int) -> list[Slot]:
        for x in s:
            x.items = without(x.items, least)
        return [x for x in s if x.pages >= least]

    least = 2
    while size(slots) > NODES and least <= pages:
        slots = without(slots, least)
        least *= 2
    return slots


class Template:
    """What the pages of a host have in common."""

    def __init__(self, pages: int = 0, slots: list[Slot] | None = None):
        self.pages, self.slots = pages, slots or []

    def add(self, other: "Template") -> "Template":
        self.pages += other.pages
        self.slots = merge_lists(self.slots, other.slots)
        if self.pages % 64 == 0 or other.pages > 1:
            self.slots = prune(self.slots, self.pages)
        return self

    def constant(self, slot: Slot | None, text: str, share: float = SHARE) -> bool:
        return slot is not None and self.pages >= PAGES and slot.texts.get(_key(text), 0) > share * self.pages

    def numbered(self) -> list[Slot]:
        """All slots, in an order that stays."""
        out, left = [], self.slots[::-1]
        while left:
            out.append(left.pop())
            left += out[-1].items[::-1]
        return out

    def open_texts(self) -> dict[int, set[str]]:
        """By slot number, the texts whose counts do not tell whether they are constant."""
        if self.pages < PAGES:
            return {}
        least = (SHARE * self.pages, NOTICE * self.pages)
        found = {k: {t for t, n in s.texts.items() if any(n <= x < n + s.lost for x in least)} for k, s in enumerate(self.numbered()) if s.lost}
        return {k: texts for k, texts in found.items() if texts}

    def content(self) -> Slot | None:
        """The deepest slot that holds the bulk of the varying text off links."""

        def mass(s: Slot) -> float:
            if s.outside:
                return 0.0
            own = max(s.varied - 2 * s.linked, 0)
            if s.texts and self.pages >= PAGES and max(s.texts.values()) > SHARE * self.pages and len(s.texts) <= 3 and not s.lost:
                own = 0
            return own + sum(map(mass, s.items))

        total, slots, found = sum(map(mass, self.slots)), self.slots, None
        while slots:
            best = max(slots, key=mass)
            if best.tag == "#" or mass(best) < 0.75 * total or best.tag in ("p", "li", "td", "blockquote", "pre"):
                break
            found, slots = best, best.items
            if best.tag in ("article", "main") and not any(x.tag == "article" for x in slots):
                break
        return found


def align(runs: list[tuple[Node, list[Node]]], slots: list[Slot]) -> dict[int, Slot]:
    """The slots of a page's runs, by their place."""
    if not slots:
        return {}
    shells = []
    for first, run in runs:
        s = Slot(first.label, first.tag, first.outside)
        for m in run:  # children of all members, as a template of this page has them
            s.items = merge_lists(s.items, [Slot(n.label, n.tag, n.outside) for n, _ in groups(m.items)], same_page=True)
        shells.append(s)
    return {y: slots[x] for x, y in matching(slots, shells)[1]}


def carried(page: str, template: Template, wanted: dict[int, set[str]]) -> set[tuple[int, str]]:
    """Which of the wanted texts (by slot number) the page's nodes carry, aligned as for extraction."""
    number = {id(s): k for k, s in enumerate(template.numbered())}
    out: set[tuple[int, str]] = set()

    def walk(nodes: list[Node], slots: list[Slot]) -> None:
        runs = groups(nodes)
        for k, slot in align(runs, slots).items():
            texts = wanted.get(number[id(slot)], ())
            for n in runs[k][1]:
                if n.tag == "#":
                    if _key(n.text) in texts:
                        out.add((number[id(slot)], _key(n.text)))
                elif not n.outside:
                    walk(n.items, slot.items)

    walk(parse(page).items, template.slots)
    return out


def extract(page: str, template: Template | None) -> str:
    """The page's blocks in the template's content region, joined by line ends."""
    root = parse(page)
    region = template.content() if template else None
    blocks: list[tuple[str, bool, bool]] = []  # text, in the region, constant

    def walk(nodes: list[Node], slots: list[Slot], inside: bool, block: Node, article: bool) -> None:
        runs = groups(nodes)
        of = align(runs, slots)
        for k, (first, run) in enumerate(runs):
            slot = of.get(k)
            here = inside or (slot is not None and slot is region)
            for n in run:
                if n.outside:
                    continue
                if n.tag == "#":
                    # Inside an article only whole blocks can be notices.
                    can = not article or len(nodes) == 1 and block.tag not in CELLS
                    blocks.append((n.text, here, bool(template) and can and template.constant(slot, n.text, NOTICE if article else SHARE)))
                else:
                    walk(n.items, slot.items if slot else [], here, n, article or n.tag in ("article", "main"))

    walk(root.items, template.slots if template else [], False, root, False)
    chosen = [(t, c) for t, here, c in blocks if here] or [(t, c) for t, _, c in blocks]
    varying = [t for t, c in chosen if not c]
    # Where nearly all of an article is constant, the host holds copies of it, not a template.
    if 2 * sum(map(len, varying)) < sum(len(t) for t, _ in chosen):
        varying = [t for t, _ in chosen]
    return "\n".join(varying)


HOST = r"\A[ \t\r\n\f]*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: str | None) -> str:
    m = re.match(HOST, url or "")
    return m.group(1).lower() if m else ""


def host_column(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


PART = "host string, part long, template binary"


def templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, template): one row for each host; pages: page_id, url, html."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in batches:
            for url, page in zip(batch.column(0), batch.column(1)):
                one = Template(1, as_slots(parse(page.as_py() or "").items))
                name = host(url.as_py())
                known[name] = known[name].add(one) if name in known else one
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array([part] * len(known), pa.int64()), pa.array([pickle.dumps(t) for t in known.values()], pa.binary())], ["host", "part", "template"])

    def join(group: pa.Table) -> pa.Table:
        out = None
        for x in group.sort_by("part")["template"]:
            t = pickle.loads(x.as_buffer())
            out = t if out is None else out.add(t)
        return pa.table({"host": group["host"][:1], "part": pa.array([group["part"][0].as_py() // GROUP], pa.int64()), "template": pa.array([pickle.dumps(out)], pa.binary())})

    found = scratch.put(pages.select("url", "html").mapInArrow(tidied(learn), PART), "templates-0")
    most, level = found.agg(F.max("part")).first()[0] or 0, 0
    while True:
        level += 1
        merged = found.groupBy("host", F.floor(F.col("part") / GROUP).alias("g")).applyInArrow(lambda t: done(join(t)), PART)
        found, most = scratch.put(merged, f"templates-{level}"), most // GROUP
        if most == 0:
            return found.select("host", "template")


def recounted(pages: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, template) with exact counts of the texts that the bound leaves open."""

    def unsure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(pickle.loads(t.as_buffer()).open_texts()) for t in batch.column(1)], pa.bool_()))

    left = scratch.put(found.mapInArrow(tidied(unsure), "host string, template binary"), "unsure")
    if left.isEmpty():
        return found

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Template, dict[int, set[str]]]] = {}
        n: dict[tuple[str, int, str], int] = {}
        for batch in batches:
            for name, page, blob in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if name not in known:
                    t = pickle.loads(blob.as_buffer())
                    known[name] = t, t.open_texts()
                for k, text in carried(page.as_py() or "", *known[name]):
                    n[name, k, text] = n.get((name, k, text), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in n], pa.string()), pa.array([x[1] for x in n], pa.int64()), pa.array([x[2] for x in n], pa.string()), pa.array(list(n.values()), pa.int64())], ["host", "slot", "text", "n"])

    # Templates, not pages, travel where they are few enough.
    few = (left.agg(F.sum(F.length("template"))).first()[0] or 0) <= SENT_BYTES
    named = pages.select(host_column("url").alias("host"), "html").join(F.broadcast(left) if few else left, "host")
    seen = named.select("host", "html", "template").mapInArrow(tidied(count), "host string, slot long, text string, n long").groupBy("host", "slot", "text").agg(F.sum("n").alias("n"))
    counts = seen.groupBy("host").agg(F.collect_list(F.struct("slot", "text", "n")).alias("counts"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for blob, counted in zip(batch.column(1), batch.column(2).to_pylist()):
                t = pickle.loads(blob.as_buffer())
                exact = {(c["slot"], c["text"]): c["n"] for c in counted or []}
                wanted, slots = t.open_texts(), t.numbered()
                for k, texts in wanted.items():
                    slots[k].texts |= {x: exact.get((k, x), 0) for x in texts}
                out.append(pickle.dumps(t))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["host", "template"])

    return scratch.put(found.join(counts, "host", "left").select("host", "template", "counts").mapInArrow(tidied(put), "host string, template binary"), "recounted")


RESULT = "page_id long, url string, text string, n_chars long"


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    scratch = Scratch(pages.sparkSession, "wrappers")
    found = recounted(pages, templates(pages, scratch), scratch)

    def rows(batch: pa.RecordBatch, template_of) -> pa.RecordBatch:
        texts = [extract(p.as_py() or "", template_of(i)) for i, p in enumerate(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    if (found.agg(F.sum(F.length("template"))).first()[0] or 0) <= SENT_BYTES:
        sent = {r["host"]: r["template"] for r in found.toArrow().to_pylist()}

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {h: pickle.loads(t) for h, t in sent.items()}
            for batch in batches:
                hosts = [host(u.as_py()) for u in batch.column(1)]
                yield rows(batch, lambda i: known.get(hosts[i]))  # noqa: B023

        return pages.mapInArrow(tidied(apply), RESULT)

    name = host_column("url")

    def apply_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, template = None, None
        for batch in batches:
            def of(i: int) -> Template:
                nonlocal last, template
                blob = batch.column(3)[i].as_buffer()  # noqa: B023
                if last is None or not blob.equals(last):
                    last, template = blob, pickle.loads(blob)
                return template

            yield rows(batch, of)

    return pages.withColumn("host", name).join(found, "host").select("page_id", "url", "html", "template").mapInArrow(tidied(apply_joined), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
