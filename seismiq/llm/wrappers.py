"""Main-text extraction by wrappers: union-free regular expressions per host.

A page is a stream of tags and texts.  Pages of a host are aligned one by one
with the host's wrapper, a regular expression without unions over such tokens:
tags and texts that agree stay, texts that differ become slots, a run of equal
groups becomes a repeated group, and what only one side has becomes an optional
group.  Each task aligns the pages of a host that it reads; the partial
wrappers, whose size is that of the template, are then aligned with each other,
in two steps, so that a host with very many pages is no single task's work.

On a page with an article (or main) element, main text is what that element
holds.  All other pages are matched with their host's expression, and each of their
texts is counted at its place: its slot or, where the bounded expression has none
for it, its path.  A text that several pages share at a place, and at least the
share TEMPLATE_SHARE of all pages that have the place, is template, copies of a page
being one page; a block all of whose texts are template goes.  Within an expression
a slot holds the texts of a few pages only, which rank its optional parts; no text is
judged by them.  Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comment lists,
known by tag or class, go on all pages, since their texts may vary too.

Text in a block is decoded, blanks are merged, and blocks are joined by two line
ends.

Defined results: a null or empty html gives the empty text; a null url counts as
a host of its own; unclosed and stray tags are tolerated; repeated pages give
equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, freed_shuffles, materialise, slices

#: Element names, and words of class, id and role, that are not main text.
CHROME_TAGS = frozenset("nav header footer aside form script style noscript template iframe select button textarea input svg dialog menu head".split())
CHROME_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion sidebar side menu nav navbar navigation breadcrumb "
    "breadcrumbs header masthead footer contentinfo complementary cookie cookies consent notice notices notification gdpr popup modal overlay "
    "dialog newsletter subscribe subscription signup login share sharing social related recommended widget search toolbar pagination pager comment "
    "comments reply replies respond disqus discussion toc skip".split())
#: Words that stand beside them in names such as "site-footer" or "comment-list"; with any other word a name means something else.
PLACE_WORDS = frozenset(
    "site page main top bottom left right upper lower global primary secondary mobile desktop sticky list item items box bar block area section "
    "wrapper wrap container inner outer link links button buttons form thread unit slot widget panel row column col group".split())
MAIN_TAGS = frozenset(["article", "main"])
#: What the path of the article's texts holds.
ARTICLE = "*"
#: An article or main element is the page's article if it holds at least this share of the text that is not chrome.
ARTICLE_SHARE = 0.25
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style", "noscript", "template", "iframe", "textarea", "title", "svg"])
#: Elements whose start closes an open one of the same list.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Pages whose texts a slot holds; a text that so many of them share is template; the longest repeated group looked for, in tokens.
SAMPLE_PAGES, TEMPLATE_PAGES, LONGEST_GROUP, SALTS = 8, 3, 24, 16
#: Of the pages that have a place, the share that must have a text there for it to be template.
TEMPLATE_SHARE = TEMPLATE_PAGES / SAMPLE_PAGES
#: Nodes of an expression: beyond them the optional parts that fewest of the sampled pages have are left out.
MOST_NODES = 300

_TAG = re.compile(r"""<!--|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes): kind is 'open', 'close' or 'text'."""
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at = m.end()
        if m.group() == "<!--":
            stop = page.find("-->", at)
            at = end if stop < 0 else stop + 3
        elif m.group(2):
            name = m.group(2).lower()
            yield ("close" if m.group(1) else "open"), name, m.group(3)
            if name in RAW and not m.group(1) and not m.group(3).endswith("/"):
                stop = re.compile(f"</{name}\\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
                yield "close", name, ""


@lru_cache(20_000)
def names_chrome(attributes: str) -> bool:
    """Whether a class, id or role names chrome: one name, all of whose words are chrome or places, and one of them chrome."""
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = _WORD.findall(name)
            if not CHROME_WORDS.isdisjoint(words) and all(w in CHROME_WORDS or w in PLACE_WORDS for w in words):
                return True
    return False


class Element:
    """An element while its page is read: its name, whether its names say chrome, whether its tags do, and the text inside."""

    __slots__ = ("buried", "main", "marked", "name", "path", "text", "up")

    def __init__(self, name: str, marked: bool, up: Element | None):
        self.name, self.marked, self.up = name, marked, up
        self.text, self.main, self.path = 0, False, ""
        self.buried = name in CHROME_TAGS or up is not None and up.buried


def _article(elements: list[Element], texts: list[tuple]) -> Element | None:
    """The article or main element with most text, if it holds enough of the page's; of nested ones with one text the outer one."""
    best = max((e for e in elements if e.name in MAIN_TAGS and not e.buried), key=lambda e: e.text, default=None)
    if best is None or not best.text:
        return None
    above = set()
    e: Element | None = best
    while e is not None:
        above.add(id(e))
        e = e.up

    def counts(e: Element | None) -> bool:
        """Whether a text of the element is in the article, or in nothing that is chrome."""
        while e is not None:
            if e is best:
                return True
            if id(e) not in above and (e.marked or e.name in CHROME_TAGS):
                return False
            e = e.up
        return True

    open_text = sum(len(t[3]) for t in texts if t[1] is not None and counts(t[1]))
    return best if best.text >= ARTICLE_SHARE * open_text else None


def stream(page: str) -> list[tuple]:
    """('t', tag) and ('#', path, block number, text) tokens of a page, with unclosed elements closed.

    A tag has a mark if its class, id or role names chrome; names of elements
    that hold the page's article, or without one most of its text, do not count.
    """
    out, stack, block, elements, texts, total = [], [], 0, [], [], 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            out.append(("/", stack.pop()))

    for kind, value, attributes in tokens(page):
        if kind == "text":
            if value.strip():
                out.append(("#", stack[-1] if stack else None, block, value))
                texts.append(out[-1])
                total += len(value)
                for e in stack:
                    e.text += len(value)
            elif value:
                out.append(("#", False, block, " "))
            continue
        if value not in INLINE:
            block += 1
        elif value == "br":
            out.append(("#", False, block, " "))
        if kind == "open":
            shut = CLOSES.get(value, ()) if value in INLINE or value in CLOSES else ("p",)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in shut:
                    close(i)
                    break
                if stack[i].name not in INLINE and stack[i].name != "p":
                    break
            element = Element(value, bool(attributes) and value not in ("body", "html") and names_chrome(attributes), stack[-1] if stack else None)
            elements.append(element)
            out.append(("t", element))
            if value not in VOID:
                stack.append(element)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == value:
                    close(i)
                    break
    close(0)
    article = _article(elements, texts)
    e = article
    while e is not None:
        e.main = True
        e = e.up
    for e in elements:  # an element comes after those around it
        if e.marked and not (e.main if article else 2 * e.text > total):
            e.name += "!"
        e.path = f"{e.up.path}/{e.name}" if e.up else e.name
        if e is article:
            e.path += "/" + ARTICLE
    return [("#", None if t[1] is False else t[1].path if t[1] else "", t[2], t[3]) if t[0] == "#" else ("t", t[1].name if t[0] == "t" else "/" + t[1].name)
            for t in out]


# A wrapper's nodes: ["t", tag], ["#", sample, element], ["?", nodes], ["+", nodes]; two nodes are alike if their keys are.
# A sample is a list of [page's content hash, sorted hashes of its texts at the slot], sorted.
def key(node: list) -> str:
    return f"<{node[1]}>" if node[0] == "t" else "#" if node[0] == "#" else "(" + "".join(map(key, node[1])) + ")" + node[0]


def _whole(nodes: list) -> bool:
    """Whether every element of a group is opened and closed in it."""
    depth = 0
    for n in nodes:
        if n[0] == "t" and n[1] not in VOID:
            depth += -1 if n[1][0] == "/" else 1
            if depth < 0:
                return False
    return depth == 0


def slots(nodes: list) -> Iterator[list]:
    """The text slots of an expression, in order."""
    for n in nodes:
        if n[0] == "#":
            yield n
        elif n[0] != "t":
            yield from slots(n[1])


def _union(a: list, b: list) -> list:
    """The sample of two slots that are one."""
    if not b or len(a) >= SAMPLE_PAGES and b[0][0] > a[-1][0]:
        return a
    if not a:
        return b
    pages = {p: x for p, x in a}
    for p, x in b:
        pages[p] = sorted({*pages[p], *x}) if p in pages else x
    return [[p, pages[p]] for p in sorted(pages)[:SAMPLE_PAGES]]


def pour(nodes: list, others: Iterator[list]) -> list:
    """The nodes with the samples of other slots, one for each of theirs, added."""
    return [n if n[0] == "t" else ["#", _union(n[1], next(others)[1]), n[2]] if n[0] == "#" else [n[0], pour(n[1], others)] for n in nodes]


def fold(nodes: list, longest: int = LONGEST_GROUP) -> list:
    """Runs of equal groups become one repeated group, inner ones first, until nothing repeats."""
    keys = [key(n) for n in nodes]
    size = 1
    while size <= min(longest, len(keys) // 2):
        if not any(map(eq, keys, keys[size:])):
            size += 1
            continue
        out, names, i, m = [], [], 0, len(keys)
        while i < m:
            if i + 2 * size <= m and keys[i] == keys[i + size] and keys[i:i + size] == keys[i + size:i + 2 * size] and _whole(nodes[i:i + size]):
                body, n = keys[i:i + size], 2
                while keys[i + n * size:i + (n + 1) * size] == body:
                    n += 1
                inner = nodes[i:i + size]
                for k in range(i + size, i + n * size, size):
                    inner = pour(inner, slots(nodes[k:k + size]))
                out.append(inner[0] if size == 1 and inner[0][0] == "+" else ["+", inner])
                names.append(key(out[-1]))
                i += n * size
            else:
                out.append(nodes[i])
                names.append(keys[i])
                i += 1
        size = 1 if len(out) < m else size + 1
        nodes, keys = out, names
    return nodes


def _core(n: list) -> str:
    """What a node matches by: optional and repeated groups match their group, a text one of the same element."""
    while n[0] in "?+" and (n[0] == "?" or len(n[1]) == 1 and n[1][0][0] in "?+") and len(n[1]) == 1:
        n = n[1][0]
    return "(" + "".join(map(key, n[1])) + ")" if n[0] in "?+" else "#" + n[2] if n[0] == "#" else key(n)


def _bodies(nodes: list) -> list[list[str]]:
    """The keys of the repeated groups, inner ones first."""
    out = []
    for n in nodes:
        if n[0] in "?+":
            out += _bodies(n[1])
            if n[0] == "+":
                out.append([key(x) for x in n[1]])
    return out


def gather(nodes: list, bodies: list[list[str]]) -> list:
    """Single groups that are repeated elsewhere become repeated groups too, so that a repeat takes them in."""
    keys = [key(n) for n in nodes]
    for body in dict.fromkeys(map(tuple, bodies)):
        size, first = len(body), body[0]
        if first not in keys or size == 1 and first[-1] in "?+":
            continue
        out, names, i = [], [], 0
        while i < len(nodes):
            if keys[i] == first and tuple(keys[i:i + size]) == body and _whole(nodes[i:i + size]):
                out.append(["+", nodes[i:i + size]])
                names.append(f"({''.join(body)})+")
                i += size
            else:
                out.append(nodes[i])
                names.append(keys[i])
                i += 1
        nodes, keys = out, names
    return nodes


def _steps(ca: list[str], cb: list[str]) -> Iterator[tuple[int | None, int | None]]:
    """Longest common subsequence: pairs of places, None where only one side has a node."""
    head, m, n = 0, len(ca), len(cb)
    while head < min(m, n) and ca[head] == cb[head]:
        yield head, head
        head += 1
    while m > head and n > head and ca[m - 1] == cb[n - 1]:
        m, n = m - 1, n - 1
    rows = [[0] * (n - head + 1) for _ in range(m - head + 1)]
    for i in range(m - 1, head - 1, -1):
        row, below = rows[i - head], rows[i - head + 1]
        for j in range(n - 1, head - 1, -1):
            k = j - head
            row[k] = below[k + 1] + 1 if ca[i] == cb[j] else max(below[k], row[k + 1])
    i = j = head
    while i < m or j < n:
        if i < m and j < n and ca[i] == cb[j]:
            yield i, j
            i, j = i + 1, j + 1
        elif j >= n or i < m and rows[i - head + 1][j - head] >= rows[i - head][j - head + 1]:
            yield i, None
            i += 1
        else:
            yield None, j
            j += 1
    yield from zip(range(m, len(ca)), range(n, len(cb)))


def align(a: list, b: list) -> list:
    """The wrapper of two: common nodes in order; a repeat takes in its single group; the rest is optional."""
    if [key(n) for n in a] == [key(n) for n in b]:
        return pour(a, slots(b))
    bodies = _bodies(a) + _bodies(b)
    a, b = gather(a, bodies), gather(b, bodies)

    def optional(n: list) -> list:
        return n if n[0] == "?" else ["?", [n]]

    out = []
    for i, j in _steps([_core(n) for n in a], [_core(n) for n in b]):
        if i is None or j is None:
            out.append(optional(a[i] if j is None else b[j]))
            continue
        x, y = a[i], b[j]
        inner, other = (y, x) if y[0] == "+" and x[0] != "+" else (x, y)
        (inner,) = pour([inner], slots([other]))
        out.append(optional(inner) if "?" in (x[0], y[0]) else inner)
    return fold(out)


def supported(nodes: list) -> list:
    """The expression within MOST_NODES: optional parts that fewer pages have go first, then the last of its nodes."""
    if len(nodes) <= MOST_NODES:
        return nodes
    seen = [max((len(x[1]) for x in slots([n])), default=0) if n[0] == "?" else SAMPLE_PAGES + 1 for n in nodes]
    kept = sorted(sorted(range(len(nodes)), key=lambda i: -seen[i])[:MOST_NODES])
    return [nodes[i] for i in kept]


def match(host: list, page: list) -> list[list | None]:
    """For each slot of a page's expression the slot of its host's; None where that has none."""
    gathered = gather(page, _bodies(host))
    found = {id(n): None for n in slots(gathered)}
    for i, j in _steps([_core(n) for n in host], [_core(n) for n in gathered]):
        if i is not None and j is not None:
            found.update(zip(map(id, slots([gathered[j]])), slots([host[i]])))
    return [found[id(n)] for n in slots(page)]


class Wrapper:
    """A host's expression and its number of pages."""

    def __init__(self, nodes: list | None = None, pages: int = 0):
        self.nodes, self.pages = nodes or [], pages
        self._matched: dict[str, list] = {}
        self._numbers: dict[str, list] = {}

    @classmethod
    def of(cls, page: str) -> Wrapper:
        tokens = stream(page)
        texts = [hash_of(t[3]) for t in tokens if t[0] == "#" and t[1] is not None]
        return cls(_shape(tokens, hash_of(repr(texts)), texts), 1)

    def add(self, other: Wrapper) -> None:
        self.nodes = supported(align(self.nodes, other.nodes) if self.pages else other.nodes)
        self.pages += other.pages

    def main_paths(self) -> Wrapper:
        """What chooses the main text of a page: the wrapper itself."""
        return self

    def template(self, tokens: list[tuple]) -> set[int]:
        """The texts of a page, by running number, that are template."""
        texts = [hash_of(t[3]) for t in tokens if t[0] == "#" and t[1] is not None]
        nodes = _shape(tokens, 0, range(len(texts)))
        shape = "".join(map(key, nodes))
        if shape not in self._matched:
            if len(self._matched) > 1000:
                self._matched.clear()
            self._matched[shape] = [_shared(s) for s in match(self.nodes, nodes)]
        return {k for slot, shared in zip(slots(nodes), self._matched[shape]) for k in slot[1][0][1] if texts[k] in shared}

    def places(self, tokens: list[tuple]) -> list[int]:
        """Where each text of a page stands: the number of its slot in the expression or, below 0, its path."""
        paths = [t[1] for t in tokens if t[0] == "#" and t[1] is not None]
        nodes = _shape(tokens, 0, range(len(paths)))
        shape = "".join(map(key, nodes))
        if shape not in self._numbers:
            if len(self._numbers) > 1000:
                self._numbers.clear()
            number = {id(s): i for i, s in enumerate(slots(self.nodes))}
            self._numbers[shape] = [None if s is None else number[id(s)] for s in match(self.nodes, nodes)]
        found = [-1 - hash_of(p) for p in paths]
        for slot, at in zip(slots(nodes), self._numbers[shape]):
            if at is not None:
                for k in slot[1][0][1]:
                    found[k] = at
        return found

    def dump(self) -> str:
        return json.dumps([self.nodes, self.pages], separators=(",", ":"))

    @classmethod
    def load(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))


def _shape(tokens: list[tuple], page: int, texts: Sequence[int]) -> list:
    """A page's expression; its slots hold the given numbers of the page's texts."""
    numbers = iter(texts)
    return fold([["t", t[1]] if t[0] == "t" else ["#", [[page, [next(numbers)]]], t[1].rpartition("/")[2]]
                 for t in tokens if t[0] == "t" or t[1] is not None])


def _shared(slot: list | None) -> set[int]:
    """The texts that enough sampled pages share at a slot."""
    counts = Counter(x for _, texts in slot[1] for x in texts) if slot else {}
    return {x for x, n in counts.items() if n >= TEMPLATE_PAGES}


def hash_of(text: str) -> int:
    """48 bits for a text, blanks merged."""
    import xxhash

    return xxhash.xxh64_intdigest(" ".join(text.split()).encode("utf-8", "replace")) >> 16


@lru_cache(20_000)
def is_chrome(path: str) -> bool:
    """Whether an element of the path is chrome; of an article's text, one inside the article."""
    return any(t.endswith("!") or t in CHROME_TAGS for t in path.rpartition(f"/{ARTICLE}")[2].split("/"))


@lru_cache(20_000)
def in_article(path: str) -> bool:
    return ARTICLE in path.split("/") and not is_chrome(path)


def has_article(tokens: list[tuple]) -> bool:
    return any(t[0] == "#" and t[1] and in_article(t[1]) for t in tokens)


def extract(page: str, template: Wrapper | set[int]) -> str:
    """The main blocks of a page: those of its article or, without one, those that are not template.

    ``template`` are the running numbers of the page's template texts, or a wrapper that knows them from its own pages.
    """
    tokens = stream(page)
    texts = [t for t in tokens if t[0] == "#"]
    article = has_article(tokens)
    if isinstance(template, Wrapper):
        template = set() if article else template.template(tokens)
    blocks: dict[int, list[str]] = {}
    varying, k = set(), -1
    for t in texts:
        if t[1] is None:
            blocks.setdefault(t[2], []).append(t[3])
            continue
        k += 1
        if in_article(t[1]) if article else not is_chrome(t[1]):
            blocks.setdefault(t[2], []).append(t[3])
            if k not in template:
                varying.add(t[2])
    done = (" ".join(entities.unescape("".join(b)).split()) for n, b in blocks.items() if n in varying)
    return "\n\n".join(b for b in done if b)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wrapper of each host among a task's pages."""
    found: dict[str, Wrapper] = {}
    for batch in (x for b in batches for x in slices(b)):
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(host, Wrapper()).add(Wrapper.of(page))
        if len(found) > 20_000:  # a bounded number of hosts at a time
            yield _rows(found)
            found = {}
    yield _rows(found)


def _rows(found: dict[str, Wrapper]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([w.dump() for w in found.values()], pa.string())], ["host", "wrapper"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of one host, which come one after the other, aligned."""
    host, held = None, Wrapper()
    for batch in batches:
        done: dict[str, Wrapper] = {}
        for h, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if h != host:
                if host is not None:
                    done[host] = held
                host, held = h, Wrapper()
            held.add(Wrapper.load(w))
        yield _rows(done)
    if host is not None:
        yield _rows({host: held})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper of each host, as JSON."""
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = pages.select("host", "html").mapInArrow(_partial, "host string, wrapper string")
    salted = (made.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).repartition(parts, "host", "salt")
              .sortWithinPartitions("host", "salt").select("host", "wrapper").mapInArrow(_merge, "host string, wrapper string"))
    return salted.repartition(parts, "host").sortWithinPartitions("host").mapInArrow(_merge, "host string, wrapper string")


def _bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages without an article."""
    for batch in (x for b in batches for x in slices(b)):
        bare = [not has_article(stream(p)) for p in batch.column("html").to_pylist()]
        yield batch.filter(pa.array(bare, pa.bool_()))


PLACES = "host string, page long, k int, place long, text long"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and hash of each text of a page."""
    held: dict[str, Wrapper] = {}
    for batch in (x for b in batches for x in slices(b)):
        rows = []
        for host, page, html, wrapper in zip(*(batch.column(x).to_pylist() for x in ("host", "page", "html", "wrapper"))):
            if host not in held:
                if len(held) > 200:
                    held.clear()
                held[host] = Wrapper.load(wrapper)
            tokens = stream(html)
            texts = [hash_of(t[3]) for t in tokens if t[0] == "#" and t[1] is not None]
            rows += [(host, page, k, place, text) for k, (place, text) in enumerate(zip(held[host].places(tokens), texts))]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["host", "page", "k", "place", "text"])


def template_texts(named: DataFrame, expressions: DataFrame) -> DataFrame:
    """(host, page, template): of each page without an article the running numbers of its template texts, from counts over all pages."""
    spark = named.sparkSession
    with freed_shuffles(spark):
        bare = named.select("host", "page", "html").mapInArrow(_bare, "host string, page long, html string")
        texts = materialise(bare.join(expressions, "host").select("host", "page", "html", "wrapper").mapInArrow(_places, PLACES).distinct(), "places")
        at = ["host", "place"]
        pages = texts.select(*at, "page").distinct().groupBy(*at).agg(F.count("*").alias("pages"))
        shared = (texts.select(*at, "text", "page").distinct().groupBy(*at, "text").agg(F.count("*").alias("n")).where(F.col("n") >= TEMPLATE_PAGES)
                  .join(pages, at).where(F.col("n") >= TEMPLATE_SHARE * F.col("pages")).select(*at, "text"))
        return materialise(texts.join(shared, [*at, "text"]).groupBy("host", "page").agg(F.collect_list("k").alias("template")), "template")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (x for b in batches for x in slices(b)):
        out = [extract(page, set(template or ())) for page, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    named = bounded_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                         F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1), F.lit(""))).alias("host"))
    named = named.withColumn("page", F.xxhash64("html"))
    template = template_texts(named, materialise(wrappers(named), "wrappers"))
    found = named.join(template, ["host", "page"], "left").select("page_id", "url", "html", "template")
    texts = found.mapInArrow(_texts, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
