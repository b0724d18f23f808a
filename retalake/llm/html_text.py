"""Main text of web pages by wrapper induction.

A page becomes a tree of elements. The trees of all pages of a host, and of each
kind of its pages, are laid over each other from the root down, elements of equal
tag and classes on each other (a style tree). The place of a block is its path in
that tree. For each place it is counted on how many pages it is met, and on how
many with which text; copies, pages whose blocks all have the same texts, count
once. A text that stands at its place on nearly all pages that have the place is
constant and belongs to the template; so do all repeated texts of a place outside
of articles where nearly every text is repeated. A place outside of articles
where nearly no text is repeated is a slot.

A page's blocks are then read in page order. What lies in elements that say by
tag, role or class name what they are (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, comments of readers) is left out, and so is what
belongs to the template, inside an article as well. If a page marks its article,
or else its main part, other blocks count only if they fill a slot and are not
mostly links. A marked part of which the template leaves nothing stays whole: it
is one of many near copies.

Kinds are told apart by the upper levels of the tree. What is shuffled is hashes
of places and texts, summed per task first, so a host with a third of all pages
is no hot group; pages stay where they are and meet the small wrapper of their
host in a join that Spark may split.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import counted_broadcast, scratch

#: A text is constant if it stands at its place on so many of the pages with the place, and on so many pages at least.
CONSTANT = 0.8
MATCHES = 3
#: Levels of the tree that tell kinds of pages apart.
KIND_LEVELS = 3
#: Wrappers, and keys in them, that may be broadcast; more meet the pages in a shuffled join.
BROADCAST_HOSTS = 20_000
BROADCAST_KEYS = 2_000_000

TAG = re.compile(r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|$)", re.I)
BLANKS = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "noframes", "iframe", "noembed"))
#: Elements that end a line of text.
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
#: Elements that are closed by the start of one of the named.
CLOSED_BY = {
    "p": BLOCK - frozenset(("br", "head", "html", "body", "title", "td", "th", "tr", "li", "dd", "dt")),
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "tfoot")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)), "head": frozenset(("body",)),
}
#: Elements whose text is never main text.
SKIPPED = frozenset(
    "head script style noscript template nav aside footer form button select option textarea input label svg math canvas "
    "iframe object embed audio video map dialog title menu fieldset legend datalist output progress meter noframes "
    "noembed xmp".split()
)
#: Words in class, id or role that name such parts.
PARTS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|nav|navbar|"
    r"navigation|menu|breadcrumb|breadcrumbs|header|masthead|topbar|footer|sidebar|aside|complementary|contentinfo|cookie|"
    r"cookies|consent|notice|notices|gdpr|popup|modal|newsletter|subscribe|subscription|signup|login|search|share|sharing|"
    r"social|related|recommended|recommendations|comment|comments|reply|replies|disqus|pagination|pager|toolbar|widget|"
    r"copyright|legal|disclaimer|skip|hidden|form)(?=$|[\s_-])",
    re.I,
)
#: Of these, names that parts of an article carry as well.
INNER = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?=$|[\s_-])", re.I)


class Node:
    __slots__ = ("children", "label", "parts", "skip", "tag", "text")

    def __init__(self, tag: str, label: str, skip: bool) -> None:
        self.tag, self.label, self.skip = tag, label, skip
        self.children: list[Node] = []
        self.text = ""  # of the element's own runs, for alignment
        self.parts: list[str | Node] = []  # runs of text and elements, in page order


def boilerplate(tag: str, attributes: str, inside_article: bool) -> tuple[bool, str]:
    """Whether an element is a part that is left out, and its class names for its label."""
    names, hidden = [], False
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            hidden |= key == "hidden" or (key == "aria-hidden" and value.lower() == "true")
            hidden |= key == "style" and re.search(r"display\s*:\s*none", value, re.I) is not None
            if key in ("class", "id", "role"):
                names.append(value)
    said = " ".join(names)
    skip = hidden or tag in SKIPPED or (tag == "header" and not inside_article)
    if said and not skip and tag not in ("html", "body", "main"):
        named = INNER.sub(" ", said) if inside_article else said
        skip = PARTS.search(named) is not None
    return skip, said


def parse(page: str) -> Node:
    """Tree of a page. Broken markup is read as browsers do, roughly: nothing is lost, stray end tags are ignored."""
    root = Node("", "", False)
    stack, at, size = [root], 0, len(page)

    def run(text: str) -> None:
        if text:
            decoded = html.unescape(text) if "&" in text else text
            stack[-1].parts.append(decoded)
            stack[-1].text += decoded

    while at < size:
        m = TAG.search(page, at)
        if m is None:
            run(page[at:])
            break
        run(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and all(n.tag != "p" for n in stack):
                stack[-1].parts.append(Node("br", "br", False))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("table", "article", "body") and tag not in ("table", "article", "body", "html", "main", "div", "section"):
                    break
            continue
        for k in range(len(stack) - 1, 0, -1):
            if tag in CLOSED_BY.get(stack[k].tag, ()):
                del stack[k:]
                break
            if stack[k].tag in BLOCK and stack[k].tag not in CLOSED_BY:
                break
        skip, said = boilerplate(tag, m[3] or "", any(n.tag in ("article", "main") for n in stack))
        node = Node(tag, f"{tag}.{DIGITS.sub('0', BLANKS.sub('.', said.strip()))}" if said else tag, skip)
        stack[-1].parts.append(node)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            stack.append(node)
    return root


class Block(NamedTuple):
    text: str
    place: str
    level: int  # 2 in an article, 1 in the page's main part, 0 elsewhere
    linked: int  # characters in links


def blocks(root: Node) -> list[Block]:
    """Blocks of text outside of skipped parts, in page order."""
    out: list[Block] = []
    runs: list[tuple[str, bool]] = []
    where = [("", 0)]

    def close() -> None:
        text = BLANKS.sub(" ", "".join(r for r, _ in runs)).strip()
        if text:
            out.append(Block(text, *where[-1], sum(len(r) for r, link in runs if link)))
        runs.clear()

    todo: list[tuple[str | Node | None, str, int, bool]] = [(root, "", 0, False)]
    while todo:
        item, place, inside, link = todo.pop()
        if item is None:  # end of a block element
            close()
            where.pop()
        elif isinstance(item, str):
            runs.append((item, link))
        elif item.skip:
            if item.tag in BLOCK:
                close()
        else:
            inside = max(inside, {"article": 2, "main": 1}.get(item.tag, 0))
            here = f"{place}/{item.label}" if item.tag in BLOCK else place
            if item.tag in BLOCK:
                close()
                where.append((here, inside))
                todo.append((None, here, inside, link))
            todo += [(p, here, inside, link or item.tag == "a") for p in reversed(item.parts)]
    close()
    return out


def aligned(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes in a largest top-down, order-preserving matching of equal labels (simple tree matching)."""

    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def match(x: Node, y: Node, depth: int = 0) -> int:
        """Size of the matching of two subtrees whose roots match; the choice is kept in memo."""
        key = (id(x), id(y))
        if key in memo:
            return memo[key][0]
        xs, ys = x.children, y.children
        if depth > 100:
            xs = []
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, p in enumerate(xs, 1):
            for j, q in enumerate(ys, 1):
                own = best[i - 1][j - 1] + match(p, q, depth + 1) if p.label == q.label else 0
                best[i][j] = max(best[i - 1][j], best[i][j - 1], own)
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        memo[key] = (1 + best[len(xs)][len(ys)], pairs)
        return memo[key][0]

    match(a, b)
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        todo += memo.get((id(x), id(y)), (0, []))[1]
    return out


def entry(kind: str, said: str, place: str) -> str:
    """Name of a text at a place, or of the place itself (said = '*'), on the pages of a kind ('' for all kinds)."""
    return f"{kind} {said} {place}"


def digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def key(name: str) -> int:
    return int.from_bytes(blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def kind_of(found: list[Block]) -> str:
    """Kind of a page: the upper levels of its tree, as far as they hold text."""
    return digest(" ".join(sorted({"/".join(b.place.split("/")[: KIND_LEVELS + 1]) for b in found})))


def seen(page: str | None) -> tuple[int, list[tuple[str, str, bool]]]:
    """Fingerprint of a page's texts, and the distinct (place, text at the place or the place again, outside of articles)."""
    found = blocks(parse(page or ""))
    rows = {}
    for kind in ("", kind_of(found)):
        for b in found:
            place = entry(kind, "*", b.place)
            rows[place, place, b.level < 2] = None
            rows[place, entry(kind, digest(b.text), b.place), b.level < 2] = None
    return key("\n".join(b.text for b in found)), list(rows)


def induced(pages: list[str]) -> tuple[list[str], list[str]]:
    """Template and slots of one host's pages, as `wrappers` learns them."""
    counts = Counter(row for rows in dict(map(seen, pages)).values() for row in rows)
    met, all_of, repeated = defaultdict(int), defaultdict(int), defaultdict(int)
    for (place, text, outer), n in counts.items():
        if text == place:
            met[place, outer] = n
        else:
            all_of[place, outer] += n
            repeated[place, outer] += n * (n >= MATCHES)
    template = {
        text
        for (place, text, outer), n in counts.items()
        if text != place and n >= MATCHES
        and (n >= CONSTANT * met[place, outer] or (outer and repeated[place, outer] >= CONSTANT * all_of[place, outer]))
    }
    slots = {p for (p, outer), n in met.items() if outer and n >= MATCHES and repeated[p, outer] <= (1 - CONSTANT) * all_of[p, outer]}
    return sorted(template), sorted(slots)


def wrapper(pages: list[str]) -> list[str]:
    """Texts at places that are template on one host's pages."""
    return induced(pages)[0]


def chosen(page: str | None, template: frozenset[int], slots: frozenset[int]) -> str:
    """Main text of a page; template and slots are keys of their names."""
    found = blocks(parse(page or ""))
    level = max((b.level for b in found), default=0)
    kinds = ("", kind_of(found)) if template or slots else ()

    def known(among: frozenset[int], said: str, place: str) -> bool:
        return bool(among) and any(key(entry(kind, said, place)) in among for kind in kinds)

    kept = [
        b
        for b in found
        if (b.level == level or (2 * b.linked <= len(b.text) and known(slots, "*", b.place)))
        and not (template and known(template, digest(b.text), b.place))
    ]
    if not kept and level:
        kept = [b for b in found if b.level == level]
    return "\n".join(b.text for b in kept)


def main_text(page: str | None, template: frozenset[str] = frozenset(), slots: frozenset[str] = frozenset()) -> str:
    return chosen(page, frozenset(map(key, template)), frozenset(map(key, slots)))


def host(url: str) -> object:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def wrappers(hosted: DataFrame) -> DataFrame:
    """A row per host that has a wrapper: host, template, slots, learned from all of its pages."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                pages = [seen(p.as_py()) for p in part.column("html")]
                rows = [[{"place": key(p), "item": key(t), "outer": o} for p, t, o in found] for _, found in pages]
                columns = [part.column("host"), pa.array([h for h, _ in pages], pa.int64()), pa.array(rows, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["host", "h", "rows"])

    kind = pa.list_(pa.struct([("place", pa.int64()), ("item", pa.int64()), ("outer", pa.bool_())]))
    schema = "host string, h long, rows array<struct<place: long, item: long, outer: boolean>>"
    pages = hosted.where("html IS NOT NULL").select("host", "html").mapInArrow(read, schema).dropDuplicates(["host", "h"])
    counts = pages.select("host", F.inline("rows")).groupBy("host", "place", "item", "outer").agg(F.count("*").alias("n"))
    counts = scratch(hosted.sparkSession).save(counts, "counts")
    text = F.col("item") != F.col("place")
    places = counts.groupBy("host", "place", "outer").agg(
        F.max(F.when(~text, F.col("n"))).alias("met"),
        F.sum(F.when(text, F.col("n"))).alias("all_of"),
        F.coalesce(F.sum(F.when(text & (F.col("n") >= MATCHES), F.col("n"))), F.lit(0)).alias("repeated"),
    )
    places = places.where(F.col("met") >= MATCHES)
    constant = (F.col("n") >= CONSTANT * F.col("met")) | (F.col("outer") & (F.col("repeated") >= CONSTANT * F.col("all_of")))
    template = counts.where(text & (F.col("n") >= MATCHES)).join(places, ["host", "place", "outer"]).where(constant)
    slots = places.where(F.col("outer") & (F.col("repeated") <= (1 - CONSTANT) * F.col("all_of")))
    found = template.select("host", "item", F.lit(None).cast("long").alias("slot")).unionByName(
        slots.select("host", F.lit(None).cast("long").alias("item"), F.col("place").alias("slot"))
    )
    return found.groupBy("host").agg(F.collect_set("item").alias("template"), F.collect_set("slot").alias("slots"))


def extracted(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars.

    A null or empty page has the text ''. Pages without a host share one
    wrapper. Repeated rows count as one page for learning.
    """
    hosted = pages.select("page_id", "url", "html", host("url").alias("host"))
    useful = scratch(spark).save(wrappers(hosted), "wrappers")
    keys = useful.agg(F.sum(F.size("template") + F.size("slots"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[str, tuple[frozenset[int], frozenset[int]]] = {}
            texts = []
            for k, name in enumerate(batch.column("host").to_pylist()):
                if name not in sets:
                    sets[name] = tuple(frozenset(batch.column(c)[k].as_py() or ()) for c in ("template", "slots"))
                texts.append(chosen(batch.column("html")[k].as_py(), *sets[name]))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    if keys <= BROADCAST_KEYS:
        useful = counted_broadcast(useful, BROADCAST_HOSTS)
    joined = hosted.join(useful, "host", "left").select("page_id", "url", "html", "host", "template", "slots")
    kind = dict(pages.dtypes)
    return joined.mapInArrow(run, f"page_id {kind['page_id']}, url string, text string, n_chars long")
