"""Main text of web pages through site style trees (operator 4).

The pages of a host are merged into one tree: an element's node is its path of tags and
names, with the presentation style (children's tags, repeats collapsed) of each element
above it. Over the distinct pages of a host that have a node, its importance is

    0.1 * entropy of its presentation styles + 0.9 * entropy of its contents,

each divided by the logarithm of the number of pages: near 1 where each page says
something else, near 0 where pages repeat one another. Nodes that name their purpose
(``nav``, ``footer``, an ``ad`` class) weigh 0 and ``article`` and ``main`` weigh 1 in
advance, which carries hosts too small for statistics. Branches below the threshold are
cut from each page; the rest is its text, inside ``article`` or ``main`` where a page has them.

Statistics are counts in Spark: no host's pages meet in a task. Pages get the cut nodes
they hold by a join on the page; html crosses it compressed.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revwatch.llm.common import written

THRESHOLD = 0.5
#: Fewer distinct pages say nothing about a node.
MIN_PAGES = 8
GAMMA = 0.9

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_NAME = re.compile(r"[a-z0-9]+")

VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag closes an open element of these kinds first.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_BARRIER = {"table", "ul", "ol", "dl", "select", "article", "main", "body", "html"}
NOISE_TAGS = set(
    "head nav header footer aside form script style noscript template iframe svg button select textarea "
    "menu dialog object embed input".split()
)
NOISE_NAMES = set(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments respond reply replies discussion disqus share sharing "
    "social related recommended widget toolbar pagination pager login signup search".split()
)
NOISE_WHOLE = {"header", "site-header", "page-header", "top-bar", "topbar"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
CONTENT_TAGS = {"article", "main"}


@dataclass(slots=True)
class Node:
    tag: str
    name: str = ""  # class, id and role
    noisy: bool = False
    parts: list = field(default_factory=list)  # texts and child nodes in page order


def _named(attributes: str) -> tuple[str, bool]:
    found = {k.lower(): v.strip("\"' ").lower() for k, v in _ATTR.findall(attributes)} if "=" in attributes else {}
    values = [found.get(k, "") for k in ("class", "id", "role")]
    words = {w for v in values[:2] for w in _NAME.findall(v)}
    whole = {w for v in values[:2] for w in v.split()}
    noisy = bool(words & NOISE_NAMES or whole & NOISE_WHOLE or values[2] in NOISE_ROLES)
    return " ".join(v for v in values if v), noisy


def parse(text: str) -> Node:
    """A lenient tree of the page: unclosed and misplaced tags do no harm."""
    root = Node("#page")
    stack, at, end = [root], 0, len(text)

    def close(kinds: set[str], barrier: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in kinds:
                del stack[i:]
                return
            if stack[i].tag in barrier:
                return

    while at < end:
        tag = _TAG.search(text, at)
        if tag is None:
            stack[-1].parts.append(text[at:])
            break
        if tag.start() > at:
            stack[-1].parts.append(text[at : tag.start()])
        at = tag.end()
        kind = (tag[2] or tag[5] or "").lower()
        if not kind:
            continue
        if tag[1] or tag[4]:
            close({kind}, {"article", "body", "table"} - {kind} if kind not in ("html", "body") else set())
            continue
        if kind not in INLINE and kind not in VOID:
            close({"p"}, {"table", "td", "th", "button", "object", "template"})
        if kind in CLOSES:
            close(CLOSES[kind], _BARRIER)
        node = Node(kind, *_named(tag[3] or ""))
        node.noisy |= kind in NOISE_TAGS
        stack[-1].parts.append(node)
        if kind in RAW:
            stop = re.compile(rf"</{kind}\s*>", re.I).search(text, at)
            at = stop.end() if stop else end
        elif kind not in VOID:
            stack.append(node)
    return root


def _style(node: Node) -> str:
    tags: list[str] = []
    for part in node.parts:
        if isinstance(part, Node) and part.tag not in INLINE and part.tag != "br":
            one = f"{part.tag}.{part.name}"
            if not tags or tags[-1] != one:
                tags.append(one)
    return ">".join(tags)


def _hash(*values: object) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, values)).encode("utf-8", "surrogatepass")) - (1 << 63)


def _content(node: Node) -> str:
    out: list[str] = []
    todo: list = [node]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            todo.extend(reversed(part.parts))
    return " ".join("".join(out).split())


def branches(root: Node) -> Iterator[tuple[int, Node, bool]]:
    """(node key, element, whether it is content by name) of the elements that may be cut.

    Nothing below a branch that its name decides is looked at: it goes or stays whole,
    but for the noisy branches inside an article.
    """
    todo = [(root, 0, False)]
    while todo:
        node, key, inside = todo.pop()
        style = _style(node)
        for part in node.parts:
            if not isinstance(part, Node) or part.tag in INLINE or part.tag in VOID:
                continue
            own = _hash(key, style, part.tag, part.name)
            content = inside or part.tag in CONTENT_TAGS
            if part.noisy:
                yield own, part, False
            else:
                if not inside:
                    yield own, part, part.tag in CONTENT_TAGS
                todo.append((part, own, content))


def _blocks(root: Node, cut: set[int], only: bool) -> list[str]:
    """Texts between block boundaries, in page order, without the nodes cut."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        block = " ".join(entities.unescape("".join(line)).split()) if line else ""
        if block:
            blocks.append(block)
        line.clear()

    todo: list = [(root, 0, not only)]
    while todo:
        part, key, shown = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            if shown:
                line.append(part)
        elif part.tag == "br":
            line.append("\n")
        else:
            inline = part.tag in INLINE
            if not inline:
                flush()
                todo.append((None, 0, False))
            style = "" if inline else _style(part)
            below = []
            for child in part.parts:
                own, seen = key, shown
                if isinstance(child, Node) and child.tag not in INLINE and child.tag not in VOID:
                    own = _hash(key, style, child.tag, child.name)
                    if own in cut:
                        below.append((None, 0, False))
                        continue
                    seen = shown or child.tag in CONTENT_TAGS
                below.append((child, own, seen))
            todo.extend(reversed(below))
    flush()
    return blocks


def main_text(text: str | None, cut: set[int]) -> str:
    """The text of a page without the nodes cut; the article or main element alone if it has one."""
    root = parse(text or "")
    kept = any(content and key not in cut for key, _, content in branches(root))
    return "\n\n".join(_blocks(root, cut, kept))


def host_of(url: str | None) -> str:
    """After the first ``://`` up to ``/ ? #`` or the end."""
    return re.split(r"[/?#]", (url or "").partition("://")[2], maxsplit=1)[0].lower()


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("k1", "k2", "host", "node", "prior", "style", "content", "page")
    kinds = (*[pa.int64()] * 2, pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 3)
    for batch in batches:
        rows = []
        keys = (batch.column(n).to_pylist() for n in ("k1", "k2", "url", "html"))
        for k1, k2, url, text in zip(*keys, strict=True):
            host = host_of(url)
            page = _hash(text or "")
            for key, node, content in branches(parse(text or "")):
                prior = 1 if content else -1 if node.noisy else 0
                said = 0 if prior else _hash(_content(node))
                rows.append((k1, k2, host, key, prior, 0 if prior else _hash(_style(node)), said, page))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _importance(elements: DataFrame) -> DataFrame:
    """(host, node, importance) of the nodes that no name decides, and 0 for noisy ones."""
    open_ = elements.where("prior = 0")

    def entropy(column: str) -> DataFrame:
        # A page is counted once per node and value, and copies of a page are one page.
        once = open_.groupBy("host", "node", column, "page").agg(F.lit(1).alias("one"))
        n = once.groupBy("host", "node", column).agg(F.count("*").alias("n"))
        of = n.groupBy("host", "node").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
        spread = 1 - F.col("s") / (F.col("m") * F.log("m"))
        return of.select("host", "node", "m", F.when(F.col("m") > 1, spread).otherwise(1.0).alias(column))

    content = entropy("content")
    style = entropy("style").drop("m")
    weighed = content.join(style, ["host", "node"]).select(
        "host",
        "node",
        F.when(F.col("m") < MIN_PAGES, 1.0)
        .otherwise((1 - GAMMA) * F.col("style") + GAMMA * F.col("content"))
        .alias("importance"),
    )
    noisy = elements.where("prior = -1").select("host", "node").distinct()
    return weighed.unionAll(noisy.withColumn("importance", F.lit(0.0)))


def extract_text(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url and ``text`` for each row of ``pages`` (page_id, url, html).

    Null html is empty and has no text; a page without any tag is one block; repeated
    rows are extracted each by itself but are one page in the statistics; pages without
    url share the host ""; other columns are ignored.
    """
    keyed = pages.select(
        "page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("k1"), F.hash("html", "page_id").cast("long").alias("k2")
    )
    elements = written(
        keyed.mapInArrow(
            _elements, "k1 long, k2 long, host string, node long, prior int, style long, content long, page long"
        ),
        "style-elements",
    )
    noise = written(_importance(elements).where(F.col("importance") < threshold).select("host", "node"), "style-noise")
    cuts = (
        elements.where("prior < 1").select("k1", "k2", "host", "node")
        .join(noise, ["host", "node"])
        .groupBy("k1", "k2").agg(F.collect_set("node").alias("cut"))
    )
    page_id = f"page_id {keyed.schema['page_id'].dataType.simpleString()}"

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor()
        for batch in batches:
            data = [squeeze.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column("html")]
            kept = [n for n in batch.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(data, pa.binary())], names=[*kept, "packed"]
            )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [
                main_text(expand.decompress(p.as_py()).decode("utf-8", "surrogatepass"), set(c.as_py() or ()))
                for p, c in zip(batch.column("packed"), batch.column("cut"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    packed = keyed.mapInArrow(shrink, f"{page_id}, url string, k1 long, k2 long, packed binary")
    joined = packed.join(cuts, ["k1", "k2"], "left").select("page_id", "url", "packed", "cut")
    return joined.mapInArrow(extract, f"{page_id}, url string, text string")


def extraction_digest(extracted: DataFrame) -> DataFrame:
    """The contract's columns from ``extract_text``."""
    return extracted.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
