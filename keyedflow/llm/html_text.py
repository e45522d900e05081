"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree: a node is a path of elements with their classes. A node whose
children look alike and whose content is the same on most pages (low entropy of presentation and content) is
boilerplate, and its branch is removed from each page; so is a single content (a paragraph, heading, item, cell
or box) that most pages with its node repeat. Nodes that too few pages of their host have are judged by the
pages of all hosts. Names of elements are evidence beside that: what is called ``nav`` or ``ad`` counts only
where an article or main element stands in it and nothing better is on the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, freed, ship_package, stored, with_row_key

#: A node on fewer pages of a host is judged by all hosts; a branch or content below this importance is removed.
FEWEST_PAGES, LEAST_IMPORTANCE = 10, 0.2
#: Stands for all hosts together; no address has such a host.
ALL_HOSTS = "*"
#: How much of a node's importance comes from its content; the power is its number of children.
CONTENT_WEIGHT = 0.9

# Names from the HTML standard, and words that sites use in classes and identifiers.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
SILENT = set(
    "head script style template noscript button select option textarea input iframe object svg canvas audio "
    "video menu dialog".split()
)
SURROUNDING = set("nav aside footer header".split())
BOXES = set("div section ul ol dl table figure details center blockquote".split())
CONTENTS = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre figcaption summary".split())
#: Words that make a name speak of a state of the page instead of the element's purpose (``no-sidebar``).
STATES = set("no not non has have with without is enabled disabled".split())
PURPOSES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments commentlist disqus reply replies respond pagination pager toolbar widget "
    "widgets copyright skip".split()
)
# What a start tag closes when it is still open: paragraphs before blocks, and items before their like.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table article section div main body blockquote".split())

WORDS = re.compile(r"[a-z0-9]+")
TAG = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
TELLING = re.compile(r"class|id|role", re.IGNORECASE)  # "hidden" has an "id", too
RAW = {tag: re.compile(rf"</{tag}(?![a-z0-9])", re.IGNORECASE) for tag in ("script", "style", "textarea", "title")}


#: How suspect an element is: not at all, by a word in its names (or a form), by its tag.
CLEAN, BY_NAME, BY_TAG = 0, 1, 2


@lru_cache(1 << 14)
def names_purpose(name: str) -> bool:
    """Whether a class, identifier or role says that its element is none of the text."""
    words = set(WORDS.findall(name))
    return bool(words & PURPOSES) and not words & STATES


@lru_cache(1 << 14)
def label_of(tag: str, names: tuple[str, ...]) -> str:
    return ".".join([tag, *sorted({w for name in names for w in WORDS.findall(name)})])


@lru_cache(1 << 16)
def path_below(path: int, label: str) -> int:
    return hash_of(f"{path}/{label}")


class Element:
    """An open element; ``suspect``, ``in_article`` and ``in_main`` are how suspect it is on the whole and below the region."""

    __slots__ = ("tag", "path", "silent", "suspect", "in_article", "in_main", "node", "children", "begin")

    def __init__(self, tag, path, silent, suspect, in_article, in_main, node, begin):
        self.tag, self.path, self.silent, self.suspect = tag, path, silent, suspect
        self.in_article, self.in_main, self.node = in_article, in_main, node
        self.children: list[str] = []
        self.begin = begin


class Node:
    """An element that other pages can judge."""

    __slots__ = ("around", "path", "box", "content", "style", "children")

    def __init__(self, around: int, path: int, box: bool):
        self.around, self.path, self.box = around, path, box
        self.content: int | None = None
        self.style = self.children = 0


class Page:
    """Blocks of text in page order, and the nodes that can be judged by other pages."""

    def __init__(self):
        self.stack = [Element("", 0, False, CLEAN, None, None, -1, 0)]
        self.open: Counter[str] = Counter()
        #: Text, how suspect it is on the whole, in its article, in its main element (None: in none), innermost node.
        self.blocks: list[tuple[str, int, int | None, int | None, int]] = []
        #: Of each node: the node around it, its path, whether it is a box and, once it is closed, hashes of the
        #: text inside (none: no text) and of the children's names, and the number of children.
        self.nodes: list[Node] = []
        self.text: list[str] = []
        #: Hashes of the first n blocks, and powers, from which the hash of any run of blocks follows.
        self.sums, self.powers = [0], [1]

    def flush(self) -> None:
        top = self.stack[-1]
        if self.text and not top.silent:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((text, top.suspect, top.in_article, top.in_main, top.node))
                self.sums.append((self.sums[-1] * FACTOR + hash_of(text)) % MODULUS)
                self.powers.append(self.powers[-1] * FACTOR % MODULUS)
        self.text = []

    def start(self, tag: str, rest: str) -> None:
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag not in INLINE and tag not in ("html", "body"):
            self.close_open({"p"} if tag not in CLOSES else CLOSES[tag] | {"p"})
        top = self.stack[-1]
        names: list[str] = []
        silent = top.silent or tag in SILENT
        for key, *values in ATTRIBUTE.findall(rest) if TELLING.search(rest) else ():
            if key.lower() in ("class", "id", "role"):
                names += "".join(values).lower().split()
            elif key.lower() == "hidden":
                silent = True
        suspect = CLEAN
        if tag not in ("html", "body", "main"):
            if any(map(names_purpose, names)) or tag == "form":
                suspect = BY_NAME
            if "header" in names and top.in_article is None and tag != "article":
                suspect = BY_NAME
            if tag in SURROUNDING and (tag != "header" or top.in_article is None):
                suspect = BY_TAG
        if tag in INLINE:  # no article stands in it
            silent = silent or suspect != CLEAN
        label = label_of(tag, tuple(names))
        path, node = top.path, top.node
        if tag not in INLINE:
            path = path_below(top.path, label)
            top.children.append(label)
            if (tag in BOXES or tag in CONTENTS) and not silent:
                self.nodes.append(Node(node, path, tag in BOXES))
                node = len(self.nodes) - 1
        in_article, in_main = (
            CLEAN if inside is None and begins else inside if inside is None else max(inside, suspect)
            for inside, begins in ((top.in_article, tag == "article"), (top.in_main, tag == "main" or "main" in names))
        )
        self.open[tag] += 1
        self.stack.append(
            Element(tag, path, silent, max(top.suspect, suspect), in_article, in_main, node, len(self.blocks))
        )

    def close_open(self, tags: set[str]) -> None:
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self.pop_to(i)
                return
            if self.stack[i].tag in SCOPES:
                return

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            top = self.stack[-1]
            if top.tag not in INLINE:
                self.flush()
            self.stack.pop()
            self.open[top.tag] -= 1
            if (top.tag in BOXES or top.tag in CONTENTS) and not top.silent and len(self.blocks) > top.begin:
                node, n = self.nodes[top.node], len(self.blocks) - top.begin
                node.content = (self.sums[-1] - self.sums[top.begin] * self.powers[n]) % MODULUS
                node.style, node.children = hash_of("|".join(top.children)), len(top.children)

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self.pop_to(i)
                return

    def data(self, text: str) -> None:
        if text and not self.stack[-1].silent:
            self.text.append(text)

    def read(self, html: str) -> Page:
        """One pass over the page; whatever is not closed by its end is dropped or ends there."""
        at = 0
        while at < len(html):
            sign = html.find("<", at)
            if sign < 0:
                sign = len(html)
            if sign > at:
                text = html[at:sign]
                self.data(entities.unescape(text) if "&" in text else text)
            if sign == len(html):
                break
            at = self.markup(html, sign)
        self.flush()
        self.pop_to(1)
        return self

    def markup(self, html: str, sign: int) -> int:
        """Handle what starts with the ``<`` there; the place after it."""
        after = html[sign + 1 : sign + 2]
        if html.startswith("<!--", sign):
            close = html.find("-->", sign + 4)
            return close + 3 if close >= 0 else len(html)
        if after.isascii() and after.isalpha():
            found = TAG.match(html, sign)
            if found:
                name, rest, at = found[1].lower(), found[2], found.end()
            else:  # a quote that is never closed
                at = html.find(">", sign) + 1
                if not at:
                    return len(html)
                name, _, rest = html[sign + 1 : at - 1].replace("/", " ").partition(" ")
                name = name.lower()
            self.start(name, rest)
            if name in RAW:
                close = RAW[name].search(html, at)
                at = close.start() if close else len(html)
            return at
        if after in ("/", "!", "?") and after:
            close = html.find(">", sign)
            if close < 0:
                return len(html)
            if after == "/":
                name = html[sign + 2 : close].split()[:1]
                self.end(name[0].lower() if name else "")
            return close + 1
        self.data("<")
        return sign + 1

    def region(self) -> list[tuple]:
        """Blocks of the articles, else of the main elements, else of the page, without suspect elements.

        A region within suspect elements counts where it holds more text than all that is not suspect. If a page
        has nothing but text in elements with suspect names, that is its text.
        """
        for inside in (2, 3):
            found = [b for b in self.blocks if b[inside] == CLEAN and b[1] == CLEAN]
            if found:
                return found
        clean = [b for b in self.blocks if b[1] == CLEAN]
        for inside in (2, 3):
            found = [b for b in self.blocks if b[inside] == CLEAN]
            if sum(len(b[0]) for b in found) > sum(len(b[0]) for b in clean):
                return found
        return clean or [b for b in self.blocks if b[1] == BY_NAME]


#: Hashes of runs of blocks are taken modulo a prime.
MODULUS, FACTOR = (1 << 61) - 1, 0x1F3D5B79A2C4E687 % ((1 << 61) - 1)


def hash_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def parse(html: str | None) -> Page:
    return Page().read(html or "")


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


#: What a node's entry says of its page: the first of these values there, of its path and content, of its path.
NEW_ENTRY, NEW_CONTENT, NEW_PATH = 1, 2, 4

#: Of each node with text: the node around it, its path, hashes, number of children, whether it is a box, and marks.
NODE = {
    "around": pa.int32(),
    "path": pa.int64(),
    "content": pa.int64(),
    "style": pa.int64(),
    "children": pa.int32(),
    "box": pa.bool_(),
    "marks": pa.int32(),
}
PARSED = (
    f"{ROW} long, page_id {{id}}, url string, host string, page long, texts array<string>, at array<int>, around array<int>, "
    "path array<long>, content array<long>, style array<long>, children array<int>, box array<boolean>, marks array<int>"
)


def entries(page: Page) -> tuple[list[tuple], list[tuple[str, int]]]:
    """Nodes with text, as in ``NODE``, and the texts of the region, each with its innermost node (-1: none)."""
    number, rows, seen = {-1: -1}, [], set()
    for i, node in enumerate(page.nodes):
        if node.content is None:
            continue
        number[i] = len(rows)
        marks = 0
        for mark, value in (
            (NEW_ENTRY, (node.path, node.content, node.style, node.children)),
            (NEW_CONTENT, (node.path, node.content)),
            (NEW_PATH, (node.path,)),
        ):
            if value not in seen:
                seen.add(value)
                marks |= mark
        rows.append((number[node.around], node.path, node.content, node.style, node.children, node.box, marks))
    return rows, [(b[0], number[b[4]]) for b in page.region()]


def parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page once: the texts of its region and its nodes."""
    for batch in batches:
        hosts, hashes, texts, places = [], [], [], []
        nodes: dict[str, list[list]] = {name: [] for name in NODE}
        for url, html in zip(batch["url"], batch["html"], strict=True):
            html = html.as_py() or ""
            rows, blocks = entries(parse(html))
            hosts.append(host_of(url.as_py()))
            hashes.append(hash_of(html))
            texts.append([t for t, _ in blocks])
            places.append([i for _, i in blocks])
            for column, values in zip(nodes.values(), zip(*rows, strict=True) if rows else [()] * len(NODE), strict=True):
                column.append(list(values))
        yield pa.record_batch(
            {
                ROW: batch[ROW],
                "page_id": batch["page_id"],
                "url": batch["url"],
                "host": pa.array(hosts, pa.string()),
                "page": pa.array(hashes, pa.int64()),
                "texts": pa.array(texts, pa.list_(pa.string())),
                "at": pa.array(places, pa.list_(pa.int32())),
                **{name: pa.array(nodes[name], pa.list_(kind)) for name, kind in NODE.items()},
            }
        )


def exploded(pages: DataFrame, *columns: str) -> DataFrame:
    """A row per node with its number on the page; of the parsed table only the columns named are read."""
    nodes = F.arrays_zip(*[F.col(c) for c in columns])
    return pages.select(ROW, "host", F.posexplode(nodes).alias("node", "of")).select(ROW, "host", "node", "of.*")


def unlike(pages: DataFrame, *by: str) -> DataFrame:
    """Row keys of the pages with the smallest key of those that are equal in ``by``."""
    return pages.groupBy(*by).agg(F.min(ROW).alias(ROW)).select(ROW)


def marked(mark: int) -> Column:
    """How many rows carry the mark."""
    return F.sum((F.col("marks").bitwiseAND(mark) != 0).cast("long"))


def entropy_of(n: str) -> Column:
    """Entropy of groups that have ``n`` rows each, to the base of their sum; 1 for a single row."""
    total = F.sum(n)
    value = (F.log(total) - F.sum(F.col(n) * F.log(n)) / total) / F.log(total)
    return F.when(total > 1, value).otherwise(1.0)


def style_tree(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host``, ``path``, ``pages``, ``importance`` of nodes, and ``host``, ``path``, ``content``, ``pages`` of contents.

    The input has a row per node of each page, without copies of pages, or a site of copies would look like
    nothing but boilerplate. Marks make all counts sums, which tasks work out before they send anything: first
    per content and per style of a node, then per node, so a host with very many pages is no single group.
    The importance of a node that is no box is null.
    """
    keys = ["host", "path"]
    contents = seen.groupBy(*keys, "content").agg(
        marked(NEW_ENTRY).alias("n"),
        marked(NEW_CONTENT).alias("pages"),
        marked(NEW_PATH).alias("firsts"),
        F.sum(F.when(F.col("marks").bitwiseAND(NEW_ENTRY) != 0, F.col("children"))).alias("children"),
        F.max("box").alias("box"),
    )
    by_content = contents.groupBy(*keys).agg(
        entropy_of("n").alias("content"),
        (F.sum("children") / F.sum("n")).alias("children"),
        F.sum("firsts").alias("pages"),
        F.max("box").alias("box"),
    )
    styles = seen.filter(F.col("marks").bitwiseAND(NEW_ENTRY) != 0).groupBy(*keys, "style").agg(F.count(F.lit(1)).alias("n"))
    by_style = styles.groupBy(*keys).agg(entropy_of("n").alias("style"))
    share = F.pow(F.lit(CONTENT_WEIGHT), F.col("children"))
    score = F.greatest(F.col("content") * share + F.col("style") * (1 - share), F.lit(0.0))
    nodes = by_content.join(by_style, keys).select(*keys, "pages", F.when(F.col("box"), score).alias("importance"))
    return nodes, contents.select(*keys, "content", "pages")


def unimportant(nodes: DataFrame, contents: DataFrame, fewest_pages: int, least_importance: float) -> DataFrame:
    """``host``, ``path``, ``content`` of what goes: a content, or a node where the content is null.

    The importance of a content is 1 on one page and 0 on all pages of its node: one less the entropy of the
    content over the pages that have it, to the base of the node's pages.
    """
    enough = nodes.filter(F.col("pages") >= fewest_pages)
    alike = enough.filter(F.col("importance") < least_importance).select("host", "path", F.lit(None).cast("long").alias("content"))
    repeated = contents.filter("pages > 1").withColumnRenamed("pages", "on")
    common = repeated.join(enough.select("host", "path", "pages"), ["host", "path"])
    common = common.filter(1 - F.log("on") / F.log("pages") < least_importance)
    return alike.union(common.select("host", "path", "content"))


def removed_nodes(found: DataFrame, low: DataFrame, by: list[str]) -> DataFrame:
    """``host``, ``path``, row key and number of the nodes that are in ``low``, some of them twice."""
    alike = low.filter("content IS NULL").select(*by)
    common = low.filter("content IS NOT NULL").select(*by, "content")
    what = ["host", "path", ROW, "node"]
    return found.join(alike, by).select(*what).union(found.join(common, [*by, "content"]).select(*what))


EXTRACTED = "page_id {id}, url string, text string"


def kept_text(texts: list[str], at: list[int], around: list[int], removed: list[int] | None) -> str:
    """The texts without those in removed nodes; all of them if nothing would be left."""
    if removed:
        gone, out = set(removed), []
        for node, outer in enumerate(around):
            out.append(node in gone or (outer >= 0 and out[outer]))
        texts = [t for t, node in zip(texts, at, strict=True) if node < 0 or not out[node]] or texts
    return " ".join(texts)


def extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("texts", "at", "around", "removed")]
        texts = [kept_text(*row) for row in zip(*columns, strict=True)]
        yield pa.record_batch({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string())})


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    fewest_pages: int = FEWEST_PAGES,
    least_importance: float = LEAST_IMPORTANCE,
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) of every page, repeated pages included.

    White space within a block becomes one space, blocks are joined by one, and character references are
    decoded. Null and empty pages have an empty text; a null or malformed address is a host of its own name.
    If all of a page would be removed, its text stays. Nodes that fewer than ``fewest_pages`` pages of their host
    have are judged by the pages of all hosts, or not at all where these are too few, too.

    Pages are parsed once; their nodes and texts are written to the scratch folder, and all statistics read from
    there. What is removed is joined by row number, never grouped by host.
    """
    spark = pages.sparkSession
    ship_package(spark)
    id_type = dict(pages.dtypes)[id_col]
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed, _ = stored(with_row_key(slim).mapInArrow(parser, PARSED.format(id=id_type)), "parsed-pages")
    counted = ["path", "content", "style", "children", "box", "marks"]

    def tree(distinct: DataFrame, host: Column) -> tuple[DataFrame, str]:
        seen = exploded(parsed.join(distinct, ROW, "left_semi"), *counted).withColumn("host", host)
        nodes, contents = style_tree(seen)
        return stored(unimportant(nodes, contents, fewest_pages, least_importance), "style-tree")

    first = unlike(parsed, "host", "page")
    low, low_path = tree(first, F.col("host"))
    everywhere, everywhere_path = tree(unlike(parsed, "page"), F.lit(ALL_HOSTS))
    found = exploded(parsed, "path", "content")
    counts = exploded(parsed.join(first, ROW, "left_semi"), "path", "marks").groupBy("host", "path").agg(marked(NEW_PATH).alias("pages"))
    rare = counts.filter(F.col("pages") < fewest_pages)
    alone = removed_nodes(found, everywhere, ["path"]).join(rare, ["host", "path"], "left_semi")
    branches = removed_nodes(found, low, ["host", "path"]).union(alone)
    removed, _ = stored(branches.groupBy(ROW).agg(F.collect_set("node").alias("removed")), "removed-nodes")
    freed(spark, low_path, everywhere_path)
    extracted = parsed.select(ROW, "page_id", "url", "texts", "at", "around").join(removed, ROW, "left")
    extracted = extracted.drop(ROW).mapInArrow(extractor, EXTRACTED.format(id=id_type))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
