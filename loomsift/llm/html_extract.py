"""Main text of web pages by container paths that the pages of a host agree on."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.llm.common import frugal, positional, stage, table

# Fixed values of the language: elements without content, elements whose content is no markup,
# elements that begin a block, and those whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
IN_HEAD = frozenset("head title meta link script style base noscript template".split())
#: What an element's start ends, if it is open and nothing of the second set stands between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
}
P_SCOPE = frozenset("table td th caption button template html".split())
#: Elements that hold no text of the page, those that never are main text unless they hold it, and those that may be part of it.
NO_TEXT = frozenset("head script style noscript template iframe noembed noframes svg math canvas object audio video textarea title xmp select".split())
NOT_MAIN = frozenset("nav button dialog menu search".split())
SOFT = frozenset("header footer aside form".split())
#: Roles that never are main text.
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Whole class names and ids that say so of a container: reader comments, adverts, notices and the like, where nothing else tells.
LABELS = frozenset(
    "ad ads advert adverts advertisement sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header cookie cookies cookie-notice cookie-banner newsletter share sharing social related-posts related-articles comment comments comment-list comments-section pagination".split()
)
LABELLED = frozenset("div section aside ul ol dl table form nav header footer".split())
CONTAINERS = frozenset("body article main section div td center".split())
BONUS = {"article": 3.0, "main": 2.0}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Share of a child container's score that its parent gets.
DECAY = 0.7
LEVELS = 6
#: An element that its kind or label would drop stays if it holds more of a page's text than this, or an article.
MOST = 0.5

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S
)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NUMBER = re.compile(r"\d+")
WORD = re.compile(r"\w")


def path_id(parent: int, key: str) -> int:
    """The hash of a generalised path by its parent's; the page's own is 0."""
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), parent & 0xFFFFFFFFFFFFFFFF) - 2**63


class Page:
    """A page as a list of texts and block breaks (None), and elements as ranges of it.

    An element's generalised path is its ancestors' tags and classes, numbers made alike; it goes by
    a hash that is worked out from the parent's, so deep nesting costs no more than its elements.
    """

    def __init__(self, markup: str):
        self.items: list[str | None] = []
        self.links: set[int] = set()
        self.tags, self.keys, self.paths, self.parents = ["html"], [""], [0], [-1]
        self.starts, self.ends = [0], [0]
        self.dropped = [0]  # 1: by label or kind, unless it holds the main text, 2: for good
        self.parse(markup)
        self.measure()
        self.owner, self.box = self.owners()

    def path(self, k: int) -> str:
        """An element's generalised path."""
        out = []
        while k > 0:
            out.append(self.keys[k])
            k = self.parents[k]
        return ">".join(reversed(out))

    def parse(self, markup: str) -> None:
        stack, in_link, at = [0], 0, 0
        depths: dict[str, list[int]] = {}  # of the open elements of each tag
        items = self.items

        def text(s: str) -> None:
            if s:
                if in_link:
                    self.links.add(len(items))
                items.append(entities.unescape(s) if "&" in s else s)

        def close(depth: int) -> None:
            nonlocal in_link
            while len(stack) > depth:
                k = stack.pop()
                self.ends[k] = len(items)
                if stack:
                    depths[self.tags[k]].pop()
                if self.tags[k] in BLOCK:
                    items.append(None)
                elif self.tags[k] == "a":
                    in_link -= 1

        def nearest(tags: frozenset, stop: frozenset) -> int:
            """The depth of the innermost open element of the tags, 0 if there is none or one of ``stop`` is inside it."""
            d = max((depths[t][-1] for t in tags if depths.get(t)), default=0)
            return d if d and all(depths[t][-1] <= d for t in stop if depths.get(t)) else 0

        end = len(markup)
        while at < end:
            m = TOKEN.search(markup, at)
            if m is None:
                text(markup[at:])
                break
            text(markup[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                if m[0].startswith("<![CDATA["):
                    text(m[0][9:].removesuffix("]]>"))
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                if tag == "br":
                    items.append(" ")
                elif d := nearest(frozenset([tag]), frozenset() if tag in ("body", "html") else frozenset(["td", "th"]) if tag not in BLOCK else frozenset()):
                    close(d)
                continue
            attrs = (m[3] or m[6] or "").strip()
            if tag == "br":
                items.append(" ")
                continue
            if tag not in IN_HEAD and len(stack) > 1 and (d := nearest(frozenset(["head"]), frozenset(["body"]))):
                close(d)
            if tag in ("html", "body") and (tag == "html" or nearest(frozenset(["body"]), frozenset())):
                continue
            if tag in BLOCK and (d := nearest(frozenset(["p"]), P_SCOPE)):
                close(d)
            if tag in ENDS and (d := nearest(*ENDS[tag])):
                close(d)
            if tag in BLOCK:
                items.append(None)
            if tag in VOID:
                continue
            self.open(stack[-1], tag, attrs)
            k = len(self.tags) - 1
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(markup, at)
                at = end if stop is None else (markup.find(">", stop.start()) + 1 or end)
                self.ends[k] = len(items)
                continue
            if attrs.endswith("/") and tag in ("svg", "math"):
                self.ends[k] = len(items)
                continue
            stack.append(k)
            depths.setdefault(tag, []).append(len(stack) - 1)
            if tag == "a":
                in_link += 1
        close(0)

    def open(self, parent: int, tag: str, attrs: str) -> None:
        key, drop = tag, 2 if tag in NO_TEXT else 1 if tag in NOT_MAIN or tag in SOFT else 0
        if attrs and tag not in ("a", "img", "script", "link"):
            for name, *values in ATTR.findall(attrs):
                name, value = name.lower(), next((v for v in values if v), "")
                if name == "class":
                    key += "".join(sorted("." + NUMBER.sub("#", c.lower()) for c in set(value.split())))
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                    drop = 2
                elif name == "role" and value.lower() in ROLES:
                    drop = max(drop, 1)
                if name in ("class", "id") and tag in LABELLED and not LABELS.isdisjoint(value.lower().split()):
                    drop = max(drop, 1)
        self.tags.append(tag)
        self.keys.append(key)
        self.parents.append(parent)
        self.paths.append(path_id(self.paths[parent], key))
        self.starts.append(len(self.items))
        self.ends.append(len(self.items))
        self.dropped.append(drop)

    def measure(self) -> None:
        """Which elements go: those of no text, and those that a kind or label tells unless they hold an article or most of the text.

        A header in an article that has a heading is the article's.
        """
        upto, n = [0], 0
        for x in self.items:
            n += len(x.strip()) if x else 0
            upto.append(n)
        size = [upto[e] - upto[s] for s, e in zip(self.starts, self.ends, strict=True)]
        holds, titled = [False] * len(self.tags), [False] * len(self.tags)
        inside = [False] * len(self.tags)
        for k in range(1, len(self.tags)):
            inside[k] = inside[self.parents[k]] or self.tags[self.parents[k]] in BONUS
        for k in range(len(self.tags) - 1, 0, -1):
            holds[self.parents[k]] |= holds[k] or self.tags[k] in BONUS
            titled[self.parents[k]] |= titled[k] or self.tags[k] in HEADINGS
        self.out = [
            d == 2 or d == 1 and not holds[k] and size[k] <= MOST * max(n, 1) and not (self.tags[k] == "header" and inside[k] and titled[k]) for k, d in enumerate(self.dropped)
        ]

    def owners(self) -> tuple[list[int], list[int]]:
        """The innermost container of each item, -1 in dropped elements, and that of each element, itself if it is one; 0 is the page."""
        gone = list(self.out)
        box = [0] * len(self.tags)
        for k in range(1, len(self.tags)):
            gone[k] = gone[k] or gone[self.parents[k]]
            box[k] = k if self.tags[k] in CONTAINERS else box[self.parents[k]]
        owner = []
        at, open_ = 1, [0]  # elements come in page order and end inside each other
        for i in range(len(self.items)):
            while len(open_) > 1 and self.ends[open_[-1]] <= i:
                open_.pop()
            while at < len(self.tags) and self.starts[at] <= i:
                if self.ends[at] > i and (self.out[at] or self.tags[at] in CONTAINERS):
                    open_.append(at)
                at += 1
            owner.append(-1 if gone[open_[-1]] else open_[-1])
        return owner, box

    def scores(self) -> dict[int, float]:
        """Score of each container: its own text that no link holds, a falling share of that of containers within, times a bonus."""
        owner, box = self.owner, self.box
        own: dict[int, float] = {}
        for i, x in enumerate(self.items):
            if x and owner[i] >= 0 and i not in self.links and (n := len(x.strip())):
                own[owner[i]] = own.get(owner[i], 0.0) + n
        total = dict(own)
        for k, n in own.items():
            up, share = k, 1.0
            for _ in range(LEVELS):
                if not up:
                    break
                up = box[self.parents[up]]
                share *= DECAY
                total[up] = total.get(up, 0.0) + n * share
        return {k: n * BONUS.get(self.tags[k], 1.0) for k, n in total.items()}

    def best(self, path: int | None = None) -> int:
        """The container of the highest score, of those with the path if there are any; the first of equals."""
        scores = self.scores()
        named = [k for k in scores if path is not None and self.paths[k] == path]
        return max(named or scores, key=lambda k: (scores[k], -k), default=0)

    def chosen(self, path: int | None = None) -> list[int]:
        """The containers with the path that have text outside links; a page without the path uses that of its best container."""
        scores = self.scores()
        if path is None or all(self.paths[k] != path for k in scores):
            path = self.paths[self.best()]
        return [k for k in scores if self.paths[k] == path] or [0]

    def main(self, path: int | None = None) -> str:
        """The text of the containers that are chosen with the path."""
        return self.text(self.chosen(path))

    def text(self, chosen: list[int]) -> str:
        """The text of these containers, and of what encloses them, in page order.

        Of enclosing containers, up to an article or main, come the blocks of their own that are
        headings or have a word outside links.
        """
        owner, box = self.owner, self.box
        outer: set[int] = set()
        take: set[int] = set()
        for k in chosen:
            take.update(i for i in range(self.starts[k], self.ends[k]) if owner[i] >= 0)
            while k and self.tags[k] not in BONUS and (k := box[self.parents[k]]) not in outer:
                outer.add(k)
        change = [0] * (len(self.items) + 1)
        for k, t in enumerate(self.tags):
            if t in HEADINGS:
                change[self.starts[k]] += 1
                change[self.ends[k]] -= 1
        heading = list(accumulate(change))
        block: list[int] = []
        for i in range(len(self.items) + 1):
            if i < len(self.items) and self.items[i] is not None and owner[i] in outer and i not in take:
                block.append(i)
                continue
            if any(heading[i] or i not in self.links and WORD.search(self.items[i]) for i in block):
                take.update(block)
            block = []
        return self.lines(sorted(take))

    def lines(self, numbers: Iterable[int]) -> str:
        """The blocks of the items, white space made one space, joined by line breaks."""
        blocks: list[str] = []
        part: list[str] = []
        last = -1
        for i in [*numbers, None]:
            x = self.items[i] if i is not None else None
            if x is None or i != last + 1:
                if line := " ".join("".join(part).split()):
                    blocks.append(line)
                part = []
            if x is not None:
                part.append(x)
            last = i if i is not None else last
        return "\n".join(blocks)


def host(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def page_votes(pages: DataFrame) -> DataFrame:
    """host, path (its hash), vote: all paths of each page's containers, once each, with the millionths of the page's best score that their best containers have.

    Votes of the pages that come in one batch are summed. A null html is an empty page and votes for nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes: dict[tuple[str, int], int] = {}
            for h, markup in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                page = Page(markup.as_py() or "")
                paths: dict[int, float] = {}
                for k, n in page.scores().items():
                    if k:
                        paths[page.paths[k]] = max(n, paths.get(page.paths[k], 0.0))
                best = max(paths.values(), default=0.0)
                for path, n in paths.items():
                    votes[h, path] = votes.get((h, path), 0) + round(1e6 * n / best)
            rows = [(h, path, n) for (h, path), n in votes.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["host", "path", "vote"])

    return pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(frugal(run), "host string, path long, vote long")


def winning_paths(votes: DataFrame) -> DataFrame:
    """host, path: the path (its hash) with most votes of each host; the least hash of equals."""
    sums = votes.groupBy("host", "path").agg(F.sum("vote").alias("n"))
    return sums.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), "path")).alias("w")).select("host", F.col("w.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """Add host, path (that of the containers the text is from), text and n_chars to pages with url and html.

    Hosts' paths are written to the shared folder first, so Spark knows their size and sends them
    to all workers only if they are small; else it joins by host and splits hot ones. The text is
    that of all containers with the path and of the enclosing ones' own blocks (``Page.main``); a
    page without the winning path uses that of its own best container. Null html and pages without text give
    an empty text. Other columns pass through; columns named as the outputs are replaced.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "text", "n_chars")]
    won = stage(winning_paths(page_votes(pages)), "host-paths").select(F.col("host").alias("__host"), F.col("path").alias("__path"))
    src = pages.select(*[F.col(f"`{c}`") for c in keep], host(F.col("url")).alias("host"))
    src = src.join(won, F.col("host") == F.col("__host"), "left").select(*[F.col(f"`{c}`") for c in keep], "host", F.col("__path").alias("path"), F.col("html").alias("__html"))
    out = [c for c in keep if c != "html"]
    schema = T.StructType([*[pages.schema[c] for c in out], T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, paths = [], []
            for path, markup in zip(b.column(len(out) + 1).to_pylist(), b.column(len(out) + 2), strict=True):
                page = Page(markup.as_py() or "")
                chosen = page.chosen(path)
                texts.append(page.text(chosen))
                paths.append(page.path(chosen[0]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(paths, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return positional(src.select(*[F.col(f"`{c}`") for c in out], "host", "path", "__html")).mapInArrow(frugal(run), schema)


def op5_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars", "path")
