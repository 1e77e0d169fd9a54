"""Main text of web pages by template deduction over the pages of a host.

A token is an element by its path from the root, with its first class. Over
the pages of a host a token has a vector of occurrence counts; a sum of hashes
of (page, count) stands for it, so vectors are compared without being gathered
and partial sums are made before the shuffle. Tokens with the same vector, on
at least half of the pages, are an equivalence class. A class is valid if it
hangs below one place of another class, and valid classes nest into the
template of the host. Their elements are the slots. A slot is dropped when its
text is mostly links, or outside an article or main element the same on all its pages; a slot of a
known kind (menu, header, footer, sidebar, notice, advert, form, comments) by
its kind. A block of text that stands at the same token of at least half of the pages is
itself a part of the template, wherever it stands. A text belongs to the nearest
slot around it. An article or main element is the article if the slots in it
hold most of what varies on the host; else all that is left is. Pages with the
same bytes are one page of the host.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.llm.urlfilter import host_of

#: Part of a host's pages that a template token is on; pages from which on equal texts count; part of a slot that links may be.
TEMPLATE_SHARE, LEAST_PAGES, LINK_SHARE = 0.5, 3, 0.5

#: Part of the varying text that an article holds at least; part of a page that equal texts are at most, as otherwise the pages are copies.
ARTICLE_SHARE, COPY_SHARE = 0.5, 0.5

#: Elements and names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("applet canvas head iframe math noembed noframes noscript object script select style svg template textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
CHROME_TAGS = frozenset("aside button dialog footer form menu nav search".split())
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CHROME_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright discussion disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended "
    "related replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets".split())
_CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table"))}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*>|<!\w[^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class _Open:
    tag: str
    path: int
    kind: int      # 0 text, 1 header inside the article, 2 of a known kind to drop
    main: int      # 0 outside, 1 in an article, 2 in main
    heading: bool
    link: bool
    block: int     # path of the block-level element around it


@dataclass(slots=True)
class Block:
    """A block of text without its runs of a known kind: its block-level element, and what is known of its place."""

    path: int
    kind: int
    main: int
    text: str
    links: int


class Page:
    """The blocks of a page in order, and its tokens: path to [parent, count]."""

    def __init__(self, text: str):
        self.blocks: list[Block] = []
        self.tokens: dict[int, list[int]] = {}
        self._buffer: list[tuple[_Open, str]] = []
        self._stack = [_Open("", 0, 0, 0, False, False, 0)]
        self._parse(text)

    def _parse(self, text: str) -> None:
        at, end = 0, len(text)
        while at < end:
            found = _TAG.search(text, at)
            if not found:
                self._add(text[at:])
                break
            if found.start() > at:
                self._add(text[at : found.start()])
            at = found.end()
            if found[1]:
                self._add(markup.escape(found[1]))
            close, tag, attributes = (found[2], found[3], found[4]) if found[3] else (found[5], found[6], found[7])
            if not tag:
                continue
            tag = tag.lower()
            if close:
                self._close(tag)
            elif tag in UNSEEN:
                if not attributes.endswith("/"):
                    after = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(text, at)
                    if after or tag not in ("head", "title"):
                        at = after.end() if after else end
            else:
                self._open(tag, attributes)
        self._flush()

    def _add(self, text: str) -> None:
        self._buffer.append((self._stack[-1], text))

    def _flush(self) -> None:
        """One block of the runs of no known kind; of all runs, with the kind of the first, where no other text is."""
        runs, self._buffer = self._buffer, []
        left = [(place, text) for place, text in runs if place.kind == 0 or place.kind == 1 and place.heading]
        kept = any(markup.unescape(text).strip() for _, text in left)
        said = left if kept else runs
        text = " ".join(markup.unescape("".join(text for _, text in said)).split())
        if text:
            place = next(place for place, text in said if markup.unescape(text).strip())
            links = sum(len(text.strip()) for run, text in said if run.link)
            self.blocks.append(Block(place.block, 0 if kept else place.kind, place.main, text, links))

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth].tag == tag:
                del self._stack[depth:]
                break
            if self._stack[depth].tag in BLOCKS and tag not in BLOCKS:
                break  # an inline end tag closes nothing outside its block

    def _end_open(self, tag: str, within: tuple[str, ...]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth].tag == tag:
                del self._stack[depth:]
                return
            if self._stack[depth].tag in within:
                return

    def _open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self._flush()
            self._end_open("p", tuple(BLOCKS - {"p"}) if tag != "p" else ("article", "main", "body", "td", "li", "div", "section"))
        if tag in _CLOSES:
            self._end_open(*_CLOSES[tag])
        if tag in ("br", "td", "th"):
            self._add(" ")
        if tag in VOID or attributes.endswith("/") and not block:
            return
        top = self._stack[-1]
        kind, main, path = top.kind, top.main, top.path
        named = ""
        if "=" in attributes or "hidden" in attributes:
            seen, named = self._known(attributes)
            if seen and tag not in ("html", "body", "main", "article"):
                kind = 2
        if tag in CHROME_TAGS:
            kind = 2
        elif tag == "header":
            kind = max(kind, 1 if main else 2)
        elif tag in ("main", "article"):
            main = max(main, 2 if tag == "main" else 1)
        if block or named:
            parent = path
            path = xxhash.xxh3_64_intdigest(f"{parent}/{tag}.{named}") >> 1
            token = self.tokens.get(path)
            if token:
                token[1] += 1
            else:
                self.tokens[path] = [parent, 1]
        heading = top.heading or tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        self._stack.append(_Open(tag, path, kind, main, heading, top.link or tag == "a", path if block else top.block))

    @staticmethod
    def _known(attributes: str) -> tuple[bool, str]:
        """Whether the attributes tell a kind to drop or an unseen element; the first class."""
        drop, first = False, ""
        for found in _ATTRIBUTE.finditer(attributes):
            name, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                drop = True
            elif name == "role":
                drop = drop or value in CHROME_ROLES
            elif name in ("class", "id"):
                if name == "class" and value:
                    first = re.sub(r"\d+", "0", value.split()[0]) if value.split() else ""
                for part in value.split():
                    words = _NAME_WORD.findall(part)
                    if any(w in CHROME_NAMES for w in words) and not {"has", "with", "no", "without"} & set(words):
                        drop = True
        return drop, first


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _text_key(block: Block) -> int:
    return _signed(xxhash.xxh3_64_intdigest(f"{block.path} {block.text}".encode("utf-8", "surrogatepass")))


_FOUND = "what path parent text mark chars own links said".split()


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, what, path, parent, text, mark, chars, own, links, said) of each page of (host, html) that is not the same as another.

    ``what`` is 0 for a token, 1 for a text of a block at a token, 2 for the page itself. ``mark`` hashes the
    page and the count of the token; chars, links and said (hash) are of the text right in the element, own
    counts the characters of no known kind; ``text`` is the key of a block's text.
    """
    ddl = f"host string, page long, found array<struct<{', '.join(f'{n}: bigint' for n in _FOUND)}>>"
    rows_of = pa.list_(pa.struct([(n, pa.int64()) for n in _FOUND]))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 500) for whole in stream for at in range(0, whole.num_rows, 500)):
            hosts, keys, sizes, rows = [], [], [0], []
            for host, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                key = _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))
                page = Page(text)
                sums: dict[int, list] = {}
                texts: dict[int, list[int]] = {}
                for block in page.blocks:
                    s = sums.setdefault(block.path, [0, 0, 0, []])
                    s[0] += len(block.text)
                    s[2] += block.links
                    s[3].append(block.text)
                    if not block.kind:
                        s[1] += len(block.text)
                        texts.setdefault(_text_key(block), [block.path, 0])[1] += len(block.text)
                for path, (parent, n) in page.tokens.items():
                    chars, own, links, said = sums.get(path, (0, 0, 0, []))
                    rows.append((0, path, parent, 0, _signed(xxhash.xxh3_64_intdigest(f"{key} {n}")), chars, own, links,
                                 _signed(xxhash.xxh3_64_intdigest("\n".join(said).encode("utf-8", "surrogatepass")))))
                rows.extend((1, path, 0, text_key, 0, chars, chars, 0, 0) for text_key, (path, chars) in texts.items())
                rows.append((2, 0, 0, 0, 0, 0, 0, 0, 0))
                hosts.append(host)
                keys.append(key)
                sizes.append(len(rows))
            inner = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(_FOUND), names=_FOUND)
            found = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), inner).cast(rows_of)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), found], names=["host", "page", "found"])

    once = pages.select("host", "html").mapInArrow(batches, ddl).dropDuplicates(["host", "page"])
    return once.select("host", F.inline("found"))


def templates(pages: DataFrame, share: float = TEMPLATE_SHARE, least_pages: int = LEAST_PAGES, link_share: float = LINK_SHARE) -> DataFrame:
    """(host, dropped, linked, slots, texts) of the template of each host.

    Paths of its slots, the mean of the characters that vary in each, paths of those to drop outside and
    inside an article, and keys of the texts that belong to it. A host of fewer than ``least_pages``
    different pages has no means. ``pages``: host, html. The slots of a host are at most ``1 / share``
    times the tokens of its mean page, and the texts ``1 / share`` times its blocks.
    """
    scratch = Scratch(pages.sparkSession, "htmltext")
    rows = page_tokens(pages).groupBy("host", "what", "path", "parent", "text").agg(
        F.count("*").alias("pages"), F.sum(F.col("mark").cast("decimal(20,0)")).alias("vector"), F.sum("chars").alias("chars"), F.sum("own").alias("own"),
        F.sum("links").alias("links"), F.min("said").alias("low"), F.max("said").alias("high"))
    rows = scratch.pin(rows.where((F.col("what") != 1) | (F.col("pages") >= least_pages)))
    size = rows.where("what = 2").select("host", F.col("pages").alias("host_pages"))
    often = rows.where("what < 2").join(size, "host").where(F.col("pages") >= share * F.col("host_pages"))
    tokens = often.where("what = 0")
    above = tokens.select("host", F.col("path").alias("parent"), F.col("vector").alias("above"))
    nested = tokens.join(above, ["host", "parent"], "left").withColumn("outside", F.when(~F.col("above").eqNullSafe(F.col("vector")), F.col("parent")))
    classes = nested.groupBy("host", "vector").agg(F.min("outside").alias("first"), F.max("outside").alias("last")).where("first is null or first = last")
    slots = nested.join(classes.select("host", "vector"), ["host", "vector"], "left_semi")
    texts = often.where("what = 1").groupBy("host", "path").agg(F.sum("chars").alias("equal"), F.collect_list("text").alias("texts"))
    said = F.col("chars") > 0
    same = (F.col("pages") >= least_pages) & (F.col("low") == F.col("high"))
    links = F.col("links") > link_share * F.col("chars")
    slots = slots.withColumn("slot", F.col("path"))
    both = slots.join(texts, ["host", "path"], "full")
    mean = F.when(F.col("host_pages") >= least_pages, F.greatest(F.lit(0), F.col("own") - F.coalesce("equal", F.lit(0))) / F.col("pages"))
    return both.groupBy("host").agg(
        F.collect_list(F.when(said & (same | links), F.col("slot"))).alias("dropped"),
        F.collect_list(F.when(said & links & (F.col("host_pages") >= least_pages), F.col("slot"))).alias("linked"),
        F.collect_list(F.when(F.col("slot").isNotNull(), F.struct(F.col("slot").alias("path"), mean.alias("mean")))).alias("slots"),
        F.flatten(F.collect_list("texts")).alias("texts"))


@dataclass(slots=True)
class Template:
    """What main_text has to know of a host; ``slots`` is path to the mean of the characters that vary, None if the pages are too few."""

    dropped: set[int]
    linked: set[int]
    slots: dict[int, float | None]
    texts: set[int]


def _article(blocks: list[Block], template: Template) -> int:
    """The least ``main`` that a block of the article has on a page with these blocks."""
    best = max((b.main for b in blocks), default=0)
    if not any(mean is not None for mean in template.slots.values()):
        return best  # no other pages to tell
    weights: dict[tuple[int, int], float] = {}
    for block in blocks:
        mean = template.slots.get(block.path)
        place = (block.main, block.path)
        weights[place] = weights.get(place, 0) + len(block.text) if mean is None else mean
    least = ARTICLE_SHARE * sum(weights.values())
    return next((k for k in range(best, 0, -1) if sum(w for (main, _), w in weights.items() if main >= k) >= least), 0)


def main_text(page: Page, template: Template) -> str:
    """The blocks left by the template, joined by empty lines."""
    blocks, equal, linked = [], set(), set()
    for block in page.blocks:
        if block.kind:
            continue
        path = block.path
        while path and path not in template.slots:
            path = page.tokens[path][0]
        if not block.main and path in template.dropped:
            continue
        if _text_key(block) in template.texts:
            equal.add(len(blocks))
        elif path in template.linked:
            linked.add(len(blocks))
        blocks.append(block)
    if sum(len(blocks[k].text) for k in equal) > COPY_SHARE * sum(len(b.text) for b in blocks):
        equal = set()
    gone = equal | linked
    if len(gone) == len(blocks):
        gone = equal  # a page of links only
    blocks = [b for k, b in enumerate(blocks) if k not in gone]
    least = _article(blocks, template)
    return "\n\n".join(b.text for b in blocks if b.main >= least)


def extracted(pages: DataFrame, **limits) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages`` (page_id, url, html).

    A null or empty html has the empty text. A null url, or one without a host,
    belongs to the host ''. Null ids and repeated rows are pages like any
    other; other columns are ignored. On a host of fewer than ``least_pages``
    different pages an article or main element with text is the article.
    """
    placed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    # written first: Spark then knows its size and moves the pages only if it is too large to be sent to them
    found = Scratch(pages.sparkSession, "templates").pin(templates(placed.select("host", "html"), **limits))
    met = placed.join(found, "host", "left").select("page_id", "url", "html", "dropped", "linked", "slots", "texts")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = [main_text(Page(text or ""), Template(set(dropped or ()), set(linked or ()), {s["path"]: s["mean"] for s in slots or ()}, set(said or ())))
                     for text, dropped, linked, slots, said in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema)

    return met.mapInArrow(batches, "page_id long, url string, text string, n_chars long")
