"""Main text of web pages, with boilerplate found by a suffix array over each host's pages.

A page is parsed once into blocks of text, each in one of four zones: content (inside the page's article or main element),
chrome (what elements, roles and plain names say is a menu, header, footer, sidebar, advert, form or comment), doubtful
(inside the content, under a name that is often but not always chrome) and open (everything else). All but the content is
the host's token stream. Each of its suffixes is told by the host and its first twelve tokens, or by the whole block if
that ends before; the array of them is range-partitioned by sampled splitters, sorted, and neighbours of one host that
agree in all these tokens on two distinct pages mark boilerplate. Equal beginnings never part at a splitter, so no
neighbours need to be compared over a boundary between partitions.

Doubtful and open blocks lose the runs so marked and keep their unique ones; doubtful blocks that are mostly links go, too.
Open text beside an article or main element stays only if its unique runs outweigh that content, as where the elements
are teasers. Content stays whole, also where pages share its sentences: they are part of the article on each of them.
Copies of one page are not distinct pages.

No host is gathered in one task: batches send each suffix once, whatever number of their pages has it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import written

CONTENT, CHROME, OPEN, DOUBTFUL = range(4)
#: Tokens that two suffixes must share.
LONG = 12
#: Bytes of packed blocks for which one task marks runs at once.
PART = 4 << 20
#: Between the tokens of a suffix; before a suffix that is one whole block.
GAP, WHOLE = " ", "\x01"
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|<\Z""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
GONE = frozenset("head script style title template noscript svg math canvas object iframe audio video map select option datalist button textarea".split())
SIDE = frozenset("nav footer aside form menu dialog search fieldset".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Names of classes and ids that say chrome everywhere, and those that say so outside the content and leave doubt inside.
SIDE_WORDS = frozenset("nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup footer pagination pager".split())
DOUBTFUL_WORDS = frozenset("promotion banner notice notices notification alert login share sharing social header masthead topbar toolbar related recommended widget copyright legal disclaimer search".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())


@dataclass
class Block:
    zone: int
    text: str
    heading: bool = False


@dataclass
class _Open:
    tag: str
    chrome: bool
    gone: bool
    inside: bool
    header: bool
    heading: bool = False
    doubtful: bool = False
    link: bool = False


def _words(value: str) -> set[str]:
    return set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()))


def _state(tag: str, attributes: str, above: _Open) -> _Open:
    chrome, gone = above.chrome or tag in SIDE, above.gone or tag in GONE
    inside = above.inside
    header = above.header or (tag == "header" and not chrome)
    names: set[str] = set()
    if attributes.strip(" /\t\r\n"):
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                names |= _words(value)
            elif name == "role":
                chrome |= value.lower() in ROLES
                inside |= value.lower() == "main" and not chrome
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                gone = True
    doubtful, named = above.doubtful, tag not in ("html", "body", "article", "main", "p", *HEADINGS)
    if names & COMMENT_WORDS or named and names & SIDE_WORDS:
        chrome = True
    elif named and names & DOUBTFUL_WORDS:
        chrome, doubtful = chrome or not inside, True
    if tag in ("article", "main") and not chrome:
        inside = True
    return _Open(tag, chrome, gone, inside, header, above.heading or tag in HEADINGS, doubtful, above.link or tag == "a")


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order, their white space made one space; empty ones are left out."""
    root = _Open("", False, False, False, False)
    stack, out, parts = [root], [], []
    zone, heading, linked = OPEN, False, 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                menu = zone == DOUBTFUL and 2 * linked >= len("".join(parts))
                out.append(Block(CHROME if menu else zone, text, heading))
            parts, linked = [], 0

    def enter() -> None:
        nonlocal zone, heading
        top = stack[-1]
        heading = top.heading
        if top.chrome or top.header and (not top.inside or not top.heading):
            zone = CHROME
        elif top.inside:
            zone = DOUBTFUL if top.doubtful else CONTENT
        else:
            zone = OPEN

    at, size = 0, len(page)
    enter()
    while at < size:
        m = TAG.search(page, at)
        begin = m.start() if m else size
        if begin > at and not stack[-1].gone:
            parts.append(page[at:begin])
            linked += begin - at if stack[-1].link else 0
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        block = tag not in INLINE
        if block:
            close()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
        elif tag in VOID:
            continue
        else:
            if block:  # a block ends an open paragraph
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        del stack[i:]
                        break
                    if stack[i].tag not in INLINE:
                        break
            if m[3].endswith("/") and tag in ("svg", "path", "use"):
                continue
            before = stack[-1]
            state = _state(tag, m[3], before)
            if not block and (state.chrome, state.gone, state.doubtful) != (before.chrome, before.gone, before.doubtful):
                close()  # an inline element of another zone
            stack.append(state)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}", re.I).search(page, at)
                at = end.start() if end else size
        old = zone
        top = stack[-1]
        if not block and parts and (top.chrome != (old == CHROME)):
            close()
        enter()
    close()
    return out


def stream(blocks: list[Block]) -> tuple[list[str], list[int], list[int]]:
    """(tokens of all blocks but the content, the block of each, the place after each block's last token)."""
    tokens, owner, ends = [], [], []
    for i, b in enumerate(blocks):
        if b.zone != CONTENT:
            some = b.text.split(" ")
            tokens += some
            owner += [i] * len(some)
        ends.append(len(tokens))
    return tokens, owner, ends


def suffixes(blocks: list[Block]) -> Iterator[tuple[str, int, int]]:
    """(beginning of the suffix, place of its first token, tokens) of every suffix that two pages can share.

    A beginning has LONG tokens of the stream, or is a whole block that is shorter than that and no heading.
    """
    tokens, owner, ends = stream(blocks)
    for i in range(len(tokens) - LONG + 1):
        yield GAP.join(tokens[i : i + LONG]), i, LONG
    for i, b in enumerate(blocks):
        size = ends[i] - (ends[i - 1] if i else 0)
        if 0 < size < LONG and not b.heading:
            yield WHOLE + b.text, ends[i] - size, size


def judged(blocks: list[Block]) -> bool:
    """Whether the page has text that the array decides on."""
    return any(b.zone in (OPEN, DOUBTFUL) for b in blocks)


def main_text(blocks: list[Block], repeated: Callable[[str], bool]) -> str:
    """Content, and what repeated runs leave of doubtful and open blocks.

    A block goes if runs cover it all. Else it loses the runs that lie inside it: one that only reaches into it from
    another block doesn't take its first or last words.
    """
    if not judged(blocks):
        return " ".join(b.text for b in blocks if b.zone == CONTENT)
    tokens, owner, ends = stream(blocks)
    everywhere, inside = np.zeros(len(tokens) + 1, np.int64), np.zeros(len(tokens) + 1, np.int64)
    for beginning, at, size in suffixes(blocks):
        if repeated(beginning):
            for cover in (everywhere, inside) if owner[at] == owner[at + size - 1] else (everywhere,):
                cover[at] += 1
                cover[at + size] -= 1
    everywhere, inside = np.cumsum(everywhere) > 0, np.cumsum(inside) > 0
    out, content, unique = [], 0, 0
    for i, b in enumerate(blocks):
        if b.zone == CONTENT:
            out.append((b.zone, b.text))
            content += len(b.text)
        elif b.zone != CHROME:
            here = range(ends[i - 1] if i else 0, ends[i])
            left = " ".join(tokens[k] for k in here if not inside[k])
            if left and not all(everywhere[k] for k in here):
                out.append((b.zone, left))
                unique += len(left) if b.zone == OPEN else 0
    return " ".join(t for zone, t in out if zone != OPEN or not content or unique > content)


def pack(blocks: list[Block]) -> bytes:
    return zstandard.compress("\n".join(f"{b.zone}{int(b.heading)}{b.text}" for b in blocks).encode(), 3)


def unpack(packed: bytes) -> list[Block]:
    lines = zstandard.decompress(packed).decode().split("\n")
    return [Block(int(x[0]), x[2:], x[1] == "1") for x in lines if x]


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html).

    Null html is empty, whose text is empty. A null url is a host of its own name, the empty one. Repeated rows stay and get
    the same text. A cut page is read as far as it goes; a tag without its end is no text. Tags that are not closed end
    with the element around them. Text of any length is read whole. Other columns are not read, so their names may clash.
    """
    page = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    rows = pages.select("page_id", "url", F.xxhash64(page).alias("pk"), host.alias("host"), page.alias("html"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A page that the array has nothing to decide on has its text at once; only its tokens of chrome are still wanted."""
        part, held = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
        for batch in batches:
            blocks, parts, open_, texts = [], [], [], []
            for text in batch.column(4):
                found = blocks_of(text.as_py())
                wanted = judged(found)
                texts.append(None if wanted else main_text(found, lambda _: False))
                blocks.append(pack(found if wanted else [b for b in found if b.zone != CONTENT]))
                open_.append(wanted)
                held += len(blocks[-1])
                parts.append(part)
                if held > PART:
                    part, held = part + 1, 0
            made = [pa.array(blocks, pa.binary()), pa.array(texts, pa.string()), pa.array(parts, pa.int64()), pa.array(open_)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *made], [*batch.schema.names[:4], "blocks", "text", "part", "judged"])

    kind = pages.schema["page_id"].dataType.simpleString()
    names = f"page_id {kind}, url string, pk long, host string, blocks binary, text string, part long, judged boolean"
    parsed = written(rows.mapInArrow(scan, names), "page-blocks")

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str, int], list] = {}
            columns = (batch.column(i).to_pylist() for i in range(5))
            for pk, name, packed, part, wanted in zip(*columns, strict=True):
                for beginning, _, _ in suffixes(unpack(packed)):
                    seen = found.setdefault((name, beginning, part), [pk, pk, wanted])
                    seen[0], seen[1], seen[2] = min(seen[0], pk), max(seen[1], pk), seen[2] or wanted
            hosts, keys, parts = zip(*found, strict=True) if found else ((), (), ())
            least, most, some = zip(*found.values(), strict=True) if found else ((), (), ())
            made = [pa.array(hosts, pa.string()), pa.array(keys, pa.string()), *(pa.array(x, pa.int64()) for x in (parts, least, most)), pa.array(some, pa.bool_())]
            yield pa.RecordBatch.from_arrays(made, ["host", "beginning", "at", "least", "most", "wanted"])

    def neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compares each suffix of the sorted array with the one before it; only places of text to be judged are kept."""
        run, least, most, marked, waiting = None, 0, 0, False, []
        for batch in batches:
            out = []
            for name, beginning, at, low, high, wanted in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if run != (name, beginning):
                    run, least, most, marked, waiting = (name, beginning), low, high, False, []
                least, most = min(least, low), max(most, high)
                if wanted:
                    waiting.append(at)
                if marked or least < most:
                    marked = True
                    out += [(x, name, beginning) for x in waiting]
                    waiting = []
            columns = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)], ["at", "host", "beginning"])

    array = parsed.select("pk", "host", "blocks", "part", "judged").mapInArrow(begin, "host string, beginning string, at long, least long, most long, wanted boolean")
    array = array.repartitionByRange("host", "beginning").sortWithinPartitions("host", "beginning")
    found = array.mapInArrow(neighbours, "at long, host string, beginning string")

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        marked = set(zip(right["host"].to_pylist(), right["beginning"].to_pylist(), strict=True))
        texts = [main_text(unpack(packed), lambda x, h=name: (h, x) in marked) for packed, name in zip(left["blocks"].to_pylist(), left["host"].to_pylist(), strict=True)]
        return pa.table([left["page_id"], left["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    open_pages = parsed.where("judged").select("page_id", "url", "host", "blocks", "part")
    kept = open_pages.groupBy("part").cogroup(found.groupBy("at")).applyInArrow(keep, f"page_id {kind}, url string, text string")
    whole = parsed.where("not judged").select("page_id", "url", "text").unionByName(kept)
    return whole.withColumn("n_chars", F.char_length("text").cast("long"))
