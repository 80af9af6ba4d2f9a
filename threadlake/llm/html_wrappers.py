"""Main text of pages by wrappers inferred for each host.

The tag streams of a host's pages are folded and aligned into one union-free regular
expression: a repeated stretch becomes a group with ``+``, a mismatch becomes an
optional group, and between the tags stand text slots (``Wrapper.slots``). A text that all
pages of the host have in a slot is a fixed string of the wrapper, as a tag is; what varies is
data, and a page's text is its data. Texts in menus, adverts, forms and the like vary too:
those are left out by the tags that are open on the page itself.
"""

from __future__ import annotations

import difflib
import html as entities
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import map_columns, written

# Comments, raw-text elements (also unclosed ones), and tags with quoted attributes.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<svg(?=[\s/])[^>]*/>"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea)(?=[\s/>]|\Z)[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<tag>/?[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
_HINT = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Tags that end no block, and end tags that HTML lets be left out.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
OPTIONAL_ENDS = frozenset("p li dt dd tr td th thead tbody tfoot option html head body".split())
VOID = frozenset("area base col embed hr input link meta param source track".split())
NO_TEXT = frozenset(
    "head title nav footer aside form select option button label fieldset dialog menu object".split()
)
REGIONS = frozenset("article main".split())
NO_TEXT_HINTS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
    "cookies footer form header login menu nav navbar navigation newsletter notice notices "
    "popup promo related share sharing sidebar social sponsor sponsored subscribe widget "
    "complementary contentinfo search dialog alert".split()
)
REGION_HINTS = frozenset("article main content post story".split())
LONGEST_REPEAT = 12
LEAST_PAGES = 3  # different articles that must have a text in a slot before it is fixed


def mark_of(name: str, rest: str, inside: bool) -> str:
    """``.no`` or ``.yes`` for what a tag says it is, empty if it says nothing or both.

    A name in its class, id or role counts as a whole: it is no text if all its parts are
    hints of that, and a region if some part is one and none is the other. The page
    as a whole and a main text are never ``.no``, nor an article that is not ``inside`` another.
    """
    no = yes = False
    for _, a, b, c in _HINT.findall(rest):
        for word in (a or b or c).lower().split():
            parts = {part for part in re.split(r"[_-]+", word) if part}
            no |= bool(parts) and parts <= NO_TEXT_HINTS
            yes |= bool(parts & REGION_HINTS) and not parts & NO_TEXT_HINTS
    no = no and not (name in ("html", "body", "main") or (name == "article" and not inside))
    return "" if no and yes else ".no" if no else ".yes" if yes else ""


def tokens_of(page: str) -> tuple[list[str], list[str]]:
    """Tags of a page, and the text after each; the first text stands before any tag.

    Inline tags are part of the text, ``br`` is white space, end tags that HTML
    lets be left out are dropped. A tag that says it is a region or no text keeps that as
    a mark: ``div.no`` or ``div.yes``.
    """
    tags: list[str] = []
    texts: list[list[str]] = [[]]
    place = 0
    # An open tag with a mark whose end would be dropped, and how deep its name is nested.
    marked, depth = "", 0
    regions = 0  # open articles and main texts
    for match in _MARKUP.finditer(page):
        texts[-1].append(page[place : match.start()])
        place = match.end()
        name = match.group("tag")
        if name is None:
            continue
        name = name.lower()
        rest = match.group("rest")
        plain = name.removeprefix("/")
        mark = mark_of(name, rest, regions > 0) if rest and name == plain else ""
        if plain in REGIONS:
            regions = max(0, regions + (1 if name == plain else -1))
        light = plain in INLINE or plain in OPTIONAL_ENDS
        if marked and plain == marked:
            if name == plain and plain in OPTIONAL_ENDS:
                depth = 0  # its next sibling ends it
            depth += -1 if name != plain else plain in INLINE
            if depth <= 0:
                marked, depth = "", 0
                if name != plain:
                    tags.append(name)
                    texts.append([])
                    continue
        if plain in INLINE and mark != ".no":
            if plain == "br":
                texts[-1].append(" ")
            continue
        if name != plain and light:
            # The text after it is a block of its own all the same.
            texts[-1].append("\0")
            continue
        if mark and light and not marked and plain not in ("html", "body"):
            marked, depth = plain, 1
        tags.append(name + mark)
        texts.append([])
    texts[-1].append(page[place:])
    return tags, ["".join(t) for t in texts]


def blocks_of(text: str) -> Iterator[str]:
    """The blocks of one slot's raw text, decoded, with single spaces."""
    for part in text.split("\0"):
        block = " ".join(entities.unescape(part).split())
        if block:
            yield block


# An expression is a list of items: a tag, ["+", items] or ["?", items].
def fold(items: Sequence) -> list:
    """``items`` with every stretch that stands twice or more in a row as a ``+`` group."""
    items = list(items)
    for width in range(1, LONGEST_REPEAT + 1):
        out, i = [], 0
        while i < len(items):
            group = items[i : i + width]
            end = i + width
            if len(group) == width:
                while items[end : end + width] == group:
                    end += width
            if end > i + width:
                only = group[0] if width == 1 and isinstance(group[0], list) else None
                out.append(only if only and only[0] == "+" else ["+", group])
                i = end
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _absorb(items: list, groups: Iterable[list]) -> list:
    """``items`` with each stretch equal to one of ``groups`` as that ``+`` group."""
    for group in groups:
        width, out, i = len(group), [], 0
        while i < len(items):
            if items[i : i + width] == group:
                if not (out and out[-1] == ["+", group]):
                    out.append(["+", group])
                i += width
            elif items[i] == ["+", group] and out and out[-1] == items[i]:
                i += 1
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _repeats(items: list) -> list[list]:
    found = [item[1] for item in items if isinstance(item, list) and item[0] == "+"]
    return sorted(found, key=len, reverse=True)


def align(wrapper: list, sample: list) -> list:
    """One expression that fits both: equal stretches stay, the rest becomes optional.

    A stretch that is a repeated group on one side is one on the other side too, so
    that one row and many rows of a list are the same thing.
    """
    if wrapper == sample:
        return wrapper
    sample = _absorb(sample, _repeats(wrapper))
    wrapper = _absorb(wrapper, _repeats(sample))
    keys = [[json.dumps(_core(x)) for x in side] for side in (wrapper, sample)]
    out: list = []
    for op, a, b, c, d in difflib.SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        if op == "equal":
            for left, right in zip(wrapper[a:b], sample[c:d]):
                both = "?" in (left[0] if isinstance(left, list) else "", right[0] if isinstance(right, list) else "")
                out.append(["?", _core(left)] if both else left)
            continue
        for side in (wrapper[a:b], sample[c:d]):
            out += [x if isinstance(x, list) and x[0] == "?" else ["?", [x]] for x in side]
    return out


def _core(item):
    """What an item is, apart from being optional."""
    if isinstance(item, list) and item[0] == "?":
        return item[1]
    return [item]


def infer(skeletons: Iterable[list]) -> list:
    """The wrapper of a host from its distinct folded streams, shortest first."""
    wrapper: list | None = None
    for skeleton in sorted(skeletons, key=lambda s: (len(json.dumps(s)), json.dumps(s))):
        wrapper = skeleton if wrapper is None else align(wrapper, skeleton)
    return wrapper or []


class Wrapper:
    """A wrapper ready to read pages: which slot each text of a page fills, and its fixed texts.

    ``fixed`` holds pairs of a slot and the hash of a block.
    """

    def __init__(self, items: list, fixed: Iterable[tuple[int, int]] = ()):
        self.items = items
        self.fixed = frozenset(fixed)
        self.size = 0
        self.program = self._number(items)

    def _number(self, items: list) -> list:
        out = []
        for item in items:
            if isinstance(item, list):
                out.append((item[0], self._number(item[1]), _firsts(item[1])))
            else:
                out.append((item, self.size))
                self.size += 1
        return out

    def slots(self, tags: list[str]) -> list[int] | None:
        """The slot after each tag, or None if the page does not fit."""
        found: list[int] = []

        def run(program: list, at: int) -> int:
            for item in program:
                if len(item) == 2:
                    if at >= len(tags) or tags[at] != item[0]:
                        return -1
                    found.append(item[1])
                    at += 1
                else:
                    kind, inner, firsts = item
                    times = 0
                    while at < len(tags) and tags[at] in firsts and (times == 0 or kind == "+"):
                        mark = len(found)
                        after = run(inner, at)
                        if after < 0 or after == at:
                            del found[mark:]
                            break
                        at, times = after, times + 1
                    if kind == "+" and not times:
                        return -1
            return at

        return found if run(self.program, 0) == len(tags) else None


def _firsts(items: list) -> set[str]:
    firsts: set[str] = set()
    for item in items:
        if isinstance(item, list):
            firsts |= _firsts(item[1])
            if item[0] == "?":
                continue
        else:
            firsts.add(item)
        break
    return firsts


def region(tag: str) -> int:
    """2 for a tag that is a region of main text, 1 for one that is said to be, else 0."""
    name, _, mark = tag.partition(".")
    if name.startswith("/") or mark == "no":
        return 0
    return 2 if name in REGIONS else int(mark == "yes")


def step(stack: list[str], tag: str) -> None:
    """Keep the tags that are open after ``tag``; an end tag closes back to its start."""
    name = tag.partition(".")[0]
    if not name.startswith("/"):
        if name in OPTIONAL_ENDS and stack and stack[-1].partition(".")[0] == name:
            stack.pop()
        if name == "body":
            stack[:] = [t for t in stack if t != "head"]
        if name not in VOID:
            stack.append(tag)
        return
    name = name[1:]
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].partition(".")[0] == name:
            del stack[i:]
            return


def is_content(stack: list[str], has_region: int) -> bool:
    """Whether text below these open tags is main text; the surest kind of region decides."""
    inside = False
    for tag in stack:
        name, _, mark = tag.partition(".")
        if mark == "no" or name in NO_TEXT or (name == "header" and not inside):
            return False
        inside = inside or (has_region > 0 and region(tag) == has_region)
    return inside or not has_region


def content_of(tags: list[str]) -> list[bool]:
    """Whether the text before any tag and after each one is main text, by the page's own open tags."""
    has_region = max(map(region, tags), default=0)
    stack: list[str] = []
    keep = [not has_region]
    for tag in tags:
        step(stack, tag)
        keep.append(is_content(stack, has_region))
    return keep


def block_hash(block: str) -> int:
    return xxhash.xxh3_64_intdigest(block.encode("utf-8", "surrogatepass")) >> 1


def blocks_in_slots(page: str | None, wrapper: Wrapper | None) -> list[tuple[int | None, str]]:
    """Blocks that the page's own tags allow, in page order, with the slots they fill.

    -1 is the slot before any tag; a page that the wrapper does not fit has no slots.
    """
    tags, texts = tokens_of(page or "")
    found = wrapper.slots(tags) if wrapper else None
    slots = [None] * len(texts) if found is None else [-1, *found]
    return [
        (slot, block)
        for slot, text, kept in zip(slots, texts, content_of(tags)) if kept
        for block in blocks_of(text)
    ]


def main_text(page: str | None, wrapper: Wrapper | None) -> str:
    """The blocks of a page that are data of its wrapper, in page order.

    A page that no wrapper fits is read by its own tags alone. So is one whose fixed
    texts are the larger part: that is a copy of other pages and not a template filled in.
    """
    blocks = blocks_in_slots(page, wrapper)
    fixed = wrapper.fixed if wrapper else frozenset()
    data = [b for slot, b in blocks if not fixed or (slot, block_hash(b)) not in fixed]
    whole = [b for _, b in blocks]
    return "\n\n".join(data if 2 * sum(map(len, data)) >= sum(map(len, whole)) else whole)


def host_of(column: str):
    """The key under which pages share a wrapper: the url's host, or an empty one."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(column), r"://([^/?#]*)", 1)), F.lit(""))


def wrappers_of(df: DataFrame, url_column: str = "url", html_column: str = "html", salts: int = 16) -> DataFrame:
    """``host, wrapper`` (JSON) from all pages of each host.

    Each page gives its folded tag stream. Equal ones are counted once before any
    shuffle, so a host with a third of all pages sends a few rows; its distinct streams are
    aligned in ``salts`` groups first and the partial wrappers then with each other.
    """

    def body():
        def one(batch: pa.RecordBatch) -> list:
            streams = []
            for page in batch.column(1):
                tags, _ = tokens_of(page.as_py() or "")
                streams.append(json.dumps(fold(tags)))
            return [batch.column(0), pa.array(streams, pa.string())]

        return one

    rows = df.select(host_of(url_column).alias("host"), F.col(html_column).cast("string").alias("html"))
    streams = map_columns(rows, "host string, stream string", body).distinct()

    def merge(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        wrapper = infer(map(json.loads, frame["stream"]))
        return pd.DataFrame({"host": [key[0]], "stream": [json.dumps(wrapper)]})

    salted = streams.withColumn("_salt", F.pmod(F.xxhash64("stream"), F.lit(salts)))
    partial = salted.groupBy("host", "_salt").applyInPandas(merge, "host string, stream string")
    whole = partial.groupBy("host").applyInPandas(merge, "host string, stream string")
    return whole.withColumnRenamed("stream", "wrapper")


def _reader():
    """A function from a wrapper's JSON and its fixed texts to the wrapper, with a cache of bounded size."""
    known: dict[tuple, Wrapper] = {}

    def wrapper_of(text: str | None, fixed: Sequence | None = None) -> Wrapper | None:
        if text is None:
            return None
        key = (text, tuple((f["slot"], f["block"]) for f in fixed or ()))
        if key not in known:
            if len(known) > 1000:
                known.clear()
            known[key] = Wrapper(json.loads(text), key[1])
        return known[key]

    return wrapper_of


def fixed_texts(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``host, fixed``: slots and hashes of the blocks that all pages have which fill the slot.

    Pages count as different if their longest blocks are; of a host's copies of one article, near
    ones too, mostly one counts. Only hashes are shuffled, equal ones once a task, and a host
    has no more fixed texts than a page has blocks.
    """

    def body():
        wrapper_of = _reader()

        def one(batch: pa.RecordBatch) -> list:
            hosts, slots, hashes, articles = [], [], [], []
            for host, page, wrapper in zip(*(batch.column(i).to_pylist() for i in range(3))):
                blocks = blocks_in_slots(page, wrapper_of(wrapper))
                if not blocks or blocks[0][0] is None:
                    continue
                filled = {(slot, block_hash(block)) for slot, block in blocks}
                hosts += [host] * len(filled)
                slots += [slot for slot, _ in filled]
                hashes += [block for _, block in filled]
                articles += [block_hash(max((block for _, block in blocks), key=len))] * len(filled)
            return [
                pa.array(hosts, pa.string()), pa.array(slots, pa.int32()),
                pa.array(hashes, pa.int64()), pa.array(articles, pa.int64()),
            ]

        return one

    rows = pages.join(wrappers, "host").select("host", "html", "wrapper")
    filled = written(
        map_columns(rows, "host string, slot int, block long, article long", body).distinct(), "filled"
    )
    of_slots = filled.select("host", "slot", "article").distinct().groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n"))
    of_blocks = filled.groupBy("host", "slot", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_PAGES)
    fixed = of_blocks.join(of_slots, ["host", "slot", "n"])
    return fixed.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "block"))).alias("fixed"))


def extract_text(
    df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page's main text.

    A null or empty html gives an empty text, a null url shares the wrapper of the empty
    host, repeated rows are read each, other columns are ignored, an empty table gives no
    rows. Wrappers are written once; their joins with the pages are left to Spark, which
    broadcasts them where their measured size allows it and else splits hot hosts.
    """
    shapes = written(wrappers_of(df, url_column, html_column), "wrappers")
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
        host_of(url_column).alias("host"),
    )
    wrappers = written(shapes.join(fixed_texts(rows, shapes), "host", "left"), "wrappers")
    joined = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper", "fixed")

    def body():
        wrapper_of = _reader()

        def one(batch: pa.RecordBatch) -> list:
            texts = [
                main_text(page, wrapper_of(wrapper, fixed))
                for page, wrapper, fixed in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
            ]
            return [
                batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]

        return one

    return map_columns(joined, f"page_id {kind}, url string, text string, n_chars long", body)
