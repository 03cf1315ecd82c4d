"""The main body of web pages, by site templates.

Pages come as HTML or as text taken from HTML. A page is cut into its leaf elements, one a line; each
is hashed without its digits, attributes and link targets, and the hashes are counted in Spark: per
host (on how many of its pages an element stands) and, over all HTML pages, by the part of the page
it stands in. An element that recurs on most pages of its host is furniture of the site. HTML shows
the parts by its structure: the body is the container that holds the page's heading with what is
nested in it (without one, the container with the least recurring text). The subtree of each such
container is hashed too and counted per host: a nested one that recurs is deleted, and where the one
with the heading recurs it is the site's masthead, so that page is read as if it had no heading.
Inside the body, lines that are nothing but a link, and the heading right before them, lead elsewhere. Text shows no structure, so its lines take the part that
their hashes have in HTML; furniture is cut off before the title and after the body, and blocks of
links are cut out. A paragraph that recurs inside the body stays.

Nulls: null, empty and JSON responses have no lines; a null host counts no recurrences. Of one id
with several pages each is read. Pages may be of any length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from wattlake.session import cut_lineage, spread

# Names of HTML elements.
BLOCKS = frozenset("html body div p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr td th table thead tbody header main footer nav section aside article form blockquote pre figure address fieldset".split())
INLINE = frozenset("a span strong em b i u small sup sub br hr img input button label select option code abbr mark time wbr svg path".split())
HIDDEN = frozenset("script style head title template noscript iframe".split())
VOID = frozenset("br hr img input meta link wbr source".split())
TOP = frozenset("header main footer nav aside section article div".split())

ROLES = ("furniture", "side", "link", "title", "heading", "item", "row", "paragraph")
_HTML = re.compile(r"<(?:!doctype|html|head|body|div|p|li|h[1-6]|header|main|table|ul)\b", re.I)
_BULLET = re.compile(r"^(?:[•*·‣▪–—-]|\d+[.)])\s+")
_DIGITS = re.compile(r"\d+")
_CRUMB = re.compile(r"^[\w ]{1,30}(?:\s*(?:»|›|>|/|→)\s*[^»›>/→]{1,60}){1,6}$")


@dataclass(slots=True)
class Line:
    no: int
    text: str = ""
    container: int = -1
    path: tuple[tuple[int, str], ...] = ()  # the containers it stands in, outermost first, each with its tag
    tag: str = ""
    linked: int = 0  # characters inside links
    shown: int = 0
    hidden: bool = False
    notice: bool = False


@dataclass(slots=True)
class _Open:
    """An open element, and what its ancestors make of what stands in it."""

    tag: str = ""
    box: int = -1
    path: tuple[tuple[int, str], ...] = ()
    block: str = ""  # the innermost block
    flow: bool = False  # inside a paragraph, item or row
    hidden: bool = False
    notice: bool = False
    linked: bool = False


# comments, declarations, instructions, end tags (1) and start tags (2, and their attributes, 3)
_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<![^>]*>|<(\?[^>]*)>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style")}
_FLOW = frozenset(("p", "li", "tr"))
_SIDES = frozenset(("header", "footer", "nav", "aside"))


class _Visitor:
    """Depth-first visitor of the elements of a page; notes for each source line its text and where it stands."""

    def __init__(self) -> None:
        self.lines: dict[int, Line] = {}
        self.root = _Open()
        self.stack: list[_Open] = []
        self.containers = 0

    def read(self, raw: str) -> dict[int, Line]:
        no, at, end = 1, 0, len(raw)
        for m in _TOKEN.finditer(raw):
            start = m.start()
            if start < at:
                continue  # inside a script
            if start > at:
                data = raw[at:start]
                if data == "\n":
                    no += 1
                else:
                    self.text(data, no)
                    no += data.count("\n")
            at = m.end()
            kind = m.lastindex
            if kind == 4:
                tag = m[3].lower()
                self.open(tag, no, m[0])
                if m[4].endswith("/"):
                    self.close(tag, no)
                elif tag in _RAW_END:
                    e = _RAW_END[tag].search(raw, at)
                    at = e.start() if e else end
            elif kind == 2:
                self.close(m[2].lower(), no)
            elif kind == 1:
                self.add(f"<{m[1]}>", no)
            no += raw.count("\n", start, at)
        if at < end:
            self.text(raw[at:end], no)
        return self.lines

    def line(self, no: int) -> Line:
        x = self.lines.get(no)
        if x is None:
            x = self.lines[no] = Line(no)
        return x

    def open(self, tag: str, no: int, whole: str) -> None:
        block = tag in BLOCKS
        if not block and tag not in INLINE and tag not in HIDDEN and tag not in VOID:
            return self.add(whole, no)  # a placeholder in angle brackets
        if tag in VOID:
            return None
        on = self.stack[-1] if self.stack else self.root
        box, path = on.box, on.path
        if tag in TOP:
            if not on.flow:
                self.containers += 1
                if box < 0 or tag != "div" or on.tag not in _SIDES:
                    box = self.containers
                    path = (*path, (box, tag))
        elif block:
            x = self.line(no)
            x.tag = x.tag or tag
        self.stack.append(_Open(tag, box, path, tag if block else on.block, on.flow or tag in _FLOW, on.hidden or tag in HIDDEN, on.notice or tag == "noscript", on.linked or tag == "a"))
        return None

    def close(self, tag: str, no: int) -> None:
        stack = self.stack
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == tag:
                del stack[i:]
                return
        if tag not in BLOCKS and tag not in INLINE and tag not in HIDDEN and tag not in VOID:
            self.add(f"</{tag}>", no)

    def text(self, data: str, no: int) -> None:
        if not data.isspace():
            self.add(html.unescape(data) if "&" in data else data, no)

    def add(self, data: str, no: int) -> None:
        on = self.stack[-1] if self.stack else self.root
        for k, part in enumerate(data.split("\n") if "\n" in data else (data,)):
            n = len(part.strip())
            if not n:
                continue
            x = self.line(no + k)
            x.text = x.text + part if x.text else part
            if on.hidden:
                x.hidden = True
                x.notice |= on.notice
            x.shown += n
            if on.linked:
                x.linked += n
            if x.container < 0:
                x.container = on.box if self.stack else 0
                x.path = on.path
            x.tag = x.tag or on.block


def clean(text: str) -> str:
    return " ".join(text.split())


def page_lines(raw: str, notices: bool = False) -> tuple[bool, list[Line]]:
    """Whether the page is HTML, and its lines with visible text, with those for browsers without scripts if ``notices``."""
    if _HTML.search(raw):
        out = [x for _, x in sorted(_Visitor().read(raw).items()) if not x.hidden or (notices and x.notice)]
        for x in out:
            x.text = clean(x.text)
        return True, [x for x in out if x.text]
    return False, [Line(i, t) for i, l in enumerate(raw.split("\n"), 1) if (t := clean(html.unescape(l)))]


def is_json(raw: str) -> bool:
    return raw.lstrip("﻿ \t\r\n").startswith(("{", "[")) and not re.match(r"^[\s﻿]*(?:\{\{|\[\[|\[[A-Za-z])", raw)


def mask(text: str, organisation: str) -> str:
    t = text.lower()
    t = _BULLET.sub("", t)
    if organisation:
        t = t.replace(organisation, "ORG")
    return _DIGITS.sub("0", t)


def _h(kind: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\x00{text}") - (1 << 63)


def _hashes(text: str, organisation: str) -> tuple[int, int, int]:
    t = mask(text, organisation)
    w = t.split(" ")
    return (_h("all", t), _h("first", w[0]), _h("last", " ".join(w[-2:]))) if len(w) > 2 else (_h("all", t), 0, 0)


_known_hashes = lru_cache(1 << 14)(_hashes)


def hashes(text: str, organisation: str) -> tuple[int, int, int]:
    """Of the whole element and, if it has more than two words, of its first word and of its last two; those of short elements, which recur, are remembered."""
    return _known_hashes(text, organisation) if len(text) < 100 else _hashes(text, organisation)


def _only_link(x: Line) -> bool:
    return x.linked > 0 and x.linked >= x.shown


#: Containers that hold no body, unless the heading stands in them.
APART = frozenset("header footer nav aside".split())


def _weight(x: Line, recurring: float = 0.0) -> float:
    return 0.0 if _only_link(x) else (1 - recurring) * x.shown * (x.tag in ("p", "h2", "h3", "tr", "td"))


def headed_body(lines: list[Line]) -> list[bool] | None:
    """Which lines stand in the container of the heading or nested in it; None without a heading.

    A container that holds nothing but the heading gives way to the one around it, and at the top of
    the page to the heaviest one, which the heading joins.
    """
    title = next((x for x in lines if x.tag == "h1"), None)
    if title is None:
        return None
    within = [{b for b, _ in x.path} for x in lines]
    mine = {b for b, _ in title.path}

    def holds(box: int) -> list[bool]:
        return [box in w and not any(t in APART and b not in mine for b, t in x.path[[b for b, _ in x.path].index(box) + 1 :]) for x, w in zip(lines, within, strict=True)]

    for box, tag in reversed(title.path):
        at = holds(box)
        if tag in ("main", "article") or any(k and x.tag != "h1" and not x.notice and not _only_link(x) for x, k in zip(lines, at, strict=True)):
            return at
    weight: dict[int, float] = {}
    for x in lines:
        if x.path and not any(t in APART for _, t in x.path):
            weight[x.path[0][0]] = weight.get(x.path[0][0], 0.0) + _weight(x)
    best = max(sorted(weight), key=lambda c: weight[c], default=-1)
    if weight.get(best, 0.0) > 0:
        return [k or x is title for x, k in zip(lines, holds(best), strict=True)]
    return [x.container == title.container for x in lines]


def html_roles(lines: list[Line], recurring: list[float] | None = None, headed: bool = True) -> list[str]:
    """The part each line of an HTML page plays; the heading tells nothing unless ``headed``."""
    inside = headed_body(lines) if headed else None
    if inside is None:
        weight: dict[int, float] = {}
        for i, x in enumerate(lines):
            weight[x.container] = weight.get(x.container, 0.0) + _weight(x, recurring[i] if recurring else 0.0)
        main = max(sorted(weight), key=lambda c: weight[c], default=-1)
        inside = [x.container == main for x in lines]
    roles = []
    for i, x in enumerate(lines):
        if not inside[i] or x.notice:
            roles.append("furniture")
        elif _only_link(x):
            roles.append("link")
        elif x.tag == "h1":
            roles.append("title")
        elif x.tag in ("h2", "h3", "h4", "h5", "h6"):
            nxt = lines[i + 1] if i + 1 < len(lines) else None
            roles.append("side" if nxt is not None and inside[i + 1] and _only_link(nxt) else "heading")
        else:
            roles.append({"li": "item", "dd": "item", "tr": "row", "td": "row", "th": "row"}.get(x.tag, "paragraph"))
    return roles


def boxes(lines: list[Line], roles: list[str], whole: list[int]) -> list[tuple[int, bool] | None]:
    """For each line of the body the hash of the subtree of the container it stands in, by the hashes of its lines, and whether another of the body is around it.

    A container recurs at least as often as the one around it, so the innermost is enough.
    """
    under: dict[int, list[int]] = {}
    for i, x in enumerate(lines):
        for b, _ in x.path:
            under.setdefault(b, []).append(i)
    base = next((x for x in lines if x.tag == "h1"), None)
    around = {b for b, _ in base.path} if base else set()
    made: dict[int, int] = {}
    out: list[tuple[int, bool] | None] = []
    for x, r in zip(lines, roles, strict=True):
        if r == "furniture" or not x.path:
            out.append(None)
            continue
        b = x.path[-1][0]
        if b not in made:
            made[b] = _h("box", " ".join(f"{lines[i].tag}{whole[i]}" for i in under[b]))
        out.append((made[b], b not in around))
    return out


#: Least share of a host's pages, and least pages, that make an element recurring; more is asked of the container of the heading.
SHARE, PAGES = 0.5, 2
HEAD_SHARE, HEAD_PAGES = 0.7, 4


@dataclass(slots=True)
class Hint:
    """What the counts say of a line: its part by its whole text, by its ends, and its recurrence on its host.

    It travels as one number, with the line's: see ``hint_code``.
    """

    known: bool = False
    apart: bool = False  # its text is furniture more often than body
    kind: str = "content"  # content, side, heading, furniture or link
    top: str = ""  # the part its text plays most often
    ends: str = ""
    pages: int = 0  # up to HEAD_PAGES
    share: float = 0.0
    mixed: bool = False  # its text also plays parts other than furniture and link


KINDS = ("content", "side", "heading", "furniture", "link")
_NO_HINT = Hint()


def hint_code(tally: dict[str, Column], known: Column, end: Column, share: Column, pages: Column) -> Column:
    """A hint in 24 bits, from how often the text plays each part, the part its ends are sure of, and its recurrence."""
    t = tally
    rest = sum((t[r] for r in ROLES if r not in ("furniture", "link")), F.lit(0))
    kind = (
        F.when(t["side"] > t["heading"], 1).when(t["heading"] > 0, 2).when(t["furniture"] > rest + t["link"], 3)
        .when((t["link"] > 0) & (t["link"] + t["title"] > t["item"] + t["paragraph"] + t["row"]), 4).otherwise(0)
    )
    most = F.array_max(F.array(*[F.struct(t[r].alias("n"), F.lit(r).alias("r"), F.lit(i).alias("i")) for i, r in enumerate(ROLES)]))["i"]
    at = F.coalesce(F.array_position(F.array(*[F.lit(r) for r in ROLES]), end), F.lit(0))
    by_text = F.when(known, 1 + 2 * (t["furniture"] > rest).cast("int") + 4 * kind + 32 * most).otherwise(F.lit(0))
    return by_text.cast("bigint") + 256 * at.cast("bigint") + 4096 * F.least(pages, F.lit(7)).cast("bigint") + 32768 * F.round(share * 255).cast("bigint") + (1 << 23) * (known & (rest > 0)).cast("bigint")


@lru_cache(1 << 12)
def _hint(code: int) -> Hint:
    known = bool(code & 1)
    end = code >> 8 & 15
    return Hint(known, bool(code & 2), KINDS[code >> 2 & 7], ROLES[code >> 5 & 7] if known else "", ROLES[end - 1] if end else "", code >> 12 & 7, (code >> 15 & 255) / 255, bool(code >> 23 & 1))


def text_body(lines: list[Line], hints: list[Hint]) -> list[int]:
    """The numbers of the lines of the main body of a page without structure."""
    n = len(lines)

    def furniture(i: int) -> bool:
        x, h = lines[i], hints[i]
        if h.known:
            return h.apart
        if h.ends == "furniture" or x.text.count(" | ") >= 2:
            return True
        sentence = x.text.endswith((".", "!", "?"))
        return h.pages >= (HEAD_PAGES if sentence else PAGES) and h.share >= (HEAD_SHARE if sentence else SHARE)

    lo = 0
    while lo < n and (furniture(lo) or (_CRUMB.match(lines[lo].text) and not hints[lo].mixed and len(lines[lo].text) < 120)):
        lo += 1
    hi = n
    while hi > lo and furniture(hi - 1):
        hi -= 1

    def kind(i: int) -> str:
        """content, heading, side, link, furniture or open"""
        x, h = lines[i], hints[i]
        if _BULLET.match(x.text) or "\t" in x.text:
            return "content"
        if h.known:
            return h.kind
        if h.ends in ("link", "furniture"):
            return h.ends
        return "content" if x.text.endswith((".", "!", "?", ":", ";")) or h.ends in ("item", "paragraph", "row") else "open"

    kinds = [kind(i) if lo <= i < hi else "furniture" for i in range(n)]
    out: list[int] = []
    i = lo
    while i < hi:
        k = kinds[i]
        if i == lo:
            out.append(i)  # the title
        elif k == "side":
            j = i + 1
            while j < hi and kinds[j] in ("link", "heading", "open"):
                j += 1
            # headings at the end of the block: links too, unless a list follows, which needs a heading, or the block is full without them
            back = j
            if j < hi and kinds[j - 1] == "heading" and j - 1 > i:
                listed = bool(_BULLET.match(lines[j].text)) or hints[j].ends in ("item", "row") or hints[j].top in ("item", "row")
                size = j - 1 - i
                if (listed and size > 2) or size >= 6:
                    back = j - 1
            i = back
            continue
        elif k != "furniture" and not (k == "link" and hints[i].ends == "link"):
            out.append(i)
        i += 1
    return [lines[i].no for i in out]


def html_body(lines: list[Line], hints: list[Hint], headed: bool = True) -> list[int]:
    rec = [1.0 if "furniture" in (h.ends, h.top) else h.share if h.pages >= PAGES else 0.0 for h in hints]
    roles = html_roles(lines, rec, headed)
    return [x.no for x, r in zip(lines, roles, strict=True) if r not in ("furniture", "side", "link")]


def host_of(url: Column, other: Column) -> Column:
    u = F.lower(F.coalesce(F.when(F.trim(url) != "", url), other))
    h = F.regexp_extract(u, r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.when(h != "", h)


LINE_SCHEMA = "pid bigint, id string, host string, line_no int, role string, h bigint, h_first bigint, h_last bigint, text string, box bigint, nested boolean, first int"
#: Bits of ``first``: the first line of its page, the first there with its hash, the first there in its box.
OF_PAGE, OF_HASH, OF_BOX = 1, 2, 4
#: A page with such an element shows its structure.
HEADED = r"(?i)<h1[\s>]"


#: Rows of a batch turned into Python objects at once, and lines given out at once: they bound what a task holds, beside its largest page.
ROWS, LINES = 64, 8_000


def _rows(b: pa.RecordBatch) -> Iterator[tuple]:
    for i in range(0, b.num_rows, ROWS):
        yield from zip(*(c.to_pylist() for c in b.slice(i, ROWS).columns), strict=True)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with its hashes; in pages that show their structure also its part, and the text if that is the body."""
    names = [c.split()[0] for c in LINE_SCHEMA.split(", ")]
    types = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int32())
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        rows.clear()
        return made

    for b in batches:
        for pid, key, raw, host, org in _rows(b):
            if is_json(raw):
                continue
            is_html, lines = page_lines(raw, notices=True)
            headed = is_html and re.search(HEADED, raw)
            roles = html_roles(lines) if headed else [None] * len(lines)
            said = [hashes(x.text, org or "") for x in lines]
            held = boxes(lines, roles, [h[0] for h in said]) if headed else [None] * len(lines)
            seen: set = {None}
            for x, r, h, at in zip(lines, roles, said, held, strict=True):
                body = headed and r not in ("furniture", "side", "link")
                first = OF_PAGE * (len(seen) == 1) + OF_HASH * (h[0] not in seen) + OF_BOX * (at not in seen)
                seen.add(h[0])
                seen.add(at)
                rows.append((pid, key if body else None, host, x.no, r, *h, x.text if body else None, *(at or (None, None)), first))
            if len(rows) >= LINES:
                yield out()
    if rows:
        yield out()


def _salted(big: DataFrame, small: DataFrame, keys: list[str], n: int = 16) -> DataFrame:
    """Left join whose key values may be hot on the big side: the small side is repeated over ``n`` salts."""
    small = small.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(n)])))
    return big.withColumn("__salt", F.pmod(F.col("pid"), F.lit(n)).cast("int")).join(small, [*keys, "__salt"], "left").drop("__salt")


def _without_recurring(lines: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The lines without the parts that recurring subtrees took, and the pages (pid), if any, whose heading stands in the site's masthead: their lines have no part yet."""
    often = lines.where(f"host is not null and box is not null and first & {OF_BOX} <> 0").groupBy("host", "box", "nested").agg(F.count("*").alias("on_pages")).where(F.col("on_pages") >= F.when(F.col("nested"), PAGES).otherwise(HEAD_PAGES)).join(sizes, "host")
    often = cut_lineage(often.where(F.col("on_pages") >= F.when(F.col("nested"), SHARE).otherwise(HEAD_SHARE) * F.col("host_pages")).select("host", "box", "nested"))
    kinds = {r[0] for r in often.select("nested").distinct().collect()}
    masthead = None
    if False in kinds:
        once = lines.where(f"not nested and host is not null and first & {OF_BOX} <> 0")
        hit = _salted(once, often.where("not nested").select("host", "box", F.lit(True).alias("hit")), ["host", "box"])
        masthead = cut_lineage(hit.where("hit").select("pid").distinct())
        x = lines.join(masthead.withColumn("m", F.lit(True)), "pid", "left")
        null = {c: F.when(F.col("m").isNull(), F.col(c)) for c in ("id", "role", "text", "box", "nested")}
        lines = cut_lineage(x.withColumns(null).select(*lines.columns))
    if True in kinds:  # only lines of nested containers can be taken
        inner = F.coalesce(F.col("nested") & F.col("host").isNotNull() & F.col("box").isNotNull(), F.lit(False))
        x = _salted(lines.where(inner), often.where("nested").select("host", "box", F.lit(True).alias("hit")), ["host", "box"])
        hit = F.coalesce("hit", F.lit(False))
        x = x.withColumns({"role": F.when(hit, "furniture").otherwise(F.col("role")), "text": F.when(~hit, F.col("text"))})
        lines = lines.where(~inner).unionByName(cut_lineage(x.select(*lines.columns)))
    return lines, masthead


def main_lines(pages: DataFrame, id_: str, raw: str, host: Column, organisation: str, least: int = 3, pure: float = 0.97) -> DataFrame:
    """(id, line_no, text) of the lines of each page's main body; a repeated row counts once."""
    every = (
        pages.select(F.col(id_).cast("string").alias("id"), F.col(raw).alias("raw"), host.alias("host"), F.lower(F.trim(F.col(organisation))).alias("org"))
        .where("id is not null and raw is not null and raw <> ''")
        .select(F.xxhash64("id", "raw").alias("pid"), "*")
    )
    src = every.dropDuplicates(["pid"])
    # read many times, a few columns each: kept in columns beside the checkpoint it can be made from again
    lines = first = cut_lineage(spread(src.select("pid", "id", "raw", "host", "org")).mapInArrow(_parse, LINE_SCHEMA)).persist(StorageLevel.MEMORY_AND_DISK)

    sizes = lines.where(f"host is not null and first & {OF_PAGE} <> 0").groupBy("host").agg(F.count("*").alias("host_pages"))
    lines, masthead = _without_recurring(lines, sizes)

    tally = [F.count_if(F.col("role") == r).alias(r) for r in ROLES]
    known = lines.where("role is not null")
    whole = known.groupBy("h").agg(*tally).where(F.expr("+".join(ROLES)) >= least)
    ends = known.select("role", F.explode(F.array("h_first", "h_last")).alias("h")).where("h <> 0").groupBy("h").agg(*tally).withColumn("n", F.expr("+".join(ROLES)))
    best = F.array_max(F.array(*[F.struct(F.col(r).alias("n"), F.lit(r).alias("role")) for r in ROLES]))
    ends = ends.where(F.col("n") >= 5 * least).withColumn("b", best).where(F.col("b.n") >= pure * F.col("n")).select("h", F.col("b.role").alias("end"))
    recurs = lines.where(f"host is not null and first & {OF_HASH} <> 0").groupBy("host", "h").agg(F.count("*").alias("on_pages")).where(F.col("on_pages") >= PAGES).join(sizes, "host")
    recurs = recurs.where(F.col("on_pages") >= SHARE * F.col("host_pages")).select("host", "h", "on_pages", (F.col("on_pages") / F.col("host_pages")).alias("share"))

    # only lines of pages without structure need what the counts say, and of them only those whose text is unknown need more than that
    none, zero = F.lit(None).cast("string"), F.lit(0)
    tallies, no_tally = {r: F.coalesce(r, zero) for r in ROLES}, dict.fromkeys(ROLES, zero)
    x = _salted(lines.where("role is null").select("pid", "host", "line_no", "h", "h_first", "h_last"), whole, ["h"])
    x = x.withColumn("code", F.when(F.col(ROLES[0]).isNotNull(), hint_code(tallies, F.lit(True), none, F.lit(0.0), zero)))
    x = cut_lineage(x.select("pid", "host", "line_no", "h", "h_first", "h_last", "code"))
    y = _salted(x.where("code is null").drop("code"), ends.withColumnsRenamed({"h": "h_first", "end": "end_first"}), ["h_first"])
    y = _salted(y, ends.withColumnsRenamed({"h": "h_last", "end": "end_last"}), ["h_last"])
    y = _salted(y, recurs, ["host", "h"])
    unknown = hint_code(no_tally, F.lit(False), F.coalesce("end_first", "end_last"), F.coalesce("share", F.lit(0.0)), F.coalesce("on_pages", zero))
    coded = x.where("code is not null").select("pid", "line_no", "code").unionByName(y.select("pid", "line_no", unknown.alias("code")))
    hints = coded.groupBy("pid").agg(F.collect_list(F.shiftleft(F.col("line_no").cast("bigint"), 24) + F.col("code")).alias("hints"))  # as many as the page has lines
    plain = ~F.col("raw").rlike(HEADED)
    if masthead is None:
        pages_left = every.where(plain)
    else:
        pages_left = every.join(masthead.withColumn("m", F.lit(True)), "pid", "left").where(plain | F.col("m"))
    pages_left = pages_left.select("pid", "id", "raw").dropDuplicates(["pid"]).join(hints, "pid")
    out = cut_lineage(lines.where("text is not null").select("id", "line_no", "text").unionByName(pages_left.select("id", "raw", "hints").mapInArrow(_label, "id string, line_no int, text string")))
    first.unpersist()
    return out


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.string()), strict=True)], ["id", "line_no", "text"])
        out.clear()
        return b

    for b in batches:
        for key, raw, said in _rows(b):
            is_html, lines = page_lines(raw)
            by = {c >> 24: _hint(c & 0xFFFFFF) for c in said}
            hints = [by.get(x.no, _NO_HINT) for x in lines]
            body = set(html_body(lines, hints, headed=False) if is_html else text_body(lines, hints))
            out += [(key, x.no, x.text) for x in lines if x.no in body]
            if len(out) >= LINES:
                yield made()
    if out:
        yield made()
