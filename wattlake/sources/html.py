"""Facts of HTML pages and Markdown of HTML fragments: the one place of the core where Python reads rows, over Arrow batches.

A page is read once by a tolerant parser; what a page says in words (amounts, contacts, dates) is told from
its text by native columns. Null and empty pages give no row; pages may be of any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattlake.functions import amounts, contacts, dates, labels
from wattlake.functions.text import strip

_SKIP = frozenset(("script", "style", "noscript", "template"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FACTS = "id string, title string, paragraphs array<string>, links array<struct<href:string,text:string>>, image string, text string"
# Words of links that lead to an application.
APPLY_WORDS = ("apply", "application", "submit", "enroll", "sign up")


def _tidy(text: str) -> str:
    return " ".join(text.split())


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.first: dict[str, str] = {}
        self.open: dict[str, list[str]] = {}
        self.meta: dict[str, str] = {}
        self.images: list[str] = []
        self.links: list[dict] = []
        self.paragraphs: list[str] = []
        self.words: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.setdefault(a.get("property") or a.get("name") or "", a.get("content", ""))
        elif tag == "img":
            self.images.append(a.get("src", ""))
        elif tag == "a":
            self.links.append({"href": a.get("href", ""), "text": ""})
        if tag not in _VOID:
            self.stack.append(tag)
            if tag in ("h1", "title", "p"):
                self.open[tag] = []

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.stack:
            return
        while (top := self.stack.pop()) != tag:
            self._done(top)
        self._done(tag)

    def _done(self, tag: str) -> None:
        if tag in self.open:
            text = _tidy("".join(self.open.pop(tag)))
            if tag == "p":
                self.paragraphs += [text] if text else []
            elif text:
                self.first.setdefault(tag, text)

    def handle_data(self, data: str) -> None:
        if any(t in _SKIP for t in self.stack):
            return
        for parts in self.open.values():
            parts.append(data)
        if "a" in self.stack and self.links:
            self.links[-1]["text"] = _tidy(f"{self.links[-1]['text']} {data}")
        if "title" not in self.stack:
            self.words.append(data)


def read_page(html: str) -> tuple[str | None, list[str], list[dict], str, str]:
    """(title, paragraphs, links, image, text): the first heading, else the title without what follows a bar or dash; the image that the page names for itself, else its first real one."""
    r = _Reader()
    r.feed(html)
    r.close()
    title = r.first.get("h1") or re.split(r"\s*\|| [-–] ", r.first.get("title", ""))[0].strip()
    real = [s for s in r.images if s and not any(w in s.lower() for w in labels.NO_IMAGE)]
    image = r.meta.get("og:image") or r.meta.get("twitter:image") or (real[0] if real else "")
    return title or None, r.paragraphs, r.links, image, _tidy(" ".join(r.words))


def page_facts(rows: DataFrame, id_: str, html: str) -> DataFrame:
    """(id, title, paragraphs, links, image, text) of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                s = b.slice(lo, 64)
                got = [read_page(x) for x in s.column(1).to_pylist()]
                kinds = (pa.string(), pa.list_(pa.string()), pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())])), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([s.column(0), *(pa.array([g[i] for g in got], t) for i, t in enumerate(kinds))], ["id", "title", "paragraphs", "links", "image", "text"])

    d = rows.select(F.col(id_).cast("string").alias("id"), F.col(html).alias("html")).where("html <> ''")
    return d.mapInArrow(run, FACTS)


def program_pages(facts: DataFrame) -> DataFrame:
    """Programs told from the facts of pages; pages whose title is no program's are left out.

    The amount is the first that stands in a context of offers; a page that lists several has none of its own.
    """
    t = F.col("text")
    amount = amounts.settle_hub(amounts.parse_amount_in_context(t), t)
    apply = F.filter("links", lambda x: labels.any_word(x["text"], APPLY_WORDS))
    about = F.filter("paragraphs", lambda p: (F.octet_length(p) >= 60) & ~labels.any_word(p, labels.NO_PARAGRAPH))
    d = facts.where((F.octet_length(strip(F.col("title"))) >= 5) & ~labels.any_word(F.col("title"), labels.NO_TITLE)).select("*", amount.alias("__a"))
    return d.select(
        "id",
        F.col("title").alias("program_name"),
        F.array_join(F.slice(about, 1, 8), "\n\n").alias("incentive_description"),
        F.col("__a.format").alias("incentive_format"),
        F.col("__a.amount").alias("incentive_amount"),
        F.get(apply, F.lit(0))["href"].alias("application_url"),
        F.when(F.col("image") != "", F.col("image")).alias("image_url"),
        contacts.email(t).alias("contact_email"),
        contacts.phone(t).alias("contact_phone"),
        contacts.says(t, contacts.CONTRACTOR).alias("contractor_required"),
        contacts.says(t, contacts.AUDIT).alias("energy_audit_required"),
        labels.groups_of(F.col("title"), t).alias("customer_type"),
        dates.date_in_text(t, dates.START).alias("start_date"),
        dates.date_in_text(t, dates.END).alias("end_date"),
    )


class _Writer(HTMLParser):
    """Markdown of headings, paragraphs, lists, links and stress; images and hidden parts are dropped."""

    STRESS = {"b": "**", "strong": "**", "i": "*", "em": "*"}  # noqa: RUF012

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.stack: list[tuple[str, str]] = []
        self.lists: list[int] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.out.append("\n")
        if tag in _VOID:
            return
        self.stack.append((tag, dict(attrs).get("href") or ""))
        if re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "table", "blockquote"):
            self.out.append("\n\n")
        elif tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ol" else -1)
            self.out.append("\n")
        elif tag == "li":
            n = self.lists[-1] if self.lists else -1
            if n >= 0:
                self.lists[-1] = n + 1
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + (f"{n + 1}. " if n >= 0 else "- "))
        elif tag == "tr":
            self.out.append("\n")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag in self.STRESS:
            self.out.append(self.STRESS[tag])
        elif tag == "a":
            self.out.append("[")

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _ in self.stack):
            return
        while True:
            top, href = self.stack.pop()
            if top in self.STRESS:
                self.out.append(self.STRESS[top])
            elif top == "a":
                self.out.append(f"]({href})" if href else "]")
            elif top in ("ul", "ol"):
                self.lists.pop()
                self.out.append("\n")
            elif top in ("p", "div", "table", "blockquote") or re.fullmatch("h[1-6]", top):
                self.out.append("\n\n")
            if top == tag:
                return

    def handle_data(self, data: str) -> None:
        if not any(t in _SKIP for t, _ in self.stack):
            self.out.append(re.sub(r"\s+", " ", data))


def to_markdown(html: str) -> str:
    w = _Writer()
    w.feed(html)
    w.close()
    text = re.sub(r"[ \t]*\n[ \t]*(?=\n)|[ \t]+(?=\n)", "\n", "".join(w.out))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"(?<=\n) (?=\S)", "", text)).strip()


def markdown(rows: DataFrame, id_: str, html: str) -> DataFrame:
    """(id, markdown) of each row with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to_markdown(x) for x in b.column(1).to_pylist()], pa.string())], ["id", "markdown"])

    return rows.select(F.col(id_).cast("string").alias("id"), F.col(html).alias("html")).where("html <> ''").mapInArrow(run, "id string, markdown string")
