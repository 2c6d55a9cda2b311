"""Fields from landed pages and links, by built-in functions where one value is wanted and the standard parser where structure is."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_markup(html: Column) -> Column:
    """A page without scripts, styles, frames and link tags."""
    return F.regexp_replace(html, r"(?is)<(script|style|iframe)\b.*?</\1\s*>|<link\b[^>]*>", "")


def page_text(html: Column) -> Column:
    """The visible text of a page, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(strip_markup(html), r"(?s)<[^>]*>", " "), r"\s+", " "))


def linked_data(html: Column, kind: str | None = None) -> Column:
    """The first JSON-LD block of a page (of ``@type`` kind) as JSON text; blocks that are no JSON are skipped."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    good = F.filter(blocks, lambda b: F.try_parse_json(b).isNotNull())
    if kind:
        good = F.filter(good, lambda b: F.get_json_object(b, "$.@type") == kind)
    return F.trim(F.get(good, F.lit(0)))


def labelled(text: Column, label: str) -> Column:
    """What stands behind "Label:" on its line; null where it is missing, blank or says that it is not available."""
    value = F.trim(F.regexp_extract(text, rf"(?im)^\s*{label}\s*:\s*(.+?)\s*$", 1))
    return F.when(~F.lower(value).isin("", "not available", "none reported"), value)


def profile_number(url: Column) -> Column:
    """The trailing number of ".../name-123.html"; null if there is none."""
    return F.nullif(F.regexp_extract(url, r"-(\d+)\.html", 1), F.lit(""))


def place_id(text: Column) -> Column:
    """A place id anywhere in a text or map link; null if there is none."""
    direct, parameter = F.regexp_extract(text, r"(ChIJ[A-Za-z0-9_-]{22,})", 1), F.regexp_extract(text, r"!1s([^!&?]+)", 1)
    return F.coalesce(F.nullif(direct, F.lit("")), F.nullif(parameter, F.lit("")))


def bar_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?i)State Bar\s*#\s*([0-9]{4,})", 1), F.lit(""))


def admission_year(text: Column) -> Column:
    """The year of a date near "admitted", else the first year from 1900 to 2099; null if there is none."""
    near = F.regexp_extract(text, r"(?is)admitted.{0,40}?\b((?:19|20)\d{2})\b", 1)
    anywhere = F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1)
    return F.coalesce(F.nullif(near, F.lit("")), F.nullif(anywhere, F.lit(""))).cast("int")


def total_pages(text: Column, size: int) -> Column:
    """Pages of ``size`` entries from "of N entries"; 1 if there is no such text."""
    n = F.replace(F.regexp_extract(text, r"(?i)of\s+([\d,]+)\s+entries", 1), F.lit(","), F.lit(""))
    return F.coalesce(F.ceil(F.nullif(n, F.lit("")).cast("int") / size), F.lit(1)).cast("int")


def listing_links(links: Column) -> Column:
    """map<number, link> of profile links, the first link of a number kept, queries and fragments cut."""
    clean = F.transform(links, lambda u: F.regexp_replace(u, "[?#].*$", ""))
    pairs = F.transform(F.filter(clean, lambda u: u.rlike(r"-\d+\.html$")), lambda u: F.struct(F.regexp_extract(u, r"-(\d+)\.html", 1).alias("key"), u.alias("value")))
    start = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    return F.aggregate(pairs, start, lambda m, p: F.when(F.map_contains_key(m, p["key"]), m).otherwise(F.map_concat(m, F.map_from_entries(F.array(p)))))


def definition_list(html: Column) -> Column:
    """map<term, text> of <dt> and <dd> by position; terms without a colon at the end, tags cut."""
    plain = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", " "), r"\s+", " "))
    terms = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<dt[^>]*>(.*?)</dt>"), F.lit(1)), lambda x: F.regexp_replace(plain(x), r"\s*:$", ""))
    texts = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<dd[^>]*>(.*?)</dd>"), F.lit(1)), plain)
    n = F.least(F.size(terms), F.size(texts))
    return F.map_from_arrays(F.slice(terms, F.lit(1), n), F.slice(texts, F.lit(1), n))


class _Tables(HTMLParser):
    """Cells of every table of a page; (id, class, rows) each."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[tuple[str, str, list[list[str]]]] = []
        self._open: list[int] = []
        self._cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        found = dict(attrs)
        if tag == "table":
            self.tables.append((found.get("id") or "", found.get("class") or "", []))
            self._open.append(len(self.tables) - 1)
        elif tag == "tr" and self._open:
            self.tables[self._open[-1]][2].append([])
        elif tag in ("td", "th") and self._open:
            self._cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self._cell is not None and self._open:
            rows = self.tables[self._open[-1]][2]
            if not rows:
                rows.append([])
            rows[-1].append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag == "table" and self._open:
            self._open.pop()

    def handle_data(self, data: str) -> None:
        if self._cell is not None:
            self._cell.append(data)


def listing_rows(pages: DataFrame, columns: list[str], marks: list[str]) -> DataFrame:
    """(page_id, row, columns...): the body rows of the listing table of each page ``pages(page_id, html)``.

    It is the first table whose id or class holds one of ``marks`` in their order, else the largest one; its first row is the header, and
    rows with fewer cells than ``columns`` are skipped. Null and broken pages give no rows.
    """
    schema = "page_id long, row int, " + ", ".join(f"`{c}` string" for c in columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, html in zip(batch.page_id, batch.html):
                parser = _Tables()
                parser.feed(html or "")
                chosen = next((t for mark in marks for t in parser.tables if mark in t[0] or mark in t[1]), None) or max(parser.tables, key=lambda t: len(t[2]), default=None)
                for i, cells in enumerate((chosen[2] if chosen else [])[1:]):
                    if len(cells) >= len(columns):
                        out.append((page, i, *cells[: len(columns)]))
            yield pd.DataFrame(out, columns=["page_id", "row", *columns])

    return pages.select("page_id", "html").mapInPandas(run, schema)
