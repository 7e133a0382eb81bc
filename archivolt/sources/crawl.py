"""Stored result pages of a search site: parsing, paging, dedup, downloads.

The engine starts at stored HTML and stored responses; it opens no browser and
passes no gate.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.config import DEFAULTS
from archivolt.functions.text import strip

_ITEM = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("pdf_url", "filename", "heading", "context")]))


class _Results(HTMLParser):
    """Items of a result page: a link inside an h3, and an excerpt paragraph."""

    def __init__(self) -> None:
        super().__init__()
        self.items: list[dict[str, str]] = []
        self.depth = 0
        self.open: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if "result-item" in classes:
            self.items.append({})
        if not self.items:
            return
        if tag == "h3":
            self.open.append("heading")
            self.items[-1].setdefault("heading", "")
        elif tag == "a" and "heading" in self.open and "pdf_url" not in self.items[-1]:
            self.items[-1]["pdf_url"] = a.get("href", "")
            self.items[-1]["filename"] = ""
            self.open.append("filename")
        elif tag == "p" and "result-excerpt" in classes:
            self.items[-1]["context"] = ""
            self.open.append("context")

    def handle_endtag(self, tag: str) -> None:
        name = {"h3": "heading", "a": "filename", "p": "context"}.get(tag)
        if name in self.open:
            self.open.remove(name)

    def handle_data(self, data: str) -> None:
        for name in self.open:
            self.items[-1][name] += data


@F.pandas_udf(_ITEM)
def html_items(html: pd.Series) -> pd.Series:
    """Items of each page; an item without a link is left out, one without an excerpt has an empty context."""
    out = []
    for page in html:
        parser = _Results()
        parser.feed(page or "")
        out.append([{"pdf_url": i["pdf_url"], "filename": i["filename"].strip(), "heading": i.get("heading", "").strip(), "context": i.get("context", "").strip()} for i in parser.items if "pdf_url" in i])
    return pd.Series(out)


def folder_of_heading(heading: Column) -> Column:
    n = F.regexp_extract(heading, r"(?U)DataSet\s+(\d+)", 1)
    return F.when(n != "", F.concat(F.lit("DS-"), n)).otherwise("Unknown")


def crawl_hits(pages: DataFrame) -> DataFrame:
    """Stored pages (``keyword, page, html``) to ``folder, keyword, filename, page, pos, context, pdf_url``."""
    items = pages.select("keyword", "page", F.posexplode(html_items("html")).alias("pos", "i"))
    return items.select(folder_of_heading(F.col("i.heading")).alias("folder"), "keyword", "i.filename", "page", "pos", "i.context", "i.pdf_url")


def result_counts(label: Column, items: Column) -> tuple[Column, Column]:
    """(results, pages) from a label such as ``Showing 1 to 10 of 23 Results``; without one the items on the page and one page."""
    total = F.nullif(F.regexp_extract(label, r"(?U)of\s+(\d+)\s+Results", 1), F.lit("")).try_cast("bigint")
    lo = F.nullif(F.regexp_extract(label, r"(?U)Showing\s+(\d+)\s+to\s+(\d+)", 1), F.lit("")).try_cast("bigint")
    hi = F.nullif(F.regexp_extract(label, r"(?U)Showing\s+(\d+)\s+to\s+(\d+)", 2), F.lit("")).try_cast("bigint")
    size = F.coalesce(hi - lo + 1, F.lit(10))
    pages = F.when(total.isNotNull(), F.floor((total + size - 1) / F.nullif(size, F.lit(0)))).when(items > 0, 1).otherwise(0)
    return F.coalesce(total, F.greatest(items, F.lit(0)).cast("bigint")), pages.cast("bigint")


def crawl_dedup(hits: DataFrame, order: list[str]) -> DataFrame:
    """The first hit of each keyword and file name across pages, in the given order; one value a key survives the shuffle."""
    rest = [c for c in hits.columns if c not in ("keyword", "filename")]
    return hits.groupBy("keyword", "filename").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("h")).select("keyword", "filename", "h.*")


def pdf_bytes(data_url: Column) -> Column:
    """The bytes of a base64 data URL if they are a PDF, else null."""
    raw = F.try_to_binary(F.element_at(F.split(data_url, ",", 2), 2), F.lit("base64"))
    return F.when(F.startswith(raw, F.lit("%PDF").cast("binary")), raw)


def download_plan(hits: DataFrame, existing: DataFrame) -> DataFrame:
    """``filename, pdf_url, status``: each wanted file once, ``skipped`` if it is there already, else ``wanted``."""
    once = hits.groupBy("filename").agg(F.min("pdf_url").alias("pdf_url"))
    return once.join(existing.select("filename").distinct().withColumn("_there", F.lit(True)), "filename", "left").select("filename", "pdf_url", F.when(F.col("_there"), "skipped").otherwise("wanted").alias("status"))


def retry_schedule(attempts: int = DEFAULTS.max_attempts, base: float = DEFAULTS.retry_base_seconds) -> list[float]:
    """Seconds to wait after each failed attempt but the last."""
    return [base * 2**k for k in range(attempts - 1)]


def download_counts(outcomes: DataFrame) -> DataFrame:
    """One row: downloaded, skipped, failed."""
    return outcomes.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("downloaded", "skipped", "failed")))


def keyword_page_totals(hits: DataFrame) -> DataFrame:
    """Hits and result pages seen a keyword."""
    return hits.groupBy("keyword").agg(F.count("*").alias("hits"), F.count_distinct("page").alias("pages"), F.max("page").alias("last_page"))
