"""Keyword search over pages: whole words, any case, any diacritics, one row an occurrence.

A keyword can only stand where its first run of word characters is a word of
the page, so pages meet keywords in an equi-join on that word and the keyword's
pattern runs only there. A list of at most ``BROADCAST_KEYWORDS`` (checked) is
broadcast; a longer one is joined by shuffle with the pages' words alone, and the
pages' texts are joined to the pairs that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.config import DEFAULTS
from archivolt.functions.text import fold, strip

#: Most keywords that are broadcast.
BROADCAST_KEYWORDS = 10_000


def load_keywords(raw: DataFrame, column: str = "keyword", order: str | None = "ord") -> DataFrame:
    """``ord, keyword``: lower case, ends stripped, blanks dropped, repeats and order kept. Nulls are dropped."""
    ready = raw.select((F.col(order) if order else F.monotonically_increasing_id()).alias("ord"), F.lower(strip(F.col(column))).alias("keyword"))
    return ready.where("keyword <> ''")


def to_pages(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents to pages: one row for each part between form feeds, numbered from 1."""
    parts = F.posexplode(F.split(text, "\f"))
    return documents.select("folder", "filename", parts.alias("_pos", "text")).select("folder", "filename", (F.col("_pos") + 1).alias("page"), "text")


_WORD = r"(?U)\w+"


def _whole_word(keyword: Column) -> Column:
    quoted = F.replace(keyword, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit(r"(?U)\b\Q"), quoted, F.lit(r"\E\b"))


def keyword_hits(pages: DataFrame, keywords: DataFrame, context_chars: int = DEFAULTS.context_chars) -> DataFrame:
    """``folder, filename, page, keyword, ord, hit, start, context`` of every occurrence.

    ``start`` counts characters of the folded page from 0; on texts in composed form it is the
    offset in the original, from which the context is cut. Overlapping hits of different
    keywords all count; hits of one keyword don't overlap. A keyword without word
    characters at its ends matches only where a word character touches it.
    """
    listed = keywords.select("ord", "keyword", fold(F.col("keyword")).alias("_key"))
    listed = listed.withColumn("_word", F.regexp_extract("_key", _WORD, 0))
    folded = pages.select("folder", "filename", "page", "text", fold(F.col("text")).alias("_folded"))
    # the empty word is on every page: it stands for keywords without any word character
    words = F.explode(F.array_append(F.array_distinct(F.regexp_extract_all("_folded", F.lit(_WORD), F.lit(0))), F.lit(""))).alias("_word")
    if keywords.limit(BROADCAST_KEYWORDS + 1).count() <= BROADCAST_KEYWORDS:
        near = folded.select("*", words).join(F.broadcast(listed), "_word")
    else:
        page = ["folder", "filename", "page", "_text"]
        marked = folded.withColumn("_text", F.xxhash64("text"))
        pairs = marked.select(*page, words).join(listed, "_word").distinct()
        near = marked.join(pairs, page)
    parts = near.withColumn("_parts", F.split("_folded", _whole_word(F.col("_key")), -1)).where(F.size("_parts") > 1)
    step = F.length("_key")
    # running offsets: each hit begins where the parts and keywords before it end
    starts = F.aggregate(
        F.slice("_parts", 1, F.size("_parts") - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, part: F.struct((acc["at"] + F.length(part) + step).alias("at"), F.array_append(acc["all"], acc["at"] + F.length(part)).alias("all")),
        lambda acc: acc["all"],
    )
    hits = parts.select("folder", "filename", "page", "keyword", "ord", "text", step.alias("_step"), F.posexplode(starts).alias("hit", "start"))
    lo = F.greatest(F.lit(0), F.col("start") - context_chars)
    hi = F.least(F.length("text"), F.col("start") + F.col("_step") + context_chars)
    cut = strip(F.replace(F.substring(F.col("text"), lo + 1, hi - lo), F.lit("\n"), F.lit(" ")))
    context = F.concat(F.when(lo > 0, "...").otherwise(""), cut, F.when(hi < F.length("text"), "...").otherwise(""))
    return hits.select("folder", "filename", "page", "keyword", "ord", "hit", "start", context.alias("context"))


def needs_ocr(pages: DataFrame, per_page: int = DEFAULTS.text_chars_per_page) -> DataFrame:
    """``pages`` (``filename, pages array<string>``) with ``needs_ocr``: too little text a page, or no page."""
    chars = F.aggregate("pages", F.lit(0), lambda acc, p: acc + F.length(strip(F.coalesce(p, F.lit("")))))
    enough = (F.size("pages") > 0) & (chars > per_page * F.size("pages"))
    return pages.withColumn("needs_ocr", F.col("pages").isNull() | ~enough)


def hits_by(hits: DataFrame, column: str) -> DataFrame:
    return hits.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def hits_breakdown(hits: DataFrame) -> DataFrame:
    """Counts by keyword and by folder in one pass (grouping sets)."""
    return hits.groupingSets([["keyword"], ["folder"]], "keyword", "folder").agg(F.count("*").alias("n"))


def file_keywords(hits: DataFrame) -> DataFrame:
    """``filename, keywords``: the distinct keywords of each file, sorted, joined by a comma and a blank."""
    return hits.groupBy("filename").agg(F.array_join(F.array_sort(F.collect_set("keyword")), ", ").alias("keywords"))


def scan_totals(hits: DataFrame, files: DataFrame) -> DataFrame:
    """One row: matches, files scanned, files with a match."""
    found = hits.agg(F.lit(1).alias("_one"), F.count("*").alias("matches"), F.count_distinct("folder", "filename").alias("files_matched"))
    return found.join(files.agg(F.lit(1).alias("_one"), F.count_distinct("folder", "filename").alias("files")), "_one").drop("_one")


def matched_files(hits: DataFrame, listing: DataFrame) -> DataFrame:
    """Each listed file with a hit, once, and the name of its copy."""
    once = hits.select("folder", "filename").distinct()
    return once.join(listing.select("folder", "filename").distinct(), ["folder", "filename"], "left_semi").withColumn("target", F.concat_ws("_", "folder", "filename"))


def summary_rows(hits: DataFrame) -> DataFrame:
    """``Filename, Keywords``: the rows of the summary file."""
    return file_keywords(hits).select(F.col("filename").alias("Filename"), F.col("keywords").alias("Keywords"))


def first_errors(files: DataFrame, k: int = 10) -> DataFrame:
    """``path, error`` of the first k files that could not be read, by path; ``error`` is null for the others."""
    return files.where("error is not null").select("path", "error").orderBy("path").limit(k)


def recent_matches(hits: DataFrame, order: list[Column], k: int = 10) -> DataFrame:
    """The last k matches, newest first: a top-k, so no full sort."""
    return hits.orderBy(*[c.desc() for c in order]).limit(k)
