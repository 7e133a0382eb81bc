import re
import unicodedata

from archivolt.operators import search


def fold(s):
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn").lower()


def model(pages, keywords, width=50):
    """Independent model: one row an occurrence with its context."""
    out = []
    for folder, name, page, text in pages:
        if text is None:
            continue
        for ord_, kw in keywords:
            for m in re.finditer(r"\b" + re.escape(fold(kw)) + r"\b", fold(text)):
                lo, hi = max(0, m.start() - width), min(len(text), m.end() + width)
                cut = text[lo:hi].replace("\n", " ").strip()
                out.append((folder, name, page, kw, ord_, m.start(), ("..." if lo else "") + cut + ("..." if hi < len(text) else "")))
    return sorted(out)


PAGES = [
    ("DS-1", "a.pdf", 1, "Timișoara and a paradigm of cluj-napoca. " + "x" * 120 + "\nARAD, arad"),
    ("DS-1", "a.pdf", 2, " +40 and a+40 and \U0001f600 arad " * 3),
    ("DS-2", "b.pdf", 1, None),
    ("DS-2", "c.pdf", 1, ""),
    ("DS-2", "d.pdf", 1, "arad " * 4000),
]
KEYWORDS = [(1, "timisoara"), (2, "arad"), (3, "cluj"), (4, "cluj-napoca"), (5, "+40"), (6, "arad"), (7, "a\\Eb")]


def test_hits_against_model(spark):
    pages = spark.createDataFrame(PAGES, "folder string, filename string, page int, text string").selectExpr("*", "'z' AS hit")
    hits = search.keyword_hits(pages, spark.createDataFrame(KEYWORDS, "ord int, keyword string"))
    got = sorted((r.folder, r.filename, r.page, r.keyword, r.ord, r.start, r.context) for r in hits.collect())
    assert got == model(PAGES, KEYWORDS)


def test_empty_inputs(spark):
    pages = spark.createDataFrame([], "folder string, filename string, page int, text string")
    keywords = spark.createDataFrame(KEYWORDS, "ord int, keyword string")
    assert search.keyword_hits(pages, keywords).count() == 0
    full = spark.createDataFrame(PAGES, pages.schema)
    assert search.keyword_hits(full, keywords.limit(0)).count() == 0


def test_keywords_keep_order_and_repeats(spark):
    raw = spark.createDataFrame([(1, " B\t"), (2, "  "), (3, None), (4, "b")], "ord int, keyword string")
    assert [tuple(r) for r in search.load_keywords(raw).orderBy("ord").collect()] == [(1, "b"), (4, "b")]


def test_needs_ocr(spark):
    rows = [("at", ["x" * 50, "y" * 50]), ("over", ["x" * 51, " y" + "y" * 49]), ("none", []), ("null", None), ("hole", [None, "z" * 200])]
    got = {r.filename: r.needs_ocr for r in search.needs_ocr(spark.createDataFrame(rows, "filename string, pages array<string>")).collect()}
    assert got == {"at": True, "over": False, "none": True, "null": True, "hole": False}


def test_breakdowns(spark):
    hits = spark.createDataFrame([("F", "f", "b"), ("F", "f", "a"), ("F", "f", "b"), ("G", "g", "c")], "folder string, filename string, keyword string")
    assert {r.filename: r.keywords for r in search.file_keywords(hits).collect()} == {"f": "a, b", "g": "c"}
    assert sorted((r.keyword or "", r.folder or "", r.n) for r in search.hits_breakdown(hits).collect()) == [("", "F", 3), ("", "G", 1), ("a", "", 1), ("b", "", 2), ("c", "", 1)]
    files = spark.createDataFrame([("F", "f"), ("F", "h"), ("F", "f")], "folder string, filename string")
    assert [(r.filename, r.target) for r in search.matched_files(hits, files).collect()] == [("f", "F_f")]
    assert search.scan_totals(hits, files).collect()[0].asDict() == {"matches": 4, "files_matched": 2, "files": 2}
