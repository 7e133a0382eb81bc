import base64

from pyspark.sql import functions as F

from archivolt.operators import render, threads
from archivolt.sources import crawl, files
from archivolt.streaming.scan import stream_keyword_hits

MAIL = "To: Ann Lee <ann@x.org>\nFrom: Bo <bo@x.org>\nSent: Thu, Dec 18, 2008 2:02 PM\nSubject: Re: boats\n\nThe boats are in.\n\nOn Thu, Dec 18, 2008 at 12:17 PM, Ann Lee <ann@x.org> wrote:\n\n> Where are the boats now?\n> Ann\n-- \nsig\n"


def test_two_messages(spark):
    df = spark.createDataFrame([("m.pdf", MAIL), ("n.pdf", None), ("o.pdf", ""), ("p.pdf", "short"), ("q.pdf", "From: x\n\nsix666")], "filename string, text string")
    got = {(r.filename, r.msg_idx): r for r in threads.messages(df).collect()}
    assert set(got) == {("m.pdf", 0), ("m.pdf", 1), ("q.pdf", 0)}
    main, quoted = got["m.pdf", 0], got["m.pdf", 1]
    assert (main.sender, main.recipient, main.subject, main.body) == ("Bo <bo@x.org>", "Ann Lee <ann@x.org>", "Re: boats", "The boats are in.")
    assert str(main.date) == "2008-12-18 14:02:00"
    assert quoted.sender == '"Ann Lee" <ann@x.org>' and quoted.recipient == "Bo <bo@x.org>" and quoted.body.startswith("Where are the boats now?")
    assert str(quoted.date) == "2008-12-18 12:17:00"


def test_simple_marker(spark):
    texts = ["a\nSent from my iPhone\nb", "no quote", "----- Original Message -----\nx", MAIL]
    rows = threads.with_quote_boundary(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t").orderBy("i").collect()
    assert [(r.offset, r.attributed) for r in rows] == [(2, False), (8, False), (0, False), (MAIL.index("On Thu"), True)]


def test_counts(spark):
    rows = [("Showing 1 to 10 of 23 Results", 10), ("of 23 Results", 10), ("", 4), (None, 0)]
    results, pages = crawl.result_counts(F.col("label"), F.col("n"))
    got = spark.createDataFrame(rows, "label string, n int").select(results, pages).collect()
    assert [tuple(r) for r in got] == [(23, 3), (23, 3), (4, 1), (0, 0)]


def test_pdf_bytes(column):
    url = lambda b: "data:application/pdf;base64," + base64.b64encode(b).decode()
    got = column(crawl.pdf_bytes, [url(b"%PDF-1.7"), url(b"<html>"), "no comma", None, "x,***"])
    assert [None if x is None else bytes(x) for x in got] == [b"%PDF-1.7", None, None, None, None]


def test_html(spark):
    page = '<div class="result-item"><h3><a href="u1"> f1.pdf </a> - DataSet 11</h3><p class="result-excerpt">a &amp; b</p></div><div class="result-item"><h3>no link</h3></div><div class="result-item"><h3><a href="u2">f2.pdf</a></h3></div>'
    rows = crawl.crawl_hits(spark.createDataFrame([("k", 1, page), ("k", 2, None)], "keyword string, page int, html string")).collect()
    assert [(r.folder, r.filename, r.context, r.pdf_url) for r in rows] == [("DS-11", "f1.pdf", "a & b", "u1"), ("Unknown", "f2.pdf", "", "u2")]
    hits = spark.createDataFrame([("k", "f", 1, 0), ("k", "f", 2, 0), ("l", "f", 3, 0)], "keyword string, filename string, page int, pos int")
    assert {(r.keyword, r.page) for r in crawl.crawl_dedup(hits, ["page", "pos"]).collect()} == {("k", 1), ("l", 3)}
    assert crawl.retry_schedule() == [2.0, 4.0]


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "in/DS-2").mkdir(parents=True)
    (tmp_path / "in/DS-2/a.pdf").write_bytes(b"one\ftwo")
    (tmp_path / "in/DS-2/b.pdf").write_bytes(b"!")
    (tmp_path / "in/DS-2/c.txt").write_bytes(b"x")
    root = str(tmp_path / "in")
    assert [(r.folder, r.filename) for r in files.list_files(spark, root).orderBy("filename").collect()] == [("DS-2", "a.pdf"), ("DS-2", "b.pdf")]

    def extract(content):
        if content == b"!":
            raise ValueError("broken")
        return content.decode().split("\f")

    pages = files.read_pages(spark, root, extract)
    assert {r.filename: (r.pages, r.error) for r in pages.collect()} == {"a.pdf": (["one", "two"], None), "b.pdf": (None, "ValueError: broken")}
    assert [tuple(r) for r in files.joined_text(pages).collect()] == [("a.pdf", "one\ntwo\n")]
    hits = spark.createDataFrame([("F", 'q"uo\nte.pdf', 1, "k", "c, d")], files.HITS)
    files.write_csv(hits, str(tmp_path / "csv"))
    assert files.read_csv(spark, str(tmp_path / "csv"), files.HITS).collect() == hits.collect()


def test_stream_equals_batch(spark, tmp_path):
    rows = [("F", "a.pdf", "the ferry and the Ferry"), ("F", "b.pdf", None)]
    spark.createDataFrame(rows, "folder string, filename string, text string").write.parquet(str(tmp_path / "docs"))
    keywords = spark.createDataFrame([(1, "ferry")], "ord int, keyword string")
    stream = spark.readStream.schema("folder string, filename string, text string").parquet(str(tmp_path / "docs"))
    stream_keyword_hits(stream, keywords, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_padding(column):
    assert column(render.padded, [1, 999, 1234], "v bigint") == ["001", "999", "1234"]
