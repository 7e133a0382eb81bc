"""What makes the links and clusters of large archives quick gives what the plain way gives."""

import random
import sys
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from archivolt.config import BODY_JUNK, BODY_NOTICES, JUNK_PATTERNS
from archivolt.functions import fingerprints as fp
from archivolt.functions import text
from archivolt.operators import joins, links


def test_close_numbers_alone_are_no_candidates(spark):
    rows = [(f"EFTA{k:08d}.pdf", f"text {k}", "", k, ["a@x.org", "b@x.org"] if k in (3, 9) else ["a@x.org"], []) for k in range(200)]
    docs = links.with_fingerprints(spark.createDataFrame(rows, "filename string, clean string, subject string, ordinal bigint, addresses array<string>, dates array<timestamp_ntz>"), "clean")
    none = spark.createDataFrame([], "i string, j string"), spark.createDataFrame([], "a string, b string, ratio double")
    assert [tuple(r) for r in links.link_candidates(docs, *none).collect()] == [("EFTA00000003.pdf", "EFTA00000009.pdf")]
    assert [(r.i, r.j, r.score) for r in links.link_edges(docs).collect()] == [("EFTA00000003.pdf", "EFTA00000009.pdf", 30)]


def test_texts_put_together_give_the_windows_of_each(spark):
    rng = random.Random(5)
    words = ["harbour", "été", "12:30", "x" * 9, " ", "\n\n", "𝒜lpha", "...."]
    long = " ".join(rng.choices(words, k=90))
    texts = ["", "ab", long, long[7:160], " ".join(rng.choices(words, k=60)), "1" * 400, long[40:] + "y" * 70000, long[:101], " " * 300 + long]
    prints = fp.winnow(texts)
    assert [p.tolist() for p in prints] == [fp.winnow([t])[0].tolist() for t in texts]
    digests = lambda t, starts: sorted({int(fp._grams(fp._codes(t[i : i + 100]), 100)[0].view(np.int64)) for i in starts}, key=lambda h: h % 2**64)
    assert [h.tolist() for h in fp.windows(texts, prints, 100)] == [digests(t, range(len(t) - 99)) for t in texts]
    df = spark.createDataFrame([(i, t, p.tolist()) for i, (t, p) in enumerate(zip(texts, prints, strict=True))], "k int, t string, p array<bigint>")
    plain = {(r.k, r.h) for r in fp.with_digests(df.withColumn("c", joins.text_chunks(F.col("t"))), "k", "c", 100).collect()}
    own = fp.with_windows(df, "k", "t", "p", 100, 50)
    assert {(r.k, r.h) for r in own.collect()} == plain and len(plain) > 20
    held = {(r.k, r.h) for r in fp.with_windows(df, "k", "t", "p", 100, among=fp.bit_map(own, "h")).collect()}
    every = {(k, h) for k, hs in enumerate(fp.windows(texts, prints, 100)) for h in hs.tolist()}
    assert held <= every and {(k, h) for k, h in every if h in {h for _, h in plain}} <= held and len(held) < len(every)


def test_white_space_is_what_the_pattern_calls_so(column):
    marks = [chr(k) for k in range(1, sys.maxunicode + 1) if unicodedata.category(chr(k)) != "Cs" and (chr(k).isspace() or unicodedata.category(chr(k))[0] in "ZC") and k < 0x20000]
    plain = column(lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), [m + "a" + m + "b" + m for m in marks])
    assert column(text.strip, [m + "a" + m + "b" + m for m in marks]) == plain
    assert column(text.strip, [None, "", "  \n"]) == [None, "", ""]


def test_junk_is_found_by_its_pieces(column):
    odd = [
        "ſent from my iPhone today", "SENT FROM MY İPhone", "a\nſent: now\nTo: b\nFRAN: c\nb", "Unauthorized uſe disclosure is prohibited x", "Copyright - all rights reserved", "x EFTA_R1_22 efta00000001 y", "Sent Irma Sainting you", "sag from si mmg mat",
        "<?XML a?> b <!doctype z> c", "*****\n> ***** notice attachments.", "the information contained in this communication is x all copies thereof y thereof, z", "a  b\t c \t\td", "Iſane-Images: q\nlane-Images: q\n1234_5.jpg", "12345 6; 7 8:9_x.jpg\n 123456 \n> ww**",
        "and may be unlawful. attachments. If you have received thiſ all thereof.", "confidential, may be attorney-client privileged for the addressee.", "On Mon, May 5, 2014 wrote: rest", "on 5 May 2014 at ten\nx WROTE: rest", "plain", "", None,
    ]

    def clean(c):
        out = F.coalesce(c, F.lit(""))
        for p in JUNK_PATTERNS:
            out = F.regexp_replace(out, "(?dimuU)" + p, "")
        return F.regexp_replace(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")

    def body(c):
        out = clean(c)
        for p, fold in (*BODY_JUNK, *BODY_NOTICES):
            out = F.regexp_replace(out, ("(?dimuU)" if fold else "(?dmU)") + p, "")
        return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")

    assert column(text.clean_text, odd) == column(clean, odd)
    assert column(text.clean_message_body, odd) == column(body, odd)
    assert column(text.normalize_body, odd[16:18]) == ["rest", "rest"]
    mails = ["a@b.c-d@e.f", "x.y@z.com@q.org", "no mail@ here@there", "-a-@b.c.d é®@x.yz", "a@b.c®d@e.fg;h@i.jk"]
    plain = lambda c: F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"(?iuU)[\w.\-®]+@[\w.-]+\.\w+"), F.lit(0)), lambda e: text.normalize_email(e))))
    assert column(text.extract_emails, mails) == column(plain, mails)


def test_common_text_is_found_once_and_no_conversation_is_made_for_nothing(spark, monkeypatch):
    from unittest.mock import MagicMock

    from archivolt.plans import queries

    for name in ("conversation_confidence", "conversation_markdown", "standalone_markdown", "index_lines"):
        found, made = MagicMock(), MagicMock(return_value=(MagicMock(), MagicMock()))
        for module, part, fake in (
            (queries, "_linked", MagicMock(return_value=(MagicMock(), MagicMock(), MagicMock()))), (queries, "materialize", lambda df, _: df), (links, "materialize", lambda df, _: df), (links, "common_text", found), (links, "like_subjects", MagicMock()),
            (links, "score_pairs", MagicMock()), (links, "link_candidates", MagicMock()), (queries.graph, "capped_clusters", MagicMock()), (queries.conv, "conversations", made), (queries.conv, "cluster_pairs", MagicMock()), (queries.conv, "numbered", MagicMock()), (queries, "render", MagicMock()),
            (queries.text, "clean_text", lambda c: F.lit("")),
        ):
            monkeypatch.setattr(module, part, fake)
        queries.QUERIES[name](spark, "nowhere")
        assert found.call_count == 1 and made.call_count == (name != "standalone_markdown")
