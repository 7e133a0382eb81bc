"""Lines that an earlier record holds are removed with their offsets."""

from archivolt.llm import spans


def test_units(spark):
    line = "This notice of the harbour board is meant for the named reader only."
    rows = [
        (2, f"first\n{line.upper()}\nsecond\n{line}"),
        (1, f"{line}\n\nshort\nshort"),
        (3, f"short\n  this NOTICE of the harbour board, is meant for the named reader only!\nend\U0001f600"),
        (3, f"short\n  this NOTICE of the harbour board, is meant for the named reader only!\nend\U0001f600"),
        (4, None), (5, ""), (6, "x" * 100_000 + "\n" + line),
    ]
    got = {r.id: r for r in spans.unit_dedup(spark.createDataFrame(rows, "id bigint, text string")).collect()}
    assert sorted(got) == [1, 2, 3, 5, 6]
    assert got[1].kept_text == rows[1][1] and got[1].removed == []
    assert got[2].kept_text == "first\nsecond" and [(r.start, r.end) for r in got[2].removed] == [(6, 6 + len(line)), (82, 82 + len(line))]
    assert got[3].kept_text == "short\nend\U0001f600" and got[3].removed_units == 1
    assert got[5].kept_text == "" and got[5].units == 1
    assert got[6].kept_text == "x" * 100_000 and got[6].removed_chars == len(line)
    assert spans.unit_dedup(spark.createDataFrame([], "id bigint, text string")).count() == 0


def test_links_are_counted_without_pairs(spark):
    from archivolt.llm import neardup

    words = [f"w{k}" for k in range(40)]
    text = " ".join(words)
    near = " ".join([*words[:38], "x", "y"])
    rows = [("d", 1, text), ("d", 2, text), ("d", 2, text), ("d", 3, near), ("d", 4, " ".join(f"v{k}" for k in range(40))), ("m", 5, text), ("d", 6, "too short"), ("d", 7, None)]
    got = {(r.rec, r.id): (r.class_id, r.copies, r.n_links) for r in neardup.near_links(spark.createDataFrame(rows, "rec string, id bigint, text string")).collect()}
    assert got == {("d", 1): (1, 2, 2), ("d", 2): (1, 2, 2), ("d", 3): (3, 1, 2), ("d", 4): (4, 1, 0), ("m", 5): (5, 1, 0)}


def test_complete_mails(spark):
    from archivolt.llm import authored

    raw = "From: a <a@x.org>\nTo: b;\n  c\nSubject: boats\n\nHi Bo,\n\nAll sold.\n\nBest,\nAnn\n\n> old"
    rows = [(1, raw), (1, raw), (2, None), (3, ""), (4, "No headers here at all."), (5, "From: a\nTo: b")]
    got = {r.msg_id: r.new_text for r in authored.new_text(spark.createDataFrame(rows, "msg_id bigint, raw_text string"), "raw_text", headed=True).collect()}
    assert got == {1: "Hi Bo,\n\nAll sold.", 2: "", 3: "", 4: "No headers here at all.", 5: ""}
