from archivolt.llm import spans


def test_ranges_and_kept_text(spark):
    part = "".join(f"clause {k} of the harbour notice; " for k in range(20))
    texts = {1: "First. " + part + "End one.", 2: "Second opening. " + part + "Finis."}
    got = {r.id: r for r in spans.shared_shares(spark.createDataFrame(list(texts.items()), "id bigint, text string")).collect()}
    at = texts[2].index(part)
    start, end = [(r.start, r.end) for r in got[2].ranges if not r.kept][0]
    assert start <= at and end >= at + len(part) and [r.shared for r in got[2].ranges] == [False, True, False]
    assert got[2].kept_text == texts[2][:start] + texts[2][end:] and got[2].removed_chars == end - start
    assert got[1].kept_text == texts[1] and all(r.kept for r in got[1].ranges)
