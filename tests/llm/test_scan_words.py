"""Word counts beyond the broadcast ones, trailing blanks, contexts."""

import random

from archivolt.llm import scanfix

WORDS = "harbour vineyard ledger notary charter orchard glacier lantern meadow compass sextant parish quarry tunnel voyage ballot".split()


def corpus(spark):
    rng = random.Random(6)
    text = lambda: " ".join(rng.choices(WORDS, k=60))
    typed = [(k, text()) for k in range(30)]
    scans, samples = [], []
    for k in range(100, 130):
        ws = rng.choices(WORDS, k=60)
        wrong = [w.replace("e", "c", 1) if rng.random() < 0.15 else w for w in ws]
        lines = [" ".join(wrong[i : i + 8]) for i in range(0, 60, 8)]
        lines[2] = lines[2] + " lan- "
        lines[3] = "tern " + lines[3]
        scans.append((k, "\n".join([*lines, "page 1"]) + "  \n \n"))
        ws[24:24] = ["lantern"]
        samples.append((k, " ".join(ws)))
    documents = spark.createDataFrame([*typed, *scans], "id bigint, text string")
    return documents, spark.createDataFrame(samples[:20], "doc_id bigint, clean_text string"), dict(samples)


def found(spark, documents, samples):
    editor, rest = scanfix.trained_editor(documents, samples)
    scanned = documents.where("id >= 100").selectExpr("'d' AS rec", "id", "text", "cast(null AS array<string>) AS names")
    return {tuple(r) for r in scanfix.scan_findings(scanned, editor, rest).collect()}, {r.rec_id: r.text for r in scanfix.repaired_texts(scanned, editor, rest).collect()}, rest


def test_words_beyond_the_cache_are_looked_up(spark, monkeypatch):
    documents, samples, truth = corpus(spark)
    all_found, texts, rest = found(spark, documents, samples)
    assert rest is None
    assert {r[3] for r in all_found if r[2] == "split"} == {"lantern"} and any(r[2] == "char" for r in all_found)
    assert {k: " ".join(t.split()) for k, t in texts.items()} == truth
    monkeypatch.setattr(scanfix, "CACHE_WORDS", 4)
    few_found, few_texts, rest = found(spark, documents, samples)
    assert rest is not None and rest.count() > 4
    assert (few_found, few_texts) == (all_found, texts)


def test_context(spark):
    documents, samples, _ = corpus(spark)
    editor, _ = scanfix.trained_editor(documents, samples)
    assert scanfix.repair_context("...bour the Harb¬ our and vincyard at the quar...", editor) == "...bour the Harbour and vineyard at the quar..."
    assert scanfix.repair_context(None, editor) is None and scanfix.repair_context("", editor) == ""


def test_edits_are_learned():
    shown = [(f"{w[:2]}x{w[3:]}", f"{w[:2]}z{w[3:]}") for w in ("lazy1", "dozen", "mazes")]
    assert scanfix.learned_edits(shown) == [("x", "z")]
    assert scanfix.learned_edits(shown[:2]) == []
