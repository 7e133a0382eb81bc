"""Every kind of personal data is decided by trees learnt from texts of known truth."""

import random

import pytest

from archivolt.llm import pii, pii_samples

GIVEN, FAMILY = "Hannah Oskar Petra Simon Ulla Viktor".split(), "Brookman Castellan Dorwick Eastley Farnham Grover".split()


def archive(spark):
    rng = random.Random(3)
    documents, messages = [], []
    for k in range(60):
        names = [f"{rng.choice(GIVEN)} {rng.choice(FAMILY)}" for _ in range(3)]
        text = f"The clerk met {names[0]} and {names[1]} at the quay. Later {names[2]} signed for Brookman Shipping Co in Hall."
        documents.append((k, text, [*names, "Brookman Shipping Co"]))
        messages.append((names[0], names[1]))
    return spark.createDataFrame(documents, "doc_id bigint, text string, names array<string>"), spark.createDataFrame(messages, "sender string, recipient string")


def found(spark, documents, finder):
    records = documents.selectExpr("'d' AS rec", "doc_id AS id", "text")
    return {tuple(r) for r in pii.findings(records, finder).collect()}


def test_words_beyond_the_cache_are_looked_up(spark, monkeypatch):
    documents, messages = archive(spark)
    finder = pii.trained_finder(documents, messages)
    want = found(spark, documents, finder)
    assert finder.rest is None and len(want) > 100
    assert not any("Shipping" in r[3] for r in want)
    monkeypatch.setattr(pii, "CACHE_WORDS", 3)
    few = pii.trained_finder(documents, messages)
    assert few.rest is not None and len(few.lexicon.counts) <= 3
    assert found(spark, documents, few) == want


@pytest.fixture(scope="module")
def finder():
    return pii.fit([], pii.Lexicon({}))


@pytest.mark.parametrize(("rows", "spans", "features", "models"), [
    (pii_samples.numbers, pii.number_spans, pii.number_features, {"phone": "phones", "idno": "idnos"}),
    (pii_samples.mails, pii.mail_spans, pii.mail_features, {"email": "mails"}),
    (pii_samples.addresses, pii.address_spans, pii.address_features, {"address": "streets"}),
])
def test_held_out_samples(finder, rows, spans, features, models):
    import numpy as np

    for kind, model in models.items():
        tree = getattr(finder, model)
        hit = missed = wrong = 0
        for text, s, e, label in rows(1500, seed=99):
            got = {(a, b) for a, b in spans(text) if tree.probability(np.array([features(text, a, b)]))[0] >= tree.threshold}
            if label == kind:
                hit += (s, e) in got
                missed += (s, e) not in got
            elif label == "":
                wrong += (s, e) in got
        assert hit > 200 and missed <= 0.03 * hit and wrong <= 0.03 * hit, (kind, hit, missed, wrong)


def test_texts_of_known_truth(finder):
    text = "Call +49 30 23125 084.\n\n14 Nov sold. Am 08.10.2014 um 9. Sent: 2015-04-14T04:52:02.588741-07:00\nlot 309-87-0078, with ID 941-89-9921 and " + "x" * 300 + "@long.example.org"
    got = [(text[s:e], k) for s, e, k, _ in finder.spans([text])[0]]
    assert got == [("+49 30 23125 084", "phone"), ("941-89-9921", "idno"), ("x" * 300 + "@long.example.org", "email")]
    assert finder.spans([None, ""]) == [[], []]
