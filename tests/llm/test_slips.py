"""Slips in names of any frequency."""

import random

from archivolt.llm import entities, leakage


def test_keys_meet_wherever_slips_are_allowed():
    rng = random.Random(4)
    for _ in range(3000):
        w = "".join(rng.choices("abcde", k=rng.choice([2, 4, 5, 6, 7, 9, 27, 28, 29, 30, 31, 33])))
        v = list(w)
        for _ in range(entities.slips_allowed(w)):
            i = rng.randrange(len(v))
            kind = rng.randrange(4)
            if kind == 0 and len(v) > 1:
                v.pop(i)
            elif kind == 1:
                v.insert(i, rng.choice("abcde"))
            elif kind == 2:
                v[i] = rng.choice("abcde")
            elif i + 1 < len(v):
                v[i], v[i + 1] = v[i + 1], v[i]
        v = "".join(v)
        if entities.slips(w, v, 2) <= entities.slips_allowed(w):
            assert entities._slip_keys(w) & entities._slip_keys(v), (w, v)


def names(spark, rows):
    return spark.createDataFrame(rows, "name string, n bigint"), spark.createDataFrame([], "name string, address string")


def test_rare_given_name_with_a_slip_is_linked(spark):
    many = [(f"{g} {f}", 5000) for g in ("William", "Robert", "Susanna") for f in ("Ford", "Mason", "Hill")]
    rows = [*many, ("Anneliese Baker", 2), ("Anneleise Baker", 1), ("nAneliese Baker", 1), ("Roland Baker", 2), ("Anneliese Barker-Dunn", 1), ("", 1)]
    got = {(r.name_a, r.name_b) for r in entities.linked_pairs(*names(spark, rows)).collect()}
    group = sorted(["Anneliese Baker", "Anneleise Baker", "nAneliese Baker"])
    assert got == {(a, b) for a in group for b in group if a < b}


def test_slips_of_slips_lead_to_the_name(spark):
    words = spark.createDataFrame([("adelmira", 5000), ("adelmria", 20), ("adlemria", 1), ("boris", 7)], "rest string, n bigint")
    assert {tuple(r) for r in entities.corrected_words(words).collect()} == {("adelmria", "adelmira"), ("adlemria", "adelmira")}
    assert entities.corrected_words(words.limit(0)).count() == 0


def test_scrambled_passages_are_paraphrases(spark):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(400)]
    item = rng.choices(vocab, k=40)
    pieces = [item[k : k + 8] for k in range(0, 40, 8)]
    broken = " extra ".join(" ".join(p) for p in pieces)
    far = " ".join(rng.choices(vocab, k=60))
    docs = [(1, " ".join(item)), (2, broken), (3, far), (4, None)]
    # other texts set the frequency of the pairs
    docs += [(k, " ".join(rng.choices(vocab, k=80))) for k in range(10, 60)]
    found = leakage.leaked_items(spark.createDataFrame(docs, "id bigint, text string"), spark.createDataFrame([(5, " ".join(item), "w1")], "item_id bigint, item_text string, answer string"))
    got = {(r.id, r.kind) for r in found.collect()}
    assert got == {(1, "verbatim"), (2, "paraphrase")}


def test_long_items_are_cut_into_overlapping_blocks(monkeypatch):
    class Row:
        def __init__(self, item_id, item_text):
            self.item_id, self.item_text = item_id, item_text

    monkeypatch.setattr(leakage, "BLOCK_WORDS", 60)
    blocks = list(leakage._blocks(iter([Row(1, " ".join(f"a{k}" for k in range(150))), Row(2, "b " * 20), Row(3, "c"), Row(4, None)]), 12))
    assert max(sum(len(ws) for _, ws in b) for b in blocks) <= 60
    parts = [ws for b in blocks for i, ws in b if i == 1]
    runs = {tuple(ws[k : k + 12]) for ws in parts for k in range(len(ws) - 11)}
    assert runs == {tuple(f"a{k + j}" for j in range(12)) for k in range(139)}
