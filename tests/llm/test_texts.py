"""Mail layout, scans, personal data, leaks and mixtures on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from archivolt.llm import authored, furniture, leakage, mixture, pii, scanfix
from archivolt.llm.texts import words

BODY = """Hi Ann,

The harbour is open.
ok

Best regards,

--
Bo Lee
Office Manager
Tel. +1 380 555 0157

Sent from my iPhone

[G382/Z89] Nothing in this e-mail is an offer or binds
Calawood Ltd.

On Thu, Dec 1, 2011 at 4:38 AM, "Ann Poe"
<a@x.org> wrote:

> Is it open?
> > Deep
>
> Ann

It opened
on Monday.

Bo"""


def test_layout():
    lines = BODY.split("\n")
    kept = [lines[n - 1] for n in authored.authored_lines(BODY)]
    assert kept == ["Hi Ann,", "The harbour is open.", "ok", "It opened", "on Monday."]
    tree = authored.parse_mail(BODY)
    assert any(n.kind == "quote" and any(c.kind == "quote" for c in n.children) for n in tree)


@pytest.mark.parametrize(
    ("body", "new"),
    [
        ("Agreed.\n\n---------- Forwarded message ----------\nFrom: x\n\ntext", [1]),
        ("On 82 March the board wrote: keep it.\n\nBye now.", [1, 3]),
        ("Am 30.08.2015 um 01:43 schrieb\nJo Lee:\n\n| alt\n\nNeu hier.", [6]),
        ("Le 5 mars 2011 à 08:29,\nT. Kir a écrit :\n\n> ancien", []),
        ("All text\npage 1\nDec Index - Town\n\ngoes on.\npage 2", [1, 5]),
        ("________________________________\nFrom: a\nSent: b\n\nold", []),
        ("", []), (None, []), ("\n\n", []), ("> " * 60 + "deep", []),
    ],
)
def test_layout_cases(body, new):
    assert authored.authored_lines(body) == new


def test_new_text_once(spark):
    df = spark.createDataFrame([(1, BODY, "x"), (1, BODY, "y"), (2, None, "z"), (3, "", "z")], "msg_id bigint, body string, line_no string")
    got = {r.msg_id: r for r in authored.new_text(df).collect()}
    assert set(got) == {1, 2, 3} and got[2].new_text == "" and got[1].kept_lines == 5
    assert authored.new_lines(df).count() == 5
    assert authored.new_lines(df.limit(0)).count() == 0


TYPED = ["The harbour was opened by the captain and the notary counted every ledger", "Please describe the well-known vineyard before the warden closes the gate", "Nobody at the museum remembered the statement about the lighthouse keeper"]


def scanned(k):
    text = TYPED[k % 3]
    bad = [text.replace("harbour", "har-\nbour").replace("counted", "c0unted"), text.replace("well-known", "well-\nknown").replace("describe", "dcscribe"), text.replace("lighthouse", "lighf¬\nhouse")][k % 3]
    half = bad.index("the")
    return f"{bad[:half]}\npage {k + 3}\nEFTA7000000{k % 10}\nMinutes of the sale\n{bad[half:]}\npage {k + 4}", text


def test_scan_repair():
    counts = {w: 200 for t in TYPED for w in t.lower().split()}
    editor = scanfix.train([scanned(k) for k in range(9)], counts)
    for k in range(3):
        bad, good = scanned(k)
        found = scanfix.findings("d", bad, editor)
        assert {x for d, x in found if d == "line"} == {f"page {k + 3}", f"page {k + 4}", f"EFTA7000000{k}", "Minutes of the sale"}
        assert {x for d, x in found if d == "split"} == {("harbour", "well-known", "lighthouse")[k]}
        assert {x for d, x in found if d == "char"} == ({"counted"}, {"describe"}, {"lighthouse"})[k]
        assert scanfix.repair(bad, editor).replace("\n", " ").split() == good.split()
    assert scanfix.findings("d", "never scanned, dcscribe it", editor) == set()
    assert scanfix.findings("d", None, editor) == scanfix.findings("d", "", editor) == set()
    assert scanfix.findings("s", "...bour was dcscribe har­ bour c0unted...", editor) == {("char", "describe"), ("split", "harbour"), ("char", "counted")}


def test_furniture_needs_its_sequence():
    assert furniture.furniture_lines(["a", "7", "b", "c"]) == {}
    assert furniture.furniture_lines(["a", "7", "b", "3", "Head - Town", "c", "4", ""]) == {6: "number", 3: "number", 4: "header"}
    assert furniture.furniture_lines(["x", "ix", "EFTA12345678", "text that goes on and on for a while", "x"]) == {4: "number", 1: "number", 2: "stamp"}
    assert furniture.furniture_lines([]) == {}


def people(rng):
    given, family = ["Desmond", "Rebecca", "Zoltán", "Élodie", "Samuel"], ["Norsazak", "Kirliriman", "Volgavane", "Torteic"]
    g, f = rng.choice(given), rng.choice(family)
    return rng.choice([f"{g} {f}", f"{f}, {g}", f"{f.upper()} {g}", f"{g[0]}. {f}", f"Prof. {g} {f}"])


@pytest.fixture(scope="module")
def finder():
    rng = random.Random(5)
    samples, counts = [], {}
    for k in range(300):
        a, b = people(rng), people(rng)
        text = f"The Ravenska vessel moved. {a} said the {rng.choice(['eager', 'lesser'])} claim failed near Corvane. Passport or identity card: {rng.randrange(900, 999)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}, holder {b}. Call (514) 555-0{rng.randrange(100, 199)} after six. Invoice INV-0075-0008{k % 10} refers to lot 377-63-00{10 + k % 80}. On Monday Volgavane Trust asked."
        samples.append((text, [a, b, "Volgavane Trust"]))
        for n in (a, b):
            g, f, _ = pii.split_name(n)
            for w in g:
                counts[w] = (counts.get(w, (0, 0, 0))[0] + 1, counts.get(w, (0, 0, 0))[1], 0)
            for w in f:
                counts[w] = (counts.get(w, (0, 0, 0))[0], counts.get(w, (0, 0, 0))[1] + 1, 0)
    cut = 240
    return pii.fit(samples[:cut], pii.Lexicon(counts)), samples[cut:]


def test_personal_data_on_held_out_texts(finder):
    model, held = finder
    hit = wrong = missed = 0
    for (text, names), spans in zip(held, model.spans([t for t, _ in held]), strict=True):
        want = {n for n in names if n != "Volgavane Trust"}
        got = {text[s:e] for s, e, k, _ in spans if k == "name"}
        hit, wrong, missed = hit + len(got & want), wrong + len(got - want), missed + len(want - got)
        numbers = [(k, text[s:e]) for s, e, k, _ in spans if k in ("phone", "idno")]
        assert [k for k, _ in numbers] == ["idno", "phone"] and numbers[1][1].startswith("(514) 555-0")
    assert hit / (hit + wrong) > 0.95 and hit / (hit + missed) > 0.95


def test_addresses_and_mail(finder):
    text = "Held at Apt 8, 55 Quarry Lane, Brădora before March; 456 rue du Rapport, 00996 Kestrin. Kanalstraße 116, 00700 Larkmoor or P.O. Box 377, Adrona. Write ann.lee@x.example or bo (at) postnest dot example, also cy [at] x.test."
    got = [(k, text[s:e]) for s, e, k, _ in finder[0].spans([text, None, ""])[0]]
    assert [v for k, v in got if k == "address"] == ["Apt 8, 55 Quarry Lane, Brădora", "456 rue du Rapport, 00996 Kestrin", "Kanalstraße 116, 00700 Larkmoor", "P.O. Box 377, Adrona"]
    assert [v for k, v in got if k == "email"] == ["ann.lee@x.example", "bo (at) postnest dot example", "cy [at] x.test"]


def test_redaction(spark, finder):
    rows = [("d", 1, "Ask ann@x.org now", None), ("d", 1, "Ask ann@x.org now", None), ("m", 2, None, None), ("m", 3, "", None)]
    df = spark.createDataFrame(rows, "rec string, id bigint, text string, names array<string>")
    assert {(r.rec, r.rec_id): r.text for r in pii.redacted(df, finder[0]).collect()} == {("d", 1): "Ask [EMAIL] now", ("m", 2): None, ("m", 3): ""}
    assert [tuple(r) for r in pii.findings(df, finder[0]).collect()] == [("d", 1, "email", "ann@x.org")]


def test_leaks_against_all_runs(spark):
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(500)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([12, 13, 40, 90]))), vocab[i]) for i in range(25)] + [(90, "too short", "x"), (91, None, None), (92, "", "y")]
    docs = []
    for k in range(150):
        text = " ".join(rng.choices(vocab, k=rng.choice([0, 20, 120])))
        if rng.random() < 0.5:
            ws = rng.choice(items[:25])[1].split()
            n = min(len(ws), rng.choice([9, 11, 12, 14, 40]))
            at = rng.randrange(len(ws) - n + 1)
            text += " , " + " ".join(ws[at : at + n]).title() + "\n" + " ".join(rng.choices(vocab, k=rng.randrange(30)))
        docs.append((k, text))
    docs += [docs[0], (900, None), (901, "")]
    want = set()
    for i, t, _ in items:
        runs = {tuple(words(t)[k : k + 12]) for k in range(len(words(t)) - 11)}
        want |= {(i, d) for d, x in docs for k in range(len(words(x)) - 11) if tuple(words(x)[k : k + 12]) in runs}
    found = leakage.leaked_items(spark.createDataFrame(docs, "id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string, answer string"))
    assert {(r.item_id, r.id) for r in found.collect()} == want
    assert len(want) > 20
    nothing = leakage.leaked_items(spark.createDataFrame(docs, "id bigint, text string").limit(0), spark.createDataFrame(items[:1], "item_id bigint, item_text string, answer string"))
    assert nothing.count() == 0


def test_runs_and_subsequences():
    assert leakage.longest_run("a b c d".split(), "x b c y c d".split()) == 2
    assert leakage.common_subsequence("a b c d".split(), "a x c d b".split()) == 3
    assert leakage.longest_run([], ["a"]) == leakage.common_subsequence([], ["a"]) == 0


def test_mixture(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("aaaaaab"), rng.randrange(1, 60)) for i in range(3000)] + [(9000, "c", 50), (9001, None, 4), (9002, "a", 0), (1, "a", 0)]
    counted = spark.createDataFrame(rows, "id bigint, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("none", 0.05, 2), ("neg", -1.0, 2)], "source string, target_share double, max_repeats int")
    chosen, report = mixture.mix_sources(counted, targets)
    got = {r.source: r for r in report.collect()}
    size = {s: sum(t for i, x, t in rows if x == s) for s in "ab"}
    total = min(size["a"] / (5 / 9), 3 * size["b"] / (4 / 9))
    for s, share in (("a", 5 / 9), ("b", 4 / 9)):
        assert abs(got[s].tokens - share * total) <= 60 and not got[s].capped
        assert abs(got[s].actual_share - share) < 0.01
    assert got["none"].tokens == 0 and "neg" not in got
    rows_chosen = chosen.collect()
    assert {r.source for r in rows_chosen} == {"a", "b"} and len({r.id for r in rows_chosen}) == len(rows_chosen)
    assert all(1 <= r.repeats <= {"a": 1, "b": 3}[r.source] for r in rows_chosen)
    # a larger total: the capped source gives all it may
    _, larger = mixture.mix_sources(counted, targets, total=10 * sum(size.values()))
    big = {r.source: r for r in larger.collect()}
    assert big["a"].tokens == size["a"] and big["a"].capped and big["b"].tokens == 3 * size["b"]
    empty = mixture.mix_sources(counted.limit(0), targets)
    assert empty[0].count() == 0 and {r.tokens for r in empty[1].collect()} == {0}


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "s", "Hello world"), (2, "s", None), (3, None, "<|endoftext|>")], "id bigint, source string, text string").withColumn("tokens", F.lit("x"))
    got = {r.id: r.tokens for r in mixture.token_counts(df).collect()}
    assert got[1] == 2 and got[2] == 0 and got[3] > 1
