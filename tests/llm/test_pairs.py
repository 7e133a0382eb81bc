"""Near duplicates, shared spans and names against brute force, on small tables with awkward rows."""

import random

import numpy as np
import pytest

from archivolt.llm import entities, neardup, spans
from archivolt.llm.texts import words

RNG = random.Random(11)
VOCAB = ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randrange(3, 9))) for _ in range(400)]


def prose(n):
    out = []
    while len(out) < n:
        out += [*RNG.choices(VOCAB, k=RNG.randrange(6, 14)), "."]
    return " ".join(out).replace(" .", ".").replace(". ", ".\n" if RNG.random() < 0.5 else ". ")


def edited(text, rate):
    ws = text.split(" ")
    return " ".join(RNG.choice(VOCAB) if RNG.random() < rate else w for w in ws)


def corpus():
    base = [prose(120) for _ in range(6)]
    rows = [("d", i, prose(100)) for i in range(20)]
    for k in range(30):
        rows.append((RNG.choice("dm"), 100 + k, edited(RNG.choice(base), RNG.choice([0, 0.02, 0.06, 0.15]))))
    rows += [("d", 200 + k, base[0]) for k in range(12)]  # a hot group of copies
    rows += [("m", 300, base[1]), ("m", 300, base[1]), ("d", 400, None), ("d", 401, ""), ("d", 402, "too short"), ("d", 403, "  \n "), ("d", 404, "long " * 30_000)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_near_pairs_against_all_pairs(spark, rows):
    sets = {}
    for rec, i, t in rows:
        ws = words(t)
        if len(ws) >= 20:
            sets[rec, i] = {tuple(ws[k : k + 3]) for k in range(len(ws) - 2)}
    want = set()
    keys = sorted(sets)
    for x, a in enumerate(keys):
        for b in keys[x + 1 :]:
            if a[0] == b[0] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6:
                want.add((a[0], a[1], b[1]))
    df = spark.createDataFrame(rows, "rec string, id bigint, text string").selectExpr("*", "1 AS cls", "'x' AS keys")
    got = [tuple(r) for r in neardup.near_record_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want
    groups = neardup.near_groups(df, threshold=0.6, size=3).collect()
    assert sorted((r.rec, r.id) for r in groups) == keys
    place = {(r.rec, r.id): (r.rec, r.group_id) for r in groups}
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for rec, a, b in sorted(want):
        x, y = sorted((find((rec, a)), find((rec, b))))
        root[y] = x
    assert place == {k: find(k) for k in keys}
    assert all(r.members == sum(p == (r.rec, r.group_id) for p in place.values()) for r in groups)
    assert neardup.near_record_pairs(df.limit(0)).count() == 0


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(1, 2**63, n).astype(np.uint64) for n in (300, 100, 100))
    x, y = np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))
    s = neardup.superminhash(np.concatenate([x, y, x[:3]]), np.array([len(x), len(y), 3]), 512)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.07
    assert (s[2] >> np.uint64(32)).max() > 100  # a small set takes many steps, and fills every place
    assert (s < np.uint64(1 << 63)).all()
    # one element: its steps are a permutation of the places
    one = neardup.superminhash(x[:1], np.array([1]), 64)[0] >> np.uint64(32)
    assert sorted(one) == list(range(64))


def test_shared_spans_against_all_spans(spark, rows):
    texts = {i: t for rec, i, t in rows if rec == "d" and t}
    base = prose(200)
    flat = "x" * 150 + "".join(RNG.choices("qrstuv", k=900)) + "y" * 100
    texts |= {500: prose(40) + base[100:405], 501: base[90:400] + prose(40), 502: base[100:399], 503: flat, 504: "z" + flat[300:620], 505: flat[130:430] + "k", 506: flat[131:430]}
    want = set()
    grams = {}
    for i, t in texts.items():
        for k in range(len(t) - 299):
            grams.setdefault(t[k : k + 300], set()).add(i)
    for ids in grams.values():
        want |= {(a, b) for a in ids for b in ids if a < b}
    df = spark.createDataFrame([*texts.items(), (200, texts[200]), (600, None), (601, "")], "id bigint, text string").selectExpr("*", "0 AS cls")
    assert {tuple(r) for r in spans.shared_span_pairs(df).collect()} == want
    assert {tuple(r) for r in spans.shared_span_pairs(df, hot=1).collect()} == want
    shares = {r.id: r for r in spans.shared_shares(df).collect()}
    linked = {x for p in want for x in p}
    assert {i for i, r in shares.items() if r.shared_chars > 0} == linked
    for i, r in shares.items():
        covered = np.zeros(len(texts[i]), bool)
        for k in range(len(texts[i]) - 299):
            if len(grams[texts[i][k : k + 300]]) > 1:
                covered[k : k + 300] = True
        assert r.shared_chars == covered.sum(), i
    assert spans.shared_span_pairs(df.limit(0)).count() == 0


def test_unit_starts_are_dense_and_local():
    text = "a" + "".join(RNG.choices("bcdefgh", k=2000))
    starts = spans.unit_starts(text, 120)
    assert max(np.diff([0, *starts])) <= 122
    inner = [p for p in starts if 500 <= p < 1300]
    assert [p + 7 for p in inner if 620 <= p < 1180] == [p for p in spans.unit_starts("1234567" + text, 120) if 627 <= p < 1187]


NAMES = [
    "Desmond Norsazak", "NORSAZAK Desmond", "Norsazak, Des", "desmond  norsazak", "Prof. Desmond Norsazak", "Norsazak, D.", "Desmond D. Norsazak", "Desmnod Norsazak", "Desmond Norsozak",
    "Gregory Norsazak", "Greg Norsazak", "Elizabeth Torvane", "Betty Torvane", "Torvane, E.", "Eleonora Torvane", "Calawood Holdings Ltd", "The Calawood Hldgs Limited", "CALAWOOD HOLDINGS LTD", "Calawood Legal Services", "Calawood Legal Serv.",
]


def test_names(spark):
    documents = spark.createDataFrame([(NAMES * 5,), (["Desmond Norsazak"] * 30,), (None,), ([],), ([None, "", " "],)], "names array<string>")
    messages = spark.createDataFrame([('"Betty Torvane" <b@x.org>', "a@x.org; Gregory Norsazak [g@x.org]"), (None, ""), ("a@x.org", None)], "sender string, recipient string")
    pairs = {(r.name_a, r.name_b) for r in entities.linked_pairs(*entities.spellings(documents, messages)).collect()}
    groups = [NAMES[:9], NAMES[9:11], NAMES[11:13], NAMES[15:18], NAMES[18:]]
    want = {(a, b) for g in groups for a in g for b in g if a < b}
    # the initial E. could be Elizabeth or Eleonora: it may join the more frequent one, never both
    loose = {p for p in pairs if "Torvane, E." in p}
    assert pairs - loose == want
    assert not ({p for p in loose if "Eleonora Torvane" in p} and {p for p in loose if "Elizabeth Torvane" in p})
    none = entities.linked_pairs(*entities.spellings(documents.limit(0), messages.limit(0)))
    assert none.count() == 0


def test_collision_curve():
    b = entities.bands_for(0.45, 0.99, 2)
    assert 1 - (1 - 0.45**2) ** b >= 0.99 > 1 - (1 - 0.45**2) ** (b - 1)
    assert entities.slips("abcd", "abdc") == 1 and entities.slips("abc", "abxyzc") == 3 and entities.slips("", "ab") == 2
