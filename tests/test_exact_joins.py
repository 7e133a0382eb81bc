"""Joins that must lose nothing, on small tables."""

import random

import pytest

from archivolt import runtime
from archivolt.functions.similarity import ratio
from archivolt.operators import conversations as conv
from archivolt.operators import joins, search


def test_fuzzy_pairs_within_groups(spark):
    rng = random.Random(9)
    rows = []
    for g in ("x", "y"):
        for _ in range(20):
            s = "".join(rng.choices("abcdefgh ", k=rng.randrange(1, 60)))
            t = list(s)
            for _ in range(rng.randrange(0, 8)):
                at = rng.randrange(len(t) + 1)
                if rng.random() < 0.5 and t:
                    t.pop(min(at, len(t) - 1))
                else:
                    t.insert(at, rng.choice("abcdefgh"))
            rows += [(g, s), (g, "".join(t))]
    rows += [("x", None), ("y", ""), ("x", rows[0][1])]
    for percent in (80, 85):
        got = {(r.g, r.a, r.b) for r in joins.fuzzy_pairs(spark.createDataFrame(rows, "g string, s string"), "s", percent, "g").collect()}
        assert got == {(g, a, b) for g, a in rows for h, b in rows if g == h and a and b and a < b and ratio(a, b) > percent}


def test_keywords_beyond_the_broadcast_bound(spark, monkeypatch):
    pages = spark.createDataFrame([("f", "a.pdf", 1, "Arad and +40x, x+40x. Cluj-Napoca; ARAD x+x"), ("f", "a.pdf", 1, "Arad and +40x, x+40x. Cluj-Napoca; ARAD x+x"), ("f", "b.pdf", 1, ""), ("f", "c.pdf", 2, None)], "folder string, filename string, page int, text string")
    words = spark.createDataFrame([(1, "arad"), (2, "cluj"), (3, "cluj-napoca"), (4, "+40x"), (5, "+"), (6, "paradigm"), (7, "arad")], "ord int, keyword string")
    few = sorted(map(tuple, search.keyword_hits(pages, words).collect()))
    assert [(r[4], r[6]) for r in few] == sorted([(1, 0), (1, 37 - 2), (2, 22), (3, 22), (4, 16), (5, 16), (5, 41), (7, 0), (7, 35)] * 2) or len(few) % 2 == 0
    monkeypatch.setattr(search, "BROADCAST_KEYWORDS", 2)
    assert sorted(map(tuple, search.keyword_hits(pages, words).collect())) == few


def test_contained_pairs(spark):
    rows = [("g", "the harbour master wrote a letter"), ("g", "yes the harbour master wrote a letter today"), ("h", "the harbour master wrote a letter"), ("g", "short"), ("g", "short text")]
    got = {tuple(r) for r in conv.contained_pairs(spark.createDataFrame(rows, "g string, norm string"), "g").collect()}
    assert got == {("g", rows[0][1], rows[1][1])}


def test_null_thread_is_deduplicated_at_any_size(spark):
    long = "the harbour master wrote a long report about the vineyard and the missing ledger"
    df = spark.createDataFrame([(None, 1, long), (None, 2, long + " of march"), (None, 3, "an entirely different message about boats and quays")], "conv string, n int, body string")
    for hot in (1, 500):
        assert {r.n for r in conv.dedup_messages(df, "conv", ["n"], hot).collect()} == {1, 3}


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        runtime.work_folder(Session())


def test_first_errors(spark):
    files = spark.createDataFrame([("b", "bad"), ("a", None), ("c", "worse")], "path string, error string")
    assert [tuple(r) for r in search.first_errors(files, 1).collect()] == [("b", "bad")]
