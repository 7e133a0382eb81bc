import random

from archivolt.operators import conversations as conv


def test_small_and_large_groups_give_the_same_parts(spark):
    rng = random.Random(4)
    rows = [("g", "".join(rng.choices("abcd ", k=300))) for _ in range(6)]
    rows += [("g", s[at : at + n]) for _, s in rows[:6] for at, n in ((0, 21), (37, 30), (100, 180), (5, 20))] + [("h", rows[0][1]), ("h", rows[0][1][:40]), ("i", rows[0][1][:50]), (None, rows[0][1][:60])]
    df = spark.createDataFrame(rows, "t string, norm string")
    want = {(g, a, b) for g, a in rows for h, b in rows if g and g == h and a != b and len(a) > 20 and a in b}
    for small in (64, 2, 1):
        got = [tuple(r) for r in conv.contained_pairs(df, "t", small).select("t", "a", "b").collect()]
        assert len(got) == len(set(got)) and set(got) == want
