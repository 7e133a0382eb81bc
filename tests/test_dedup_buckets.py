import random

from archivolt.operators import conversations as conv


def test_groups_of_a_bucket_keep_what_strict_order_keeps(spark):
    rng = random.Random(8)
    rows = []
    for g in range(30):
        body = "".join(rng.choices("abcdefghij", k=60))
        for n in range(rng.randrange(1, 8)):
            rows.append((f"g{g}", rng.choice([n, None]), body if n % 3 else body[: rng.choice([25, 45])] + "".join(rng.choices("klm", k=rng.choice([0, 30])))))
    want, kept = set(), {}
    for g, n, body in sorted(set(rows), key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2])):
        if not conv.is_duplicate(body, kept.setdefault(g, [])):
            kept[g].append(body)
            want.add((g, body))
    df = spark.createDataFrame(rows, "g string, n int, norm string").distinct()
    for buckets in (1, 7):
        assert {(r.g, r.norm) for r in conv.greedy_keep(df, "g", ["n"], buckets).collect()} == want
