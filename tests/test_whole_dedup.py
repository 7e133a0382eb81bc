import random

from archivolt.operators import conversations as conv


def test_hot_thread_keeps_what_strict_order_keeps(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(12):
        body = "".join(rng.choices("abcdefghij ", k=60))
        for _ in range(6):
            rows.append(("c", len(rows), body[: rng.choice([25, 45, 60])]))
            at = rng.randrange(50)
            body = body[:at] + "".join(rng.choices("klmnop", k=4)) + body[at + 4 :]
    df = spark.createDataFrame(rows, "conv string, n int, body string")
    kept = lambda hot: {r.n for r in conv.dedup_messages(df, "conv", ["n"], hot).collect()}
    assert kept(10) == kept(20_000)
