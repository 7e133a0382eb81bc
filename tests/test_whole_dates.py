from datetime import datetime

import __spark_entry__


def test_every_same_day_pair_counts(spark, tmp_path):
    rows = [("a", k, datetime(2010, 1, 1 + k // 4, 6 * (k % 4))) for k in range(12)] + [("b", 50, None)]
    spark.createDataFrame(rows, "folder string, msg_id bigint, date_ts timestamp_ntz").write.parquet(f"{tmp_path}/messages.parquet")
    got = {r.msg_id: r.n_within_day for r in __spark_entry__.queries()["same_date_counts"](spark, str(tmp_path)).collect()}
    assert got == {k: min(k, 3) for k in range(1, 12)}
