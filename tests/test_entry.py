"""The registry, and a few queries against their SQL on the smallest tables."""

import glob
import os

import pytest

TABLES = "/root/testdata/sf0.001"


def test_registry():
    import __spark_entry__

    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries)
    assert {"p4_found", "keyword_context", "link_edges", "capped_clusters"} <= set(queries)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables here")
@pytest.mark.parametrize("name", ["keyword_hits", "keyword_context", "clean_text", "doc_type", "normalize_body", "crawl_dedup", "same_date_interval_join", "conversation_numbering", "thread_messages", "main_body", "quoted_message", "sort_messages", "dedup_messages", "dedup_containment", "link_edges", "conversation_markdown", "subject_similarity", "indel_ratio", "parse_dates"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__

    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = __spark_entry__.queries()[name](spark, TABLES)
    want = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda found: sorted(tuple(map(str, r)) for r in found)
    assert rows(got.select(*columns).collect()) == rows(want.fetchall())
