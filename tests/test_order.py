"""Sorted jobs: the row sequence equals the oracle's ORDER BY sequence."""

import pytest

import __spark_entry__ as entry
from harness import norm

SORTED = ["srt01_sort_asc_desc", "srt02_multi_key_mixed", "srt03_desc_nulls_last", "srt05_top_k",
          "job16_record_counts", "job17_avg_ping_window", "job18_user_summary", "job09_abandoned_items",
          "job02_top_traffic_sources"]


@pytest.mark.parametrize("name", SORTED)
def test_row_order(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    cols = df.columns
    got = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    sql = entry.oracle_sql()[name]
    if name == "job02_top_traffic_sources":
        sql = f"SELECT * FROM ({sql}) ORDER BY total_rev DESC, traffic_source"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = [tuple(norm(row[names.index(c)]) for c in cols) for row in rel.fetchall()]
    assert got == want
