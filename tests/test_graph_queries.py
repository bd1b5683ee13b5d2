"""Deduplication queries on a small table."""

import __spark_entry__ as entry


def test_docket_report(spark, tmp_path):
    rows = [("a", "x", "1", "2020-01-01"), ("b", "x", "1", "2020-01-01"), ("b", "x", "1", "2020-01-01"), ("c", "y", "1", "2020-01-01"), ("d", "x", "1", "2020-01-02"), ("e", "x", "", "2020-01-01"), ("f", "x", "", "2020-01-01"), ("g", "x", "2", None), ("h", "x", "2", None), ("i", "x", "3", "2021-01-01"), ("i", "x", "3", "2021-01-01")]
    spark.createDataFrame(rows, "decision_id string, court string, docket_number string, decision_date string").write.parquet(f"{tmp_path}/decisions.parquet")
    assert [tuple(r) for r in entry.queries()["ded_10_docket_report"](spark, str(tmp_path)).collect()] == [("x", "1", "2020-01-01", 2, "a,b")]
