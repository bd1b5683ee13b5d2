"""Physical plans: whole texts stay where they are read; the index is read by its terms."""

import re

import pytest

import __spark_entry__ as entry
from tessera.operators import search as S

WITHOUT_TEXTS = ["ded_01_keep_richest", "ded_02_prefix_copies", "ded_04_upgrade_or_rename", "fts_04_bm25_columns", "srv_search_decisions", "scl_09_header_date", "scl_14_best_date", "scl_18_headnote", "scl_50_change_kind", "scl_62_embedding_text", "tvf_01_statutes", "tvf_15_summary_pairs"]


def exchanged(df):
    """The columns that the exchanges of a plan move."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\n(?:.*\n)*?Input \[\d+\]: \[([^\]]*)\]", plan)
    return {re.sub(r"#\d+L?$", "", x.strip()) for b in blocks for x in b.split(",")}


@pytest.mark.parametrize("name", WITHOUT_TEXTS)
def test_no_whole_text_is_moved(spark, data, name):
    assert not {"full_text", "content_text", "text"} & exchanged(entry.queries()[name](spark, data))


def test_resolution_reads_few_tables(spark, data):
    plan = entry.queries()["grf_02_resolve"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") < 10


def test_index_is_read_by_its_terms(spark, data):
    df = entry.queries()["fts_03_bm25"](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan and "places" not in plan.split("ReadSchema")[1]


DOCS = [("a", 1, "Das Gericht weist die Beschwerde ab"), ("a", 2, "anders"), ("b", 1, "Gericht Gericht"), ("c", 1, ""), ("d", 1, None)]


def test_index_against_a_plain_count(spark, tmp_path):
    df = spark.createDataFrame(DOCS, "id string, version int, t string")
    for _ in range(2):  # building again gives the same
        S.build_index(df, "id", ["t"], str(tmp_path / "i"), ["version"])
    index = S.open_index(spark, str(tmp_path / "i"))
    assert index.n == 4 and index.average == 8 / 4
    assert {(r["doc"], r["term"], r["tf"], r["len"]) for r in index.postings.where("term = 'gericht'").collect()} == {("a", "gericht", 1, 6), ("b", "gericht", 2, 2)}
    assert index.postings.where("term = 'anders'").count() == 0
    assert {(r["term"], r["df"]) for r in index.terms.where("field = '' and term in ('gericht', 'ab')").collect()} == {("gericht", 2), ("ab", 1)}
    assert [r["doc"] for r in S.bm25(index, ["gericht"]).orderBy("score").collect()] == ["b", "a"]
    assert [r["doc"] for r in S.match(index, S.parse('"die Beschwerde"')).collect()] == ["a"]
    assert S.match(index, S.parse("")).count() == 0


def test_empty_index(spark, tmp_path):
    S.build_index(spark.createDataFrame([], "id string, t string"), "id", ["t"], str(tmp_path / "e"))
    index = S.open_index(spark, str(tmp_path / "e"))
    assert index.n == 0 and S.bm25(index, ["x"]).count() == 0


def test_index_is_written_once_and_its_postings_are_not_shuffled(spark, tmp_path, monkeypatch):
    """a second copy and two shuffles of all postings took more disk than there is."""
    monkeypatch.setattr(S, "PIECE", 3)
    df = spark.createDataFrame([(i, f"b{i} a a, c", None if i % 2 else "a d") for i in range(9)], "id int, t string, u string").repartition(2)
    assert not exchanged(S.postings(df, "id", ["t", "u"])) & {"term", "places"}
    S.build_index(df, "id", ["t", "u"], str(tmp_path / "i"))
    assert not (tmp_path / "i" / "raw").exists()
    index = S.open_index(spark, str(tmp_path / "i"))
    got = {(r["doc"], r["field"], r["term"], r["tf"], tuple(r["places"]), r["len"]) for r in index.postings.collect()}
    assert got == {x for i in range(9) for x in [(i, "t", f"b{i}", 1, (0,), 4 + 2 * (i % 2 == 0)), (i, "t", "a", 2, (1, 2), 4 + 2 * (i % 2 == 0)), (i, "t", "c", 1, (3,), 4 + 2 * (i % 2 == 0))] + [(i, "u", "a", 1, (0,), 6), (i, "u", "d", 1, (1,), 6)] * (i % 2 == 0)}
    assert {(r["field"], r["df"], r["tf"]) for r in index.terms.where("term = 'a'").collect()} == {("t", 9, 18), ("u", 5, 5), ("", 9, 23)}
