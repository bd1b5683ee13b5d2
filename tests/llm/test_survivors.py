"""Survivors against a plain computation, with ties, dirt and empty tables."""

from datetime import datetime

from tessera.llm import survivors as S

D = "decision_id string, title string, regeste string, full_text string, judges string, pdf_url string, source string, scraped_at timestamp_ntz"
T = [datetime(2023, 1, n) for n in range(1, 9)]


def _found(spark, decisions, links, sources=(("s1", 1), ("s2", 2))):
    d = spark.createDataFrame(list(decisions), D)
    li = spark.createDataFrame(list(links), "canonical_decision_id string, member_decision_id string")
    so = spark.createDataFrame(list(sources), "source string, trust_rank int")
    return {(r["group_id"], r["field_name"]): r["decision_id"] for r in S.winners(S.ballots(d, li, so)).collect()}, (d, li, so)


def test_rules(spark):
    rows = [
        ("b", "old", "n/a", "long text", "J2", " ", "s2", T[0]),
        ("c", "new", "head", "longer text", "J1", "u", "s1", T[1]),
        ("c", "", None, "longer text", "J1", "u", "s1", T[5]),  # a later repetition does not count
        ("d", "None", "head", "longer-text", "J1b", None, "s1", T[1]),
        ("z", "alone", "-", "x", None, None, "s9", T[2]),
        ("q", "unlinked", "x", "x", "x", "x", "s1", T[7]),
    ]
    got, tables = _found(spark, rows, [("c", "b"), ("c", "gone"), ("gone", "d"), ("c", "c"), ("c", "b"), ("z", "z"), ("none", "none2"), (None, "b")])
    assert got == {("b", "full_text"): "c", ("b", "title"): "c", ("b", "regeste"): "c", ("b", "judges"): "c", ("b", "pdf_url"): "c", ("z", "title"): "z", ("z", "full_text"): "z"}
    wide = {r["group_id"]: r for r in S.records(*tables).collect()}
    assert wide["b"]["full_text"] == "longer text" and wide["b"]["judges"] == "J1" and wide["z"]["judges"] is None


def test_support_is_a_share_of_votes(spark):
    rows = [(i, "same" if i != "e" else "other", None, None, None, None, "s1", T[0]) for i in "abcde"]
    d = spark.createDataFrame(rows, D)
    li = spark.createDataFrame([("a", x) for x in "bcde"], "canonical_decision_id string, member_decision_id string")
    so = spark.createDataFrame([("s1", 1)], "source string, trust_rank int")
    w = S.winners(S.ballots(d, li, so)).where("field_name = 'title'").first()
    assert (w["decision_id"], round(w["support"], 6)) == ("a", 0.8)


def test_empty(spark):
    assert _found(spark, [], [])[0] == {}
    assert _found(spark, [("a", "t", None, None, None, None, "s1", T[0])], [])[0] == {}
    assert _found(spark, [("a", "t", None, None, None, None, None, None)], [("a", "a")])[0] == {("a", "title"): "a"}


def test_a_rule_outweighs_all_other_votes(spark):
    """The newest title stands against forty older equal ones; without a rule these win."""
    rows = [(f"m{n:02d}", "common" if n else "newest", None, None, None, None, "s1", T[0] if n else T[7]) for n in range(41)]
    d = spark.createDataFrame(rows, D)
    li = spark.createDataFrame([("m00", f"m{n:02d}") for n in range(1, 41)], "canonical_decision_id string, member_decision_id string")
    so = spark.createDataFrame([("s1", 1)], "source string, trust_rank int")
    votes = S.ballots(d, li, so).where("field_name = 'title'")
    assert [r["value"] for r in S.winners(votes).collect()] == ["newest"]
    free = votes.withColumn("first", S.F.lit(None).cast("bigint")).withColumn("second", S.F.lit(None).cast("bigint"))
    assert [(r["value"], r["decision_id"]) for r in S.winners(free).collect()] == [("common", "m01")]
