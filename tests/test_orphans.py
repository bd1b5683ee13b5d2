"""Orphan references on a small fixture, the Bloom filter, and the components."""

from datetime import datetime

from pyspark.sql import functions as F

from tessera.operators import orphans as O
from tessera.operators.bloom import Bloom
from tessera.operators.components import components

T0, T1 = datetime(2023, 1, 1), datetime(2023, 6, 1)


def test_keys(spark):
    cases = {
        "BGE 111 I 14": "bge111i14", "ATF 111-I-14": "bge111i14", "111 i 14": "bge111i14", "bge_111_I_14": "bge111i14", "GE / 2013 / 1629": "ge20131629", " 1C_2634/2012 ": "1c26342012", "1c.2634-2012": "1c26342012", "zh_obergericht_RU067897": "zhobergerichtru067897",
        "p. 786 ss": None, "Rz. 12": None, "cons. 4a": None, "act. 170": None, "": None, "  ": None, "doc. 9": None, "E. 5.2": None, "E-5012/2018": "e50122018", "R 17 7858": "r177858",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "r string").select("r", O.reference_key(F.col("r")).alias("k"))
    got = {r["r"]: r["k"] for r in df.collect()}
    assert got.pop(None) is None
    assert got == cases


def _tables(spark, decisions, register=(), removals=()):
    return (
        spark.createDataFrame(list(decisions), "decision_id string, docket_number string, scraped_at timestamp_ntz"),
        spark.createDataFrame(list(register), "bge_reference string, docket_number_2 string, decision_id string"),
        spark.createDataFrame(list(removals), "decision_id string, docket_number string"),
    )


def test_states(spark):
    tables = _tables(spark, [("a_1_2020", "1A_1/2020", T1), ("a_1_2020", "1A_1/2020", T0), ("b_2_2020", "1B_2/2020", T1), (None, None, None)], [("BGE 1 I 1", "1C_3/2020", "bge_1_I_1")], [("d_4_2020", "1D_4/2020"), ("a_1_2020", "1A_1/2020")])
    refs = spark.createDataFrame(
        [("t", "s", r, T0) for r in ("1a 1 2020", "1B_2/2020", "BGE 1 I 1", "dtf 1-i-1", "1C_3/2020", "1D_4/2020", "1E_5/2020", "Rz. 3", None, "")] + [("t", "s", "1E_5/2020", T0), ("t", "s", "1B_2/2020", None)], "table_name string, source_decision_id string, target_ref string, seen_at timestamp_ntz"
    )
    clashing = refs.selectExpr("*", "1 as key", "2 as since", "3 as status", "4 as maybe", "5 as state")
    got = {(r["target_ref"], r["ref_month"], r["status"]) for r in O.orphans(clashing, *tables).collect()}
    assert got == {("1B_2/2020", "2023-01", "late"), ("1D_4/2020", "2023-01", "deleted"), ("1E_5/2020", "2023-01", "missing")}


def test_empty_tables(spark):
    tables = _tables(spark, [])
    refs = spark.createDataFrame([], "table_name string, source_decision_id string, target_ref string, seen_at timestamp_ntz")
    assert O.orphans(refs, *tables).count() == 0
    one = spark.createDataFrame([("t", "s", "1E_5/2020", T0)], refs.schema)
    assert [r["status"] for r in O.orphans(one, *tables).collect()] == ["missing"]


def test_bloom_never_denies_a_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    b = Bloom(keys, "k")
    assert keys.where(~b.might_hold(F.col("k"))).count() == 0
    others = spark.range(5000, 10000).select(F.concat(F.lit("k"), "id").alias("k"))
    assert others.where(b.might_hold(F.col("k"))).count() < 250
    assert spark.createDataFrame([(None,)], "k string").select(b.might_hold(F.col("k")).alias("x")).first()["x"] is None


def test_components_chain_star_and_dirt(spark):
    links = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("hub", f"leaf{i}") for i in range(200)] + [("x", "x"), ("y", None), (" ", "z"), ("n010", "n009"), ("n010", "n009")]
    df = spark.createDataFrame(links, "a string, b string")
    got = {r["node"]: r["root"] for r in components(df, "a", "b").collect()}
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert {got[f"leaf{i}"] for i in range(200)} == {"hub"}
    assert (got["x"], got["y"], got["z"]) == ("x", "y", "z")
    assert components(df.limit(0), "a", "b").count() == 0
