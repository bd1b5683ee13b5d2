"""Extraction queries over whole tables against brute force."""

import re

import pytest

import __spark_entry__ as entry
from tessera.functions import extract as E


def run(spark, folder, query, table, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
    return [tuple(r) for r in entry.queries()[query](spark, str(folder)).collect()]


def test_all_statutes(spark, tmp_path):
    texts = [
        "Nach Art. 41 Abs. 1 OR und Art. 8 ZGB, Art. 5 Abs. 1bis lit. a StPO sowie Artikel 12 Absatz 3 AIG.", "l'art. 13 al. 2 CC, art. 9 Cst et art. 29 al. 1 LTF", "giusta l'art. 16 cpv. 4 CC e l'art. 58 cpv. 3 CP", "Art. 6 ff. OR, Art. 28a ZGB, Art. 7 Ziff. 2 EMRK",
        "art. 4 al. 1 CF tenor la dretgira; Art. 5 der Verfassung, Art. 41 Abs. 1 OR und Art. 41 Abs. 1 OR", "Nichts.", None, "",
    ]
    got = run(spark, tmp_path, "tvf_01_statutes", "documents", list(enumerate(texts)), "doc_id bigint, text string")
    want = {
        0: ["ART.41.ABS.1.OR", "ART.8.ZGB", "ART.5.ABS.1bis.STPO", "ART.12.ABS.3.AIG"], 1: ["ART.13.ABS.2.CC", "ART.9.CST", "ART.29.ABS.1.LTF"], 2: ["ART.16.ABS.4.CC", "ART.58.ABS.3.CP"],
        3: ["ART.6.OR", "ART.28a.ZGB", "ART.7.EMRK"], 4: ["ART.4.ABS.1.CF", "ART.41.ABS.1.OR"],
    }
    assert sorted((r[0], r[-1]) for r in got) == sorted((i, n) for i, names in want.items() for n in names)
    for _, law, article, paragraph, name in got:
        assert name == f"ART.{article}" + (f".ABS.{paragraph}" if paragraph else "") + f".{law}"


PROVISIONS = {
    "Art. 10 BV und Art. 36 Abs. 3 ZPO": {"ART.10.BV", "ART.36.ABS.3.ZPO"},
    "art. 9 al. 4 CEDH, Art. 7 cpv. 3 LPGA": {"ART.9.ABS.4.CEDH", "ART.7.ABS.3.LPGA"},
    "Art. 8bis BV, Art. 34ter BV, Art. 8 Abs. 2bis BV": {"ART.8bis.BV", "ART.34ter.BV", "ART.8.ABS.2bis.BV"},
    "Art. 5 Abs. 1 lit. a Ziff. 2 StPO": {"ART.5.ABS.1.STPO"},
    "Artikel 97 CO, art. 97 al. 2 CO": {"ART.97.CO", "ART.97.ABS.2.CO"},
    "Art. 12 Abs. 3 und 4; art. 3 du règlement; Art. 8 al. Zürich; Art. 4 Oder": set(),
}


def test_forms_of_provisions(spark):
    df = spark.createDataFrame([(t,) for t in [*PROVISIONS, None]], "t string").select("t", E.statutes(E.F.col("t")).alias("r"))
    got = {r["t"]: r["r"] and {x["normalised"] for x in r["r"]} for r in df.collect()}
    assert got.pop(None) is None
    assert {t: x or set() for t, x in got.items()} == PROVISIONS


def test_forms_of_citations(spark):
    text = "Vgl. BGE 147 I 268, ATF 120 II 5 sowie Urteil 1A.122/2005, VB.2018.00411 und 99 III 7; dtf 130 V 2."
    got = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(E.citations(E.F.col("t")).alias("r")).collect()
    assert {(x["kind"], x["normalised"]) for x in got[0]["r"]} == {("bge", "BGE 147 I 268"), ("bge", "BGE 120 II 5"), ("bge", "BGE 130 V 2"), ("docket", "1A_122_2005"), ("docket", "VB_2018_00411"), ("docket", "99 III 7")}
    assert not got[1]["r"] and not got[2]["r"]


DECISIONS = "decision_id string, docket_number string, full_text string, regeste string"
ROWS = [
    ("a", "4A_1/2020", "Urteil 4A_1/2020, 4A_2/2020 und 4A_3/2020 vom 1. Mai 2021\nBeschwerde gegen das Urteil des Obergerichts Zürich vom 3. Mai 2020 (LB117672).\nSachverhalt:\nA. Siehe (" + "vgl. dazu ausführlich und mit weiteren Hinweisen auf die Lehre und die Praxis der Gerichte " * 2 + ", SBK.2025.285).", "Mietrecht (E. 2.1, 3-5 und 7)."),
    ("b", "4A_9/2020", "Urteil 4A_9/2020 vom 1. Mai 2021\nrecours contre l'arrêt de la Cour de justice Genève du 2 mars 2019 (A/1168/2024 et 35.2024.77). Fassung gemäss AS 2013 4417 (BBl 2001 II 33).", "Bail (consid. 4.2–4.4)."),
    ("c", "4A_9/2020", "4A_1/2020, 4A_2/2020. AS 2013 4417 und AS 2013 4417. Nichts (nichts).", "nichts (E. x) (E. 1-90)"),
    ("d", None, None, None),
]
WANTED = {
    "tvf_03_all_prior_instances": [("a", "LB117672"), ("b", "A/1168/2024"), ("b", "35.2024.77")],
    "tvf_04_dockets_in_brackets": [("a", "LB117672"), ("a", "SBK.2025.285"), ("b", "A/1168/2024"), ("b", "35.2024.77")],
    "tvf_06_joined_dockets": [("a", "4A_1/2020"), ("a", "4A_2/2020"), ("a", "4A_3/2020")],
    "tvf_21_paragraph_hints": [("a", "2.1"), ("a", "3"), ("a", "4"), ("a", "5"), ("a", "7"), ("b", "4.2"), ("b", "4.3"), ("b", "4.4")],
    "scl_36_appealed": [("a", "LB117672"), ("b", "A/1168/2024 et 35.2024.77")],
}


@pytest.mark.parametrize("query", WANTED)
def test_real_rows_of_decisions(spark, tmp_path, query):
    got = run(spark, tmp_path, query, "decisions", ROWS, DECISIONS)
    assert sorted((r[0], r[-1]) for r in got) == sorted(WANTED[query])


def test_amendments_of_both_tables(spark, tmp_path):
    spark.createDataFrame([(7, "modifié, RO 2019 1234"), (8, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = run(spark, tmp_path, "tvf_19_amendments", "decisions", ROWS, DECISIONS)
    assert sorted(r[:5] for r in got) == [("decisions", "b", "dispatch", "2001", "33"), ("decisions", "b", "law", "2013", "4417"), ("decisions", "c", "law", "2013", "4417"), ("decisions", "c", "law", "2013", "4417"), ("documents", "7", "law", "2019", "1234")]


def test_literal_rows():
    assert E.dockets_in_brackets("A/1168/2024 und 35.2024.77") == ["A/1168/2024", "35.2024.77"] and E.dockets_in_brackets("nichts") == []
    assert E.dockets_in_brackets("4A_291/2017, LZ250038") == ["4A_291/2017", "LZ250038"]
    assert E.joined_dockets("Urteil 4A_1/2020 vom", "4A_1/2020") == [] and E.joined_dockets("4A_1/2020, 4A_2/2020", "4A_9/2020") == []
    assert E.paragraph_hints("Mietrecht (E. 2.1, 3-5 und 7).") == ["2.1", "3", "4", "5", "7"] and E.paragraph_hints("(E. 1-90)") == []
