"""Repair of scanned texts on a small corpus."""

import pytest

from tessera.llm import scans as S

GOOD = "Die Beschwerde erweist sich in diesem Punkt als unbegründet und das Gericht weist sie ab ; Montclair-Dessus Kantons- und Gemeindesteuern procès-verbal Gemeinde theoretische circulait Überprüfung"
SCAN = "OBERGERICHT ZÜRICH\nDie Bcschwerde erwe1st sich in diesem Punkt als unbe-\n- 1 -\nOBERGERICHT ZÜRICH\ngründet. Das Gericlit weist sie ab, die Kantons-\nund Gerneindesteuern in Montclair-\nDessus und das procès-\nverbal.\n\nDie Über¬\nprüfung der fheoretische Seite 3\n                    - 2 -\nLB117672   Obergericht Zürich   3\nciiculait."


@pytest.fixture(scope="module")
def lex(spark):
    df = spark.createDataFrame([(GOOD,)] * 60 + [(SCAN,), (None,), ("",)], "full_text string")
    return S.lexicon(df, ["full_text"])


def test_repair(lex):
    whole, items = S.Repairer(lex).repair(SCAN, "LB117672")
    assert set(items) == {
        ("page", "- 1 -"), ("page", "- 2 -"), ("header", "OBERGERICHT ZÜRICH"), ("header", "LB117672   Obergericht Zürich   3"), ("hyphen", "unbegründet"), ("hyphen", "Überprüfung"),
        ("char", "Beschwerde"), ("char", "erweist"), ("char", "Gericht"), ("char", "Gemeindesteuern"), ("char", "theoretische"),
    }
    assert "Kantons- und Gemeindesteuern in Montclair-Dessus und das procès-verbal." in whole
    assert "\n" not in whole.split("\n\n")[0] and "OBERGERICHT" not in whole


def test_repairing_again_changes_nothing(lex):
    r = S.Repairer(lex)
    whole, _ = r.repair(SCAN, "LB117672")
    again, items = r.repair(whole, "LB117672")
    assert again == whole and items == []


def test_texts_without_pages_keep_their_letters(lex):
    r = S.Repairer(lex)
    text = "Die Bcschwerde\nvom 3. Mai\n7\nund mehr."
    whole, items = r.repair(text)
    assert items == [] and "Bcschwerde" in whole
    assert r.repair(None) == (None, []) and r.repair("") == ("", [])
    assert len(r.repair("Das Gericht weist sie ab\n" * 50_000)[0]) > 1_000_000


def test_table(spark, lex):
    df = spark.createDataFrame([("a", "LB117672", SCAN, None), ("a", "LB117672", SCAN, None), ("b", None, None, ""), (None, None, "Ge-\nmeinde", None)], "decision_id string, docket_number string, full_text string, content_text string")
    got = S.repairs(df, "decision_id", "docket_number", ["full_text", "content_text"], lex)
    assert got.where("decision_id = 'a'").count() == 11 and got.where("decision_id is null").first()["item"] == "Gemeinde"
    assert S.repairs(df.limit(0), "decision_id", "docket_number", ["full_text"], lex).count() == 0
    assert S.lexicon(df.limit(0), ["full_text"]).words == {}


@pytest.mark.parametrize("parts", [1, 6])
def test_pair_counts_do_not_depend_on_tasks(spark, parts):
    # every pair comes once in each text, so once in each task
    df = spark.createDataFrame([("eins zwei drei",)] * 6, "full_text string").repartition(parts)
    words, pairs, floor = S.counts(df, ["full_text"])
    assert floor == S.LEAST and words == {"eins": 6, "zwei": 6, "drei": 6}
    assert pairs == {("eins", "zwei"): 6, ("zwei", "drei"): 6}


def test_an_unknown_courts_header_goes(lex):
    """Neither court nor docket is known to the lexicon; the header comes back beside the page numbers."""
    text = "Die Beschwerde erweist sich in diesem Punkt\n- 1 -\nKantonsgericht Wallis\nals unbegründet und das\n- 2 -\nKantonsgericht Wallis\nGericht weist sie ab."
    whole, items = S.Repairer(lex).repair(text)
    assert set(items) == {("page", "- 1 -"), ("page", "- 2 -"), ("header", "Kantonsgericht Wallis")}
    assert whole == "Die Beschwerde erweist sich in diesem Punkt als unbegründet und das Gericht weist sie ab."


def test_headers_are_learned_from_the_corpus(spark):
    page = "Das Gericht weist sie ab\n{n}\nTribunal de Xville\nund mehr\n{m}\nTribunal de Xville\nund so."
    df = spark.createDataFrame([(page.format(n=n, m=n + 1),) for n in range(1, 7)] + [("Nur ein Text.",)], "t string")
    lex = S.lexicon(df.repartition(3), ["t"])
    assert lex.heads == {"tribunal de xville"}
    one = "Das Gericht\nTribunal de Xville   7\nweist sie ab.\nTribunal de Xville"
    assert set(S.Repairer(lex).repair(one)[1]) == {("header", "Tribunal de Xville   7"), ("header", "Tribunal de Xville")}


def test_letters_are_repaired_where_many_words_are_misread(lex):
    text = "Die Bcschwerde erwe1st sich als unbegriindet, das Gericlit weist sie ab."
    whole, items = S.Repairer(lex).repair(text)
    assert {("char", "Beschwerde"), ("char", "erweist"), ("char", "Gericht")} <= set(items) and "Beschwerde erweist" in whole


def test_a_corpus_and_its_double_are_repaired_alike(spark):
    rows = [(GOOD,)] * 60 + [(SCAN,)]
    once = S.lexicon(spark.createDataFrame(rows, "t string"), ["t"])
    twice = S.lexicon(spark.createDataFrame(rows * 2, "t string").repartition(5), ["t"])
    assert S.Repairer(once).repair(SCAN, "LB117672") == S.Repairer(twice).repair(SCAN, "LB117672")


def test_unknown_words_count_in_shares():
    """The least count that a repair by letters needs is the same share of all words, whatever the floor."""
    for floor in (4, 40, 400):
        lex = S.Lexicon({"Gericht": 20 * max(1, floor // 4), "andere": 10 * floor}, {}, floor)
        assert [w for w, _ in lex.candidates("Gerieht")] == ["Gericht"] or [w for w, _ in lex.candidates("Gericlit")] == ["Gericht"]
        assert S.Lexicon({"Gericht": 20 * max(1, floor // 4) - 1}, {}, floor).candidates("Gericlit") == []
