"""Residue: known records, texts that quote it, empty texts; on the test data both sides are told apart."""

import pytest

from tessera.llm import residue as R


@pytest.fixture(scope="module")
def model(spark):
    return R.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id", "text")


REAL = "Die Vorinstanz erwog, dass der Mangel sofort nach der Ablieferung angezeigt wurde. Die Beschwerde erweist sich in diesem Punkt als unbegründet."
JUNK = [
    "Urteil vom {{ judge }}\nGeschäfts-Nr. [inserire docket]\n\n%BODY% gegen XXcourt_nameXX\n\nDas Gericht zieht in Erwägung:\n{{ amount }}",
    "TODO TODO TODO TODO TODO TODO TODO TODO", "Fehler 500\nLe document demandé n'est plus disponible à cette adresse.\nVorgangsnummer b27a810f7a3d9",
    "Bitte aktivieren Sie JavaScript in Ihrem Browser, um die Entscheide anzuzeigen.", "Startseite | Rechtsprechung | Suche | Kontakt\nYou need to enable JavaScript to run this app.\nMenu\nDE FR IT RM",
]
GOOD = [
    REAL, f"{REAL}\n\nBitte aktivieren Sie JavaScript in Ihrem Browser, um die Entscheide anzuzeigen.", f"© Gerichtsportal\n{REAL}",
    f"{REAL}\n\nDas Formular enthielt den Platzhalter {{{{name}}}}, den D.________ nie ausgefüllt hatte; darin liegt keine Willenserklärung.", None, "", " \n\t ",
]


@pytest.mark.parametrize("text", JUNK)
def test_residue(model, text):
    assert model.residue([text])[0][0]


@pytest.mark.parametrize("text", GOOD)
def test_text(model, text):
    assert not model.residue([text])[0][0]


def test_batches_do_not_matter(model):
    together = model.residue(JUNK + GOOD)[1]
    assert together.tolist() == [model.residue([t])[1][0] for t in JUNK + GOOD]


def test_table(spark, model):
    df = spark.createDataFrame(list(enumerate(JUNK + GOOD + [REAL * 5000])), "doc_id bigint, text string").selectExpr("*", "1 as residue", "2 as odds")
    got = {r["doc_id"]: r["residue"] for r in R.score(df, "doc_id", "text", model).collect()}
    assert [i for i, x in got.items() if x] == list(range(len(JUNK))) and len(got) == len(JUNK + GOOD) + 1
    assert R.score(df.limit(0), "doc_id", "text", model).count() == 0


def test_nothing_trusted_means_nothing_found(spark):
    df = spark.createDataFrame([(1, REAL), (2, None)], "doc_id bigint, text string")
    assert not R.fit(df, "doc_id", "text").residue(JUNK)[0].any()
    assert not R.fit(df.limit(0), "doc_id", "text").residue(JUNK)[0].any()


def test_records_without_their_cues_are_found(spark, model, monkeypatch):
    """With every second cue left out nearly all records are found that all cues find, and hardly others: the words around tell them."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = lambda m: {r["doc_id"] for r in R.score(df, "doc_id", "text", m).where("residue").collect()}
    every = found(model)
    monkeypatch.setattr(R, "CUES", R.CUES[::2])
    some = found(R.fit(df, "doc_id", "text"))
    assert len(every & some) >= 0.9 * len(every) and len(some - every) <= 0.02 * len(every)


def test_slots_of_other_shapes(model):
    assert model.residue(["Sehr geehrte << Vorname >> << Nachname >>\n<< Adresse >>"])[0][0]
