"""Language: held-out accuracy, mixed texts, labels in other notations, rejection."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import language as L

PARTS = {
    "de": "Die Vorinstanz erwog, dass der Mangel sofort nach der Ablieferung angezeigt wurde und die Frist unbenutzt ablief.",
    "fr": "L'instance précédente a considéré que le défaut a été signalé aussitôt après la livraison et que le délai est échu.",
    "it": "L'istanza inferiore ha considerato che il difetto è stato notificato subito dopo la consegna e il termine è scaduto.",
    "en": "The court below held that the defect was notified immediately after delivery and that the time limit expired unused.",
}


@pytest.fixture(scope="module")
def model(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/decisions.parquet")
    return L.fit(df, "decision_id", "language", "full_text")


def _run(spark, model, rows):
    df = spark.createDataFrame(rows, "decision_id string, language string, full_text string")
    return L.segments(df, "decision_id", "language", "full_text", model)


def test_held_out_accuracy(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.001/decisions.parquet").where("language in ('de', 'fr', 'it', 'rm', 'en')")
    whole = L.segments(df, "decision_id", "language", "full_text", model).where("seg = -1")
    assert whole.where("main = named").count() / whole.count() > 0.9  # about five of a hundred labels are wrong


def test_segments_and_labels(spark, model):
    text = "\n\n".join([PARTS["de"] * 2, PARTS["fr"], PARTS["de"], "Rue 5", PARTS["it"], "Verena Krumegger\nRue des Noyers 5\n1234 Rivabella, Vauxbelle, Prélongin"])
    rows = [("a", "deu", text), ("b", "fr", text), ("c", None, text), ("d", " DE-ch", text), ("e", "unknown", PARTS["en"]), ("f", "de", None), ("g", "de", ""), ("h", "fr", "kurz")]
    found = _run(spark, model, rows)
    got = {(r["id"], r["seg"], r["lang"]) for r in L.corrections(found).collect()}
    want = {(i, 1, "fr") for i in "abcd"} | {(i, 4, "it") for i in "abcd"} | {("b", -1, "de"), ("c", -1, "de"), ("e", -1, "en")}
    assert got == want
    assert all(0 <= r["confidence"] <= 1 for r in found.collect())


def test_gibberish_is_rejected_or_unsure(spark, model):
    r = _run(spark, model, [("x", "de", "zzxq wvvk qqpt jjkx " * 20)]).where("seg = -1").first()
    assert r["lang"] is None or r["confidence"] < 0.99


def test_labels(spark):
    cases = {"de": "de", " FR": "fr", "it-CH": "it", "roh": "rm", "eng": "en", "Deutsch": "de", "": None, "und": None, "None": None, "unknown": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", L.label(F.col("x")).alias("y"))
    assert {r["x"]: r["y"] for r in df.collect()} == cases


def test_no_labels_reject_all(spark):
    df = spark.createDataFrame([("a", None, PARTS["de"])], "decision_id string, language string, full_text string")
    m = L.fit(df, "decision_id", "language", "full_text")
    assert L.segments(df, "decision_id", "language", "full_text", m).where("lang is not null").count() == 0
    assert L.segments(df.limit(0), "decision_id", "language", "full_text", m).count() == 0


def test_without_confidence_nothing_is_corrected(spark):
    df = spark.createDataFrame([("a", None, PARTS["de"])], "decision_id string, language string, full_text string")
    m = L.fit(df, "decision_id", "language", "full_text")
    assert L.corrections(L.segments(df, "decision_id", "language", "full_text", m)).count() == 0


def test_a_rare_language_is_drawn_whole(spark):
    """Eight of four thousand labelled texts are French; all of them train, and the model knows the language."""
    rows = [(f"d{n}", "de", f"{PARTS['de']} {n}") for n in range(4000)] + [(f"f{n}", "fr", f"{PARTS['fr']} {n}") for n in range(8)]
    m = L.fit(spark.createDataFrame(rows, "decision_id string, language string, full_text string"), "decision_id", "language", "full_text")
    assert _run(spark, m, [("x", None, PARTS["fr"])]).where("seg = -1").first()["main"] == "fr"
