"""Personal data: texts with known pieces, redaction, empty and long texts."""

import pytest

from tessera.llm import pii

CASES = [
    ("Bitte an reto+akten@netz.example.org schreiben.", {("email", "reto+akten@netz.example.org")}),
    ("E-Mail: BEAT.ROHRHAUEN @ POST-FACH.EXAMPLE und krumtorf[at]mail.example.", {("email", "BEAT.ROHRHAUEN @ POST-FACH.EXAMPLE"), ("email", "krumtorf[at]mail.example")}),
    ("Das Zeichen @ im Firmennamen ist nicht unterscheidungskräftig.", set()),
    ("Natel 059/573 77 25, Tel. +41 (0)69 505 43 62, 0041 59 419 14 77 und +41505091127.", {("phone", "059/573 77 25"), ("phone", "+41 (0)69 505 43 62"), ("phone", "0041 59 419 14 77"), ("phone", "+41505091127")}),
    ("im Verfahren 300 2001 7606 über Fr. 18'747.-- (LB117672, 35.2013.3122, BGE 070 I 312)", set()),
    ("Die Nummer 756.4601.1183.26 ist eine, 756.4601.1183.27 ist keine.", {("id_number", "756.4601.1183.26")}),
    ("(AHV-Nr. 508.83.271.127), UID CHE-340.111.222", {("id_number", "508.83.271.127")}),
    ("mit dem Reisepass C331P7817 und dem Ausweis Nr. S8100060, im Verfahren PS182020", {("id_number", "C331P7817"), ("id_number", "S8100060")}),
    ("Zustelladresse: Alte Säumerstrasse 67a, 5099 Crapteig.", {("address", "Alte Säumerstrasse 67a")}),
    ("an der Adresse Rebenrain 10, 4099 Altmatten, sowie Obere Gasse 3", {("address", "Rebenrain 10"), ("address", "Obere Gasse 3")}),
    ("devant le 82, avenue des Grands-Prés à Crapteig, chemin de l'Orge 53", {("address", "82, avenue des Grands-Prés"), ("address", "chemin de l'Orge 53")}),
    ("Via ai Castagni 96, Salita al Mulino 57\nDie Parzelle Nr. 12 am Rebbergweg ist frei; la parcelle à la route de la Combe n'est pas bâtie.", {("address", "Via ai Castagni 96"), ("address", "Salita al Mulino 57")}),
    ("Gemäss Ursina Montabris-Bramhauen war Richter Krumegger krank.", {("name", "Ursina Montabris-Bramhauen")}),
    ("Die Rechnung ist auf ISCHEGGER Thierry ausgestellt, nicht auf Jürg von Kräbühl.", {("name", "ISCHEGGER Thierry"), ("name", "Jürg von Kräbühl")}),
    ("Freundliche Grüsse\nEwislacher, Jürg\nS. Quelllacher\nTreuhand Krumegger GmbH", {("name", "Ewislacher, Jürg"), ("name", "S. Quelllacher")}),
    ("Selon Trüblacher, in: Kommentar, N 67", set()),
]


@pytest.mark.parametrize("text, pieces", CASES)
def test_pieces(text, pieces):
    assert {(k, text[a:b]) for a, b, k in pii.find(text)} == pieces


#: Names that no list of the operator holds, in the places where texts have them.
OTHERS = "Xaver Zgraggen;Kreszenz Aufdermauer;Ottokar Imfeld;Fulvia Rezzonico;Ambrogio Quattropani;Gwendoline Bochatay;Ignace Pittet;Duri Cavelti;Seraina Tönz;Wilhelmina Thorne".split(";")
FRAMES = ["Der Zeuge {} sagte aus.", "Mme {} a été entendue.", "La signora {} è stata sentita.", "Freundliche Grüsse\n{}\nTel.", "Urteil:\n{}\nLindenweg 7\n8000 Zürich", "Herr {} wohnt dort.", "Mr. {} appealed."]


@pytest.mark.parametrize("frame", FRAMES)
def test_names_outside_the_list(frame):
    assert not {n.split()[0] for n in OTHERS} & set(pii.GIVEN)
    for name in [*OTHERS, "Hans Müller", "Sophie Dupont", "Thomas Weber"]:
        text = frame.format(name)
        assert name in {text[a:b] for a, b, k in pii.find(text) if k == "name"}


@pytest.mark.parametrize(
    "text, names",
    [
        ("Gemäss Hans Müller war Frau Sandra Keller mit H. Meier dort.", {"Hans Müller", "Sandra Keller", "H. Meier"}),
        ("Kontakt: Emma Thompson, Martin O'Neill und John van der Berg.", {"Emma Thompson", "Martin O'Neill", "John van der Berg"}),
        ("Im Fall Peter Muster AG, BGE 120 II 5, Richter Meier; Mme la Juge Favre, M. le Juge Rochat", set()),
        ("A. Streitig ist die Sache.\nB. Beschwerde wird erhoben.", set()),
    ],
)
def test_names_by_shape(text, names):
    assert {text[a:b] for a, b, k in pii.find(text) if k == "name"} == names


def test_learns_given_names_and_common_words(spark):
    """Names that stand in telling places teach the operator to find them anywhere, whatever the partitions."""
    rows = [(FRAMES[i % len(FRAMES)].format(n) + " Gemäss Streitwert bleibt der Streitwert.",) for i in range(21) for n in OTHERS]
    df = spark.createDataFrame(rows, "t string")
    one, many = pii.learn(df.repartition(1), "t"), pii.learn(df.repartition(7), "t")
    assert one.given == many.given and one.common == many.common
    assert {n.split()[0] for n in OTHERS} <= one.given and "Streitwert" in one.common
    for n in OTHERS:
        given, family = n.split()
        text = f"Auf {n} ausgestellt, an {family}, {given} und {family.upper()} {given}. A. Streitwert: keiner."
        assert {text[a:b] for a, b, _ in pii.find(text, one)} == {n, f"{family}, {given}", f"{family.upper()} {given}"}
    assert pii.learn(df.limit(0), "t").common == frozenset()


def test_no_windows():
    long = "a" * 300 + "@b.example"
    assert pii.find(f"x {long}") == [(2, 2 + len(long), "email")]
    far = "Reisepass " + "und wieder " * 50 + "C331P7817"
    assert [far[a:b] for a, b, _ in pii.find(far)] == ["C331P7817"]


def test_redaction():
    assert pii.redact("Gemäss Urs Gamsstaller, 070 790 04 93, an a@b.example.") == "Gemäss [NAME], [PHONE], an [EMAIL]."
    assert pii.redact(None) is None and pii.redact("") == "" and pii.redact("ohne") == "ohne"
    once = pii.redact(CASES[3][0])
    assert pii.redact(once) == once


def test_very_long_text():
    assert len(pii.find("ohne Daten " * 200_000 + " a@b.example")) == 1


def test_table(spark):
    rows = [("1", "Tel. 070 790 04 93"), ("1", "Tel. 070 790 04 93"), ("2", None), ("3", ""), (None, "a@b.example")]
    df = spark.createDataFrame(rows, "id string, t string").selectExpr("*", "1 as pii_type", "2 as text")
    assert {tuple(r) for r in pii.find_all(df, "id", "t").collect()} == {("1", "phone", "070 790 04 93"), (None, "email", "a@b.example")}
    assert pii.find_all(df.limit(0), "id", "t").count() == 0
    assert [r["t"] for r in pii.redact_all(df, "t").collect()].count("Tel. [PHONE]") == 2


def test_numbered_placeholders():
    text = "Hans Müller (a@b.example) und Sandra Keller; Hans Müller, c@d.example."
    assert pii.redact(text, numbered=True) == "[NAME_1] ([EMAIL_1]) und [NAME_2]; [NAME_1], [EMAIL_2]."


def test_initials_at_lines_and_behind_abbreviations():
    cases = {
        "Freundliche Grüsse\nH. Zgraggen» Er war dort.": {"H. Zgraggen"}, "in Sachen\nS. Zgraggen Er wies sich aus.": {"S. Zgraggen"}, "nach Art. 4 RPG. M. Zgraggen ist der Halbbruder.": {"M. Zgraggen"},
        "Text.\n\nA. Zgraggen wohnt dort.": set(), "J. P. Zgraggen, J.-P. Imfeld": {"J.-P. Imfeld"}, "Mit J. P. Zgraggen kam er.": {"J. P. Zgraggen"},
    }
    for text, names in cases.items():
        assert {text[a:b] for a, b, k in pii.find(text) if k == "name"} == names, text
