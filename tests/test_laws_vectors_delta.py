"""Law texts, harvests, vectors, deltas and orders against hand-made cases, with nulls, broken and empty input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import documents as D
from tessera.functions import extract as E
from tessera.functions import text as T
from tessera.operators import aggregates as A
from tessera.operators import delta, dedup, joins
from tessera.operators import quality as Q
from tessera.operators import vectors as V
from tessera.sources import laws as L
from tessera.sources import readers


def test_xml_text_and_dispatches():
    assert L.xml_text("<a>x<footnote>n</footnote> y\x01</a>") == "x y" and L.xml_text("<a") is None and L.xml_text(None) is None
    xml = "<d><heading>Teil</heading><s><heading>Art. 5a Zweck</heading><p>Text<authorialNote>n</authorialNote></p><p> </p></s><p>Ende</p></d>"
    assert L.dispatch_paragraphs(xml) == [{"path": "Teil / Art. 5a Zweck", "anchor": "5a", "text": "Text"}, {"path": "Teil", "anchor": None, "text": "Ende"}]
    assert L.dispatch_paragraphs("") == [] and L.dispatch_paragraphs("kein XML") == []


def test_segmentation():
    text = "Gesetz\nArt. 1 Zweck\nDieses Gesetz\nregelt.\n Art. 2bis\nText.\n§ 3 gilt, was folgt:\nmehr"
    assert L.segmented(text) == [{"number": "1", "heading": "Zweck", "text": "Dieses Gesetz\nregelt."}, {"number": "2bis", "heading": None, "text": "Text."}, {"number": "3", "heading": None, "text": "gilt, was folgt:\nmehr"}]
    assert L.segmented(None) == [] and L.segmented("nichts") == []


def test_html_article():
    page = "<div><article id='art_5'><h1>A &amp; B</h1> Text</article><article id='art_55'>anders</article></div>"
    assert L.html_article(page, "5") == "A & B Text" and L.html_article(page, "6") is None and L.html_article(None, "5") is None


def test_harvest_pages():
    records, token, deleted = L.oai_records("<r><record><header status='deleted'/></record><record><header><identifier>1</identifier></header><m><title>a\x0b</title><title>b</title></m></record><resumptionToken>7</resumptionToken></r>")
    assert (records, token, deleted) == ([{"identifier": "1", "title": "a; b"}], "7", 1)
    assert L.oai_records("broken <") == ([], None, 0)


def test_pdf_pages():
    assert L.pdf_pages(b"<< /L 1 >>\nstream\nBT (a \\(b\\)) Tj T* [(c) -2 (d)] TJ ET\nendstream") == ["a (b)\ncd"]
    assert L.pdf_pages(None) == [] and L.pdf_pages(b"<< /Filter /FlateDecode >>\nstream\nbroken\nendstream") == []


def test_encoding_keeps_order_and_skips_blanks(spark):
    seen = []

    def encoder(texts):
        assert [len(t) for t in texts] == sorted(len(t) for t in texts) and len(texts) <= 3
        return np.array([[len(t)] for t in texts])

    rows = [(i, "x" * (i * 7 % 11)) for i in range(40)] + [(99, None), (98, "  ")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {r["id"]: r["vector"][0] for r in V.encode(df, "id", "t", encoder, batch=3).collect()}
    assert got == {i: float(len(t)) for i, t in rows if t and t.strip()} and seen == []
    done = df.where("id < 20").select("id")
    assert {r["id"] for r in V.build(df, "id", "t", encoder, done=done, batch=3).collect()} == {i for i in got if i >= 20}
    assert V.encode(df.limit(0), "id", "t", encoder).count() == 0


def test_packing_and_quantising(spark):
    df = spark.createDataFrame([([1.5, -2.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    assert [r["u"] for r in df.select(V.unpack(V.pack(F.col("v"))).alias("u")).collect()] == [[1.5, -2.0], [0.0, 0.0], None]
    q = [r["q"] for r in df.where("v is not null").select(V.quantised(F.col("v")).alias("q")).collect()]
    assert [list(x["codes"]) for x in q] == [[95, -127], [0, 0]]


def test_hybrid_modes(spark):
    lexical = spark.createDataFrame([(1, 1), (2, 2)], "doc int, rank int")
    dense = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (5, 4)], "doc int, rank int")
    signal = {r["doc"]: r["score"] for r in V.hybrid(lexical, dense, "signal").collect()}
    assert set(signal) == {1, 2} and signal[2] == pytest.approx(1.5 / 62 + 1 / 61) and signal[1] == pytest.approx(1.5 / 61)
    both = {r["doc"]: r["score"] for r in V.hybrid(lexical, dense, "inject", inject=2).collect()}
    assert set(both) == {1, 2, 3, 4} and both[3] == pytest.approx(0.3 / 62) and {k: both[k] for k in signal} == signal


def test_pinpoints_agree_or_stay_lexical(spark):
    rows = [("d", 0, "nichts", [0.0, 1.0]), ("d", 1, "Mangel und Frist", [1.0, 0.0]), ("e", 0, "Mangel", [0.0, 1.0]), ("e", 1, "anderes", [1.0, 0.0]), ("f", 0, "ohne", [1.0, 0.0])]
    p = spark.createDataFrame(rows, "doc string, number int, text string, vector array<double>")
    got = {r["doc"]: (r["number"], r["method"], r["confidence"]) for r in V.pinpoints(p, ["mangel", "frist"], [1.0, 0.0]).collect()}
    assert got == {"d": (1, "both", 0.9), "e": (0, "lexical", 0.3)}
    off = {r["doc"]: (r["number"], r["method"], r["confidence"]) for r in V.pinpoints(p.drop("vector"), ["mangel", "frist"], [], None).collect()}
    assert off == {"d": (1, "lexical", 0.6), "e": (0, "lexical", 0.3)}


def test_quick_publish_refuses_two_and_keeps_old_rows(spark, tmp_path):
    root = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b")], "id int, v string")
    assert delta.quick_publish(spark, root, df.where("id = 1"), "id") == 1
    assert delta.quick_publish(spark, root, df, "id") == 2
    assert sorted(r["id"] for r in spark.read.parquet(*delta.published_paths(spark, root)).collect()) == [1, 2]
    (tmp_path / "p" / "lock").touch()
    with pytest.raises(RuntimeError):
        delta.quick_publish(spark, root, df, "id")
    assert len(delta.published_paths(spark, root)) == 2


def test_snapshot_artifact_refuses(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    df.write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        delta.snapshot_artifact(rows, "id", str(tmp_path / "out"), ["id", "court"])
    with pytest.raises(ValueError):
        delta.snapshot_artifact(rows, "id", str(tmp_path / "out"), ["id"], least=2)
    assert not delta.intact(spark, str(tmp_path / "out"), "id")
    assert delta.snapshot_artifact(rows, "id", str(tmp_path / "good"), ["id"])["rows"] == 1 and delta.intact(spark, str(tmp_path / "good"), "id")


def test_refreshed_is_the_full_run(spark):
    old = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d")], "id int, t string")
    new = spark.createDataFrame([(1, "a b"), (2, "x y"), (4, None)], "id int, t string")
    extract = lambda df: df.where("t is not null").select("id", F.explode(F.split("t", " ")).alias("w"))
    got = delta.refreshed(extract(old), old.select("id", F.md5("t").alias("digest")), new, "id", F.md5("t"), extract)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, extract(new).collect()))


def test_topological_order():
    assert A.topological_order({"c": ["a", "b"], "b": ["a"], "a": [], "z": []}) == ["a", "b", "c", "z"] and A.topological_order({}) == []
    for bad in ({"a": ["b"], "b": ["a"]}, {"a": ["nobody"]}):
        with pytest.raises(ValueError):
            A.topological_order(bad)


def test_percentiles_and_positions_against_sorting(spark):
    values = [(g, None if i % 17 == 0 else float((i * 37) % 100 if g == "a" else i * i % 1009)) for g in "ab" for i in range(700)] + [("c", 5.0), ("d", None)]
    df = spark.createDataFrame(values, "g string, v double")
    got = {r["g"]: r for r in A.percentiles(df, ["g"], "v", [0.5, 0.95], False, buckets=8).collect()}
    smooth = {r["g"]: r for r in A.percentiles(df, ["g"], "v", [0.25, 0.9], True, buckets=8).collect()}
    for g in "abc":
        own = sorted(v for k, v in values if k == g and v is not None)
        assert [got[g]["p50"], got[g]["p95"]] == [own[min(int(p * len(own)), len(own) - 1)] for p in (0.5, 0.95)]
        assert [smooth[g]["p25"], smooth[g]["p90"]] == pytest.approx([np.percentile(own, 25), np.percentile(own, 90)])
    assert "d" not in got
    rows = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "k int").repartition(5)
    assert [r["pos"] for r in A.positions(rows, ["k"]).orderBy("k").collect()] == list(range(1000))


def test_nearest_before_against_brute_force(spark):
    import datetime

    t0 = datetime.datetime(2024, 1, 1)
    at = lambda i: t0 + datetime.timedelta(minutes=(i * 7919) % 9000)
    events = [(i, "hot" if i % 3 else f"u{i % 5}", at(i)) for i in range(200)]
    shown = [("hot" if i % 4 else f"u{i % 5}", at(i * 3 + 1), i) for i in range(150)] + [("hot", at(5), 999)]
    e = spark.createDataFrame(events, "id int, u string, t timestamp_ntz")
    s = spark.createDataFrame(shown, "u string, s timestamp_ntz, x int")
    got = {r["id"]: r["s"] for r in joins.nearest_before(e, s, ["u"], "t", "s", width=3600).collect()}
    want = {i: max((b for v, b, _ in shown if v == u and b < t), default=None) for i, u, t in events}
    assert got == {i: b for i, b in want.items() if b is not None}


def test_prefix_copies_and_representations(spark):
    long, other = "Das Gericht hat erwogen und entschieden. " * 12, "Etwas ganz anderes steht in diesem Text hier. " * 7
    rows = [("c", "1", "a", long + "mehr"), ("c", "1", "b", long), ("c", "1", "d", other), ("c", "2", "e", long), ("c", "1", "f", None), ("c", "1", "b", long)]
    df = spark.createDataFrame(rows, "court string, docket string, id string, t string")
    assert {tuple(r) for r in dedup.prefix_copies(df, ["court", "docket"], "id", "t").collect()} == {("b", "a")}
    reps = spark.createDataFrame([("a", "u", "h"), ("b", "u", None), ("c", "", "h"), ("d", None, None)], "id string, url string, hash string")
    got = {(r["member"], r["canonical"], tuple(r["methods"])) for r in dedup.representations(reps, "id", {"url": F.col("url"), "hash": F.col("hash")}).collect()}
    assert got == {("b", "a", ("url",)), ("c", "a", ("hash",))}


def test_upgrade_takes_a_much_longer_text(spark):
    rows = [("d1", "2020-01-01", 100, 1, "r1"), ("d1", "2020-01-01", 5000, 2, "r2"), ("d1", "2021-05-06", None, 1, "r3"), ("d2", None, 50, 1, "r4")]
    df = spark.createDataFrame(rows, "docket string, day string, n int, trust int, row string")
    got = {(r["docket"], r["day"], r["n"], r["text_from"]) for r in dedup.upgrade(df, "docket", "trust", "n", "row", "day").collect()}
    assert got == {("d1", "2020-01-01", 5000, "r2"), ("d1_d20210506", "2021-05-06", None, "r3"), ("d2", None, 50, "r4")}


DAYS = [
    ("Urteil vom 3. Mai 2019\n" + "Text " * 400, "2019-05-03", ("2019-05-03", "title", "same")),
    ("Bundesgesetz vom 17. Juni 2005. Und am 4.5.2018 geschah es. " + "Text " * 400, None, ("2018-05-04", "head", "only_text")),
    ("Kein Datum. " + "Text " * 400 + "\nLausanne, den 7. August 2017", "2017-01-01", ("2017-08-07", "signature", "different")),
    ("Nichts.", "2017-01-01", (None, None, "only_stored")),
    ("", None, (None, None, "none")),
]


def test_decision_day(spark):
    df = spark.createDataFrame([(n, t, s) for n, (t, s, _) in enumerate(DAYS)], "n int, t string, s string").select("n", D.decision_day(F.col("t"), F.col("s")).alias("x"))
    assert [(r["x"]["day"], r["x"]["method"], r["x"]["category"]) for r in df.orderBy("n").collect()] == [w for *_, w in DAYS]


def test_docket_date_and_keys(spark):
    df = spark.createDataFrame([("Urteil 9C 113/2025 vom 3. Mai 2025", "bge", "BGE 120 II 5", "x"), ("1A.1/2020 vom 3. Mai 2019", "zh", "A-1/20", None), (None, None, None, None)], "t string, court string, docket string, day string")
    got = df.select(D.docket_date(F.col("t")).alias("x"), D.regroup_key(F.col("court"), F.col("docket"), F.col("day")).alias("k")).collect()
    assert tuple(got[0]["x"]) == ("9C_113/2025", "2025-05-03") and tuple(got[1]["x"]) == ("1A_1/2020", None) and got[2]["x"] is None
    assert [r["k"] for r in got] == ["bge|120|II|5", "zh|A120|?", "?||?"]


def test_study_parts():
    found = E.study_parts("Sachverhalt:\nA. Eins\nB. Zwei\nD. nicht\nErwägungen:\n1. Text\nDemnach erkennt das Gericht:\n1. Ab.")
    assert [p["letter"] for p in found["parts"]] == ["A", "B"] and found["quality"] == 100
    assert E.study_parts(None) == {"parts": [], "quality": 0}


def test_grown_lines(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text("1\n2\n3")
    b.write_text("x\n")
    first, state = readers.grown_lines(spark, str(tmp_path), None)
    assert sorted(r["value"] for r in first.collect()) == ["1", "2", "x"]
    a.write_text("1\n2\n3\n4\n")
    second, state = readers.grown_lines(spark, str(tmp_path), state)
    assert sorted(r["value"] for r in second.collect()) == ["3", "4"]
    a.write_text("9\n")  # shrunk: read anew
    third, state = readers.grown_lines(spark, str(tmp_path), state)
    assert [r["value"] for r in third.collect()] == ["9"]
    assert readers.grown_lines(spark, str(tmp_path), state)[0].count() == 0


def test_bad_json_and_log_lines(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.txt").write_text('{"a": 1}\n{"b"\n\n[1]\n{"c": null}\n')
    assert sorted((r["line"], r["value"]) for r in readers.bad_json(spark, str(tmp_path / "j")).collect()) == [(2, '{"b"'), (4, "[1]")]
    (tmp_path / "log").write_text("2024-01-01T00:00:00 c e GET 200 99.5 - 0123abcd\nanother\n")
    rows = readers.access_log(spark, str(tmp_path / "log")).orderBy("client").collect()
    assert [(r["client"], r["bytes"], r["latency_ms"]) for r in rows] == [(None, None, None), ("c", 0, 60_000)]


def test_agent_classes(spark):
    cases = {"GPTBot/1.0": "ai_crawler", "Mozilla/5.0 (compatible; bingbot/2.0)": "search_engine", "python-requests/2": "script", "Mozilla/5.0 (Android)": "mobile", "": "none", None: "none", "???": "other"}
    df = spark.createDataFrame([(k,) for k in cases], "a string").select("a", T.agent_class(F.col("a")).alias("k"))
    assert {r["a"]: r["k"] for r in df.collect()} == cases


def test_all_chunks_hold_the_whole_text():
    text = "Sachverhalt:\n" + "Wort " * 700 + "\nErwägungen:\n" + "x" * 1300 + "\nDemnach erkennt das Gericht:\n1. Ab."
    parts = E.all_chunks(text)
    assert all(0 < len(p) <= E.CHUNK for p in parts) and "".join("".join(parts).split()) == "".join(text.split())
    assert E.all_chunks(None) == [] and E.all_chunks("  ") == []


def test_a_broken_check_is_critical(spark):
    df = spark.createDataFrame([(1,)], "id int")
    got = {r["check"]: (r["severity"], r["passed"]) for r in Q.run(df, [Q.Check("n", F.count("*"), low=1), Q.Check("bad", F.sum("nobody"), 0, severity=Q.INFO)]).collect()}
    assert got == {"n": (Q.WARNING, True), "bad": (Q.CRITICAL, False)}
    assert all(k.severity == Q.CRITICAL for k in Q.discovered("decision_checks", critical_only=True)) and Q.discovered("graph_checks")


def test_order_pages_are_read_without_holding_the_table(spark, tmp_path):
    """all orders were Python objects on the driver, and each page went through all of them."""
    import json
    import tracemalloc

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tessera.plans.law_queries import OrderBindings, src_23_pages_by_year

    n = 200_000
    day = pa.array(np.arange(n) % 1000 * 86_400_000_000, pa.timestamp("us"))
    pq.write_table(pa.table({"o_orderkey": pa.array(np.arange(n)[::-1]), "o_orderdate": day}), tmp_path / "large.parquet")
    tracemalloc.start()
    client = OrderBindings({"file": str(tmp_path / "large.parquet")})
    assert client.years() == [1970, 1971, 1972]
    keys = [int(b["key"]["value"]) for at in (0, 50) for b in json.loads(client.page(1971, at))["results"]["bindings"]]
    assert tracemalloc.get_traced_memory()[1] < 10e6
    tracemalloc.stop()
    assert keys == sorted(keys) and len(set(keys)) == 100
    # a null date is a year of its own, and so is a year of whole pages alone
    rows = [(k, 1970 if k < 100 else 1990) for k in range(130)] + [(500, None), (None, 1990)]
    pq.write_table(pa.table({"o_orderkey": pa.array([k for k, _ in rows], pa.int64()), "o_orderdate": pa.array([y and np.datetime64(f"{y}-05-05", "us") for _, y in rows], pa.timestamp("us"))}), tmp_path / "orders.parquet")
    got = [(r["key"], r["year"]) for r in src_23_pages_by_year(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(k if k is None else str(k), y if y is None else str(y)) for k, y in rows], key=str)
