"""Joins, aggregates, search, extraction, versions, streams and writers on small fixtures."""

import hashlib
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.functions import extract, text
from tessera.operators import aggregates, incremental, joins, quality, search
from tessera.sources import readers, writers
from tessera.streaming import counters


def test_asof_join_against_brute_force(spark):
    import random

    random.seed(1)
    left = [(f"l{i}", random.choice("ab"), random.randint(0, 300)) for i in range(80)]
    right = [(random.choice("ab"), random.randint(0, 300), f"r{i}") for i in range(60)]
    got = {r["id"]: (r["start"], r["rid"]) for r in joins.asof_join(spark.createDataFrame(left, "id string, g string, at int"), spark.createDataFrame(right, "g string, start int, rid string"), ["g"], "at", "start", 30, ["rid"]).collect()}
    want = {}
    for i, g, at in left:
        hits = [(s, r) for h, s, r in right if h == g and s <= at <= s + 30]
        if hits:
            want[i] = max(hits)
    assert got == want


def test_or_join_has_no_nested_loop(spark):
    a = spark.createDataFrame([("x", "k1", "k2"), ("y", None, "k3")], "id string, p string, q string")
    b = spark.createDataFrame([("k2", 1), ("k1", 2), ("k9", 3)], "k string, v int")
    j = joins.or_join(a, b, [F.col("p"), F.col("q")], F.col("k"), ["id", "v"])
    assert {(r["id"], r["v"]) for r in j.collect()} == {("x", 1), ("x", 2)}
    assert "NestedLoop" not in j._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_merkle_root(spark, n):
    leaves = [f"leaf{i}".encode() for i in range(n)]

    def fold(xs):
        if len(xs) == 1:
            return hashlib.sha256(b"\0" + xs[0]).digest()
        k = 1
        while k * 2 < len(xs):
            k *= 2
        return hashlib.sha256(b"\1" + fold(xs[:k]) + fold(xs[k:])).digest()

    df = spark.createDataFrame([(i, x.decode()) for i, x in enumerate(leaves)], "k int, v string")
    row = aggregates.merkle_root(df, "k", F.col("v")).first()
    assert (row["root"], row["n"]) == (fold(leaves).hex(), n)


def test_noise_and_small_groups(spark):
    df = spark.createDataFrame([(5,), (1000,)], "n int").select("n", aggregates.noisy_count(F.col("n"), 1).alias("x"))
    got = {r["n"]: r["x"] for r in df.collect()}
    assert got[5] is None and abs(got[1000] - 1000) < 50


def test_query_parser():
    q = search.parse('Miete OR Pacht NOT Wohnung "Treu und Glauben" kind*')
    assert (q.may, q.never, q.phrases, q.prefixes) == (["miete", "pacht"], ["wohnung"], [["treu", "und", "glauben"]], ["kind"])
    assert search.parse("Obligationenrecht OR").must == ["obligationenrecht", "or"]
    assert search.parse("").must == []
    assert search.docket_intent("4A_291/2017") and not search.docket_intent("was sagt 4A_291/2017 zur Miete")
    assert search.condense("Brief " * 50 + "BGE 111 I 14 wegen Kündigung").startswith("BGE 111 I 14")


def test_docket_forms(spark):
    cases = {"8C 862/2008": "8C_862_2008", "5A_438/2012": "5A_438_2012", "4P.253/1999": "4P_253_1999", "BGE 121 I 102": "BGE 121 I 102", "79_IV_170": "79 IV 170"}
    df = spark.createDataFrame([(k,) for k in cases], "d string").select("d", text.graph_docket(F.col("d")).alias("g"))
    assert {r["d"]: r["g"] for r in df.collect()} == cases


def test_confidence_prefers_the_earlier_decision(spark):
    df = spark.createDataFrame([("2020-01-01", "2019-12-01"), ("2020-01-01", "2020-12-01"), (None, "2019-01-01"), ("bad", "")], "s string, t string")
    side = lambda d: {"court": F.lit("bger"), "canton": F.lit("CH"), "date": F.col(d)}
    got = [r["c"] for r in df.select(text.citation_confidence(side("s"), side("t"), F.lit("4A_1_2019"), F.lit(1), F.lit(1)).alias("c")).collect()]
    assert got[0] == 0.99 and got[0] > got[1] and got[2] == got[3] == pytest.approx(0.98)


def test_paragraphs_sections_chunks():
    t = "Sachverhalt\nA. X klagt.\n\nErwägungen\n1. Eintreten.\n1.1 Form.\n1.2 Frist.\n3. Sache.\n77. Nein.\n2.1 Nein.\n\nDemnach erkennt das Gericht: Abweisung."
    s = extract.sections(t)
    assert s["method"] == "headings" and s["orders"].startswith("Demnach")
    assert [p["number"] for p in extract.numbered_paragraphs(s["reasons"])] == ["1", "1.1", "1.2", "3"]
    assert extract.numbered_paragraphs(None) == [] and extract.chunks("") == [] and extract.sections(None)["method"] == "empty"
    assert all(len(c) <= extract.CHUNK for c in extract.chunks("x" * 9000))


def test_versions_and_diffs(spark):
    assert incremental.apply_diff("a\nb\nc", incremental.reverse_diff("a\nb\nc", "a\nx\nc\nd")) == "a\nx\nc\nd"
    assert incremental.apply_diff("a", incremental.reverse_diff("a", None)) is None
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, h string")
    new = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", None), ("d", "4")], "k string, h string")
    diff = incremental.changes(old, new, "k", "h")
    assert {(r["k"], r["state"]) for r in diff.collect()} == {("b", "changed"), ("d", "new")}
    assert sorted(map(tuple, incremental.apply_changes(old, new, diff, "k").collect()), key=str) == sorted(map(tuple, new.collect()), key=str)


def test_gates(spark):
    assert quality.row_gate(95, 100) and not quality.row_gate(94, 100) and quality.row_gate(0, 0)
    live = spark.createDataFrame([("a",)] * 10 + [("b",)] * 3, "g string")
    assert [r["g"] for r in quality.group_gate(live.where("g = 'b'"), live, "g", least=5).collect()] == ["a"]
    report = quality.run(live, [quality.Check("n", F.count("*"), low=100, severity=quality.CRITICAL)])
    assert not quality.safe_to_publish(report)


def test_snapshot_is_not_published_when_it_shrinks(spark, tmp_path):
    root = str(tmp_path / "s")
    big, small = spark.range(100).withColumn("g", F.lit("x")), spark.range(10).withColumn("g", F.lit("x"))
    assert writers.current(spark, root) is None
    writers.snapshot(big, root, 1, "g", least=5)
    with pytest.raises(ValueError):
        writers.snapshot(small, root, 2, "g", least=5)
    assert writers.current(spark, root).count() == 100


def test_jsonl_keeps_malformed_lines_apart(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "1", "v": "direct"}\nnonsense\n{"k": "2", "v": "direct"}\n')
    (tmp_path / "es_b.jsonl").write_text('{"k": "1", "v": "mirror"}\n{"k": "3", "v": "mirror"}\n')
    df = readers.jsonl(spark, str(tmp_path), "k string, v string")
    assert {(r["k"], r["v"]) for r in readers.by_priority(df, "k").collect()} == {("1", "direct"), ("2", "direct"), ("3", "mirror")}


class Pages:
    def __init__(self, options):
        self.n = int(options["n"])

    def pages(self):
        return range(self.n)

    def fetch(self, page):
        flag = f"/tmp/tessera-page-{os.getppid()}-{page}"
        if page == 1 and not os.path.exists(flag):
            open(flag, "w").close()
            raise OSError("try again")
        if os.path.exists(flag):
            os.remove(flag)
        return [(page, f"row {i}") for i in range(3)]


def test_paged_source_retries(spark):
    readers.register_paged(spark)
    df = spark.read.format("paged").option("service", "tests.test_operators:Pages").option("columns", "page int, v string").option("n", "4").load()
    assert df.count() == 12


def test_streams(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [(i, t + timedelta(seconds=i * 10), 1, "view", 1.0, "{}") for i in range(20)] + [(100 + i, t + timedelta(minutes=i * i), 2, "view", 1.0, "{}") for i in range(10)]
    spark.createDataFrame(rows, counters.EVENTS).write.parquet(str(tmp_path / "in"))
    stream = counters.read_events(spark, str(tmp_path / "in"))
    out = counters.run_available(counters.visitors(stream, "ts"), "visitors_test", "update", str(tmp_path / "c1"))
    got = {r["user_id"]: (r["n"], r["gaps"], r["verdict"]) for r in out.collect()}
    want = {r["user_id"]: (r["n"], r["gaps"], r["verdict"]) for r in counters.visitors_batch(spark.createDataFrame(rows, counters.EVENTS), "ts").collect()}
    assert got == want and got[1][2] == "bot" and got[2][2] == "person"
    seen = counters.run_available(counters.once(stream, "user_id", "ts"), "seen_test", "append", str(tmp_path / "c2"))
    assert seen.count() == 2


def test_log_lines(spark, tmp_path):
    (tmp_path / "x.log").write_text("2024-01-01T00:00:00 c /s GET 200 0.5 12 0123abcd\n2024-01-01T00:00:01 c /s GET 200 99999 - -\nbroken\n2024-01-02T00:00:00 c /s GET 200 1 1 -\n")
    rows = readers.access_log(spark, str(tmp_path), "2024-01-01").orderBy("ts").collect()
    assert [(r["latency_ms"], r["bytes"], r["cohort"]) for r in rows] == [(500, 12, "0123abcd"), (60000, 0, None)]


def test_nothing_outside_imports_llm():
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "tessera"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "tessera.llm" not in path.read_text(), path
