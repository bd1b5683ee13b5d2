"""Encoding: exact joins at every place, unusual texts, the round trip; mixing against its bounds."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import mixing as M
from tessera.llm import tokens as T

ALPHABET = st.sampled_from(["a", "bc", " ", "  ", "\n", "1", "9", "'s", " '", " ", "ß", "é", "　", "漢", "-", "!", " \n ", "\x1c", "\x85", " ", "x" * 40, "👩‍⚖️", "\x00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=120).map("".join), st.sampled_from([1, 4, 16, 33]), st.sampled_from([1, 3, 8]))
def test_tree_concatenation_is_exact(text, leaf, window):
    encode = T.encoder().encode_ordinary
    leaves = [(text[a:b], encode(text[a:b])) for a, b in T.halves(len(text), leaf)]
    original = T.joined
    T.joined = lambda l, r, e: original(l, r, e, window)
    try:
        assert T.concatenated(leaves, encode) == encode(text)
    finally:
        T.joined = original


def test_halves_cover_the_text():
    for n in (0, 1, 7, 100, 8193, 100_000):
        spans = T.halves(n, 13)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and all(b - a <= 13 for a, b in spans)


def test_table(spark):
    long = "Ein langer Satz ohne Ende und mit vielen Wörtern; " * 3000
    blob = "ab" * 30_000
    rows = [(1, None), (2, ""), (3, "  "), (4, "Das Gericht"), (4, "Das Gericht"), (5, long), (5, long), (6, blob), (7, "\x00ÿ漢")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as ids", "2 as id", "3 as row")
    got = T.encode(df, "doc_id", "text").collect()
    e = T.encoder()
    want = sorted((i, e.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == want
    assert all(e.decode(list(r["ids"])) == dict((i, t or "") for i, t in rows)[r["doc_id"]] for r in got)
    assert T.encode(df.limit(0), "doc_id", "text").count() == 0
    assert {r["doc_id"]: r["n_tokens"] for r in T.counts(df, ["doc_id"], "text").collect()}[1] == 0


@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(1, 60), min_size=1))
def test_no_source_is_a_block_away(weights):
    slots, period = M.schedule(weights), sum(weights.values())
    assert None not in slots
    for s, w in weights.items():
        had = 0
        for t, x in enumerate(slots, 1):
            had += x == s
            assert abs(had - w * t / period) < 1


def test_mixture(spark):
    docs = [(i, "big", 10) for i in range(900)] + [(1000 + i, "small", 10) for i in range(20)] + [(2000, None, 10), (2001, "nobody", 10), (2002, "big", 0)]
    d = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens int")
    s = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("absent", 0.2, 2), ("zero", 0.0, 2)], "source string, target_share double, max_repeats int")
    mixed = M.mixture(d, s, block=100)
    rows = mixed.collect()
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows) and max(r["copy"] for r in rows) == 2
    by = {r["source"]: r for r in M.shares(mixed, s).collect()}
    assert by["small"]["n_documents"] == 60 and by["small"]["short"] and by["absent"]["short"] and not by["zero"]["short"]
    assert abs(by["big"]["n_tokens"] - 4600) <= 10
    assert M.mixture(d.limit(0), s).count() == 0


def test_small_sources_are_repeated_up_to_their_share(spark):
    d = spark.createDataFrame([(i, "a", 7) for i in range(600)] + [(1000 + i, "b", 7) for i in range(100)], "doc_id bigint, source string, n_tokens int")
    s = spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 5)], "source string, target_share double, max_repeats int")
    by = {r["source"]: r for r in M.shares(M.mixture(d, s, block=70), s).collect()}
    assert abs(by["a"]["actual_share"] - 0.6) < 0.01 and abs(by["b"]["actual_share"] - 0.4) < 0.01


def test_the_mixture_itself_is_less_than_a_block_away(spark):
    """At the end of every slot, with documents up to a block long, a source that is repeated and one that runs out."""
    sizes = [1 + (i * i * 37) % 1000 for i in range(1500)]
    d = spark.createDataFrame([(i, "abc"[i % 7 % 3] if i > 60 else "d", n) for i, n in enumerate(sizes)], "doc_id bigint, source string, n_tokens int")
    s = spark.createDataFrame([("a", 0.5, 2), ("b", 0.29997, 1), ("c", 0.2, 4), ("d", 0.00003, 1)], "source string, target_share double, max_repeats int")
    block = max(sizes)
    rows = M.mixture(d, s, block=block).orderBy("slot", "position").collect()
    quantum, slots = -(-block // M.QUANTA), max(r["slot"] for r in rows) + 1
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows)
    for source, w in (("a", 0.5), ("b", 0.29997), ("c", 0.2), ("d", 0.00003)):
        had, at, own = 0, 0, [r for r in rows if r["source"] == source]
        if any(r["source_short"] for r in own):
            continue
        for slot in range(slots):
            while at < len(own) and own[at]["slot"] <= slot:
                had += own[at]["n_tokens"]
                at += 1
            assert abs(had - w * (slot + 1) * quantum) < block, (source, slot)


def test_exact_shares():
    assert M.whole_weights({"a": 0.5, "b": 0.3, "c": 0.2, "z": 0.0}) == {"a": 5, "b": 3, "c": 2}
    assert M.whole_weights({"a": 0.99997, "b": 0.00003}) == {"a": 99997, "b": 3}
    rough = M.whole_weights({"a": 2 / 3, "b": 1 / 3, "c": 1e-12})
    assert rough["c"] == 1 and abs(sum(rough.values()) - M.PERIOD) <= 3
    assert M.whole_weights({}) == {}


def test_a_source_that_falls_short_by_little_is_told(spark):
    d = spark.createDataFrame([(i, "a", 10) for i in range(970)] + [(2000 + i, "b", 10) for i in range(14)], "doc_id bigint, source string, n_tokens int")
    s = spark.createDataFrame([("a", 0.97, 1), ("b", 0.03, 2), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    by = {r["source"]: r for r in M.shares(M.mixture(d, s, block=100), s).collect()}
    assert by["b"]["short"] and by["b"]["n_documents"] == 28 and not by["a"]["short"] and not by["none"]["short"]
