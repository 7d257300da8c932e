"""Edges of the scalar functions and operators."""

from pyspark.sql import functions as F

from tracesieve.functions import messages as M
from tracesieve.functions import text as T
from tracesieve.operators import consensus, ledger, screening, vectors


def one(spark, expression, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expression(F.col("x")).alias("y")).first()["y"]


def test_tokenize_edges(spark):
    text = "É A b　C​d\x0be\x1cf  G,\x85h"
    assert one(spark, T.tokenize, text) == ["É", "a", "b", "c​d", "e\x1cf", "g,", "h"]
    assert one(spark, T.tokenize, "") == []
    assert one(spark, T.tokenize, None) is None


def test_shingles_of_short_texts(spark):
    for n in (4, 5, 7, 8):
        words = " ".join(f"w{i}" for i in range(n))
        assert len(one(spark, lambda x: T.shingles(T.tokenize(x), 5), words)) == max(0, n - 4)


def test_parse_decimal(spark):
    good = {"42": 42.0, "-1.5e2": -150.0, ".5": 0.5, "+3.": 3.0, "0e-999": 0.0}
    for x, y in good.items():
        assert one(spark, T.parse_decimal, x) == y
    for x in ("1e400", "1e-400", "42d", "1,000", " 42 ", "", ".", "nan", "inf", "0x10"):
        assert one(spark, T.parse_decimal, x) is None, x


def test_extract_marked(spark):
    f = lambda x: T.extract_marked(x, "ANSWER:")
    assert one(spark, f, "so\nANSWER: 4\n\n") == "4"
    assert one(spark, f, "ANSWER: 4\nANSWER: 5") is None
    assert one(spark, f, "ANSWER: 4\nbye") is None


def test_strip_channels(spark):
    assert tuple(one(spark, T.strip_channels, "<think></think>x")) == ("x", "")
    assert tuple(one(spark, T.strip_channels, "x<think>a</think>")) == ("x<think>a</think>", None)
    assert tuple(one(spark, T.strip_channels, "<|channel>thought\na\n\n<channel|>b")) == ("b", "a\n")


def test_scores(spark):
    for x, y in ((float("nan"), 0.0), (float("inf"), 0.0), (-0.0, 0.0), (7.0, 0.7), (70.0, 1.0), (1.0, 1.0)):
        assert one(spark, T.normalize_score, x, "x double") == y


def test_reply(spark):
    assert tuple(one(spark, T.judge_reply, '```json\n{"score": 8, "verdict": "Admit"}\n```')) == (0.8, "accept")
    assert one(spark, T.judge_reply, '{"score": 8}') is None


def test_all_uncertain_panel(spark):
    votes = spark.createDataFrame([(1, 0.2, 1.0, "uncertain"), (1, 0.4, 0.0, "uncertain"), (2, 0.9, 0.0, "accept")], "record_id int, score double, weight double, verdict string")
    rows = {r["record_id"]: r for r in consensus.panel(votes, 0.3).collect()}
    assert rows[1]["aggregate"] is None and rows[1]["decision"] == "reject" and rows[1]["decisive"] == 0
    assert rows[2]["aggregate"] is None


def test_gemma_keeps_trailing_system(spark):
    schema = "m array<struct<role string, content string, reasoning string>>"
    got = spark.createDataFrame([([("system", "s", None), ("user", "u", None), ("assistant", "a", ""), ("system", "z", None)],)], schema).select(M.gemma(F.col("m")).alias("y")).first()["y"]
    assert got == "<bos><|turn>user\ns\n\nu<turn|>\n<|turn>model\n<|channel>thought\n\n<channel|>a<turn|>\n<|turn>user\nz<turn|>\n"


def test_components_and_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9)], "a long, b long")
    assert {tuple(r) for r in screening.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}
    assert screening.components(edges.limit(0)).count() == 0
    cycle = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 5)], "child long, parent long")
    assert {r[0] for r in screening.cyclic_nodes(cycle).collect()} == {1, 2, 3}


def test_jaccard_at_the_threshold(spark):
    texts = spark.createDataFrame([(1, "a b c d"), (2, "b c d e"), (3, "a b c d")], "id long, text string")
    reps, members = screening.distinct_texts(texts)
    assert reps.count() == 2 and {tuple(r) for r in members.collect()} == {(1, 1), (2, 2), (3, 1)}
    at = screening.similar_pairs(reps, (2, 2), 0.5).collect()
    assert [(r["a"], r["b"], r["intersection"], r["total"]) for r in at] == [(1, 2, 2, 4)]
    assert screening.similar_pairs(reps, (2, 2), 0.51).count() == 0


def test_breaker(spark):
    rows = spark.createDataFrame([("a", i, True) for i in range(3)] + [("b", 0, False), ("b", 1, True), ("b", 2, True), ("b", 3, True)], "k string, at int, failed boolean")
    assert {tuple(r) for r in ledger.breaker(rows, "k", 3).collect()} == {("a", True), ("b", False)}


def test_stream_and_batch_agree(spark, tmp_path):
    from tracesieve.streaming.folds import latest_states, read_states

    rows = [(i % 5, f"s{i % 3}", i) for i in range(40)]
    schema = "record_id int, state string, event_id int"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = latest_states(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    want = ledger.latest(spark.createDataFrame(rows, schema), "record_id", ["event_id"], ["state", "event_id"])
    assert {tuple(r) for r in read_states(spark, f"{tmp_path}/out").collect()} == {tuple(r) for r in want.collect()}


def test_publish_and_verify(spark, tmp_path):
    import pytest

    from tracesieve.sources import export

    rows = spark.createDataFrame([(f"r{i}", i % 3, None if i % 2 else 1.5) for i in range(20)], "record_id string, n int, s double")
    at = f"file://{tmp_path}/out"
    first = export.publish(rows, at)
    assert export.publish(rows.repartition(7), at) == first and export.verify(spark, at) == []
    with pytest.raises(ValueError, match="other rows"):
        export.publish(rows.limit(3), at)
    rows.limit(5).write.mode("overwrite").parquet(f"{at}/data")
    assert "n_records" in export.verify(spark, at)


def test_shingle_hashes_tell_grams_apart(spark):
    words = "a b a b a b c a b a b d e f g h i j k l m n".split()
    for n in (1, 2, 3, 5, 8, 12, 13):
        df = spark.createDataFrame([(words,), (words[: n - 1],)], "w array<string>")
        got = [r[0] for r in df.select(F.size(screening.hashed_shingles(F.col("w"), n))).collect()]
        assert got == [len({tuple(words[i : i + n]) for i in range(len(words) - n + 1)}), 0]


def test_common_line_hides_no_pair(spark):
    line = " ".join(f"license{i}" for i in range(12))
    body = lambda k: " ".join(f"w{k}_{i}" for i in range(60))
    texts = [(k, f"{body(k)} {line}") for k in range(30)] + [(100, f"{body(7)} {line} tail")]
    reps, _ = screening.distinct_texts(spark.createDataFrame(texts, "id long, text string"))
    grams = {k: {tuple(t.split()[i : i + 8]) for i in range(len(t.split()) - 7)} for k, t in texts}
    want = {(a, b, len(grams[a] & grams[b]), len(grams[a] | grams[b])) for a in grams for b in grams if a < b and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])}
    assert want and {tuple(r) for r in screening.similar_pairs(reps, (8, 8)).select("a", "b", "intersection", "total").collect()} == want


def test_protected_matches_by_broadcast_and_by_shuffle(spark, monkeypatch):
    items = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "k l m n o p q r s t"), (3, None), (4, "too short")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "x a b c d e f g h i j"), (3, None), (4, "")], "id long, text string")
    want = {(1, 1, 3, 3), (2, 1, 3, 4)}
    assert {tuple(r) for r in screening.protected_matches(texts, items, 8, 0.5).collect()} == want
    monkeypatch.setattr(screening, "ITEM_SHINGLES", 2)
    assert {tuple(r) for r in screening.protected_matches(texts, items, 8, 0.5).collect()} == want
    assert screening.protected_matches(texts.limit(0), items, 8, 0.5).count() == 0


def test_nearest_prior_equals_brute_force(spark):
    import random

    roll = random.Random(3)
    rows = [(i, [roll.gauss(0, 1) for _ in range(5)]) for i in range(60)] + [(60, None), (61, []), (62, [0.0] * 5), (63, [1.0, 2.0]), (64, [float("nan")] * 5)]
    df = spark.createDataFrame(rows, "id long, v array<double>")

    def cosine(a, b):
        if not a or not b or len(a) != len(b) or a != a or any(x != x for x in (*a, *b)):
            return 0.0
        norm = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return sum(x * y for x, y in zip(a, b, strict=True)) / norm if norm else 0.0

    want = {i: max(cosine(v, w) for j, w in rows if j != i) for i, v in rows}
    for block in (7, 8192):
        got = {r["id"]: r["nearest"] for r in vectors.nearest_prior(df, df, block).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    alone = vectors.nearest_prior(df.filter("id = 3"), df.filter("id = 3")).select("nearest", vectors.novel(F.col("nearest"), 0.4).alias("novel")).first()
    assert tuple(alone) == (None, True)
    assert vectors.nearest_prior(df.limit(0), df).count() == 0


def test_multiset_digest(spark):
    df = spark.createDataFrame([(x,) for x in "abcb"], "x string").withColumn("h", F.sha2("x", 256))
    made = lambda rows: rows.agg(T.multiset_digest(F.col("h"))).first()[0]
    assert made(df) == made(df.repartition(3)) and made(df) != made(df.distinct())


def test_matrix_by_broadcast_and_by_shuffle(spark, monkeypatch):
    votes = spark.createDataFrame([(1, 0, "x", 1.0), (1, 1, "y", 2.0), (1, 2, "z", 1.0), (2, 0, "x", 3.0)], "record_id long, pos int, judge string, weight double")
    rho = spark.createDataFrame([("x", "y", 0.5), ("y", "z", -1.0)], "judge_a string, judge_b string, rho double")
    want = {1: 16 / (6 + 2 * 1 * 2 * 0.5), 2: 1.0}
    assert {r["record_id"]: r["n_eff"] for r in consensus.effective_n_matrix(votes, rho).collect()} == want
    monkeypatch.setattr(consensus, "MATRIX", 1)
    assert {r["record_id"]: r["n_eff"] for r in consensus.effective_n_matrix(votes, rho).collect()} == want


def test_publication_is_resumed_and_advances_once(spark, tmp_path):
    import pytest

    from tracesieve.sources import export, receipts

    rows = spark.createDataFrame([(f"r{i}", i % 3, None if i % 2 else 1.5) for i in range(8)], "record_id string, n int, s double")
    none = spark.createDataFrame([], "record_id string, state string, detail string")
    store, at = f"file://{tmp_path}/store", f"file://{tmp_path}/out"
    assert receipts.pending(spark, store, at, "engine") is None
    with pytest.raises(ValueError, match="may not"):
        receipts.publish(rows, store, at, "engine", none, validate=lambda r: ["repeated_key"])
    made = receipts.prepare(rows, store, at, "engine")
    assert receipts.pending(spark, store, at, "engine")["publication_id"] == made["publication_id"]
    with pytest.raises(ValueError, match="changed"):
        receipts.acknowledge(rows.limit(3), store, made["publication_id"], none)
    history = receipts.resume(rows.repartition(3), store, made["publication_id"], none)
    assert {r["record_id"] for r in history.collect()} == {f"r{i}" for i in range(8)} and export.verify(spark, at) == []
    assert receipts.pending(spark, store, at, "engine") is None and receipts.load(spark, store, made["publication_id"])["state"] == "acknowledged"
    assert receipts.publish(rows, store, at, "engine", history).count() == 0
    assert receipts.publish(rows, store, at, "standalone", none).count() == 0
    with pytest.raises(KeyError):
        receipts.load(spark, store, "unknown")
    with pytest.raises(ValueError, match="purpose"):
        receipts.prepare(rows, store, at, "other")


def test_schema_depth(spark, monkeypatch):
    """Nodes lie at most SCHEMA_DEPTH levels below the root."""
    from tracesieve.functions import json as J

    monkeypatch.setattr(J, "SCHEMA_DEPTH", 5)

    def nested(levels):
        return '{"type":"array","items":' * (levels - 1) + '{"type":"string"}' + "}" * (levels - 1)

    rows = spark.createDataFrame([(1, nested(6)), (2, nested(7)), (3, None), (4, '"x"'), (5, '{"type":"object","properties":{"a":"{}"}}')], "k int, s string")
    got = sorted(tuple(r) for r in J.schema_problems(rows, "k", "s").collect())
    assert got == [(2, "$" + "[]" * 6, "depth"), (3, "$", "not_an_object"), (4, "$", "not_an_object"), (5, "$.a", "not_an_object")]


def test_answered(spark):
    from tracesieve.operators import seams

    requests = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "n int, k string")
    recorded = spark.createDataFrame([("a", 1.0)], "k string, v double")
    asked = []

    def ask(missing):
        asked.extend(r["k"] for r in missing.collect())
        return missing.filter("k = 'b'").selectExpr("k", "2d as v")

    rows = lambda df: sorted((r["n"], r["v"], r["origin"]) for r in df.collect())
    assert rows(seams.answered(requests, recorded, ["k"], "v")) == [(1, 1.0, "recorded"), (2, 1.0, "recorded"), (3, None, "unavailable"), (4, None, "unavailable")]
    assert rows(seams.answered(requests, recorded, ["k"], "v", ask)) == [(1, 1.0, "recorded"), (2, 1.0, "recorded"), (3, 2.0, "fresh"), (4, None, "unavailable")]
    assert sorted(asked, key=str) == [None, "b"]
    assert seams.answered(requests.limit(0), recorded, ["k"], "v").count() == 0
