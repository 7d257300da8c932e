"""Cycles, groups that are extended, and the cache, against plain loops."""

import random

from pyspark.sql import functions as F

from tracesieve.operators import budgets, screening
from tracesieve.sources import cache


def endless(edges):
    left = set(edges)
    while True:
        sources = {a for a, _ in left}
        kept = {(a, b) for a, b in left if b in sources}
        if kept == left:
            return sources
        left = kept


def test_a_long_line_takes_few_passes(spark, monkeypatch):
    passes = []
    real = screening.cut
    monkeypatch.setattr(screening, "cut", lambda df: passes.append(1) or real(df))
    line = spark.range(100_000).select(F.col("id").alias("child"), (F.col("id") + 1).alias("parent"))
    assert screening.cyclic_nodes(line).count() == 0
    assert len(passes) < 40
    ring = line.withColumn("parent", F.when(F.col("parent") == 100_000, F.lit(70_001)).otherwise(F.col("parent")))
    assert screening.cyclic_nodes(ring).count() == 100_000


def test_cycles_of_made_up_graphs(spark):
    r = random.Random(4)
    for n, m in ((1, 1), (6, 7), (40, 38), (60, 70), (200, 190)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 1001), (3000, 3000), (3001, 3002)]
        df = spark.createDataFrame([*edges, *edges[:3], (None, 1), (1, None)], "child long, parent long")
        assert {x["node"] for x in screening.cyclic_nodes(df).collect()} == endless(edges)
    assert screening.cyclic_nodes(df.limit(0)).count() == 0


def test_extended_groups_are_those_of_all_edges(spark):
    r = random.Random(9)
    edge = "a long, b long"
    for n in (12, 60):
        first = [(r.randrange(n), r.randrange(n)) for _ in range(n // 3)]
        star = screening.components(spark.createDataFrame(first, edge))
        for _ in range(2):
            later = [(r.randrange(n + 20), r.randrange(n + 20)) for _ in range(n // 5)]
            fresh, moved = screening.extended_components(star, spark.createDataFrame(later, edge))
            first += later
            star = screening.resolved(star, fresh, moved)
            got = {x["node"]: x["root"] for x in star.collect()}
            want = {x["node"]: x["root"] for x in screening.components(spark.createDataFrame(first, edge)).collect()}
            assert {k: v for k, v in got.items() if k in want} == want
            assert all(got[k] == k for k in got.keys() - want.keys())  # only edges to themselves
    fresh, moved = screening.extended_components(star, spark.createDataFrame([], edge))
    assert fresh.count() == moved.count() == 0


CALL = "content_hash string, kind string, model string, rubric_id string, value string"


def test_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    ask = spark.createDataFrame([("a", "judge", "m", None, 1), ("a", "judge", "m", "r", 2), ("z", "judge", "m", "", 3)], "content_hash string, kind string, model string, rubric_id string, n long")
    told = lambda: {x["n"]: (x["value"], x["hit"]) for x in cache.get(ask, path).collect()}
    put = lambda *rows: cache.put(spark.createDataFrame(rows, CALL), path)
    assert told() == {1: (None, False), 2: (None, False), 3: (None, False)} and cache.compact(spark, path) == 0
    assert put(("a", "judge", "m", None, "one")) == 1
    assert put(("a", "judge", "m", "", "two"), ("a", "judge", "m", "r", None)) == 2
    assert told() == {1: ("two", True), 2: (None, True), 3: (None, False)}
    before = cache.state(spark, path)
    assert cache.compact(spark, path) == 2 and cache.compact(spark, path) == 2
    assert put(("a", "judge", "m", "", "three")) == 3
    assert before.count() == 2 and told()[1] == ("three", True)  # an old reader still reads
    cache.vacuum(spark, path)
    assert sorted(x.name for x in (tmp_path / "cache").iterdir()) == ["delta-000000000003", "snapshot-000000000002"]
    assert told() == {1: ("three", True), 2: (None, True), 3: (None, False)}
    assert cache.compact(spark, path) == 3 and told()[1] == ("three", True)


def plain_budget(texts, limits):
    most = budgets.LIMITS | limits
    total, words = 0, []
    for i, t in enumerate(texts):
        if len(t.encode()) > most["segment_bytes"]:
            return "segment_bytes", i
        if i >= most["segments"]:
            return "segments", i
        total += len(t.encode())
        if total > most["total_text_bytes"]:
            return "total_text_bytes", i
        words.append(t.split())
        if len(words[-1]) > most["segment_tokens"]:
            return "segment_tokens", i
    work = shingles = 0
    for i, w in enumerate(words):
        for n in budgets.LENGTHS:
            if len(w) >= n:
                work += (len(w) - n + 1) * n
                if work > most["shingle_token_work"]:
                    return "shingle_token_work", i
                shingles += len({tuple(w[k : k + n]) for k in range(len(w) - n + 1)})
                if shingles > most["distinct_shingles"]:
                    return "distinct_shingles", i
    return "complete", None


def test_budgets_against_a_plain_loop(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.choice([0, 3, 8, 20, 60]))) for _ in range(60)]
    cases = {f"{name}-{k}": {name: k} for name, ks in {"segment_bytes": (1, 100), "segments": (0, 30), "total_text_bytes": (0, 900), "segment_tokens": (2, 59), "shingle_token_work": (0, 5000, 20_000), "distinct_shingles": (0, 700)}.items() for k in ks}
    cases |= {"none": {}, "both": {"shingle_token_work": 5000, "distinct_shingles": 700}}
    df = spark.createDataFrame([(i, t or None) for i, t in enumerate(texts)], "id long, text string").repartition(5)
    got = {x["case_"]: (x["counter"], x["ordinal"]) for x in budgets.first_over(budgets.charged_segments(df, ["id"]), cases).collect()}
    assert got == {name: plain_budget(texts, limits) for name, limits in cases.items()}
    empty = budgets.first_over(budgets.charged_segments(df.limit(0), ["id"]), {"none": {}}).collect()
    assert [(x["counter"], x["used"]) for x in empty] == [("complete", None)]
