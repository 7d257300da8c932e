"""Cases of the third review: plans that grow as their input, exact forms of cheaper steps."""

import tracesieve.plans.all  # noqa: F401
from pyspark.sql import functions as F
from tracesieve.functions import text as T
from tracesieve.operators import screening, seams
from tracesieve.plans.registry import QUERIES

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_chain_is_never_broadcast(spark):
    assert "BroadcastHashJoin" not in plan(QUERIES["predecessor_revalidation"](spark, DIR))


def test_an_episode_is_parsed_once(spark):
    told = plan(spark.range(1).select(seams.episode_identities(F.concat(F.lit('{"task":{"source":"'), "id", F.lit('"}}'))).alias("x")))
    assert told.count("parse_json") == 1 or told.count("parseJson") == 1
    assert spark.sql("select '[1' as j").select(seams.episode_identities(F.col("j")).alias("x")).select("x.task", "x.candidate").first() == (None, None)


def test_similar_pairs_of_all_lengths_by_few_shingles(spark):
    texts = [" ".join(f"w{(i * 7 + k * k) % 90}" for k in range(30 + i)) for i in range(12)]
    texts += [t + " and some more" for t in texts] + ["one " + " ".join(texts[0].split()[1:]), "a b a b c " * 12, "a b a b c " * 11 + "a", "a b " * 20, "a b " * 30]
    common = " ".join(f"c{k}" for k in range(14))
    texts += [f"{common} {' '.join(f'u{i}x{k}' for k in range(12))}" for i in range(20)] + [f"{common} {' '.join(f'u3x{k}' for k in range(12))} end"]
    reps = spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "rep long, words array<string>")
    want = set()
    sets = {n: [{tuple(t.split()[k : k + n]) for k in range(len(t.split()) - n + 1)} for t in texts] for n in range(8, 14)}
    for n, s in sets.items():
        for a in range(len(s)):
            for b in range(a + 1, len(s)):
                both, total = len(s[a] & s[b]), len(s[a] | s[b])
                if both and both >= 0.8 * total:
                    want.add((a, b, n, both, total))
    assert want and {tuple(r) for r in screening.similar_pairs(reps).collect()} == want
    heads = screening._heads(reps, (8, 13), 0.8).count()
    assert heads < sum(len(x) for x in sets[8])  # not the heads of each length


def test_a_minus_is_no_count(spark):
    texts = ["-0.0", " -0", "0.0", "+7.9", "-3", "n/a"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.to_count(F.col("t")).cast("long").alias("n")).collect()
    assert dict(got) == {"-0.0": None, " -0": None, "0.0": 0, "+7.9": 7, "-3": None, "n/a": None}


def test_sizes_of_all_lengths_from_one_hash_of_the_words(spark):
    texts = ["", "a", "a b c d e", "a b " * 9, " ".join(f"w{k % 11}" for k in range(40))]
    words = spark.createDataFrame([(t.split(),) for t in texts], "w array<string>")
    lengths = (5, 8, 9, 13)
    got = words.select("w", screening.shingle_sizes(F.col("w"), lengths).alias("k")).collect()
    assert [list(r.k) for r in got] == [[len({tuple(r.w[i : i + n]) for i in range(len(r.w) - n + 1)}) for n in lengths] for r in got]


def test_edges_read_texts_once(spark):
    edges = QUERIES["declared_edges"](spark, DIR)
    assert "text#" not in plan(edges)  # only their digests, which are written once


def test_rows_of_artifacts_are_put_in_order_without_bodies(spark):
    made = [(1, 1, 20), (1, 3, 15), (1, 4, 40), (2, 7, 5), (2, 9, 6), (None, 1, 2), (None, 2, 1), (3, 1, 9)]
    rows = spark.createDataFrame([(*r, '{"a":1}') for r in made], "artifact_id long, place int, record_id long, body string")
    rows = rows.withColumn("row_id", F.when(F.col("artifact_id").eqNullSafe(3), "0").otherwise(T.framed_digest(F.lit("row-v5"), F.col("record_id").cast("string"), F.col("body"))))
    out = seams.artifact_rows(rows)
    got = {tuple(r)[:3]: r.problem for r in out.collect()}
    # the place before may be any: between 1 and 3 stands none
    assert got == {r: {(1, 3, 15): "order", (None, 2, 1): "order", (3, 1, 9): "identity"}.get(r) for r in made}
    assert "body" not in plan(out).replace(" THEN body ", "") and "SortMergeJoin" not in plan(out)


def test_a_tile_computes_no_pair_that_its_links_connect(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from tracesieve.llm import neardup

    texts = [" ".join(["again"] * 9 + [f"w{k % 60}" for k in range(120 + i % 5)]) for i in range(30)] + ["quite another text of nine words is this one"]
    vectors = next(neardup._vectors(iter([pa.RecordBatch.from_pydict({"node": pa.array(range(31)), "text": texts})])))
    n = vectors.num_rows
    sides = []
    for outer in (True, False):
        marks = {"band": pa.array([1] * n), "i": pa.array([0] * n, pa.int32()), "j": pa.array([0] * n, pa.int32()), "outer": [outer] * n, "node": vectors.column("node"), "root": vectors.column("node"), "main": [False] * n}
        sides.append(pa.RecordBatch.from_pydict({**marks, "keys": vectors.column("keys"), "counts": vectors.column("counts")}))
    calls, exact = [], neardup.similarity
    monkeypatch.setattr(neardup, "similarity", lambda a, b: calls.append(1) or exact(a, b))
    found = list(neardup._tiles(0.8)(iter(sides)))
    links = {(a, b) for batch in found for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)}
    assert len(links) == 29 and {x for pair in links for x in pair} == set(range(30))  # a tree over the copies
    assert len(calls) <= 2 * n  # not all 900 pairs


def test_a_round_has_no_more_learners_than_asked_for(spark, monkeypatch):
    """Each learner sends all tables: a session with many partitions for a key must not multiply them."""
    import public_tokenizers as P
    from tracesieve.llm import lm

    docs = spark.createDataFrame([(i, f"some words {i % 7} and others {i % 11} " * 9) for i in range(60)], "doc_id long, text string")
    ranks, pattern = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    ids, tasks = lm.encoded(docs, ranks, pattern), []
    frame = type(docs)
    deal, learn = frame.repartition, frame.mapInArrow
    monkeypatch.setattr(frame, "repartition", lambda self, n, *columns: deal(self, max(n, 40), *columns))
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, kind, *more: (f.__name__ == "run" and kind == lm._LEARNT and tasks.append(self.rdd.getNumPartitions())) or learn(self, f, kind, *more))
    model = lm.train(ids, len(lm.subwords(ranks, pattern).begins), 1)
    assert tasks == [1] * lm.ROUNDS * lm.SHARE and model.seen


def test_words_kept_from_block_to_block_have_their_own_ids(monkeypatch):
    import numpy as np
    import public_tokenizers as P
    import pyarrow as pa
    from tracesieve.llm import lm

    monkeypatch.setattr(lm, "KNOWN", 40)  # so that kept words are also dropped
    model = lm.Subwords(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    monkeypatch.setattr(lm, "subwords", lambda *_: model)
    asked, plain = [], model.of_words
    monkeypatch.setattr(model, "of_words", lambda words: asked.extend(words) or plain(words))
    texts = [" ".join(f"w{(i * 5 + k * k) % 60}x don't" for k in range(i % 9)) for i in range(40)]
    for a in range(0, 40, 4):
        ids, at = lm.encode_texts(pa.array(texts[a : a + 4]), "", "")
        for t, x, y in zip(texts[a : a + 4], at[:-1], at[1:], strict=True):
            assert ids[x:y].tolist() == [i for w in t.split() for i in model.encode(" " + w)] + [model.end]
    assert 0 < len(model.known[0]) <= 40 and np.all(np.diff(model.known[0].astype(float)) > 0)
    assert len(asked) < sum(len({w for t in texts[a : a + 4] for w in t.split()}) for a in range(0, 40, 4))
