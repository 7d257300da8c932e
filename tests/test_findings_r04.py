"""Cases of the fourth review: sums in the order of the input, pairs that grow as their input."""

import random

import tracesieve.plans.all  # noqa: F401
from pyspark.sql import functions as F
from tracesieve.operators import screening
from tracesieve.plans.registry import QUERIES
from tracesieve.sources import tables


def test_panels_add_up_in_the_order_of_the_input(spark, tmp_path):
    """Means exactly at a border, votes of a panel in several files: the band is that of adding up row by row."""
    draw, rows = random.Random(4), []
    for record in range(400):
        border = 60 if record % 2 else 80  # hundredths of the score
        while True:
            panel = [(draw.randrange(11), draw.randrange(20, 51)) for _ in range(4)]
            if sum(w * (10 * d - border) for d, w in panel) == 0:
                break
        rows += [(record, d / 100, float(w)) for d, w in panel]
    draw.shuffle(rows)
    for at in range(3):
        part = spark.createDataFrame(rows[at * 534 : (at + 1) * 534], "l_orderkey long, l_discount double, l_quantity double")
        votes = part.withColumns({"l_linenumber": F.lit(1), "l_suppkey": F.lit(1).cast("long"), "l_returnflag": F.lit("A"), "l_linestatus": F.lit("F")})
        votes.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{at}")
        (part_file,) = (tmp_path / str(at)).glob("part-*.parquet")
        (tmp_path / "lineitem.parquet").mkdir(exist_ok=True)
        (tmp_path / "lineitem.parquet" / f"part-{at}.parquet").write_bytes(part_file.read_bytes())
    scored, weights = {}, {}
    for record, d, w in rows:
        scored[record] = scored.get(record, 0.0) + w * (d * 10)
        weights[record] = weights.get(record, 0.0) + w
    mean = {r: scored[r] / weights[r] for r in scored}
    want = {r: "accept" if m >= 0.8 else "reject" if m < 0.6 else "revise" for r, m in mean.items()}
    assert set(want.values()) == {"accept", "reject", "revise"}  # of two borders, three bands: sums are off either way
    for partitions in ("1m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", partitions)
        try:
            got = QUERIES["panel_consensus"](spark, str(tmp_path)).select("record_id", "n_eff", "votes", "decision").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        guarded = {r.record_id for r in got if r.n_eff / r.votes < 0.5 or r.n_eff < 1.5}
        assert len(got) == 400 and len(guarded) < 200
        assert {r.record_id: r.decision for r in got} == {r: "escalate" if r in guarded else w for r, w in want.items()}


def brute(texts, ngrams, threshold):
    want = set()
    for n in range(ngrams[0], ngrams[1] + 1):
        s = [{tuple(t[k : k + n]) for k in range(len(t) - n + 1)} for t in texts]
        for a in range(len(s)):
            for b in range(a + 1, len(s)):
                both, total = len(s[a] & s[b]), len(s[a] | s[b])
                if both and both >= threshold * total:
                    want.add((a, b, n, both, total))
    return want


def test_pairs_leave_little_on_disk(spark, tmp_path, monkeypatch):
    """Texts of six have a quarter in common and aren't similar: what is written stays near eight bytes a word."""
    texts = [[f"line{i // 6}x{k}" for k in range(75)] + [f"own{i}x{k}" for k in range(225)] for i in range(150)]
    texts += [[*t, "end"] for t in texts[:4]]
    reps = spark.createDataFrame(list(enumerate(texts)), "rep long, words array<string>")
    monkeypatch.setattr(tables, "shared_folder", lambda _: f"file://{tmp_path}")
    got = {(r.a, r.b) for r in screening.similar_pairs(reps).collect()}
    assert got == {(i, 150 + i) for i in range(4)}
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 2 * 8 * sum(map(len, texts))


def test_pairs_of_texts_with_repeats(spark, monkeypatch):
    """The least share of heads drops no pair, be words repeated or common; neither do small blocks."""
    draw = random.Random(8)
    texts = [[f"w{draw.randrange(6)}" for _ in range(draw.randrange(1, 60))] for _ in range(40)]
    for t in texts[:30]:  # near copies, some twice as long by a repeat
        copy = list(t)
        copy[draw.randrange(len(copy))] = "other"
        texts += [copy, copy + copy[: draw.randrange(len(copy))]]
    monkeypatch.setattr(screening, "COMMON", 2)
    reps = spark.createDataFrame(list(enumerate(texts)), "rep long, words array<string>")
    for ngrams, threshold in (((2, 5), 0.5), ((3, 6), 0.8), ((4, 4), 0.3)):
        monkeypatch.setattr(screening, "BLOCK_TEXTS", 3)
        monkeypatch.setattr(screening, "BLOCK_WORDS", 100)
        want = brute(texts, ngrams, threshold)
        assert want and {tuple(r) for r in screening.similar_pairs(reps, ngrams, threshold).collect()} == want
