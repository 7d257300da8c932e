"""Repair, formatting and collocations against their SQL, plain loops and odd rows."""

import collections
import hashlib
import itertools
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tracesieve.llm import chats, phrases, queries, repair

DIR = "/root/testdata/sf0.001"
CHATS = "conv_id long, turn long, role string, text string, place long, told double"
DOCS = "doc_id long, text string, lang string, source string, n double, word string"


def told_by_sql(name, **tables):
    c = duckdb.connect()
    for t, rows in tables.items():
        c.register(t, rows)
    found = c.execute(queries.ORACLES[name])
    names = [x[0] for x in found.description]
    return sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in found.fetchall()), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_edit_lattice", "op12_byte_assembly", "op13_collocations"])
def test_query_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("conversations", "documents"):
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DIR)
    found = c.execute(queries.ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df) == sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in found.fetchall()), key=repr)


def odd_chats():
    r = random.Random(5)
    texts = ["Hi.", "", " \t\n", "Well", "No!", "a" * 40_000 + ".", "日本 é😀?", "[INST] x [/INST]", r"<\\/s> [\SYS] <s>", "Hi.", "  end.  \r\n", None]
    rows = [(c, t, r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "[/ROLE]", None]), r.choice(texts), 1, 0.5) for c in range(60) for t in range(r.randint(1, 9))]
    rows += [(None, 0, "user", "Hi.", 1, 0.5), (None, 1, "assistant", "Ho.", 1, 0.5), (70, None, "user", "Hi.", 1, 0.5), (70, 2, "assistant", "Yes.", 1, 0.5), (71, None, None, None, None, None)]
    rows += [(72, 3, "user", "Same.", 1, 0.5)] * 4 + [(73, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.", 1, 0.5) for t in range(700)]
    return rows


def test_odd_conversations(spark):
    rows = odd_chats()
    df = spark.createDataFrame(rows, CHATS)
    table = pa.table({n: [x[i] for x in rows] for i, n in enumerate(["conv_id", "turn", "role", "text"])}, schema=pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    assert rows_of(repair.digests(repair.damaged(df), df).repartition(3)) == told_by_sql("op11_edit_lattice", conversations=table)
    assert rows_of(chats.read_back(chats.formatted(chats.with_probe(df)))) == told_by_sql("op12_byte_assembly", conversations=table)
    none = df.limit(0)
    assert repair.digests(repair.damaged(none), none).count() == 0
    assert chats.read_back(chats.formatted(none)).count() == 0


def test_repaired_rows(spark):
    df = spark.createDataFrame(odd_chats(), CHATS)
    want = {r["conv_id"]: r for r in repair.digests(df).collect()}
    got = collections.defaultdict(list)
    for r in repair.repaired(df).orderBy("conv_id", "place").collect():
        got[r["conv_id"]].append(r)
    for i, told in want.items():
        said = got[i]
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in said).encode()).hexdigest() == told["repaired_sha256"]
        assert "".join(r["edit"] for r in said) == told["audit"].replace("D", "")
        initials = "".join(r["role"][:1] for r in said)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)


def plain_repair(codes):
    """Row by row: the least (cost, audit) of each state."""
    step = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(best):
        for s, (c, a) in list(best.items()):
            for more in ("I", "II"):
                s = step[s]
                best[s] = min(best.get(s, (c + 3 * len(more), a + more)), (c + 3 * len(more), a + more))
        return best

    best = inserted({0: (0, "")})
    for code in codes:
        new = {}
        for s, (c, a) in best.items():
            ways = [(s, c + 4, "D")]
            if not code & 4:
                extra = 3 if code & 8 else 0
                ways.append((step[s], c + 3 + extra, "R"))
                r = code & 3
                if (r == 1 and s == 0) or (r > 1 and step[s] == r):
                    ways.append((r, c + extra, "K"))
            for t, cost, letter in ways:
                new[t] = min(new.get(t, (cost, a + letter)), (cost, a + letter))
        best = inserted(new)
    return min(x for s, x in best.items() if s in (0, 3))


def test_cheapest_edits_against_a_plain_fold():
    kinds = [0, 1, 2, 3, 6, 7, 10, 11]
    for n in range(4):
        for codes in itertools.product(kinds, repeat=n):
            assert repair.repair(bytes(codes)) == plain_repair(codes), codes
    r = random.Random(2)
    for _ in range(400):
        codes = bytes(r.choices(kinds, [1, 1, 5, 5, 1, 1, 1, 1], k=r.randint(1, 40)))
        want = plain_repair(codes)
        assert repair.repair(codes) == want
        for size in (1, 2, 3, 7):  # by blocks
            assert repair.repair(codes, size) == want, (codes, size)
    long = bytes(r.choices(kinds, [1, 1, 5, 5, 1, 1, 1, 1], k=3000))
    assert repair.repair(long) == plain_repair(long)


def test_parts_of_a_long_conversation(monkeypatch):
    r = random.Random(3)
    said = [(r.choice(["system", "user", "assistant", "tool [/ROLE]"]), r.choice(["", "é" * r.randint(0, 90), "</s>", "[INST]", "\\", "<\\s>"])) for _ in range(200)]
    rows = pa.RecordBatch.from_pydict({"conv_id": [1] * 120 + [None] * 80, "role": [x for x, _ in said], "text": [x for _, x in said]}, schema=pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    for part in (1, 50, 1000, 1 << 20):
        monkeypatch.setattr(chats, "PART", part)
        for cut in (1, 7, 200):
            parts = [p for b in chats._format_batches(iter([rows.slice(i, cut) for i in range(0, 200, cut)])) for p in b.to_pylist()]
            assert len(parts) > 2 or part > 1000
            got, mask = collections.defaultdict(list), collections.defaultdict(str)
            for p in parts:
                got[p["conv_id"]] += [t[:2] for t in chats.turns_of(p["text"], p["first"])]
                mask[p["conv_id"]] += "".join(chats.unescaped(p["text"][a:b]) for a, b in zip(p["starts"], p["ends"], strict=True))
            assert got == {1: said[:120], None: said[120:]}
            assert mask == {k: "".join(t for x, t in v if x == "assistant") for k, v in got.items()}


def test_escapes_come_back():
    r = random.Random(4)
    texts = ["".join(r.choices(["<", "[", "\\", "/", "s>", "INST]", "SYS]", "ROLE]", " ", "x"], k=r.randint(0, 12))) for _ in range(3000)]
    out = chats.escaped(pa.array(texts, pa.large_string())).to_pylist()
    assert [chats.unescaped(x) for x in out] == texts
    for x in out:
        assert not any(c in x for c in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]"))


# --- phrases -----------------------------------------------------------------------------------


def test_multikey_quicksort_counts():
    r = np.random.default_rng(1)
    for n in (0, 1, 5, 2000):
        keys = r.integers(0, 6, (n, 3)) ** 2
        keys[r.random(n) < 0.3, 2] = -1
        weights = r.integers(1, 4, n)
        want = collections.Counter()
        for k, w in zip(keys.tolist(), weights.tolist(), strict=True):
            for words in (2, 3):
                if k[words - 1] >= 0:
                    want[tuple(k[:words])] += w
        for least in (1, 10):
            got = {tuple(keys[p, :k].tolist()): c for k, at, count in phrases.multikey_quicksort(keys, weights, least, False) for p, c in zip(at.tolist(), count.tolist(), strict=True)}
            assert got == {k: c for k, c in want.items() if c >= least}
            deep = {tuple(keys[p, :k].tolist()): c for k, at, count in phrases.multikey_quicksort(keys, weights, least, True) for p, c in zip(at.tolist(), count.tolist(), strict=True)}
            assert deep == {k: c for k, c in want.items() if c >= least or len(k) == 2}


def odd_docs():
    r = random.Random(6)
    words = ["aa", "bb", "cc", "Dd", "é", "x\x0by", "日", "…", "q r"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", " ", ", ", ".\n"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None, "und"]), "s", 1.0, "w") for i in range(120)]
    rows += [(None, None, "en", None, None, None), (500, "", "en", "s", 1.0, "w"), (501, " . ", None, "s", 1.0, "w"), (502, "hot pair " * 3000, "en", "s", 1.0, "w"), (502, "hot pair " * 3000, "en", "s", 1.0, "w"), (503, "one", "fr", "s", 1.0, "w")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_odd_documents(spark, small, monkeypatch):
    rows = odd_docs()
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if small:  # so that pairs are routed by three words
        monkeypatch.setattr(phrases, "FINER", 1)
        heavy = phrases.word_counts(df.select("lang", "text").fillna("und", ["lang"]).fillna("", ["text"]), 10).filter("word like '% %'").count()
        assert heavy > 0
    table = pa.table({"lang": [x[2] for x in rows], "text": [x[1] for x in rows]})
    got, want = rows_of(phrases.collocations(df)), told_by_sql("op13_collocations", documents=table)
    assert len(want) > 20 and got == want
    assert phrases.collocations(df.limit(0)).count() == 0


def test_score_past_64_bits(spark):
    big = 3_000_000_000_007
    df = spark.sql(f"select {big}L as a, {big + 5}L as l, {big + 9}L as r")
    from pyspark.sql import functions as F

    got = df.select(phrases.exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert got == 1_000_000 * big * big // ((big + 5) * (big + 9))
