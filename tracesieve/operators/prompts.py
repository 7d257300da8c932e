"""Edges between records whose complete prompts are the same or similar.

A unit is an assistant's turn to train on, its prompt all that stands before it: a shape (roles and
fields) and segments (the texts of the fields, as words). Two prompts of one shape are the same if
all their segments have the same words, and similar if each segment that differs is similar to its
counterpart. Prompts of which one is a prefix of another share their segments: a unit carries only
digests of all up to it, chained, so that a conversation of n turns makes n short rows.

Candidates: similar segments are linked first, over the distinct texts of the corpus; linked ones
form classes, and similar prompts have the same classes at all places. Prompts of one chain of
classes are joined at the place at which they differ most, by equal or similar segments, and only
those pairs are looked at whole. Neither a common first turn nor a common system text makes pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.functions.text import tokenize
from tracesieve.operators import screening
from tracesieve.sources.tables import cut

_UNIT = "struct<target int, exact string, classes string, user boolean>"
_STATE = f"struct<exact string, classes string, raw string, user boolean, open {_UNIT}, units array<struct<target int, exact string, classes string, user boolean, rendered string>>>"


def segments(records: DataFrame) -> DataFrame:
    """record, i, j, role, shape, seg, text, user: a row for each text of each message of records
    (record, messages); a message without any has one of no text. seg: a digest of the words."""
    m = records.select("record", F.posexplode("messages").alias("i", "m"))
    field = lambda name: F.when(F.col(f"m.{name}").isNotNull(), F.struct(F.lit(name).alias("field"), F.col(f"m.{name}").alias("text")))
    fields = F.array_compact(F.array(field("content"), field("reasoning")))
    rows = m.select("record", "i", F.col("m.role").alias("role"), F.posexplode_outer(fields).alias("j", "f"))
    words = F.array_join(tokenize(F.col("f.text")), " ")
    return rows.select(
        "record", "i", F.coalesce("j", F.lit(0)).alias("j"), "role",
        F.concat_ws("/", F.coalesce("role", F.lit("-")), F.coalesce("f.field", F.lit("-")), F.coalesce("j", F.lit(0)).cast("string")).alias("shape"),
        F.when(F.col("f.text").isNotNull(), F.sha2(words, 256)).alias("seg"),
        F.col("f.text").alias("text"),
        ((F.col("role") == "user") & (F.col("f.field") == "content") & (words != "")).alias("user"),
    )


def similar_segments(rows: DataFrame, ngrams: tuple[int, int], threshold: float) -> DataFrame:
    """a, b, lengths, similarity: different segments a < b whose n-grams reach the similarity, for how
    many n they do, and the greatest."""
    distinct = rows.filter("seg is not null").groupBy("seg").agg(F.min("text").alias("text"))
    pairs = screening.similar_pairs(distinct.select(F.col("seg").alias("rep"), tokenize(F.col("text")).alias("words")), ngrams, threshold)
    return cut(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("lengths"), F.max(F.col("intersection") / F.col("total")).alias("similarity")))


def _chained(before: Column, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", before, *(F.coalesce(p, F.lit("-")) for p in parts)), 256)


def units(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """record, target, exact, classes, rendered: the units whose prompt has a user's words, with
    digests of the prompt's shape and segments, of its shape and their classes, and of the texts
    as they stand, the target's included. classes: node, root."""
    named = rows.join(classes.toDF("seg", "root"), "seg", "left")
    x = F.struct("i", "j", "role", "shape", "seg", F.coalesce("root", "seg").alias("root"), F.sha2("text", 256).alias("raw"), "user")
    whole = named.groupBy("record").agg(F.array_sort(F.collect_list(x)).alias("x"))

    def closed(s: Column) -> Column:
        unit = F.struct(s["open"]["target"].alias("target"), s["open"]["exact"].alias("exact"), s["open"]["classes"].alias("classes"), s["open"]["user"].alias("user"), s["raw"].alias("rendered"))
        return F.when(s["open"].isNotNull(), F.array_append(s["units"], unit)).otherwise(s["units"])

    def step(s: Column, e: Column) -> Column:
        begins = e["j"] == 0
        unit = F.struct(e["i"].alias("target"), s["exact"].alias("exact"), s["classes"].alias("classes"), s["user"].alias("user"))
        opened = F.when(begins & (e["role"] == "assistant"), unit).when(begins, F.lit(None).cast(_UNIT)).otherwise(s["open"])
        return F.struct(
            _chained(s["exact"], e["shape"], e["seg"]).alias("exact"),
            _chained(s["classes"], e["shape"], e["root"]).alias("classes"),
            _chained(s["raw"], e["shape"], e["raw"]).alias("raw"),
            (s["user"] | F.coalesce(e["user"], F.lit(False))).alias("user"),
            opened.alias("open"),
            F.when(begins, closed(s)).otherwise(s["units"]).alias("units"),
        )

    start = F.from_json(F.lit('{"exact":"","classes":"","raw":"","user":false,"units":[]}'), _STATE)
    found = whole.select("record", F.explode(F.aggregate("x", start, step, closed)).alias("u"))
    return found.filter("u.user").select("record", "u.target", "u.exact", "u.classes", "u.rendered")


def prompt_edges(records: DataFrame, ngrams: tuple[int, int] = screening.NGRAMS, threshold: float = screening.SIMILARITY) -> DataFrame:
    """kind, target, a, b, differing, similarity for records (record, messages): edges of
    exact_training_example and exact_complete_prompt join the first record of equal units with each
    other one; lexical_complete_prompt joins the first records of two different prompts that are similar
    throughout, with the number of segments that differ and the least of their similarities.
    target: the place of the assistant's turn. Null messages and null texts have no segments."""
    rows = cut(segments(records))
    near = similar_segments(rows, ngrams, threshold)
    unit = cut(units(rows, screening.components(near.select("a", "b"))))
    none = (F.lit(None).cast("long").alias("differing"), F.lit(None).cast("double").alias("similarity"))

    def stars(kind: str, key: str) -> DataFrame:
        first = unit.groupBy(key).agg(F.min("record").alias("a"))
        return unit.join(first, key).filter("record <> a").select(F.lit(kind).alias("kind"), "target", "a", F.col("record").alias("b"), *none)

    prompts = unit.groupBy("classes", "exact", "target").agg(F.min("record").alias("record"))
    several = prompts.groupBy("classes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("classes")
    prompts = cut(prompts.join(several, "classes"))
    place = F.struct("i", "j").alias("place")
    of = cut(prompts.join(rows.select("record", "seg", "i", place), "record").filter("i < target").select("classes", "exact", "place", "seg"))
    widest = of.groupBy("classes", "place").agg(F.countDistinct("seg").alias("n")).groupBy("classes").agg(F.max_by("place", F.struct("n", "place")).alias("place"))
    at = of.join(widest, ["classes", "place"]).select("classes", "exact", "seg")
    both = near.select("a", "b").union(near.select("b", "a")).toDF("seg", "other")
    other = at.select("classes", F.col("seg").alias("other"), F.col("exact").alias("right"))
    reached = at.join(both, "seg").select("classes", "exact", "other").union(at.select("classes", "exact", F.col("seg").alias("other")))
    pairs = reached.join(other, ["classes", "other"]).filter("exact < right").select("classes", F.col("exact").alias("left"), "right").distinct()
    left, right = (of.select("classes", F.col("exact").alias(side), "place", F.col("seg").alias(f"{side}_seg")) for side in ("left", "right"))
    places = pairs.join(left, ["classes", "left"]).join(right, ["classes", "right", "place"]).filter("left_seg <> right_seg")
    told = places.withColumns({"a": F.least("left_seg", "right_seg"), "b": F.greatest("left_seg", "right_seg")}).join(near, ["a", "b"], "left")
    whole = told.groupBy("classes", "left", "right").agg(F.count(F.lit(1)).alias("differing"), F.min("similarity").alias("similarity"), F.bool_and(F.col("similarity").isNotNull()).alias("all"))
    ends = [prompts.select(F.col("exact").alias(side), F.col("target"), F.col("record").alias(side + "_record")) for side in ("left", "right")]
    found = whole.filter("all").join(ends[0], "left").join(ends[1].drop("target"), "right")
    lexical = found.select(F.lit("lexical_complete_prompt").alias("kind"), "target", F.least("left_record", "right_record").alias("a"), F.greatest("left_record", "right_record").alias("b"), "differing", "similarity")
    return stars("exact_training_example", "rendered").union(stars("exact_complete_prompt", "exact")).union(lexical)


def item_prompts(records: DataFrame, items: DataFrame) -> DataFrame:
    """record, target, item_id: units whose complete prompt has the words of a protected item's,
    which is one user's turn."""
    rows = segments(records)
    unit = units(rows, rows.select(F.col("seg").alias("node"), F.col("seg").alias("root")).limit(0))
    words = F.array_join(tokenize(F.col("text")), " ")
    exact = _chained(F.lit(""), F.lit("user/content/0"), F.sha2(words, 256))
    return unit.join(items.filter(words != "").select("item_id", exact.alias("exact")), "exact").select("record", "target", "item_id")
