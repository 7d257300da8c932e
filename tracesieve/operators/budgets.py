"""Budgets of work, charged in order: which limit a screening passes first, and where.

Segments are charged in their order, first for being taken in (bytes, number, bytes of all, words), then for their
shingles (words touched and different shingles, for the overlap's length and each n-gram's, ascending), then records for
the pairs of their units. What is charged up to a segment is a sum over those before it, so that no loop is run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.functions.text import tokenize
from tracesieve.operators.screening import MIN_OVERLAP, NGRAMS, shingle_sizes
from tracesieve.operators.sequences import prefix_sums
from tracesieve.sources.tables import cut

# Limits of a screening.
LIMITS = {
    "segment_bytes": 1 << 20, "segments": 100_000, "total_text_bytes": 64 << 20, "segment_tokens": 65_536,
    "shingle_token_work": 64_000_000, "distinct_shingles": 2_000_000, "comparisons": 1_000_000,
}
LENGTHS = tuple(sorted({MIN_OVERLAP, *range(NGRAMS[0], NGRAMS[1] + 1)}))


def charged_segments(segments: DataFrame, order: list[str]) -> DataFrame:
    """For each segment (order, text) in order: ordinal, bytes, tokens and the sums of bytes, and for each length n
    work_n, shingles_n and the sums up to and with it. Null texts are empty ones."""
    text = F.coalesce("text", F.lit(""))
    x = segments.select(*order, F.octet_length(text).cast("long").alias("bytes"), tokenize(text).alias("words"))
    sized = x.select(*order, "bytes", F.size("words").cast("long").alias("tokens"), shingle_sizes(F.col("words"), LENGTHS).alias("sizes"))
    sized = cut(sized)  # ranges are found by a pass over the rows: not over the texts again
    sized = sized.select(*order, "bytes", "tokens", *(F.col("sizes")[k].cast("long").alias(f"shingles_{n}") for k, n in enumerate(LENGTHS)))
    work = {f"work_{n}": F.greatest(F.lit(0).cast("long"), F.col("tokens") - (n - 1)) * n for n in LENGTHS}
    sized = sized.withColumns(work)
    total = lambda kind: reduce(lambda a, b: a + b, (F.col(f"{kind}_{n}") for n in LENGTHS))
    return prefix_sums(sized.withColumns({"work": total("work"), "shingles": total("shingles")}), order, ["bytes", "work", "shingles"])


def charged_records(records: DataFrame, order: list[str]) -> DataFrame:
    """For each record (order, units) in order: ordinal and the pairs of its units with those of the records before it, summed
    up to and with it."""
    x = prefix_sums(records.select(*order, F.coalesce("units", F.lit(0)).cast("long").alias("units")), order, ["units"])
    pairs = x.select(*order, (F.col("units") * (F.col("upto_units") - F.col("units"))).alias("pairs"))
    return prefix_sums(pairs, order, ["pairs"])


def _charges(phase: int, used: list[tuple[str, int | None, Column]]) -> Column:
    """An array of what is charged in turn: counter, length and the sum by then."""
    rows = (F.struct(F.lit(phase).alias("phase"), F.lit(k).alias("place"), F.lit(c).alias("counter"), F.lit(n).cast("int").alias("length"), x.cast("long").alias("used")) for k, (c, n, x) in enumerate(used))
    return F.array(*rows)


def first_over(segments: DataFrame, cases: dict[str, dict[str, int]], records: DataFrame | None = None) -> DataFrame:
    """A row for each case, which is a name and limits (those that it doesn't give are LIMITS'): case_; counter, the first
    limit that is passed, or complete; ordinal, of the segment (comparisons: of the record) that passes it; length, of the
    shingles; used, what is charged by then, the step that passes included. segments: from charged_segments; records: from
    charged_records. All cases are told by one aggregation."""
    taken = [("segment_bytes", None, F.col("bytes")), ("segments", None, F.col("ordinal") + 1), ("total_text_bytes", None, F.col("upto_bytes")), ("segment_tokens", None, F.col("tokens"))]
    # what was charged before a segment, and then for its lengths up to n
    upto = lambda kind, k: F.col(f"upto_{kind}") - F.col(kind) + reduce(lambda a, b: a + b, (F.col(f"{kind}_{n}") for n in LENGTHS[: k + 1]))
    made = [(name, n, upto(kind, k)) for k, n in enumerate(LENGTHS) for kind, name in (("work", "shingle_token_work"), ("shingles", "distinct_shingles"))]
    charged = segments.select("ordinal", F.explode(F.concat(_charges(0, taken), _charges(1, made))).alias("x"))
    if records is not None:
        charged = charged.union(records.select("ordinal", F.explode(_charges(2, [("comparisons", None, F.col("upto_pairs"))])).alias("x")))
    charged = charged.select("x.phase", "ordinal", "x.place", "x.counter", "x.length", "x.used")

    def least(limits: dict[str, int]) -> Column:
        limit = F.element_at(F.create_map(*(F.lit(v) for kv in (LIMITS | limits).items() for v in kv)), F.col("counter"))
        return F.min(F.when(F.col("used") > limit, F.struct("phase", "ordinal", "place", "counter", "length", "used")))

    first = charged.agg(*(least(limits).alias(name) for name, limits in cases.items()))
    each = first.select(F.explode(F.array(*(F.struct(F.lit(name).alias("case_"), F.col(name).alias("f")) for name in cases))).alias("c"))
    return each.select("c.case_", F.coalesce("c.f.counter", F.lit("complete")).alias("counter"), "c.f.ordinal", "c.f.length", "c.f.used")
