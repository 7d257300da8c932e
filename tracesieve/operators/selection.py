"""Choice among siblings, preference pairs, rewards, export predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def admissible() -> Column:
    return F.col("decision").isin("accept", "revise")


def selected_admitted(verdict: str = "verdict", state: str = "state") -> Column:
    return (F.col(verdict) == "admit") & F.col(state).isin("admitted", "formatted", "exported")


def best_of_k(rows: DataFrame) -> DataFrame:
    """rows with outcome: of a group's admissible rows the one of the largest aggregate is kept
    (an established one before all, ties to the lowest idx, null last), the others are retained;
    rows that aren't admissible keep their decision. One window by group; groups are as large as
    their number of completions."""
    order = Window.partitionBy("group_id", admissible()).orderBy(F.coalesce("established", F.lit(False)).desc(), F.col("aggregate").desc_nulls_last(), "idx")
    place = F.row_number().over(order)
    return rows.withColumn("outcome", F.when(~admissible(), F.col("decision")).when(place == 1, "selected").otherwise("best_of_k_retained"))


def preference_pairs(rows: DataFrame, margin: float) -> DataFrame:
    """group_id, chosen, rejected, gap: an admitted row with every decisive row of its group that it
    beats by more than the margin."""
    good = rows.filter(selected_admitted()).select("group_id", F.col("record_id").alias("chosen"), F.col("aggregate").alias("ca"))
    poor = rows.filter(F.col("decision").isin("accept", "reject")).select("group_id", F.col("record_id").alias("rejected"), F.col("aggregate").alias("ra"))
    gap = F.col("ca") - F.col("ra")
    return good.join(poor, "group_id").filter((F.col("chosen") != F.col("rejected")) & (gap > margin)).select("group_id", "chosen", "rejected", gap.alias("gap"))


def revised(decision: Column, is_retry: Column) -> Column:
    """What becomes of a decision: a second revision is a rejection."""
    return F.when((decision == "revise") & is_retry, "rejected").when(decision == "revise", "retry").when(decision == "accept", "admitted").when(decision == "reject", "rejected").otherwise("needs_review")


def reward_valid(ids: Column, vocabulary: int, control: Column, eos: int) -> Column:
    """Ids within the vocabulary, and control ids only as a last end id."""
    inside = F.forall(ids, lambda x: (x >= 0) & (x < vocabulary))
    body = F.when((F.size(ids) > 0) & (F.element_at(ids, -1) == eos), F.slice(ids, 1, F.size(ids) - 1)).otherwise(ids)
    return inside & ~F.arrays_overlap(body, control)


def label_tokens(offsets: Column, owners: Column, ids: Column) -> Column:
    """Labels of tokens: the id where the token lies inside a supervised span, -100 where it touches
    none; null for the row if a token lies in both. offsets: array of struct(start, end); owners:
    array of struct(start, end) of the supervised spans, in order."""

    def of(t: Column, i: Column) -> Column:
        inside = F.exists(owners, lambda o: (o["start"] <= t["start"]) & (t["end"] <= o["end"]))
        touches = F.exists(owners, lambda o: (o["start"] < t["end"]) & (t["start"] < o["end"]))
        return F.when(inside, F.element_at(ids, i + 1).cast("long")).when(~touches, F.lit(-100).cast("long"))

    labels = F.transform(offsets, of)
    return F.when(~F.exists(labels, lambda x: x.isNull()), labels)
