"""Coverage of evidence, separation, outcomes, promotion."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def separation(rows: DataFrame, least_groups: int = 10, least_fraction: float = 0.05) -> DataFrame:
    """One row. Groups of rows by (run_id, training_area, group_id): how many have one row, all passed, all
    failed or both; the share of the last among those of two rows or more, and whether it, or their
    number, is too low (null if least_fraction is no share). Scores count in groups that all passed and
    have two valid ones (finite, from 0 to 1) or more: the means over those groups of the largest, of the
    mean and of their gap, and the mean over all their scores. Valid or not, no other score counts."""
    valid = F.col("aggregate").isNotNull() & ~F.isnan("aggregate") & F.col("aggregate").between(0, 1)
    g = rows.withColumn("s", F.when(valid, F.col("aggregate"))).groupBy("run_id", "training_area", "group_id").agg(
        F.count("*").alias("n"), F.bool_and("all_passed").alias("all_pass"), F.bool_or("all_passed").alias("any_pass"), F.max("s").alias("top"), F.avg("s").alias("mid"),
        F.sum("s").alias("total"), F.count("s").alias("scored"), (F.count("aggregate") - F.count("s")).alias("invalid"),
    )
    many = F.col("n") > 1
    mixed = many & F.col("any_pass") & ~F.col("all_pass")
    told = many & F.col("all_pass") & (F.col("scored") > 1)
    of = lambda c: F.when(told, c)
    share = F.try_divide(F.count_if(mixed), F.count_if(many))
    low = (F.count_if(mixed) < least_groups) | (F.coalesce(share, F.lit(0.0)) < least_fraction)
    return g.agg(
        F.count("*").alias("groups"),
        F.count_if(~many).alias("singletons"),
        F.count_if(many & F.col("all_pass")).alias("all_pass"),
        F.count_if(many & ~F.col("any_pass")).alias("all_fail"),
        F.count_if(mixed).alias("mixed"),
        share.alias("decidable"),
        F.count_if(told).alias("score_groups"),
        F.avg(of(F.col("top"))).alias("mean_max"),
        F.avg(of(F.col("mid"))).alias("mean_mean"),
        F.try_divide(F.sum(of(F.col("total"))), F.sum(of(F.col("scored")))).alias("pooled_mean"),
        F.avg(of(F.col("top") - F.col("mid"))).alias("mean_gap"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_scores"),
        (low if 0 <= least_fraction <= 1 else F.lit(None).cast("boolean")).alias("low_decidability"),
    )


def radius(confidence: float, n: Column) -> Column:
    """Hoeffding's half width for values within -1 and 1."""
    return F.sqrt(F.lit(-2.0 * math.log(1.0 - confidence)) / n)


def outcome_gap(rows: DataFrame, confidence: float) -> DataFrame:
    """One row: prompts, selector_mean, random_mean, mean_gap, lower_bound. Of the groups whose rows
    all passed and that have two scored rows or more, the outcome of the row with the largest
    aggregate (ties to the lowest idx) against the group's mean. A group with a row that lacks an
    outcome is not evaluated."""
    g = rows.groupBy("group_id").agg(
        F.bool_and("all_passed").alias("ok"),
        F.count("aggregate").alias("scored"),
        F.count("*").alias("n"),
        F.count("outcome").alias("known"),
        F.max_by("outcome", F.when(F.col("aggregate").isNotNull(), F.struct("aggregate", (-F.col("idx")).alias("i")))).alias("chosen"),
        F.avg(F.when(F.col("aggregate").isNotNull(), F.col("outcome"))).alias("mid"),
    )
    used = g.filter(F.col("ok") & (F.col("scored") > 1) & (F.col("known") == F.col("n")))
    out = used.agg(F.count("*").alias("prompts"), F.avg("chosen").alias("selector_mean"), F.avg("mid").alias("random_mean"), F.avg(F.col("chosen") - F.col("mid")).alias("mean_gap"))
    return out.withColumn("lower_bound", F.when(F.col("prompts") > 0, F.col("mean_gap") - radius(confidence, F.col("prompts"))))


def coverage(members: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, status of every member and label: duplicate, unexpected, missing, unknown or known."""
    m = members.groupBy(key).agg(F.count("*").alias("m"))
    l_ = labels.groupBy(key).agg(F.count("*").alias("l"), F.count("outcome").alias("k"))
    both = m.join(l_, key, "full_outer")
    status = F.when(F.col("m").isNull(), "unexpected").when(F.col("l").isNull(), "missing").when(F.col("l") > 1, "duplicate").when(F.col("k") == 0, "unknown").otherwise("known")
    return both.select(key, status.alias("status"))


def binding_mismatch(declared: DataFrame, actual: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key and the joined names of the fields that differ, or missing / undeclared."""
    d = declared.select(key, *(F.col(f).alias(f"d_{f}") for f in fields), F.lit(True).alias("in_d"))
    a = actual.select(key, *(F.col(f).alias(f"a_{f}") for f in fields), F.lit(True).alias("in_a"))
    differ = F.array_compact(F.array(*(F.when(~F.col(f"d_{f}").eqNullSafe(F.col(f"a_{f}")), F.lit(f)) for f in fields)))
    what = F.when(F.col("in_a").isNull(), "missing").when(F.col("in_d").isNull(), "undeclared").otherwise(F.array_join(differ, ","))
    return d.join(a, key, "full_outer").select(key, what.alias("mismatch")).filter("mismatch != ''")


def promotion(baseline: DataFrame, candidate: DataFrame, min_delta: float, sigma_k: float) -> DataFrame:
    """metric, delta, noise_band, outcome: win, regress, noise, or missing where a side lacks the
    metric or a value isn't finite. Both: metric, value, sigma (candidate's counts, null: 0)."""
    b = baseline.select("metric", F.col("value").alias("b"))
    c = candidate.select("metric", F.col("value").alias("c"), F.col("sigma"))
    finite = F.col("b").isNotNull() & F.col("c").isNotNull() & (F.abs(F.col("c") - F.col("b")) < float("inf"))
    band = F.greatest(F.lit(0.0), F.lit(min_delta) + F.lit(sigma_k) * F.greatest(F.lit(0.0), F.coalesce("sigma", F.lit(0.0))))
    rows = b.join(c, "metric", "full_outer").withColumn("delta", F.when(finite, F.col("c") - F.col("b"))).withColumn("noise_band", F.when(finite, band))
    outcome = F.when(~finite, "missing").when(F.col("delta") > F.col("noise_band"), "win").when(F.col("delta") < -F.col("noise_band"), "regress").otherwise("noise")
    return rows.select("metric", "delta", "noise_band", outcome.alias("outcome"))


def promoted(outcomes: DataFrame, drift_exit: int = 0) -> DataFrame:
    """One row: any_win, any_regress, evidence_valid, promote."""
    out = outcomes.agg(
        F.coalesce(F.bool_or(F.col("outcome") == "win"), F.lit(False)).alias("any_win"), F.coalesce(F.bool_or(F.col("outcome") == "regress"), F.lit(False)).alias("any_regress"), (F.count_if(F.col("outcome") == "missing") == 0).alias("evidence_valid")
    )
    return out.withColumn("promote", F.lit(drift_exit == 0) & F.col("any_win") & ~F.col("any_regress") & F.col("evidence_valid"))


def leaks(fit: DataFrame, assessment: DataFrame, keys: list[str]) -> DataFrame:
    """kind, value: what both partitions hold."""
    out = None
    for k in keys:
        part = fit.select(F.col(k).cast("string").alias("value")).distinct().join(assessment.select(F.col(k).cast("string").alias("value")).distinct(), "value", "left_semi").select(F.lit(k).alias("kind"), "value")
        out = part if out is None else out.unionByName(part)
    return out
