"""Judge panels: means, effective votes, calibration, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Defaults: accept from, reject below, least effective votes, least share of them.
ACCEPT, REJECT_BELOW, MIN_N_EFF, MIN_RATIO = 0.80, 0.60, 1.5, 0.5
#: Most pairs of judges whose correlations are broadcast.
MATRIX = 100_000


def weighted_mean(score: str = "score", weight: str = "weight") -> Column:
    """Sum of w * s over sum of w, within 0 and 1; null where weights are negative or sum to 0."""
    total = F.sum(weight)
    mean = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.sum(F.col(weight) * F.col(score)), total)))
    return F.when((F.min(weight) >= 0) & (total > 0), mean)


def kish_n(weight: str = "weight") -> Column:
    return F.try_divide(F.sum(weight) ** 2, F.sum(F.col(weight) ** 2))


def effective_n(weight: str, rho: float) -> Column:
    """Effective votes under one correlation for all pairs; at most the number of votes."""
    one, two = F.sum(weight), F.sum(F.col(weight) ** 2)
    r = max(0.0, rho)
    return F.least(F.try_divide(one**2, (1 - r) * two + r * one**2), F.count(F.lit(1)).cast("double"))


def effective_n_matrix(votes: DataFrame, correlations: DataFrame, key: str = "record_id") -> DataFrame:
    """key, n_eff under a correlation for each pair of judges (judge_a, judge_b, rho); pairs that
    aren't listed have 0. A panel is gathered once and its pairs are made inside of it, so that only
    the votes are shuffled; correlations of more than MATRIX pairs are joined by a shuffle too."""
    small = correlations.limit(MATRIX + 1).count() <= MATRIX
    panel_of = F.array_sort(F.collect_list(F.struct("pos", "judge", "weight")))
    panels = votes.groupBy(key).agg(F.sum("weight").alias("w"), F.sum(F.col("weight") ** 2).alias("w2"), F.count("*").alias("k"), panel_of.alias("p"))
    later = lambda x: F.transform(F.filter("p", lambda y: y["pos"] > x["pos"]), lambda y: F.struct(x["judge"].alias("judge_a"), y["judge"].alias("judge_b"), (2 * x["weight"] * y["weight"]).alias("ww")))
    pairs = panels.select(key, "w", "w2", "k", F.inline_outer(F.flatten(F.transform("p", later))))
    rated = pairs.join(F.broadcast(correlations) if small else correlations, ["judge_a", "judge_b"], "left")
    cross = F.sum(F.col("ww") * F.greatest(F.lit(0.0), F.coalesce("rho", F.lit(0.0))))
    out = rated.groupBy(key).agg(F.first("w").alias("w"), F.first("w2").alias("w2"), F.first("k").alias("k"), F.coalesce(cross, F.lit(0.0)).alias("cross"))
    return out.select(key, F.least(F.try_divide(F.col("w") ** 2, F.col("w2") + F.col("cross")), F.col("k").cast("double")).alias("n_eff"))


def decisive_n(votes: DataFrame, correlations: DataFrame, key: str = "record_id") -> DataFrame:
    """key, decisive, n_eff of the votes that are sure, under the submatrix of their judges: uncertain votes lose
    their rows and columns. Records without a sure vote have no row."""
    sure = votes.filter("verdict <> 'uncertain'")
    counts = sure.groupBy(key).agg(F.count(F.lit(1)).alias("decisive"))
    return counts.join(effective_n_matrix(sure, correlations, key), key)


def agreement(score: str = "score") -> Column:
    """One less the population variance, within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.var_pop(score)))


def band(aggregate: Column, accept: float = ACCEPT, reject_below: float = REJECT_BELOW) -> Column:
    return F.when(aggregate >= accept, "accept").when(aggregate < reject_below, "reject").otherwise("revise")


def decision(aggregate: Column, n_eff: Column, decisive: Column, accept: float = ACCEPT, reject_below: float = REJECT_BELOW, min_n_eff: float = MIN_N_EFF, min_ratio: float = MIN_RATIO) -> Column:
    """The guard first, then the band; no decisive vote is a rejection."""
    guarded = (n_eff / F.greatest(decisive, F.lit(1)) < min_ratio) | (n_eff < min_n_eff)
    return F.when(aggregate.isNull(), "reject").when(F.coalesce(guarded, F.lit(False)), "escalate").otherwise(band(aggregate, accept, reject_below))


def panel(votes: DataFrame, rho: float, key: str = "record_id", order: tuple[str, ...] = ()) -> DataFrame:
    """key, votes, decisive, aggregate, agreement, n_eff, decision. Uncertain votes leave the mean
    and the guard; without a decisive vote the agreement is that of all. Sums of doubles depend on their order: with
    columns to order by, each panel is added up vote by vote in that order, whatever the layout; without, as Spark meets them."""
    sure = F.col("verdict") != "uncertain"
    s, w = F.when(sure, F.col("score")), F.when(sure, F.col("weight"))
    marked = votes.withColumns({"_s": s, "_w": w})
    sums = {
        "votes": F.count("*"),
        "decisive": F.count("_s"),
        "_k": F.count("_w"),
        "_least": F.min("_w"),
        "_one": F.sum("_w"),
        "_two": F.sum(F.col("_w") * F.col("_w")),
        "_scored": F.sum(F.col("_w") * F.col("_s")),
        "_var": F.var_pop("_s"),
        "_var_all": F.var_pop("score"),
    }
    if order:
        by = Window.partitionBy(key).orderBy(*order)
        whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = marked.select(key, *(x.over(whole).alias(c) for c, x in sums.items()), F.row_number().over(by).alias("_row")).filter("_row = 1")
    else:
        out = marked.groupBy(key).agg(*(x.alias(c) for c, x in sums.items()))
    one, two, k = F.col("_one"), F.col("_two"), F.col("_k")
    within = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    out = out.select(
        key,
        "votes",
        "decisive",
        F.when((F.col("_least") >= 0) & (one > 0), within(F.try_divide("_scored", "_one"))).alias("aggregate"),
        F.coalesce(within(1 - F.col("_var")), within(1 - F.col("_var_all"))).alias("agreement"),
        F.when(k > 0, F.least(F.try_divide(one * one, (1 - rho) * two + rho * one * one), k.cast("double"))).alias("n_eff"),
    )
    return out.withColumn("decision", decision(F.col("aggregate"), F.col("n_eff"), F.col("decisive")))


def grade(passed: Column, hold: Column, panel_decision: Column) -> Column:
    """The verifier first (a fail rejects, a hold escalates), then the panel; no panel is an error."""
    return F.when(passed == F.lit(False), "reject").when(hold.isNotNull(), "escalate").when(panel_decision.isNull(), "error").otherwise(panel_decision)


def gate(axes: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """(passed, review) from (policy, outcome) of each axis in order. Only authoritative axes
    count: a fail decides; else the last unknown one names the review."""
    fails = F.lit(False)
    review = F.lit(None).cast("int")
    for i, (policy, outcome) in enumerate(axes):
        counts = policy == "authoritative"
        fails = fails | (counts & (outcome == "fail"))
        review = F.when(counts & (outcome == "unknown"), i).otherwise(review)
    return ~fails & review.isNull(), F.when(~fails, review)


def calibration_weights(judges: DataFrame, beta: float = 2.0, gamma: float = 1.0) -> DataFrame:
    """key, judge, weight from mean_brier and mean_log_score: softmax of the negative penalty in
    each key; judges without a rating take the mean penalty, and all alike if none has one."""
    each = Window.partitionBy("key")
    known = judges.withColumn("penalty", beta * F.col("mean_brier") + gamma * F.col("mean_log_score"))
    filled = known.withColumn("penalty", F.coalesce("penalty", F.avg("penalty").over(each), F.lit(0.0)))
    least = F.min("penalty").over(each)
    raw = filled.withColumn("raw", F.exp(least - F.col("penalty")))
    return raw.select("key", "judge", (F.col("raw") / F.sum("raw").over(each)).alias("weight"))


def grouped_losses(rows: DataFrame) -> DataFrame:
    """judge, loss, groups: the mean over groups of the mean squared error in each."""
    inner = rows.groupBy("group_id", "judge").agg(F.avg((F.col("score") - F.col("outcome")) ** 2).alias("loss"))
    return inner.groupBy("judge").agg(F.avg("loss").alias("loss"), F.count("*").alias("groups"))


def exponential_weights(losses: DataFrame, beta: float) -> DataFrame:
    """judge, loss, weight: exp(-beta * (loss - least)), normalised. One row for each judge of a
    panel, so that one window over all of them is small."""
    every = Window.partitionBy(F.lit(1))
    raw = losses.withColumn("raw", F.exp(-beta * (F.col("loss") - F.min("loss").over(every))))
    return raw.select("judge", "loss", (F.col("raw") / F.sum("raw").over(every)).alias("weight"))


def rating_lookup(requests: DataFrame, ratings: DataFrame, tie: str = "n_updates") -> DataFrame:
    """requests (judge, area) with the rating used: usable in the area, usable anywhere, any in the
    area, any anywhere; then by tie. ratings: judge, area (null: global), mean_brier, n_updates.
    The best rating of each judge and area is found before the join, so that only those meet."""
    usable = (F.col("n_updates") > 0) & F.col("mean_brier").isNotNull()
    best = (
        F.when(usable & F.col("rating_area").isNotNull(), 0).when(usable, 1).when(F.col("rating_area").isNotNull(), 2).otherwise(3)
    )
    best_of = F.min_by(F.struct("mean_brier", "n_updates", F.col(tie).alias("tie")), F.struct((~usable).alias("unusable"), F.col(tie)))
    r = ratings.groupBy("judge", F.col("area").alias("rating_area")).agg(best_of.alias("r")).select("judge", "rating_area", "r.*")
    fits = requests.join(r, "judge", "left").filter("rating_area is null or rating_area = area")
    picked = fits.groupBy("judge", "area").agg(F.min_by(F.struct("rating_area", "mean_brier", "n_updates"), F.struct(best, F.col("tie"))).alias("r"))
    return requests.select("judge", "area").distinct().join(picked, ["judge", "area"], "left").select("judge", "area", "r.*")
