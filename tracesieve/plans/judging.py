"""Queries over judges' votes and candidate records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.operators import consensus, evaluate, ledger, selection, sequences
from tracesieve.plans.registry import query
from tracesieve.plans.sql import CANDIDATES, VOTES
from tracesieve.sources.tables import candidates, placed, table, votes

RHO = 0.3
_W = f"with {VOTES}, sure as (select * from votes where verdict <> 'uncertain') "
_C = f"with {CANDIDATES} "


def _votes(spark: SparkSession, d: str) -> DataFrame:
    return votes(table(spark, d, "lineitem"))


def _panel(spark: SparkSession, d: str) -> DataFrame:
    """Panels added up in the order of the input, as the SQL does where a single thread reads it."""
    return consensus.panel(votes(placed(spark, d, "lineitem"), "place"), RHO, order=("place",))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates(table(spark, d, "orders"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query(f"with {VOTES} select record_id, round(greatest(0.0, least(1.0, sum(weight * score) / sum(weight))), 9) as aggregate from votes group by record_id")
def weighted_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_votes(spark, d).groupBy("record_id").agg(consensus.weighted_mean().alias("aggregate")), "aggregate")


@query(f"with {VOTES} select record_id, round(least(pow(sum(weight), 2) / ({1 - RHO} * sum(weight * weight) + {RHO} * pow(sum(weight), 2)), count(*)), 9) as n_eff from votes group by record_id")
def effective_n(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_votes(spark, d).groupBy("record_id").agg(consensus.effective_n("weight", RHO).alias("n_eff")), "n_eff")


@query(f"""with {VOTES}, v as (select *, row_number() over (partition by record_id order by pos, judge, weight, score, verdict) as p from votes),
 cross_ as (select a.record_id, sum(2 * a.weight * b.weight * case when a.judge = b.judge then 0.9 when (substr(a.judge, 6)::int + substr(b.judge, 6)::int) % 2 = 0 then 0.4 else 0.0 end) as x
   from v a join v b on a.record_id = b.record_id and a.p < b.p group by 1)
 select record_id, round(least(pow(sum(weight), 2) / (sum(weight * weight) + coalesce(max(x), 0)), count(*)), 9) as n_eff from v left join cross_ using (record_id) group by record_id""")
def effective_n_matrix(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    pairs = [(f"judge{i}", f"judge{j}", 0.9 if i == j else 0.4 if (i + j) % 2 == 0 else -0.2) for i in range(5) for j in range(5)]
    rho = spark.createDataFrame(pairs, "judge_a string, judge_b string, rho double")
    order = Window.partitionBy("record_id").orderBy("pos", "judge", "weight", "score", "verdict")
    return _rounded(consensus.effective_n_matrix(_votes(spark, d).withColumn("pos", F.row_number().over(order)), rho), "n_eff")


@query(f"with {VOTES} select record_id, round(pow(sum(weight), 2) / sum(weight * weight), 9) as n_kish from votes group by record_id")
def kish_n(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_votes(spark, d).groupBy("record_id").agg(consensus.kish_n().alias("n_kish")), "n_kish")


@query(f"with {VOTES} select record_id, round(greatest(0.0, least(1.0, 1 - var_pop(score))), 9) as agreement from votes group by record_id")
def agreement(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_votes(spark, d).groupBy("record_id").agg(consensus.agreement().alias("agreement")), "agreement")


_PANEL = f"""panel as (select record_id, count(*) as votes, count(*) filter (verdict <> 'uncertain') as decisive,
  greatest(0.0, least(1.0, sum(weight * score) filter (verdict <> 'uncertain') / sum(weight) filter (verdict <> 'uncertain'))) as raw_aggregate,
  coalesce(greatest(0.0, least(1.0, 1 - var_pop(score) filter (verdict <> 'uncertain'))), greatest(0.0, least(1.0, 1 - var_pop(score)))) as agreement,
  sum(weight) filter (verdict <> 'uncertain') as w, sum(weight * weight) filter (verdict <> 'uncertain') as w2 from votes group by record_id),
 judged as (select record_id, votes, decisive, case when decisive > 0 then raw_aggregate end as aggregate, agreement,
  case when decisive > 0 then least(w * w / ({1 - RHO} * w2 + {RHO} * w * w), decisive) end as n_eff from panel)"""


def _decision(accept: float, reject: float) -> str:
    return f"""case when aggregate is null then 'reject' when n_eff / greatest(decisive, 1) < 0.5 or n_eff < 1.5 then 'escalate'
 when aggregate >= {accept} then 'accept' when aggregate < {reject} then 'reject' else 'revise' end"""


@query(f"with {VOTES}, {_PANEL} select record_id, votes, decisive, round(aggregate, 9) as aggregate, round(agreement, 9) as agreement, round(n_eff, 9) as n_eff, {_decision(0.8, 0.6)} as decision from judged")
def panel_consensus(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_panel(spark, d), "aggregate", "agreement", "n_eff")


@query(f"with {VOTES}, {_PANEL} select record_id, {_decision(0.8, 0.6)} as before, {_decision(0.5, 0.3)} as after from judged")
def rederive_verdict(spark: SparkSession, d: str) -> DataFrame:
    p = _panel(spark, d)
    after = consensus.decision(F.col("aggregate"), F.col("n_eff"), F.col("decisive"), 0.5, 0.3)
    return p.select("record_id", F.col("decision").alias("before"), after.alias("after"))


@query(f"""with {VOTES}, {_PANEL}, graded as (select record_id, {_decision(0.8, 0.6)} as panel_decision, o_orderstatus from judged join orders on record_id = o_orderkey)
 select record_id, case when o_orderstatus = 'F' then 'reject' when o_orderstatus = 'P' then 'escalate' else panel_decision end as grade from graded""")
def grade_decision(spark: SparkSession, d: str) -> DataFrame:
    p = _panel(spark, d).join(table(spark, d, "orders"), F.col("record_id") == F.col("o_orderkey"))
    status = F.col("o_orderstatus")
    return p.select("record_id", consensus.grade(status != "F", F.when(status == "P", "answer"), F.col("decision")).alias("grade"))


@query(f"""{_C} select decision, count(*) as n, min(case decision when 'accept' then 'admit' when 'reject' then 'reject' when 'escalate' then 'needs_review' end) as verdict,
 min(case decision when 'accept' then 'admitted' when 'reject' then 'rejected' when 'escalate' then 'needs_review' else 'judged' end) as state from cand group by decision""")
def decision_map(spark: SparkSession, d: str) -> DataFrame:
    verdict = F.when(F.col("decision") == "accept", "admit").when(F.col("decision") == "reject", "reject").when(F.col("decision") == "escalate", "needs_review")
    state = F.when(F.col("decision") == "accept", "admitted").when(F.col("decision") == "reject", "rejected").when(F.col("decision") == "escalate", "needs_review").otherwise("judged")
    return _candidates(spark, d).groupBy("decision").agg(F.count("*").alias("n"), F.min(verdict).alias("verdict"), F.min(state).alias("state"))


_AXIS = "case {} when 0 then 'pass' when 1 then 'fail' else 'unknown' end"
_POLICY = "case {} when 0 then 'absent' when 1 then 'advisory' else 'authoritative' end"


@query(f"""with axes as (select l_orderkey as record_id, l_linenumber as pos, l_partkey as part, {_POLICY.format('l_partkey % 3')} as p0, {_AXIS.format('l_suppkey % 3')} as o0,
  {_POLICY.format('l_suppkey // 3 % 3')} as p1, {_AXIS.format('l_partkey // 3 % 3')} as o1, {_POLICY.format('l_orderkey % 3')} as p2, {_AXIS.format('l_partkey // 9 % 3')} as o2 from lineitem),
 f as (select *, (p0 = 'authoritative' and o0 = 'fail') or (p1 = 'authoritative' and o1 = 'fail') or (p2 = 'authoritative' and o2 = 'fail') as fails,
  case when p2 = 'authoritative' and o2 = 'unknown' then 2 when p1 = 'authoritative' and o1 = 'unknown' then 1 when p0 = 'authoritative' and o0 = 'unknown' then 0 end as r from axes)
 select passed, review, count(*) as n from (select not fails and r is null as passed, case when not fails then r end as review from f) group by all""")
def verifier_gate(spark: SparkSession, d: str) -> DataFrame:
    policy = lambda x: F.when(x == 0, "absent").when(x == 1, "advisory").otherwise("authoritative")
    axis = lambda x: F.when(x == 0, "pass").when(x == 1, "fail").otherwise("unknown")
    p, s, k = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    third = lambda x, n: F.floor(x / n) % 3
    passed, review = consensus.gate([(policy(p % 3), axis(s % 3)), (policy(third(s, 3)), axis(third(p, 3))), (policy(k % 3), axis(third(p, 9)))])
    return table(spark, d, "lineitem").select(passed.alias("passed"), review.alias("review")).groupBy("passed", "review").agg(F.count("*").alias("n"))


_RATINGS = """ratings as (select 'judge' || (s_suppkey % 5) as judge, case when s_suppkey // 5 % 3 = 0 then null else 'area' || (s_suppkey // 5 % 3) end as area,
  case when s_suppkey % 4 = 0 then null else round(s_nationkey / 100.0::double, 4) end as mean_brier, s_nationkey % 3 as n_updates, s_suppkey from supplier)"""


@query(f"""with {_RATINGS}, req as (select distinct 'judge' || (l_suppkey % 6) as judge, 'area' || (l_linenumber % 4) as area from lineitem),
 r as (select req.judge, req.area, ratings.area as rating_area, mean_brier, n_updates, row_number() over (partition by req.judge, req.area order by
  case when n_updates > 0 and mean_brier is not null then case when ratings.area is not null then 0 else 1 end when ratings.area is not null then 2 else 3 end, s_suppkey) as k
  from req left join ratings on req.judge = ratings.judge and (ratings.area is null or ratings.area = req.area))
 select judge, area, rating_area, mean_brier, n_updates from r where k = 1""")
def rating_lookup(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey")
    third = F.floor(s / 5) % 3
    ratings = table(spark, d, "supplier").select(
        F.concat(F.lit("judge"), (s % 5).cast("string")).alias("judge"),
        F.when(third != 0, F.concat(F.lit("area"), third.cast("string"))).alias("area"),
        F.when(s % 4 != 0, F.round(F.col("s_nationkey") / 100.0, 4)).alias("mean_brier"),
        (F.col("s_nationkey") % 3).cast("long").alias("n_updates"),
        "s_suppkey",
    )
    li = table(spark, d, "lineitem")
    req = li.select(F.concat(F.lit("judge"), (F.col("l_suppkey") % 6).cast("string")).alias("judge"), F.concat(F.lit("area"), (F.col("l_linenumber") % 4).cast("string")).alias("area")).distinct()
    return consensus.rating_lookup(req, ratings, tie="s_suppkey")


@query("""with j as (select s_nationkey as key, 'j' || s_suppkey as judge, case when s_suppkey % 3 = 0 then null else s_nationkey / 50.0::double + s_suppkey % 7 / 20.0::double end as b,
  s_suppkey % 5 / 4.0::double as l from supplier), p as (select *, 2.0 * b + 1.0 * l as p0 from j),
 f as (select key, judge, coalesce(p0, avg(p0) over (partition by key), 0.0) as p1 from p), e as (select key, judge, exp(min(p1) over (partition by key) - p1) as e from f)
 select key, judge, round(e / sum(e) over (partition by key), 9) as weight from e""")
def calibration_weights(spark: SparkSession, d: str) -> DataFrame:
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    judges = table(spark, d, "supplier").select(
        n.alias("key"), F.concat(F.lit("j"), s.cast("string")).alias("judge"), F.when(s % 3 != 0, n / 50.0 + (s % 7) / 20.0).alias("mean_brier"), ((s % 5) / 4.0).alias("mean_log_score")
    )
    return _rounded(consensus.calibration_weights(judges), "weight")


_LOSS = f"with {VOTES}, o as (select record_id % 50 as group_id, judge, score, (record_id % 2)::double as outcome from votes), i as (select group_id, judge, avg(pow(score - outcome, 2)) as loss from o group by 1, 2), l as (select judge, avg(loss) as loss, count(*) as groups from i group by judge) "


def _losses(spark: SparkSession, d: str) -> DataFrame:
    rows = _votes(spark, d).select((F.col("record_id") % 50).alias("group_id"), "judge", "score", (F.col("record_id") % 2).cast("double").alias("outcome"))
    return consensus.grouped_losses(rows)


@query(_LOSS + "select judge, round(loss, 9) as loss, groups from l")
def calibration_losses(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_losses(spark, d), "loss")


@query(_LOSS + "select judge, round(loss, 9) as loss, round(exp(-5.0 * (loss - (select min(loss) from l))) / (select sum(exp(-5.0 * (loss - (select min(loss) from l)))) from l), 9) as weight from l")
def calibration_fit(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(consensus.exponential_weights(_losses(spark, d), 5.0), "loss", "weight")


@query("""with g as (select unnest(range(1, 13)) as votes), r as (select unnest([0.0, 0.2, 0.5, 0.9]) as rho) select rho, min(votes) filter (votes / (1 + (votes - 1) * rho) >= 1.5 - 1e-12 and 1 / (1 + (votes - 1) * rho) >= 0.5 - 1e-12) as decisive from g, r group by rho""")
def panel_feasibility(spark: SparkSession, d: str) -> DataFrame:
    rho = spark.createDataFrame([(x,) for x in (0.0, 0.2, 0.5, 0.9)], "rho double")
    n_eff = lambda k: k / (1 + (k - 1) * F.col("rho"))
    fits = F.filter(F.sequence(F.lit(1), F.lit(12)), lambda k: (n_eff(k) >= 1.5 - 1e-12) & (n_eff(k) / k >= 0.5 - 1e-12))
    return rho.select("rho", F.try_element_at(fits, F.lit(1)).cast("long").alias("decisive"))


@query(_C + """, e as (select *, record_id % 97 = 0 as established, decision in ('accept', 'revise') as ok from cand),
 w as (select *, row_number() over (partition by group_id, ok order by established desc, aggregate desc nulls last, idx) as k from e)
 select group_id, record_id as winner, aggregate from w where ok and k = 1""")
def best_of_k(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumn("established", F.col("record_id") % 97 == 0)
    return selection.best_of_k(rows).filter("outcome = 'selected'").select("group_id", F.col("record_id").alias("winner"), "aggregate")


@query(_C + """, e as (select *, record_id % 97 = 0 as established, decision in ('accept', 'revise') as ok from cand),
 w as (select *, row_number() over (partition by group_id, ok order by established desc, aggregate desc nulls last, idx) as k from e)
 select record_id, case when not ok then decision when k = 1 then 'selected' else 'best_of_k_retained' end as outcome from w""")
def best_of_k_retained(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumn("established", F.col("record_id") % 97 == 0)
    return selection.best_of_k(rows).select("record_id", "outcome")


_V = "case decision when 'accept' then 'admit' when 'reject' then 'reject' when 'escalate' then 'needs_review' end"


def _with_verdict(spark: SparkSession, d: str) -> DataFrame:
    verdict = F.when(F.col("decision") == "accept", "admit").when(F.col("decision") == "reject", "reject").when(F.col("decision") == "escalate", "needs_review")
    return _candidates(spark, d).withColumn("verdict", verdict)


@query(_C + f"select run_id, record_id, state from cand where {_V} = 'admit' and state in ('admitted', 'formatted', 'exported')")
def selected_admitted(spark: SparkSession, d: str) -> DataFrame:
    return _with_verdict(spark, d).filter(selection.selected_admitted()).select("run_id", "record_id", "state")


@query(_C + f"select record_id, state, aggregate from cand where run_id = 'run1' and state = 'admitted' and {_V} = 'admit' and aggregate >= 0.5")
def record_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = _with_verdict(spark, d).filter((F.col("run_id") == "run1") & (F.col("state") == "admitted") & (F.col("verdict") == "admit") & (F.col("aggregate") >= 0.5))
    return rows.select("record_id", "state", "aggregate").orderBy("record_id")


@query(_C + f"""select record_id, run_id as training_area, sha256(record_id || ':' || idx) as record_hash, sha256(group_id::varchar) as prompt_hash, {_V} as verdict, aggregate as judge_aggregate, cost as reasoning_tokens
 from cand where {_V} = 'admit' and state in ('admitted', 'formatted', 'exported')""")
def export_projection(spark: SparkSession, d: str) -> DataFrame:
    rows = _with_verdict(spark, d).filter(selection.selected_admitted())
    return rows.select(
        "record_id", F.col("run_id").alias("training_area"), F.sha2(F.concat_ws(":", "record_id", "idx"), 256).alias("record_hash"), F.sha2(F.col("group_id").cast("string"), 256).alias("prompt_hash"),
        "verdict", F.col("aggregate").alias("judge_aggregate"), F.col("cost").alias("reasoning_tokens"),
    )


@query(_C + f"""select a.group_id, a.record_id as chosen, b.record_id as rejected, round(a.aggregate - b.aggregate, 9) as gap from cand a join cand b using (group_id)
 where a.record_id <> b.record_id and a.decision = 'accept' and a.state in ('admitted', 'formatted', 'exported') and b.decision in ('accept', 'reject') and a.aggregate - b.aggregate > 0.1""")
def preference_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(selection.preference_pairs(_with_verdict(spark, d), 0.1), "gap")


@query(_C + "select record_id, case when decision = 'revise' then case when idx = 3 then 'rejected' else 'retry' end when decision = 'accept' then 'admitted' when decision = 'reject' then 'rejected' else 'needs_review' end as next from cand")
def revise_bound(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("record_id", selection.revised(F.col("decision"), F.col("idx") == 3).alias("next"))


@query(_C + """select run_id, count(*) as total, count(*) filter (state in ('admitted', 'formatted', 'exported')) as admitted, count(*) filter (state = 'rejected') as rejected,
 count(*) filter (state = 'needs_review') as needs_review, count(*) filter (state = 'errored') as errored from cand group by run_id""")
def run_tally(spark: SparkSession, d: str) -> DataFrame:
    return ledger.tally(_candidates(spark, d))


@query(_C + """select run_id, count(*) filter (state in ('admitted', 'formatted', 'exported')) / count(*) filter (state in ('admitted', 'formatted', 'exported', 'rejected'))::double as admit_rate from cand group by run_id""")
def admit_rate(spark: SparkSession, d: str) -> DataFrame:
    return ledger.admit_rate(ledger.tally(_candidates(spark, d)))


# Rows of a group may differ in their area; some scores are out of range or no number.
@query(_C + """, x as (select *, 'area' || (group_id % 3) as training_area, case when record_id % 37 = 0 then 1.5 when record_id % 41 = 0 then 'nan'::double else aggregate end as v from cand),
 g as (select count(*) as n, bool_and(all_passed) as a, bool_or(all_passed) as o, max(v) filter (ok) as top, avg(v) filter (ok) as mid, sum(v) filter (ok) as total, count(*) filter (ok) as scored, count(v) filter (not ok) as invalid
  from (select *, coalesce(isfinite(v) and v between 0 and 1, false) as ok from x) group by run_id, training_area, group_id), h as (select *, n > 1 and a and scored > 1 as told, n > 1 and o and not a as mixed from g)
 select count(*) as groups, count(*) filter (n = 1) as singletons, count(*) filter (n > 1 and a) as all_pass, count(*) filter (n > 1 and not o) as all_fail, count(*) filter (mixed) as mixed,
 round(count(*) filter (mixed) / (count(*) filter (n > 1))::double, 9) as decidable, count(*) filter (told) as score_groups, round(avg(top) filter (told), 9) as mean_max, round(avg(mid) filter (told), 9) as mean_mean,
 round(sum(total) filter (told) / sum(scored) filter (told), 9) as pooled_mean, round(avg(top - mid) filter (told), 9) as mean_gap, sum(invalid)::bigint as invalid_scores,
 count(*) filter (mixed) < 10 or coalesce(count(*) filter (mixed) / (count(*) filter (n > 1))::double, 0) < 0.05 as low_decidability from h""")
def separation_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("record_id")
    rows = _candidates(spark, d).withColumn("training_area", F.concat(F.lit("area"), (F.col("group_id") % 3).cast("string")))
    rows = rows.withColumn("aggregate", F.when(k % 37 == 0, 1.5).when(k % 41 == 0, float("nan")).otherwise(F.col("aggregate")))
    return _rounded(evaluate.separation(rows), "decidable", "mean_max", "mean_mean", "pooled_mean", "mean_gap")


@query(_C + """, c as (select *, (record_id * 7 % 11) / 10.0::double as outcome from cand), g as (select group_id, bool_and(all_passed) as ok, count(aggregate) as scored, first(outcome order by aggregate desc nulls last, idx) as chosen, avg(outcome) filter (aggregate is not null) as mid from c group by 1)
 select count(*) as prompts, round(avg(chosen), 9) as selector_mean, round(avg(mid), 9) as random_mean, round(avg(chosen - mid), 9) as mean_gap, round(avg(chosen - mid) - sqrt(-2 * ln(0.05) / count(*)), 9) as lower_bound from g where ok and scored > 1""")
def outcome_gap(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumn("outcome", (F.col("record_id") * 7 % 11) / 10.0)
    return _rounded(evaluate.outcome_gap(rows, 0.95), "selector_mean", "random_mean", "mean_gap", "lower_bound")


def _metrics(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, d, "lineitem").withColumn("metric", F.concat(F.lit("m"), (F.col("l_suppkey") % 12).cast("string")))
    base = li.filter("l_suppkey % 12 != 11").groupBy("metric").agg(F.avg("l_discount").alias("value"))
    cand = li.filter("l_suppkey % 12 != 10").groupBy("metric").agg(F.avg("l_tax").alias("value"), (F.stddev_pop("l_tax") / 10).alias("sigma"))
    return base, cand


_METRICS = """with b as (select 'm' || (l_suppkey % 12) as metric, avg(l_discount) as b from lineitem where l_suppkey % 12 <> 11 group by 1),
 c as (select 'm' || (l_suppkey % 12) as metric, avg(l_tax) as c, stddev_pop(l_tax) / 10 as s from lineitem where l_suppkey % 12 <> 10 group by 1),
 o as (select metric, c - b as delta, case when b is not null and c is not null then 0.0075 + 1.0 * coalesce(s, 0) end as band from b full join c using (metric)),
 r as (select metric, delta, band, case when delta is null then 'missing' when delta > band then 'win' when delta < -band then 'regress' else 'noise' end as outcome from o) """


@query(_METRICS + "select metric, round(delta, 9) as delta, round(band, 9) as noise_band, outcome from r")
def promotion_gate(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluate.promotion(*_metrics(spark, d), 0.0075, 1.0), "delta", "noise_band")


@query(_METRICS + "select bool_or(outcome = 'win') as any_win, bool_or(outcome = 'regress') as any_regress, count(*) filter (outcome = 'missing') = 0 as evidence_valid, bool_or(outcome = 'win') and not bool_or(outcome = 'regress') and count(*) filter (outcome = 'missing') = 0 as promote from r")
def promotion_rederive(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.promoted(evaluate.promotion(*_metrics(spark, d), 0.0075, 1.0))


@query("""with s as (select l_partkey % 40 as item, l_returnflag as side, count(*) as n, bool_or(l_linestatus = 'O' and l_quantity < 5) as unknown, bool_or(l_quantity = 50) as failed from lineitem group by 1, 2)
 select side, count(*) as items, count(*) filter (not unknown and not failed) as passed, count(*) filter (not unknown and failed) as failed, count(*) filter (unknown) as unknown from s group by side""")
def paired_counts(spark: SparkSession, d: str) -> DataFrame:
    unknown = (F.col("l_linestatus") == "O") & (F.col("l_quantity") < 5)
    s = table(spark, d, "lineitem").groupBy((F.col("l_partkey") % 40).alias("item"), F.col("l_returnflag").alias("side")).agg(F.bool_or(unknown).alias("u"), F.bool_or(F.col("l_quantity") == 50).alias("f"))
    return s.groupBy("side").agg(F.count("*").alias("items"), F.count_if(~F.col("u") & ~F.col("f")).alias("passed"), F.count_if(~F.col("u") & F.col("f")).alias("failed"), F.count_if("u").alias("unknown"))


@query("""select l_orderkey as run_id, case when bool_or(l_linestatus = 'O' and l_returnflag = 'N') then 'unknown' when bool_or(l_quantity > 45) then 'failed' else 'passed' end as outcome from lineitem group by 1""")
def suite_outcome(spark: SparkSession, d: str) -> DataFrame:
    skipped = F.bool_or((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"))
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(F.when(skipped, "unknown").when(F.bool_or(F.col("l_quantity") > 45), "failed").otherwise("passed").alias("outcome"))


@query("""select l_orderkey as record_id, case when bool_or(l_returnflag = 'N') then 'unknown' when bool_or(l_quantity > 48) or count(*) <> count(distinct l_partkey) or sum(l_linenumber) > 25 then 'failed' else 'passed' end as evidence from lineitem group by 1""")
def execution_evidence(spark: SparkSession, d: str) -> DataFrame:
    bad = F.bool_or(F.col("l_quantity") > 48) | (F.count("*") != F.countDistinct("l_partkey")) | (F.sum("l_linenumber") > 25)
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("record_id")).agg(F.when(F.bool_or(F.col("l_returnflag") == "N"), "unknown").when(bad, "failed").otherwise("passed").alias("evidence"))


@query(_C + """select group_id, count(*) as members, max(idx) + 1 as n_completions, count(distinct idx) = max(idx) + 1 and count(*) = max(idx) + 1 and count(distinct run_id) = 1 as consistent from cand group by group_id""")
def sibling_consistency(spark: SparkSession, d: str) -> DataFrame:
    n = F.max("idx") + 1
    return _candidates(spark, d).groupBy("group_id").agg(F.count("*").alias("members"), n.alias("n_completions"), ((F.countDistinct("idx") == n) & (F.count("*") == n) & (F.countDistinct("run_id") == 1)).alias("consistent"))


# Of the orders that are not finished: their keys have gaps.
@query("""with i as (select o_orderkey as item, row_number() over (order by o_orderkey) - 1 as i from orders where o_orderstatus <> 'F')
 select i % 8 as shard, item, row_number() over (partition by i % 8 order by i) - 1 as "offset", 1000 + i as seed, 'run0-s' || (i % 8) || '-seed' || (1000 + i) || '-a0-c0' as record_id from i""")
def seed_shards(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("item"))
    x = sequences.shards(items, ["item"], 8, 1000)
    return x.withColumn("record_id", F.format_string("run0-s%d-seed%d-a%d-c%d", "shard", "seed", F.lit(0), F.lit(0)))


@query("""with p as (select l_orderkey % 16 as shard, l_orderkey // 16 as "offset", 7 + l_orderkey % 5000 as seed from (select distinct l_orderkey from lineitem))
 select shard, count(*) as items, count(distinct seed) = count(*) as seeds_unique, max("offset") + 1 = count(*) and min("offset") = 0 as contiguous from p group by shard""")
def seed_plan_validate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey")
    p = table(spark, d, "lineitem").select("l_orderkey").distinct().select((k % 16).alias("shard"), F.floor(k / 16).cast("long").alias("offset"), (7 + k % 5000).alias("seed"))
    n = F.count("*")
    return p.groupBy("shard").agg(n.alias("items"), (F.countDistinct("seed") == n).alias("seeds_unique"), ((F.max("offset") + 1 == n) & (F.min("offset") == 0)).alias("contiguous"))


@query("""select l_suppkey % 9 as panel, 'm' || (l_partkey % 4) || ':' || (l_linenumber % 2) as fingerprint, count(distinct l_linenumber) as positions from lineitem group by 1, 2 having count(distinct l_linenumber) > 1""")
def aliased_judges(spark: SparkSession, d: str) -> DataFrame:
    finger = F.concat(F.lit("m"), (F.col("l_partkey") % 4).cast("string"), F.lit(":"), (F.col("l_linenumber") % 2).cast("string"))
    return table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 9).alias("panel"), finger.alias("fingerprint")).agg(F.countDistinct("l_linenumber").alias("positions")).filter("positions > 1")


@query("""with c as (select l_orderkey as record_id, l_linenumber as pos, l_partkey as k, case l_partkey % 3 when 0 then 'absent' when 1 then 'advisory' else 'authoritative' end as policy,
 case l_suppkey % 4 when 0 then null when 1 then 'numeric' when 2 then 'set' else 'sql' end as kind, case l_partkey // 3 % 3 when 0 then null when 1 then 'literal' else 'sandbox' end as oracle from lineitem)
 select policy, kind, oracle, count(*) as n, case when policy = 'absent' and (kind is not null or oracle is not null) then 'unused_answer' when policy <> 'absent' and kind is null then 'missing_kind'
 when policy <> 'absent' and oracle is null then 'missing_oracle' when kind = 'numeric' and oracle = 'sandbox' then 'numeric_needs_literal' else 'ok' end as status from c group by all""")
def contract_validate(spark: SparkSession, d: str) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    third = F.floor(p / 3) % 3
    c = table(spark, d, "lineitem").select(
        F.when(p % 3 == 0, "absent").when(p % 3 == 1, "advisory").otherwise("authoritative").alias("policy"),
        F.when(s % 4 == 1, "numeric").when(s % 4 == 2, "set").when(s % 4 == 3, "sql").alias("kind"),
        F.when(third == 1, "literal").when(third == 2, "sandbox").alias("oracle"),
    )
    used = F.col("policy") != "absent"
    status = (
        F.when(~used & (F.col("kind").isNotNull() | F.col("oracle").isNotNull()), "unused_answer").when(used & F.col("kind").isNull(), "missing_kind").when(used & F.col("oracle").isNull(), "missing_oracle")
        .when((F.col("kind") == "numeric") & (F.col("oracle") == "sandbox"), "numeric_needs_literal").otherwise("ok")
    )
    return c.groupBy("policy", "kind", "oracle", status.alias("status")).agg(F.count("*").alias("n"))


@query("select l_orderkey as record_id, l_linenumber as pos, l_partkey as part, l_quantity as q, list_transform(range(0, l_linenumber::bigint), lambda i: (l_partkey + i * 37) % 110) as ids, "
       "len(list_filter(list_transform(range(0, l_linenumber::bigint), lambda i: (l_partkey + i * 37) % 110), lambda x: x >= 105)) = 0 and len(list_filter(list_transform(range(0, case when (l_partkey + (l_linenumber - 1) * 37) % 110 = 104 then l_linenumber::bigint - 1 else l_linenumber::bigint end), lambda i: (l_partkey + i * 37) % 110), lambda x: x in (100, 101, 104))) = 0 as valid from lineitem")  # fmt: skip
def reward_policy(spark: SparkSession, d: str) -> DataFrame:
    ids = F.transform(F.sequence(F.lit(0), F.col("l_linenumber") - 1), lambda i: (F.col("l_partkey") + i * 37) % 110)
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("q"), ids.alias("ids"))
    control = F.array(*(F.lit(x).cast("long") for x in (100, 101, 104)))
    return li.withColumn("valid", selection.reward_valid(F.col("ids"), 105, control, 104))


@query(f"""with {VOTES}, v as (select record_id, judge, score, verdict from votes), x as (select record_id, judge, count(*) as n, min(verdict) as verdict, min(score) as lo, max(score) as hi from v group by 1, 2)
 select record_id, judge, case when n > 1 and lo <> hi then 'invalid_duplicate' when verdict = 'uncertain' then 'incomplete_uncertain' when hi > 1 then 'invalid_score' else 'ok' end as status from x""")
def calibration_intake(spark: SparkSession, d: str) -> DataFrame:
    x = _votes(spark, d).groupBy("record_id", "judge").agg(F.count("*").alias("n"), F.min("verdict").alias("verdict"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    status = F.when((F.col("n") > 1) & (F.col("lo") != F.col("hi")), "invalid_duplicate").when(F.col("verdict") == "uncertain", "incomplete_uncertain").when(F.col("hi") > 1, "invalid_score").otherwise("ok")
    return x.select("record_id", "judge", status.alias("status"))


@query("""with k as (select unnest(range(0, 10)) as i) select i, least(500 * pow(2, i), 30000)::bigint as delay_ms, least(500 * pow(2, i), 30000)::bigint as capped from k""")
def backoff_schedule(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(10).select(F.col("id").alias("i"), ledger.backoff(F.col("id")).alias("delay_ms"), ledger.backoff(F.col("id"), hint_ms=F.lit(None).cast("long")).alias("capped"))


@query("""select o_orderkey as record_id, case when t < 32000 then least(ceil(t * 1.5), 32000)::bigint end as next_budget, o_orderkey + o_orderkey % 4 + 1000000 as revision_seed from (select *, (o_totalprice / 10)::bigint as t from orders)""")
def retry_budget(spark: SparkSession, d: str) -> DataFrame:
    tokens = F.bround(F.col("o_totalprice") / 10).cast("long")
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("record_id"), ledger.retry_budget(tokens).alias("next_budget"), (k + k % 4 + 1_000_000).alias("revision_seed"))
