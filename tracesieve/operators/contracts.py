"""Contracts of tasks, suites of cases, coverage of protected sets, sets of siblings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.functions import text as T

# Comparators that take a literal or an executed answer.
COMPARED = ("numeric_match", "set_match", "sql_result_match", "schema_shape")


def contract_fault() -> Column:
    """What is wrong with a contract, the first fault; null if nothing is. Columns: answer_policy, execution_policy (absent,
    advisory, authoritative), kind, oracle (coding_suite, sandbox_execution, literal, refusal_policy, none), expected, has_numeric,
    required_tests, suite_cases (arrays of names)."""
    c = F.col
    tests = F.coalesce("required_tests", F.array().cast("array<string>"))
    suite = (c("answer_policy") != "absent") | (c("execution_policy") != "authoritative") | (c("kind") != "none") | ~tests.eqNullSafe(c("suite_cases"))
    numeric = c("kind") == "numeric_match"
    told = c("oracle").isin("literal", "sandbox_execution") & c("expected").isNotNull()
    supported = (c("kind").isin(*COMPARED) & c("oracle").isin("literal", "sandbox_execution")) | ((c("kind") == "refusal_expected") & (c("oracle") == "refusal_policy"))
    blank = F.exists(tests, lambda t: F.trim(t) == "") | (F.size(F.array_distinct(tests)) < F.size(tests))
    return (
        F.when(c("answer_policy").isNull(), "no_answer_policy")
        .when(c("execution_policy").isNull(), "no_execution_policy")
        .when((c("oracle") == "coding_suite") & suite, "inexact_suite")
        .when(numeric & ~c("has_numeric"), "numeric_missing")
        .when(numeric & told & T.parse_decimal(c("expected")).isNull(), "numeric_expected")
        .when(~numeric & c("has_numeric"), "numeric_unused")
        .when((c("answer_policy") != "absent") & ~supported, "unsupported_comparator")
        .when((c("execution_policy") == "authoritative") & (F.size(tests) == 0), "no_tests")
        .when(blank, "test_names")
    )


def suite_outcomes(cases: DataFrame) -> DataFrame:
    """record, outcome of suites of cases (record, status, settled): unknown with a case that isn't settled or was
    skipped, failed with a failed one, else passed."""
    open_ = ~F.coalesce("settled", F.lit(False)) | (F.col("status") == "skipped")
    return cases.groupBy("record").agg(F.when(F.bool_or(open_), "unknown").when(F.bool_or(F.col("status") == "failed"), "failed").otherwise("passed").alias("outcome"))


def coverage_issues(sets: DataFrame, items: DataFrame, required: DataFrame, languages: list[str], fields: list[str]) -> DataFrame:
    """(set_id, issue) of protected sets. sets: set_id, permitted, reviewer, evidence (array), complete, languages, media, fields
    (arrays); items: set_id, language; required: set_id. missing_protected_set, unresolved_protected_rights (no permission,
    reviewer or evidence), incomplete_protected_contents (not declared complete, or without items), incomplete_protected_coverage (a required or
    an item's language, a field or text as the only medium isn't covered)."""
    of = items.groupBy("set_id").agg(F.count(F.lit(1)).alias("items"), F.collect_set("language").alias("spoken"), F.bool_or(F.col("language").isNull()).alias("unknown"))
    x = sets.join(of, "set_id", "left")
    within = lambda small, large: F.size(F.array_except(small, large)) == 0
    evidence = F.coalesce("evidence", F.array().cast("array<string>"))
    rights = F.coalesce("permitted", F.lit(False)) & (F.trim(F.coalesce("reviewer", F.lit(""))) != "") & (F.size(evidence) > 0) & ~F.exists(evidence, lambda e: F.coalesce(F.trim(e), F.lit("")) == "")
    whole = F.coalesce("complete", F.lit(False)) & (F.coalesce("items", F.lit(0)) > 0)
    held = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    wanted = lambda names: F.array(*(F.lit(n) for n in names)).cast("array<string>")
    covered = (
        within(wanted(languages), held("languages")) & within(held("spoken"), held("languages")) & ~F.coalesce("unknown", F.lit(False))
        & held("media").eqNullSafe(wanted(["text"])) & within(wanted(fields), held("fields"))
    )
    issues = F.array_compact(F.array(F.when(~rights, F.lit("unresolved_protected_rights")), F.when(~whole, F.lit("incomplete_protected_contents")), F.when(~covered, F.lit("incomplete_protected_coverage"))))
    missing = required.select("set_id").distinct().join(sets.select("set_id"), "set_id", "left_anti").select("set_id", F.lit("missing_protected_set").alias("issue"))
    return x.select("set_id", F.explode(issues).alias("issue")).union(missing)


def sibling_issues(members: DataFrame, declared: DataFrame) -> DataFrame:
    """(run_id, group_id, record, issue) of sets of siblings. members: run_id, group_id (null: no evidence), record, n_completions,
    completion_index, prompt_hash, prefix (what identifies all messages but the last); declared: run_id, group_id, record.

    Of a record: missing_sibling_evidence; invalid_sibling_identity (an index outside the number, or a group that isn't its prompt). Of a set (record is
    null): undeclared_sibling_set, expected_sibling_membership (other members than declared), incomplete_or_inconsistent_siblings
    (declared, but numbers, indexes or prefixes that don't agree with each other or with the members)."""
    known = F.col("group_id").isNotNull() & F.col("n_completions").isNotNull() & F.col("completion_index").isNotNull()
    wrong = (F.col("n_completions") == 0) | (F.col("completion_index") >= F.col("n_completions")) | ~F.col("prompt_hash").eqNullSafe(F.col("group_id"))
    of_record = members.select("run_id", "group_id", "record", F.when(~known, "missing_sibling_evidence").when(wrong, "invalid_sibling_identity").alias("issue")).filter("issue is not null")
    keys = ["run_id", "group_id"]
    prefix = F.coalesce(F.col("prefix").cast("string"), F.lit(""))
    real = members.filter(known).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("n_completions").alias("least"), F.max("n_completions").alias("most"), F.countDistinct("completion_index").alias("indexes"), F.countDistinct(prefix).alias("prefixes")
    )
    there, said = members.filter(known).select(*keys, "record"), declared.select(*keys, "record").distinct()
    both = there.withColumn("real", F.lit(1)).join(said.withColumn("said", F.lit(1)), [*keys, "record"], "full")
    differs = both.filter("real is null or said is null").select(*keys).distinct()
    named = said.select(*keys).distinct()
    bad = (F.col("least") != F.col("n")) | (F.col("most") != F.col("n")) | (F.col("indexes") != F.col("n")) | (F.col("prefixes") > 1)
    none = F.lit(None).cast(members.schema["record"].dataType)
    tell = lambda df, issue: df.select(*keys, none.alias("record"), F.lit(issue).alias("issue"))
    return (
        of_record.unionByName(tell(real.join(named, keys, "left_anti"), "undeclared_sibling_set"))
        .unionByName(tell(differs.join(named, keys, "left_semi"), "expected_sibling_membership"))
        .unionByName(tell(real.filter(bad).join(named, keys, "left_semi"), "incomplete_or_inconsistent_siblings"))
    )
