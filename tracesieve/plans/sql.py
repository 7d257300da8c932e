"""Pieces of SQL that several statements share; they restate the views of sources.tables."""

from __future__ import annotations

from tracesieve.functions.text import COMPLIANCES, CONTROL_TOKENS, REFUSALS

# The separators of the word tokenizer, as DuckDB's regular expressions write them.
SEPARATORS = r"[\x{09}\x{0A}\x{0B}\x{0C}\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS = f"list_filter(regexp_split_to_array({LOWER.format('text')}, '{SEPARATORS}'), lambda w: w <> '')"


def shingles(n: int, table: str, key: str) -> str:
    """A SELECT of the distinct n-grams g of each key; table has key and words."""
    gram = " || ' ' || ".join(["w", *(f"lead(w, {i}) over o" for i in range(1, n))])
    flat = f"select {key}, unnest(words) as w, generate_subscripts(words, 1) as p from {table}"
    return f"select distinct {key}, {n} as n, g from (select {key}, {gram} as g from ({flat}) window o as (partition by {key} order by p)) where g is not null"


VOTES = """votes as (select l_orderkey as record_id, l_linenumber as pos, 'judge' || (l_suppkey % 5) as judge, l_discount * 10 as score,
  l_quantity as weight, case when l_returnflag = 'A' then 'accept' when l_returnflag = 'R' then 'reject'
  when l_linestatus = 'F' then 'revise' else 'uncertain' end as verdict from lineitem)"""

CANDIDATES = """cand as (select o_orderkey as record_id, o_orderkey // 4 as group_id, o_orderkey % 4 as idx, 'run' || ((o_orderkey // 4) % 3) as run_id,
  case when o_custkey % 13 <> 0 then (o_custkey % 101) / 100.0::double end as aggregate, o_orderstatus <> 'F' as all_passed,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'accept' when o_orderpriority = '3-MEDIUM' then 'revise'
  when o_orderpriority = '5-LOW' then 'escalate' else 'reject' end as decision,
  (['planned','generated','verifying','verified','judging','judged','admitted','formatted','exported','rejected','needs_review','errored'])[(o_custkey % 12) + 1] as state,
  o_custkey % 7 as cost from orders)"""

MESSAGES = """turns as (select conv_id, turn, role, text as content,
  case when role = 'assistant' and (conv_id + turn) % 3 = 0 then split_part(text, ' ', 1) end as reasoning from conversations)"""


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def first_token(column: str) -> str:
    return "coalesce(" + ", ".join(f"case when contains({column}, {quoted(t)}) then {quoted(t)} end" for t in CONTROL_TOKENS) + ")"


def any_phrase(column: str, phrases: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({column}, {quoted(p)})" for p in phrases) + ")"


REFUSAL = f"""case when {any_phrase('t', REFUSALS)} then 'refusal' when {any_phrase('t', COMPLIANCES)} then 'compliance' else 'ambiguous' end"""


def framed(*parts: str) -> str:
    return "sha256(" + " || ".join(f"case when {p} is null then 'n;' else length({p}) || ':' || {p} || ';' end" for p in parts) + ")"
