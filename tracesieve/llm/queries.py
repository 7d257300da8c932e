"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.llm import bpe, chats, language, lm, neardup, pages, phrases, quality, repair, secrets, templates, toxicity, vectors
from tracesieve.llm.common import shared_folder, table


def op1_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in two batches as if one had come after the other, over a ledger of the query's own."""
    docs = table(spark, sf_dir, "documents")
    later = F.xxhash64("doc_id") % 2 == 0
    return secrets.scan_history([docs.filter(~later), docs.filter(later)], f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")


def op7_template_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op9_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"))


def op10_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_edit_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.digests(repair.damaged(conversations), conversations)


def op12_byte_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.read_back(chats.formatted(chats.with_probe(table(spark, sf_dir, "conversations"))))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_attention_lm,
        op2_probminhash,
        op3_template_decontamination,
        op4_byte_bpe,
        op5_ftrl_toxicity,
        op6_secret_ledger,
        op7_template_pages,
        op8_language_mixture,
        op9_prefix_forest,
        op10_quality_discriminant,
        op11_edit_lattice,
        op12_byte_assembly,
        op13_collocations,
    )
}
ORACLES: dict[str, str] = {}

# The audit is told by going through the rows once, each state with its least (cost, audit).
ORACLES["op11_edit_lattice"] = r"""with recursive k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
 f as (select *, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(name, ''), lambda c: ascii(c)::ubigint)),
   lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), lambda a, z: case when a % 2 = 1 then xor(a // 2, 3988292384::ubigint) else a // 2 end)), 4294967295::ubigint) % 20 as fault from k),
 r as (select conv_id, turn, case when fault = 4 then 'user' else role end as role, case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
   unnest(case when fault = 3 then [0, 1] else [0] end) as copy from f where fault <> 0),
 o as (select *, coalesce(conv_id::varchar, '') as c, row_number() over w as i,
   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as tail, lag(role[1:1]) over w as before_ from r window w as (partition by conv_id order by turn nulls first, role, md5(role || chr(10) || text))),
 p as (select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again from o),
 x as (select *, tail = '' as blank, tail <> '' and again as duplicate, tail <> '' and not again and tail not in ('.', '!', '?') as truncated from p),
 told as (select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
   count(*) filter (before_ is not null and before_ || role[1:1] not in ('su', 'ua', 'au')) as illegal, max(i) as n from x group by 1),
 way as (select * from (values (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (2, 2, 6, 'II'), (3, 3, 0, ''), (3, 2, 3, 'I'), (3, 3, 6, 'II')) v(s, t, more, letters)),
 empty as (select s, t, more, letters, case when letters = '' then []::varchar[] when s = 2 and letters = 'II' then ['assistant:', 'user:'] when s = 2 then ['assistant:'] when letters = 'II' then ['user:', 'assistant:'] else ['user:'] end as made from way),
 dp as (select c, 0::bigint as i, t as s, {'cost': more, 'audit': letters, 'made': made} as best from told, empty where empty.s = 0
  union all
  select c, i, s, min(best) from (
   select d.c, x.i, e.t as s, {'cost': d.best.cost + m.more + e.more, 'audit': d.best.audit || m.letter || e.letters, 'made': d.best.made || m.made || e.made} as best
   from dp d join x on x.c = d.c and x.i = d.i + 1,
   lateral (select unnest([{'letter': 'D', 'more': 4, 'to': d.s, 'made': []::varchar[]},
     case when not (blank or duplicate) then {'letter': 'R', 'more': 3 + 3 * truncated::int, 'to': case when d.s = 2 then 3 else 2 end, 'made': [case when d.s = 2 then 'assistant:' else 'user:' end || text]} end,
     case when not (blank or duplicate) and (d.s = 0 and role[1:1] = 's' or d.s <> 2 and role[1:1] = 'u' or d.s = 2 and role[1:1] = 'a')
      then {'letter': 'K', 'more': 3 * truncated::int, 'to': case role[1:1] when 's' then 1 when 'u' then 2 else 3 end, 'made': [role || ':' || text]} end], recursive := true)) m
   join empty e on e.s = m.to where m.letter is not null) group by c, i, s),
 best as (select c, min(best) as best from dp join told using (c) where dp.i = told.n and dp.s in (0, 3) group by c)
 select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(best.cost, 0)::bigint as cost, coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.made, chr(10)), '')) as repaired_sha256
  from (select distinct conv_id, coalesce(conv_id::varchar, '') as c from conversations) a left join told using (c) left join best using (c)"""

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(/?(?:INST|SYS|ROLE)\]|/?s>)', '\1\\\2\3', 'g')"
ORACLES["op12_byte_assembly"] = f"""with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, t, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(t, r))
 select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  3 + sum(length({_ESCAPED.format('text')}) + case role when 'system' then 11 when 'user' then 15 when 'assistant' then 5 else 17 + length({_ESCAPED.format('role')}) end)::bigint as formatted_chars
 from c group by conv_id"""

ORACLES["op13_collocations"] = r"""with d as (select row_number() over () as i, coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
 p as (select lang, i, unnest(regexp_split_to_array(t, '[.,;:!?\n\x{0B}\f\r]')) as piece from d),
 q as (select lang, row_number() over () as i, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as ws from p),
 w as (select lang, i, unnest(ws) as w1, generate_subscripts(ws, 1) as j from q),
 s as (select lang, w1, lead(w1) over o as w2, lead(w1, 2) over o as w3 from w window o as (partition by i order by j)),
 n as (select lang, count(*) as n from s group by 1),
 f as (select lang, w1 as phrase, 1 as size, count(*) as c from s group by 1, 2
  union all select lang, w1 || ' ' || w2, 2, count(*) from s where w2 is not null group by 1, 2
  union all select lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) from s where w3 is not null group by 1, 2),
 g as (select * from f where c >= 10),
 x as (select lang, phrase, size, c as a, unnest(generate_series(1, size - 1)) as k, string_split(phrase, ' ') as v from g where size > 1),
 y as (select x.*, l.c as l, r.c as r, (1000000::hugeint * a * a) // (l.c::hugeint * r.c) as score from x
  join g l on l.lang = x.lang and l.phrase = array_to_string(v[1:k], ' ') join g r on r.lang = x.lang and r.phrase = array_to_string(v[k + 1:], ' ')),
 z as (select * from y qualify row_number() over (partition by lang, phrase order by score, k) = 1),
 inner_ as (select lang, phrase, max(a) as longer from (select lang, array_to_string(v[1:2], ' ') as phrase, a from x where size = 3 union all select lang, array_to_string(v[2:3], ' '), a from x where size = 3) group by 1, 2),
 kept as (select z.* from z left join inner_ using (lang, phrase) where longer is null or 100 * longer < 50 * a)
 select lang, rank, phrase, a, l, r, n, score::bigint as score from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join n using (lang) where rank <= 2000"""
