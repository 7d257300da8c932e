"""Queries over documents, protected items, labels and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.functions import text as T
from tracesieve.operators import evaluate, screening, vectors
from tracesieve.plans.registry import query
from tracesieve.plans.sql import WORDS, framed, shingles
from tracesieve.sources.tables import cut, table

#: The similarity at which the test tables have protected matches.
LOOSE = 0.1
_D = f"docs as (select doc_id as id, text, lang, source, {WORDS} as words from documents)"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")


@query(f"select doc_id, {WORDS} as words from documents")
def tokenize(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select(F.col("id").alias("doc_id"), T.tokenize(F.col("text")).alias("words"))


@query(f"""with {_D}, s as ({" union all ".join(shingles(n, "docs", "id") for n in (5, 8, 13))}), k as (select id, n, count(*) as k from s group by 1, 2)
 select id as doc_id, len(words) as n_words, coalesce(max(k) filter (n = 5), 0) as n5, coalesce(max(k) filter (n = 8), 0) as n8, coalesce(max(k) filter (n = 13), 0) as n13 from docs left join k using (id) group by id, words""")
def shingle_counts(spark: SparkSession, d: str) -> DataFrame:
    lengths = (5, 8, 13)
    counted = lambda w: F.struct(F.size(w).alias("n_words"), screening.shingle_sizes(w, lengths).alias("k"))
    c = _docs(spark, d).select(F.col("id").alias("doc_id"), T.once(T.tokenize(F.col("text")), counted).alias("c"))
    return c.select("doc_id", "c.n_words", *(F.coalesce(F.col("c.k")[i], F.lit(0)).alias(f"n{n}") for i, n in enumerate(lengths)))


_ITEMS = f"items as (select item_id, {WORDS} as words from benchmark)"


@query(f"with {_ITEMS} select item_id, g as shingle from ({shingles(8, 'items', 'item_id')})")
def shingles_query(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark").select("item_id", T.tokenize(F.col("text")).alias("words"))
    return b.select("item_id", F.explode(T.shingles(F.col("words"), 8)).alias("shingle"))


_PAIR_SQL = f"""with {_D}, rep as (select min(id) as id, words from docs group by words),
 s as ({" union all ".join(shingles(n, "rep", "id") for n in range(8, 14))}),
 m as (select id, n, count(*) as m from s group by 1, 2),
 i as (select a.id as a, b.id as b, a.n, count(*) as k from s a join s b on a.n = b.n and a.g = b.g and a.id < b.id group by 1, 2, 3),
 p as (select i.a, i.b, i.n, k as intersection, ma.m + mb.m - k as total from i join m ma on ma.id = i.a and ma.n = i.n join m mb on mb.id = i.b and mb.n = i.n where k >= 0.8 * (ma.m + mb.m - k)) """


@query(_PAIR_SQL + "select a, b, n, intersection, total from p")
def lexical_pairs(spark: SparkSession, d: str) -> DataFrame:
    reps, _ = screening.distinct_texts(_docs(spark, d))
    return screening.similar_pairs(reps)


@query(_PAIR_SQL + "select a, b, max(intersection / total) as similarity from p group by 1, 2")
def jaccard(spark: SparkSession, d: str) -> DataFrame:
    reps, _ = screening.distinct_texts(_docs(spark, d))
    return screening.similar_pairs(reps).groupBy("a", "b").agg(F.max(F.col("intersection") / F.col("total")).alias("similarity"))


_MATCH_SQL = f"""with {_D}, {_ITEMS}, t as ({shingles(8, "docs", "id")}), tm as (select id, count(*) as m from t group by 1),
 i as ({shingles(8, "items", "item_id")}), im as (select item_id, count(*) as k from i group by 1),
 x as (select id, item_id, count(*) as intersection from t join i using (g) group by 1, 2),
 f as (select id, item_id, intersection, m + k - intersection as total from x join tm using (id) join im using (item_id)) """


@query(_MATCH_SQL + f"select id, item_id, intersection, total from f where intersection >= {LOOSE} * total")
def decontam_matches(spark: SparkSession, d: str) -> DataFrame:
    return screening.protected_matches(_docs(spark, d), table(spark, d, "benchmark"), 8, LOOSE)


# No document reaches the default similarity; the items themselves are texts too, under negative ids.
_WITH_ITEMS = f"""docs as (select doc_id as id, {WORDS} as words from documents union all select -1 - item_id as id, {WORDS} as words from benchmark)"""


@query(_MATCH_SQL.replace(_D, _WITH_ITEMS) + "select id, item_id, intersection, total from f where intersection >= 0.8 * total")
def decontam_matches_default(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark")
    texts = _docs(spark, d).select("id", "text").union(items.select(-1 - F.col("item_id"), "text"))
    return screening.protected_matches(texts, items, 8, screening.SIMILARITY)


@query(f"""with {_D} select words_hash, copies, first_id from (select sha256(array_to_string(words, ' ')) as words_hash, count(*) as copies, min(id) as first_id from docs group by words) where copies > 1""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    h = _docs(spark, d).select("id", F.sha2(F.array_join(T.tokenize(F.col("text")), " "), 256).alias("words_hash"))
    return h.groupBy("words_hash").agg(F.count("*").alias("copies"), F.min("id").alias("first_id")).filter("copies > 1")


# Links between documents by arithmetic: a record's parents are half and a third of its id, where
# those are divisible; copies of a text are linked to the first.
_EDGES = f"""edges as (select distinct a, b from (
  select min(id) over (partition by words) as a, id as b from docs union all select id // 7 as a, id as b from docs where id % 7 = 0 and id > 0) where a <> b)"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    # the words by one space, without an array of them; written, as the first of a key and its others both read it
    key = cut(docs.select("id", F.sha2(T.normalize_answer(F.col("text")), 256).alias("k")))
    parents = docs.filter("id % 7 = 0 and id > 0").select(F.floor(F.col("id") / 7).cast("long").alias("a"), F.col("id").alias("b"))
    return screening.star_edges(key, "k").union(parents).distinct()


@query(f"with {_D}, {_EDGES} select a, b from edges")
def declared_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


_COMP = f"""with recursive {_D}, {_EDGES}, both_ as (select a, b from edges union select b, a from edges),
 reach(node, root) as (select a, a from both_ union select x.b, r.root from reach r join both_ x on x.a = r.node),
 comp as (select node, min(root) as root from reach group by node)"""


@query(_COMP + " select node, root from comp")
def components(spark: SparkSession, d: str) -> DataFrame:
    return screening.components(_edges(spark, d))


@query(f"""with {_D}, e as (select 'exact_text' as kind, min(id) over (partition by words) as a, id as b from docs union all select 'declared_parent', id // 7, id from docs where id % 7 = 0
  union all select 'declared_source', min(id) over (partition by source, lang), id from docs) select kind, count(*) as edges from (select distinct * from e where a <> b) group by kind""")
def edge_kinds(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    key = docs.select("id", F.sha2(F.array_join(T.tokenize(F.col("text")), " "), 256).alias("k"))
    exact = screening.star_edges(key, "k").withColumn("kind", F.lit("exact_text"))
    parent = docs.filter("id % 7 = 0 and id > 0").select(F.floor(F.col("id") / 7).cast("long").alias("a"), F.col("id").alias("b"), F.lit("declared_parent").alias("kind"))
    source = screening.star_edges(docs.withColumn("k", F.concat_ws(":", "source", "lang")), "k").withColumn("kind", F.lit("declared_source"))
    return exact.unionByName(parent).unionByName(source).groupBy("kind").agg(F.count("*").alias("edges"))


_GROUPS = _COMP + """, grp as (select id, coalesce(root, id) as group_id, case when id % 10 < 8 then 'train' when id % 10 = 8 then 'test' end as split from docs left join comp on node = id)"""


def _groups(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("id") % 10
    docs = _docs(spark, d).select("id", F.when(m < 8, "train").when(m == 8, "test").alias("split"))
    return screening.grouped(docs, _edges(spark, d))


@query(_GROUPS + """, g as (select group_id, count(*) as members, min(split) as one, count(distinct split) as splits, count(split) as declared, bool_or(id % 50 = 3) as hit from grp group by 1)
 select group_id, members, case when splits = 1 and declared = members then one end as split, splits > 1 or hit as quarantined,
  array_to_string(list_filter([case when hit then 'protected_match' end, case when splits > 1 then 'split_conflict' end], lambda x: x is not null), ',') as reasons from g""")
def component_quarantine(spark: SparkSession, d: str) -> DataFrame:
    g = _groups(spark, d)
    return screening.quarantine(g, g.filter("id % 50 = 3").select("id"))


@query(_GROUPS + """, q as (select group_id, count(distinct split) > 1 or bool_or(id % 50 = 3) as quarantined from grp group by 1)
 select count(*) as population, count(distinct grp.group_id) as groups, count(*) filter (quarantined) as quarantined_members, count(*) filter (not quarantined and coalesce(split, '') = 'train') as eligible from grp join q using (group_id)""")
def screen_counts(spark: SparkSession, d: str) -> DataFrame:
    g = _groups(spark, d)
    q = screening.quarantine(g, g.filter("id % 50 = 3").select("id")).select("group_id", "quarantined")
    return g.join(q, "group_id").agg(
        F.count("*").alias("population"), F.countDistinct("group_id").alias("groups"), F.count_if("quarantined").alias("quarantined_members"),
        F.count_if(~F.col("quarantined") & (F.coalesce("split", F.lit("")) == "train")).alias("eligible"),
    )


@query(_GROUPS + """, q as (select group_id, count(distinct split) > 1 or bool_or(id % 50 = 3) as quarantined from grp group by 1),
 r as (select id, array_to_string(list_sort(list_filter([case when id % 17 = 0 then 'incomplete_plan' end, case when id % 5 = 0 then 'not_selected_admitted' end, case when quarantined then 'quarantined_component' end,
  case when split is distinct from 'train' then 'not_train_component' end, case when id % 11 = 0 then 'missing_output_member' end], lambda x: x is not null)), ',') as reasons from grp join q using (group_id))
 select id, reasons from r where reasons <> ''""")
def screen_exclusions(spark: SparkSession, d: str) -> DataFrame:
    g = _groups(spark, d)
    q = screening.quarantine(g, g.filter("id % 50 = 3").select("id")).select("group_id", "quarantined")
    rows = g.join(q, "group_id").select("id", (F.col("id") % 17 != 0).alias("complete"), (F.col("id") % 5 != 0).alias("selected"), "quarantined", "split", (F.col("id") % 11 != 0).alias("present"))
    return screening.exclusions(rows)


@query(_GROUPS + """, q as (select group_id, count(distinct split) > 1 or bool_or(id % 50 = 3) as quarantined from grp group by 1)
 select id, group_id from grp join q using (group_id) where not quarantined and split = 'train'""")
def screened_export(spark: SparkSession, d: str) -> DataFrame:
    g = _groups(spark, d)
    held = screening.quarantine(g, g.filter("id % 50 = 3").select("id")).filter("quarantined").select("group_id")
    return g.join(held, "group_id", "left_anti").filter("split = 'train'").select("id", "group_id")


@query(_GROUPS + """, prev as (select id, 'p' || (id // 3) as stable_id from grp where id % 4 = 0), j as (select group_id, count(distinct stable_id) as n, list_sort(list_distinct(list(stable_id) filter (stable_id is not null))) as old from grp left join prev using (id) group by 1)
 select group_id, case when n = 0 then 'g' || group_id when n = 1 then old[1] else 'j:' || array_to_string(old, '+') end as stable_id, n > 1 as joined from j""")
def group_extension(spark: SparkSession, d: str) -> DataFrame:
    g = _groups(spark, d)
    prev = g.filter("id % 4 = 0").select("id", F.concat(F.lit("p"), F.floor(F.col("id") / 3).cast("string")).alias("stable_id"))
    return screening.extended_groups(g, prev)


@query("""with e as (select doc_id as child, (doc_id * 3 + 1) % (select count(*) from documents) as parent from documents where doc_id % 2 = 0)
 select child, parent, p.doc_id is null as missing from e left join documents p on p.doc_id = e.parent""")
def parent_lineage(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    n = docs.count()
    e = docs.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("child"), ((F.col("doc_id") * 3 + 1) % n).alias("parent"))
    there = docs.groupBy(F.col("doc_id").alias("parent")).agg(F.count("*").alias("k"))
    return e.join(there, "parent", "left").select("child", "parent", (F.coalesce("k", F.lit(0)) != 1).alias("missing"))


@query("""with recursive n as (select count(*) as n from documents), e as (select doc_id as child, (doc_id * 3 + 1) % n as parent from documents, n),
 r as (select child, parent from e union select r.child, e.parent from r join e on e.child = r.parent)
 select distinct child as node from e where not exists (select 1 from r where r.child = e.child and r.parent not in (select child from e))""")
def lineage_cycles(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    n = docs.count()
    return screening.cyclic_nodes(docs.select(F.col("doc_id").alias("child"), ((F.col("doc_id") * 3 + 1) % n).alias("parent")))


@query(f"""with {_D}, t as (select octet_length(encode(text)) as b, len(words) as w from docs),
 u as (select sum(b)::bigint as a, max(b)::bigint as c, max(w)::bigint as e, count(*) as f, sum({' + '.join(f'greatest(0, w - {n - 1})' for n in (5, 8, 9, 10, 11, 12, 13))})::bigint as h from t)
 select counter, used, "limit", used > "limit" as exceeded from (select unnest(['text_bytes', 'segment_bytes', 'segment_tokens', 'segments', 'shingles']) as counter, unnest([a, c, e, f, h]) as used,
  unnest([67108864, 1048576, 65536, 100000, 2000000]::bigint[]) as "limit" from u)""")
def resource_budget(spark: SparkSession, d: str) -> DataFrame:
    limits = {"text_bytes": 64 << 20, "segment_bytes": 1 << 20, "segment_tokens": 65_536, "segments": 100_000, "shingles": 2_000_000}
    return screening.budgets(_docs(spark, d), limits)


@query("""select source, count(distinct lang) as langs, count(*) as members from documents group by source having count(distinct lang) > 1""")
def split_crossing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.countDistinct("lang").alias("langs"), F.count("*").alias("members")).filter("langs > 1")


@query("""with need as (select unnest(['en', 'de', 'fr', 'es', 'it', 'pt']) as lang) select lang from need where lang not in (select lang from documents where lang is not null)""")
def missing_protected(spark: SparkSession, d: str) -> DataFrame:
    need = spark.createDataFrame([(x,) for x in ("en", "de", "fr", "es", "it", "pt")], "lang string")
    return need.join(table(spark, d, "documents").select("lang").distinct(), "lang", "left_anti")


@query("""select lang, count(*) as items, count(*) filter (text is null or trim(text) = '') as blank, min(length(text)) >= 1 and count(*) > 0 as covered from documents group by lang""")
def protected_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("items"), F.count_if(t.isNull() | (F.trim(t) == "")).alias("blank"), ((F.min(F.length(t)) >= 1) & (F.count("*") > 0)).alias("covered"))


@query("""with m as (select doc_id, count(*) as m from documents where doc_id % 3 <> 0 group by 1), l as (select doc_id, count(*) as l, count(case when quality = 1 or toxic = 0 then 1 end) as k from labels group by 1)
 select doc_id, case when m is null then 'unexpected' when l is null then 'missing' when l > 1 then 'duplicate' when k = 0 then 'unknown' else 'known' end as status from m full join l using (doc_id)""")
def outcome_coverage(spark: SparkSession, d: str) -> DataFrame:
    members = table(spark, d, "documents").filter("doc_id % 3 != 0").select("doc_id")
    labels = table(spark, d, "labels").select("doc_id", F.when((F.col("quality") == 1) | (F.col("toxic") == 0), 1).alias("outcome"))
    return evaluate.coverage(members, labels)


@query("""with dd as (select doc_id, lang, source, n_chars from documents where doc_id % 3 <> 0), aa as (select doc_id, case when doc_id % 10 = 0 then 'xx' else lang end as lang, source, case when doc_id % 15 = 0 then n_chars + 1 else n_chars end as n_chars from documents where doc_id % 4 <> 0),
 j as (select doc_id, case when a.doc_id is null then 'missing' when d.doc_id is null then 'undeclared' else array_to_string(list_filter([case when d.lang is distinct from a.lang then 'lang' end, case when d.source is distinct from a.source then 'source' end, case when d.n_chars is distinct from a.n_chars then 'n_chars' end], lambda x: x is not null), ',') end as mismatch from dd d full join aa a using (doc_id))
 select doc_id, mismatch from j where mismatch <> ''""")
def binding_mismatch(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    k = F.col("doc_id")
    actual = docs.filter("doc_id % 4 != 0").withColumn("lang", F.when(k % 10 == 0, "xx").otherwise(F.col("lang"))).withColumn("n_chars", F.when(k % 15 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    return evaluate.binding_mismatch(docs.filter("doc_id % 3 != 0"), actual, "doc_id", ["lang", "source", "n_chars"])


@query(f"""with f as (select source, sha256(text) as prompt from documents where doc_id % 2 = 0), a as (select source, sha256(text) as prompt from documents where doc_id % 2 = 1)
 select 'source' as kind, source as value from (select source from f intersect select source from a) union all select 'prompt', prompt from (select prompt from f intersect select prompt from a)""")
def partition_leak(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("prompt"))
    return evaluate.leaks(rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1"), ["source", "prompt"])


@query(f"select doc_id, {framed('lang', 'source', 'text')} as content_hash from documents")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.framed_digest(F.col("lang"), F.col("source"), F.col("text")).alias("content_hash"))


@query(f"""with h as (select source, {framed('lang', 'source', 'text')} as h from documents) select source, count(*) as n_records, sha256({" || ':' || ".join(["count(*)", *(f"sum(('0x' || substr(h, {at}, 15))::bigint)" for at in (1, 16, 31, 46))])}) as build_hash from h group by source""")
def build_inputs_hash(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "documents").select("source", T.framed_digest(F.col("lang"), F.col("source"), F.col("text")).alias("h"))
    return h.groupBy("source").agg(F.count("*").alias("n_records"), T.multiset_digest(F.col("h")).alias("build_hash"))


@query("""select a.vec_id, b.vec_id as other_id, round(list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) / sqrt(list_dot_product(b.embedding::double[], b.embedding::double[])), 9) as cosine
 from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def cosine(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("other_id"), F.col("embedding").alias("other"))
    return e.join(b, "vec_id").select("vec_id", "other_id", F.round(T.cosine(F.col("embedding"), F.col("other")), 9).alias("cosine"))


# Every vector is an item; its priors are all the others.
_GATE = """v as (select vec_id, embedding::double[] as v, sqrt(list_dot_product(embedding::double[], embedding::double[])) as norm from embeddings),
 g as (select a.vec_id, max(list_dot_product(a.v, b.v) / a.norm / b.norm) as nearest from v a left join v b on a.vec_id <> b.vec_id group by 1)"""


def _nearest(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return vectors.nearest_prior(e, e).withColumnRenamed("id", "vec_id")


@query(f"with {_GATE} select vec_id, round(nearest, 9) as nearest, coalesce(nearest < 0.4, true) as diverse from g")
def diversity_gate(spark: SparkSession, d: str) -> DataFrame:
    return _nearest(spark, d).select("vec_id", F.round("nearest", 9).alias("nearest"), vectors.novel(F.col("nearest"), 0.4).alias("diverse"))


@query(f"with {_GATE} select vec_id, vec_id % 3 <> 0 and vec_id % 7 <> 0 and coalesce(nearest < 0.4, true) and (vec_id % 4 <> 0 or vec_id % 8 = 0) as passed from g")
def qc_gate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("vec_id")
    answerable, targeted, in_scope, refusal = k % 3 != 0, k % 7 != 0, k % 4 != 0, k % 8 == 0
    return _nearest(spark, d).select("vec_id", (answerable & targeted & vectors.novel(F.col("nearest"), 0.4) & (in_scope | refusal)).alias("passed"))
