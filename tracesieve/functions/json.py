"""JSON texts: canonical form, task and tool documents, stream chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.sources.tables import cut

# Words that can't name a Python function.
KEYWORDS = (
    "False", "None", "True", "and", "as", "assert", "async", "await", "break", "class", "continue", "def", "del", "elif", "else", "except",
    "finally", "for", "from", "global", "if", "import", "in", "is", "lambda", "nonlocal", "not", "or", "pass", "raise", "return", "try",
    "while", "with", "yield",
)


def canonical(x: Column) -> Column:
    """A JSON text with the keys of every object in order and no space between; null if it is none.
    A variant keeps its keys sorted, so that reading and writing one is enough."""
    return F.to_json(F.try_parse_json(x))


def identifier(x: Column) -> Column:
    """Whether x can name a Python function: ASCII, 64 characters at most, no keyword."""
    return x.rlike("^[A-Za-z_][A-Za-z0-9_]{0,63}$") & ~x.isin(*KEYWORDS)


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def tool_problem(x: Column) -> Column:
    """What is wrong with a tool definition; null if nothing is."""
    v = F.try_parse_json(x)
    function = F.get_json_object(x, "$.function")
    keys = F.json_object_keys(x)
    inner = F.json_object_keys(function)
    name = F.get_json_object(x, "$.function.name")
    odd = F.size(F.array_except(inner, F.array(*(F.lit(k) for k in ("name", "description", "parameters", "strict"))))) > 0
    wrong = lambda path, kind: F.coalesce(_kind(v, path), F.lit(kind)) != kind
    return (
        F.when(v.isNull() | keys.isNull(), "not_an_object")
        .when((F.array_sort(keys) != F.array(F.lit("function"), F.lit("type"))) | ~F.get_json_object(x, "$.type").eqNullSafe(F.lit("function")), "wrapper")
        .when(inner.isNull(), "function")
        .when(odd | wrong("$.function.description", "STRING") | wrong("$.function.strict", "BOOLEAN"), "field")
        .when(name.isNull() | (F.trim(name) == ""), "name")
        .when(~F.get_json_object(x, "$.function.parameters.type").eqNullSafe(F.lit("object")), "parameters")
    )


def chunk_status(x: Column) -> Column:
    """How a chunk of a stream reads: malformed, provider_error, choice, legacy_call,
    conflicting_reasoning or ok."""
    v = F.try_parse_json(x)
    get = lambda p: F.get_json_object(x, p)
    a, b = get("$.choices[0].delta.reasoning"), get("$.choices[0].delta.reasoning_content")
    return (
        F.when(v.isNull(), "malformed")
        .when(get("$.error").isNotNull(), "provider_error")
        .when(get("$.choices[1]").isNotNull() | (F.coalesce(get("$.choices[0].index"), F.lit("0")) != "0"), "choice")
        .when(get("$.choices[0].delta.function_call").isNotNull(), "legacy_call")
        .when(a != b, "conflicting_reasoning")
        .otherwise("ok")
    )


def content_text(x: Column) -> Column:
    """The text of a message's content, a JSON text: a string itself, the text parts of an array
    without anything between, null for null."""
    parts = F.from_json(x, "array<struct<type:string,text:string>>")
    texts = F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit("")))
    return F.when(x.startswith("["), F.array_join(texts, "")).otherwise(F.try_variant_get(F.try_parse_json(x), "$", "string"))


def leaves(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, text) of every string and of every object key in a JSON text: keys under the path
    of their value with ~ before it. Goes down level by level, as deep as the texts do."""
    spark = rows.sparkSession
    level = rows.select(F.col(key).alias("key"), F.lit("$").alias("path"), F.try_parse_json(column).alias("v"))
    out = None
    while True:
        kind = F.schema_of_variant("v")
        found = level.filter(kind == "STRING").select("key", "path", F.variant_get("v", "$", "string").alias("text"))
        out = found if out is None else out.unionByName(found)
        nested = level.filter(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        if nested.isEmpty():
            return out.withColumnRenamed("key", key)
        nested.createOrReplaceTempView("nested_json")
        inner = spark.sql("select n.key, n.path, e.pos, e.key as name, e.value as v from nested_json n, lateral variant_explode(n.v) e")
        path = F.concat("path", F.when(F.col("name").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), "name")))
        level = inner.select("key", path.alias("path"), "name", "v")
        out = out.unionByName(level.filter("name is not null").select("key", F.concat(F.lit("~"), "path").alias("path"), F.col("name").alias("text")))
        level = level.drop("name")


# The keywords and types of a parameter schema.
SCHEMA_KEYWORDS = ("type", "description", "properties", "required", "items", "enum", "additionalProperties")
SCHEMA_TYPES = ("object", "array", "string", "number", "integer", "boolean", "null")
SCHEMA_DEPTH = 64


def schema_problem(j: Column) -> Column:
    """What is wrong with one node of a parameter schema, a JSON text, but for its inner schemas;
    null if nothing is."""
    v, keys = F.try_parse_json(j), F.json_object_keys(j)
    has = lambda k: F.array_contains(keys, k)
    is_ = lambda k, kind: F.coalesce(_kind(v, f"$.{k}"), F.lit("")).startswith(kind)
    kind = F.try_variant_get(v, "$.type", "string")
    required = F.try_variant_get(v, "$.required", "array<variant>")
    names = F.transform(required, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.variant_get(x, "$", "string")))
    declared = F.coalesce(F.json_object_keys(F.get_json_object(j, "$.properties")), F.array().cast("array<string>"))
    distinct = (F.size(F.array_distinct(F.array_compact(names))) == F.size(names)) & (F.size(F.array_except(names, declared)) == 0)
    members = F.try_variant_get(v, "$.enum", "array<variant>")
    annotation = (has("description") & ~is_("description", "STRING")) | (has("additionalProperties") & ((kind != "object") | ~is_("additionalProperties", "BOOLEAN"))) | (has("enum") & (~is_("enum", "ARRAY") | (F.size(members) == 0)))
    return (
        F.when(v.isNull() | keys.isNull(), "not_an_object")
        .when(F.size(F.array_except(keys, F.array(*(F.lit(k) for k in SCHEMA_KEYWORDS)))) > 0, "keyword")
        .when(~is_("type", "STRING") | ~kind.isin(*SCHEMA_TYPES), "type")
        .when(annotation, "annotation")
        .when(has("properties") & ((kind != "object") | ~is_("properties", "OBJECT")), "properties")
        .when(has("required") & ((kind != "object") | ~is_("required", "ARRAY") | ~F.coalesce(distinct, F.lit(False))), "required")
        .when(has("items") & (kind != "array"), "items")
    )


def schema_problems(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, problem) of every wrong node of the parameter schemas in a column of JSON texts.
    Goes down level by level, as deep as the schemas do, and no deeper than is allowed; each level
    is written to the shared folder, so that plans stay short."""
    spark = rows.sparkSession
    level = rows.select(F.col(key).alias("key"), F.lit("$").alias("path"), F.col(column).alias("j"))
    out = None
    for depth in range(SCHEMA_DEPTH + 2):
        problem = F.lit("depth") if depth > SCHEMA_DEPTH else schema_problem(F.col("j"))
        found = level.select("key", "path", problem.alias("problem")).filter("problem is not null")
        out = found if out is None else out.unionByName(found)
        nested = level.select("key", "path", F.try_parse_json("j").alias("v"))
        nested = nested.filter(F.try_variant_get("v", "$.properties", "variant").isNotNull() | F.try_variant_get("v", "$.items", "variant").isNotNull())
        if depth > SCHEMA_DEPTH or nested.isEmpty():
            break
        nested.createOrReplaceTempView("nested_schema")
        properties = spark.sql("select n.key, concat(n.path, '.', e.key) as path, to_json(e.value) as j from nested_schema n, lateral variant_explode(try_variant_get(n.v, '$.properties', 'variant')) e where e.key is not null")
        items = nested.select("key", F.concat("path", F.lit("[]")).alias("path"), F.to_json(F.try_variant_get("v", "$.items", "variant")).alias("j")).filter("j is not null")
        level = cut(properties.unionByName(items))
    return out.withColumnRenamed("key", key)
