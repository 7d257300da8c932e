"""Secret scans over an incremental blob ledger.

Every text version is content-addressed (SHA-256). The ledger has a row for each (blob, rule
version) pair that was ever scanned, findings or not; a scan takes only pairs that the ledger
lacks, each once, and joins the findings back to all rows that hold the blob.

Null text: the empty text. Empty tables: no rows. Repeated rows and exact copies: scanned once,
a result for each row. Very long texts are scanned whole. Ties of spans go by the order of KINDS.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.llm.common import cut, texts

RULE_VERSION = "rules-1.1"

# The patterns of the base kinds (assign, access, hex) and of the added ones.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
# A key reaches to its END line or, without one, over the headers and base64 lines that follow.
_PEM = re.compile(
    r"""-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----(?:(?:(?!-----BEGIN\x20).)*?-----END\x20[A-Z\x20]*PRIVATE\x20KEY-----
    |(?:(?:\s|\\[nr])+[A-Za-z-]+:\x20[^\n\\]*)*(?:(?:\s|\\[nr])+[A-Za-z0-9+/]{16,}={0,2})+(?:[ \t\r]*\n[ \t]*[A-Za-z0-9+/]+={0,2}[ \t\r]*(?=\n|\Z))?)?""",
    re.S | re.X,
)
_DOTTED = re.compile(r"[A-Za-z0-9_.-]+")
_GIT = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt", "git")


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then by the order of KINDS. Each kind's
    matches are leftmost and don't overlap; those that are too short are dropped afterwards."""
    out = []
    lower = text.lower()
    if any(x in lower for x in ("passw", "secret", "token", "key")):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        out += [(m.start(), m.end(), "pem") for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [(a, b, "jwt") for a, b in _web_tokens(text)]
    if "gh" in text:
        out += [(m.start(), m.end(), "git") for m in _GIT.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def _web_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Three parts joined by dots, of which the first two begin with eyJ; every run of parts is read once."""
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".") if "eyJ" in m[0] else []
        at = [m.start()]
        for x in parts:
            at.append(at[-1] + len(x) + 1)
        i = 0
        while i + 2 < len(parts):
            j = parts[i].find("eyJ")
            if j >= 0 and len(parts[i]) - j >= 11 and parts[i + 1].startswith("eyJ") and len(parts[i + 1]) >= 11 and len(parts[i + 2]) >= 8:
                yield at[i] + j, at[i + 3] - 1
                i += 3
            else:
                i += 1


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: str) -> str:
    """text with every span of the joined list put out; overlapping spans go as one."""
    out, at = [], 0
    for start, end in sorted((int(a), int(b)) for _, a, b in (x.split(":") for x in spans.split(",") if x)):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = end
    return "".join([*out, text[at:]])


_LEDGER = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _first(batch: pa.RecordBatch, seen: set[str]) -> pa.RecordBatch:
    """The rows whose blob isn't in seen, each blob once; adds them to it."""
    keep = []
    for i, blob in enumerate(batch.column("blob").to_pylist()):
        if blob not in seen:
            seen.add(blob)
            keep.append(i)
    return batch.take(pa.array(keep, pa.int32()))


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each blob once per task, before it is moved."""
    seen: set[str] = set()
    for batch in batches:
        yield _first(batch, seen)


def _scan(rule_version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            fresh, rows = _first(batch, seen), []
            for blob, text in zip(fresh.column("blob").to_pylist(), fresh.column("text"), strict=True):
                spans = find_spans(text.as_py())
                base = [x for x in spans if x[2] in BASE_KINDS]
                n = [sum(x[2] == k for x in base) for k in BASE_KINDS]
                rows.append((blob, rule_version, *n, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _TYPES, strict=True)], _NAMES)

    return run


_NAMES = [x.split()[0] for x in _LEDGER.split(", ")]
_TYPES = [pa.int64() if x.endswith("long") else pa.string() for x in _LEDGER.split(", ")]


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """New rows of the ledger: one for each blob of docs that has none under rule_version."""
    blobs = texts(docs).select(F.sha2("text", 256).alias("blob"), "text").mapInArrow(_first_of_each, "blob string, text string")
    blobs = blobs.repartition("blob")  # texts are moved once: a join by blob takes them as they lie
    if ledger is not None:
        blobs = blobs.join(ledger.filter(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    return blobs.mapInArrow(_scan(rule_version), _LEDGER)


def findings(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """doc_id and the ledger's columns for each row of docs; the ledger must cover docs."""
    paths = texts(docs).select("doc_id", F.sha2("text", 256).alias("blob"))
    return paths.join(ledger, "blob").drop("blob")


def scan(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """doc_id, rule_version, n_assign, n_access, n_hex, base_sha256, spans: a row for each row
    of docs. With a ledger, what it covers isn't scanned again."""
    rows = scan_unseen(docs, ledger, rule_version)
    if ledger is not None:
        rows = rows.unionByName(ledger.filter(F.col("rule_version") == rule_version).select(_NAMES))
    return findings(docs, rows)


def add(docs: DataFrame, path: str, rule_version: str = RULE_VERSION) -> None:
    """Scans what the ledger in the table at path (a shared folder) lacks of docs, and adds it. An
    interrupted run adds nothing or all of its rows; a later one takes up from there."""
    spark = docs.sparkSession
    schema = scan_unseen(docs.limit(0)).schema
    if not _there(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    scan_unseen(docs, spark.read.schema(schema).parquet(path), rule_version).write.mode("append").parquet(path)


def _kept(docs: DataFrame, path: str, rule_version: str) -> DataFrame:
    ledger = docs.sparkSession.read.schema(scan_unseen(docs.limit(0)).schema).parquet(path)
    return ledger.filter(F.col("rule_version") == rule_version).dropDuplicates(["blob"])


def update(docs: DataFrame, path: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """As scan, with the ledger kept in the table at path."""
    add(docs, path, rule_version)
    return findings(docs, _kept(docs, path, rule_version))


def scan_history(batches: list[DataFrame], path: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """As scan, of all rows of the batches, which are versions of a corpus in the order in which they came: each
    scans only the blobs that the ledger at path lacks by then. The ledger is read when all have been: two reads of
    one path with other files would be taken for the same by Spark within one plan."""
    for batch in batches:
        add(batch, path, rule_version)
    docs = reduce(DataFrame.unionByName, (texts(b) for b in batches))
    return findings(docs, _kept(docs, path, rule_version))


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def put_out(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """docs, all rows and columns, with "[secret]" in place of every span in text, and n_chars
    (where there is such a column) of the new text. Texts without findings stay as they are."""
    rows = scan_unseen(docs, ledger, rule_version)
    if ledger is not None:
        rows = rows.unionByName(ledger.filter(F.col("rule_version") == rule_version).select(_NAMES))
    spans = cut(rows.filter("spans != ''").select("blob", "spans"))

    def run(text: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([redact(t.as_py(), s.as_py()) if s.is_valid else t.as_py() for t, s in zip(text, spans, strict=True)], pa.string())

    run.__annotations__ = {"text": pa.Array, "spans": pa.Array, "return": pa.Array}
    packed = docs.select(F.struct("*").alias("row"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    # one plan at every size: a small table of findings would be broadcast, a large one not
    found = packed.join(spans.hint("merge"), "blob", "left").withColumn("new", F.arrow_udf(run, "string")("row.text", "spans"))
    columns = []
    for name in docs.columns:
        old = F.col("row").getField(name)
        if name == "text":
            old = F.col("new")
        elif name == "n_chars":
            old = F.when(F.col("spans").isNull(), old).otherwise(F.length("new").cast(docs.schema[name].dataType))
        columns.append(old.alias(name))
    return found.select(*columns)
