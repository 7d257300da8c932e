"""What the operators of this subpackage share: table access, the shared folder, batches."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see. The session names it in spark.checkpoint.dir; only
    where that is unset (tests, one machine) a temporary folder stands in.
    On a cluster an unset one is an error: executors wouldn't see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
    return path or f"file://{_own_folder()}"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def cut(df: DataFrame, batch: int | None = None) -> DataFrame:
    """df written to the shared folder and read back: its lineage ends there and survives
    the loss of any executor. batch: rows of an Arrow batch, for this write only, where rows are long."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    try:
        if batch is not None:
            spark.conf.set(_BATCH, str(min(batch, int(before)) if int(before) > 0 else batch))
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def bucket(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id long, text string): nothing else of the table is carried, so that extra columns
    can't clash. A null text is the empty text."""
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def slices(column: pa.Array, max_chars: int):
    """(from, to) row ranges of a string column holding about max_chars bytes each; a single
    longer text is a range of its own."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_chars:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def trim() -> None:
    """Gives freed memory back to the system: Python workers live on between stages, and what the
    allocators keep for them counts against the executor."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBRARY, "malloc_trim"):
        _LIBRARY.malloc_trim(0)


_LIBRARY = ctypes.CDLL(None)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit words, as uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column in one array, and the n + 1 offsets into it."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Marks the bytes that separate words: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

#: The odd multiplier of byte hashes.
_MULTIPLIER = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 2^bits + 1 of each."""
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        x = np.full((1 << bits) + 1, base, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x))
    return out[0], out[1]


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (maximal run without separators; texts are word borders),
    and the n + 1 word offsets of the texts."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~separators[data]
    inner = offsets[1:-1]
    starts = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]
    inner = inner[(inner > 0) & (inner < len(data))]
    starts[inner] = solid[1:-1][inner]
    ends[inner - 1] = solid[1:-1][inner - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of codes (uint64), by prefix sums of a polynomial over all of
    them: sum of code * m^i, divided by m^start (m is odd, so it has an inverse)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        powers, inverse = _powers(max(21, int(len(codes)).bit_length()))
        prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(powers[: len(codes)] * codes, out=prefix[1:])
        return mix64((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    return run_hashes(_BYTE_CODES[data], starts, ends)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive offsets; 0 where there are none."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals U+00C0 to U+00DE (but for U+00D7) in lower case."""
    out = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    if len(data) > 1:
        wide = np.zeros(len(data), bool)
        wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[wide] += 32
    return out


#: Separates runs of letters: every ASCII byte that isn't one.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
