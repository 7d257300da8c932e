"""Byte-level BPE over Arrow batches with the tokenizers library, and its exact inverse.

Texts are cut into the matches of the public pattern; each distinct chunk of matches is encoded
once per worker (a bounded memo), and ids are put together per text. A token is a string in which every
byte stands for itself through the byte-to-character table; decoding reverses that table, joins
the bytes of all tokens and only then reads UTF-8, so characters split over tokens come back whole.

Null text: the empty text, no ids. Empty tables: no rows. Repeated rows: a result for each.
Other columns of the input are ignored by `encode` and kept by `with_ids`.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import texts, trim

#: Distinct chunks that a worker remembers, and the longest that it remembers, in characters.
MEMO, LONGEST = 250_000, 48

#: White space and what follows it up to the next white space. Where a text has no other white
#: space than these four characters, no match of the pattern crosses a border of such chunks.
_CHUNK = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: Everything that any engine may take for white space, besides those four.
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


def byte_characters() -> dict[int, str]:
    """The byte-to-character table of byte-level BPE: printable Latin-1 bytes stand for
    themselves, the rest, in order, for the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memo(dict):
    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, chunk: str) -> str:
        out = self.make(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = out
        return out


class Codec:
    """vocabulary: a tokenizers JSON file; pattern: what the texts are cut by."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 0xD800:
            raise ValueError("ids are kept as code points: a vocabulary has 55,296 entries at most")
        self.find = regex.compile(pattern).findall
        self.pieces = self.tokenizer.model.tokenize
        self.characters = byte_characters()
        back = {c: b for b, c in self.characters.items()}
        size = self.tokenizer.get_vocab_size()
        named = (self.tokenizer.id_to_token(i) for i in range(size))
        self.bytes_of = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in named]
        self.decimal = [str(i) for i in range(size)]
        self.memo = Memo(self._encode_chunk)

    def _encode_chunk(self, chunk: str) -> str:
        """Each match of the pattern in byte characters, through the library's merges."""
        if chunk.isascii() and chunk[:1] == " " and chunk[1:].isalpha():  # one match, most often
            return "".join([chr(t.id) for t in self.pieces(self.characters[32] + chunk[1:])])
        mapped = [m.encode().decode("latin-1").translate(self.characters) for m in self.find(chunk)]
        return "".join([chr(t.id) for m in mapped for t in self.pieces(m)])

    def encode_packed(self, text: str) -> str:
        """The ids as the code points of a string, which is far smaller than a list."""
        if _OTHER_SPACE.search(text):
            return self._encode_chunk(text)
        memo = self.memo
        if len(memo) > MEMO:  # the older half goes
            for x in list(islice(memo, MEMO // 2)):
                del memo[x]
        return "".join([memo[x] for x in _CHUNK.findall(text)])

    def encode(self, text: str) -> list[int]:
        return list(map(ord, self.encode_packed(text)))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """The characters of text that each token covers, end exclusive; tokens that share the
        bytes of one character all cover it."""
        first = [i for i, c in enumerate(text) for _ in range(len(c.encode()))]
        out, at = [], 0
        for i in ids:
            n = len(self.bytes_of[i])
            out.append((first[at], first[at + n - 1] + 1) if n else (0, 0))
            at += n
        return out


@functools.lru_cache(maxsize=2)
def codec(vocabulary: str, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def digest_batches(vocabulary: str, pattern: str):
    """For mapInArrow: (doc_id, text) to ids' and decoded bytes' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary, pattern)
        for batch in batches:
            n, encoded, decoded = [], [], []
            for text in batch.column("text"):
                ids = c.encode(text.as_py())
                n.append(len(ids))
                encoded.append(hashlib.sha256(" ".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(c.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a row for each row of docs."""
    return texts(docs).mapInArrow(digest_batches(vocabulary, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def with_ids(docs: DataFrame, vocabulary: str, pattern: str, ids_column: str = "token_ids") -> DataFrame:
    """docs with the ids of its text, and all its columns (one named as the new one is replaced)."""

    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocabulary, pattern)
        for texts_ in column:
            packed = [np.frombuffer(c.encode_packed(x.as_py() or "").encode("utf-16-le"), np.uint16) for x in texts_]
            at = np.r_[0, np.cumsum([len(x) for x in packed], dtype=np.int64)]
            flat = np.concatenate([np.empty(0, np.uint16), *packed]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
            del packed, flat
            trim()

    run.__annotations__ = {"column": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(ids_column, F.arrow_udf(run, "array<int>")(F.col("text")))


def decoded(docs: DataFrame, vocabulary: str, pattern: str, ids_column: str = "token_ids", text_column: str = "decoded") -> DataFrame:
    """docs with the text that the ids stand for."""

    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocabulary, pattern)
        for ids in column:
            yield pa.array([c.decode(x.as_py() or []) for x in ids], pa.string())

    run.__annotations__ = {"column": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(text_column, F.arrow_udf(run, "string")(F.col(ids_column)))
