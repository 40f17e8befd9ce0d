"""Flat token files, written and read through Spark.

A file holds nothing but little-endian unsigned token ids.  Writing uses the text
sink: a document's tokens are one "line" and the separator's bytes are the line
end, so any file system and Spark's commit protocol work.  Reading uses the
``binaryFile`` source.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmine.llm import textkernel as K

#: A public byte-level BPE as ranks (a parameter everywhere; never copied).
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the id that ends a document in that vocabulary's public use.
END_OF_DOCUMENT = 50256
# Fixed value: the public pre-tokenisation pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DTYPES = {"uint16": np.uint16, "uint32": np.uint32}

_loaded: dict = {}


def bpe(path: str = TOKENIZER):
    """The tokenizer of a ranks file; loaded once per Python worker."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def bpe_ids(texts: pa.Array, path: str = TOKENIZER):
    """Token ids of each text (null: none)."""
    encode = bpe(path).encode_ordinary
    for i in range(len(texts)):
        yield np.array(encode(texts[i].as_py() or ""), dtype=np.uint32)


def word_ids(texts: pa.Array, vocabulary: int):
    """Hashed word ids 1 .. vocabulary - 1 of each text (null: none); 0 stays free."""
    for chunk in K.chunks(texts):
        h, doc = chunk.words()
        ids = (h % K.U64(vocabulary - 1) + K.U64(1)).astype(np.uint32)
        yield from np.split(ids, np.cumsum(chunk.counts(doc))[:-1])


def flat_values(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(first element of every value and the end of the last, all elements) of a
    binary column without nulls, as views of its buffers."""
    wide = pa.types.is_large_binary(column.type)
    size = np.dtype(dtype).itemsize
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(dtype) if data is not None else np.zeros(0, dtype)
    return (ends - ends[0]) // size, body


def write_flat(records: DataFrame, path: str, end: bytes, partition_by: str | list[str] | None = None, most_records: int = 0, mode: str = "errorifexists") -> None:
    """Write a binary column ``value``: each record's bytes and then ``end``."""
    out = records.withColumn("value", records["value"].cast("string")).write.mode(mode)
    if partition_by:
        out = out.partitionBy(partition_by)
    # latin-1 maps the separator's bytes one to one
    out.option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1")).option("maxRecordsPerFile", most_records).text(path)
