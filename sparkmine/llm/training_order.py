"""Operator 4: training-order materialisation as fixed-stride binary shards.

Every text becomes sequences of ``LENGTH`` token ids (the last one padded with 0;
a text without tokens has none).  With a tokenizer the ids are those of its
byte-level BPE, and the records decode to the texts; without one they are hashed
words, which no vocabulary decodes.  The texts are tokenised once, into a table in
``spark.checkpoint.dir`` that stores each row's partition and first sequence.  One
count per partition and a prefix scan over those counts number the sequences; both
come from the written table, never from a second scan.  A keyed Feistel
permutation of the next even power of two, walked along its cycle until it falls
below the number of sequences, maps the number to a global slot: a bijection that
needs no table and can be inverted.  Shard s holds the slots from s * SHARD_SLOTS:
range partitions whose bounds are known, since slots are dense.  One task sorts a
shard's records by slot and writes it as one flat file, so slot t lies at byte
(t mod SHARD_SLOTS) * stride and reading can resume anywhere.  The shards are
written in RANGES ranges, one after the other, whose shuffle files go with each;
the token table goes after the last.

Record: doc_id (int64), number within the document (int32), tokens used (int32),
the token ids (uint16) and a two-byte record end.

Defined cases: null and empty texts have no sequence, nor have blank ones without a
tokenizer; a null doc_id is written as -1; repeated rows get sequences of their own;
other columns, of any name, are not read; an empty table writes no record.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm import tokenfiles as TF
from sparkmine.llm.common import documents
from sparkmine.session import cut_lineage, ensure_checkpoint_dir, table_scope

LENGTH = 512
SHARD_SLOTS = 8192
VOCABULARY = 65_535
KEY = 20240607
ROUNDS = 6
#: Ranges of shards that are written one after the other.
RANGES = 4
#: Spark's setting that removes a query's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RECORD_END = b"\xff\xff"


def record_type(length: int = LENGTH) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("seq", "<i4"), ("n", "<i4"), ("tokens", "<u2", (length,)), ("end", "S2")])


def _half_bits(n: int) -> int:
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def _round(half: np.ndarray, r: int, key: int, mask) -> np.ndarray:
    return K.mix(half + K.U64((key * 1_000_003 + r) * 0x9E3779B97F4A7C15 & (1 << 64) - 1), 50 + r) & mask


def _feistel(x: np.ndarray, bits: int, key: int, order: range) -> np.ndarray:
    """The rounds in ``order``: forwards, or backwards for the inverse."""
    mask = K.U64((1 << bits) - 1)
    left, right = x >> K.U64(bits), x & mask
    for r in order:
        if order.step > 0:
            left, right = right, left ^ _round(right, r, key, mask)
        else:
            left, right = right ^ _round(left, r, key, mask), left
    return (left << K.U64(bits)) | right


def _walk(index: np.ndarray, n: int, key: int, order) -> np.ndarray:
    bits = _half_bits(n)
    out = _feistel(index.astype(np.uint64), bits, key, order)
    while True:
        beyond = out >= K.U64(n)
        if not beyond.any():
            return out.astype(np.int64)
        out[beyond] = _feistel(out[beyond], bits, key, order)


def slot_of(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Global slots of sequence numbers below ``n``."""
    return _walk(index, n, key, range(0, ROUNDS, 1))


def index_of(slot: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The inverse of ``slot_of``."""
    return _walk(slot, n, key, range(ROUNDS - 1, -1, -1))


def _tokenised(length: int, tokenizer: str | None):
    """(part, first, pieces, doc_id, tokens) of every text that has tokens;
    ``first``: sequences of the partition before it."""

    def run(batches):
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(at, 512)
                tokens = list(TF.word_ids(texts, VOCABULARY) if tokenizer is None else TF.bpe_ids(texts, tokenizer))
                pieces = np.array([-(-len(t) // length) for t in tokens], np.int64)
                if max(map(len, tokens)) and max(int(t.max()) for t in tokens if len(t)) > 65_535:
                    raise ValueError("token ids above 65,535 do not fit the records")
                some = np.flatnonzero(pieces)
                before = first + np.cumsum(pieces) - pieces
                first += int(pieces.sum())
                body = pa.array([tokens[i].astype("<u2").tobytes() for i in some], pa.binary())
                cols = (np.full(len(some), part, np.int64), before[some], pieces[some], ids[at : at + len(tokens)][some])
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), body], ["part", "first", "pieces", "doc_id", "tokens"])

    return run


def _records(start: dict[int, int], total: int, length: int, shard_slots: int, key: int, low: int, high: int):
    """The records of the shards low .. high - 1."""
    kind = record_type(length)

    def run(batches):
        for batch in batches:
            part, before, pieces, ids = (batch.column(j).to_numpy(zero_copy_only=False) for j in range(4))
            at, body = TF.flat_values(batch.column(4), "<u2")
            number = np.array([start[x] for x in part.tolist()], np.int64) + before
            for lo in range(0, len(ids), 512):
                some = slice(lo, lo + 512)
                doc = np.repeat(np.arange(len(ids))[some], pieces[some])
                seq = np.arange(len(doc)) - np.repeat(np.cumsum(pieces[some]) - pieces[some], pieces[some])
                slot = slot_of(number[doc] + seq, total, key)
                here = np.flatnonzero((slot >= low * shard_slots) & (slot < high * shard_slots))
                for cut in range(0, len(here), 2048):
                    own = here[cut : cut + 2048]
                    first = at[doc[own]] + seq[own] * length
                    out = np.zeros(len(own), kind)
                    out["doc_id"], out["seq"] = ids[doc[own]], seq[own]
                    out["n"] = np.minimum(length, at[doc[own] + 1] - first)
                    place = np.arange(length)
                    used = place < out["n"][:, None]
                    out["tokens"][used] = body[(first[:, None] + place)[used]]
                    raw = np.ascontiguousarray(out.view(np.uint8).reshape(len(own), kind.itemsize)[:, : -len(RECORD_END)])
                    ends = np.arange(len(own) + 1, dtype=np.int32) * raw.shape[1]
                    value = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays([pa.array(slot[own] // shard_slots), pa.array(slot[own]), value], ["shard", "slot", "value"])

    return run


def _write_ranges(held: DataFrame, path: str, start: dict[int, int], total: int, length: int, shard_slots: int, key: int, ranges: int) -> None:
    """Write the shards, one range of them after the other: only that range's
    records are in a shuffle at a time."""
    spark = held.sparkSession
    shards = max(1, -(-total // shard_slots))
    ranges = max(1, min(ranges, shards))
    bounds = [r * shards // ranges for r in range(ranges + 1)]
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        for low, high in zip(bounds, bounds[1:]):
            rows = held.mapInArrow(_records(start, max(1, total), length, shard_slots, key, low, high), "shard long, slot long, value binary")
            # slots are dense, so the ranges of equal size are known: one per shard
            dealt = rows.repartitionById(high - low, (F.col("shard") - F.lit(low)).cast("int"))
            TF.write_flat(dealt.sortWithinPartitions("shard", "slot").select("shard", "value"), path, RECORD_END, partition_by="shard", mode="append")
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def write_training_order(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = KEY, tokenizer: str | None = None, ranges: int = RANGES) -> int:
    """Write the shards under ``path``, a new folder, as ``shard=<s>/part-*``; the
    number of sequences.  ``tokenizer``: ranks file of a BPE, or None for hashed
    words.  ``ranges``: how many ranges of shards are written one after the other;
    each reads the token table once, and the table goes after the last."""
    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise FileExistsError(path)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with table_scope(spark):
        held = cut_lineage(src.mapInArrow(_tokenised(length, tokenizer), "part long, first long, pieces long, doc_id long, tokens binary"), compression="zstd")
        # one row per input partition
        parts = held.groupBy("part").agg(F.sum("pieces").alias("n"), F.max(F.col("first") + F.col("pieces")).alias("end")).collect()
        start, total = {}, 0
        for r in sorted(parts, key=lambda r: r["part"]):
            if r["n"] != r["end"]:
                raise RuntimeError(f"partition {r['part']} holds {r['n']} sequences and numbers {r['end']}")
            start[r["part"]] = total
            total += r["n"]
        _write_ranges(held, path, start, total, length, shard_slots, key, ranges)
    return total


def read_training_order(spark: SparkSession, path: str, length: int = LENGTH, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(slot, shard, position, doc_id, seq, n_tokens, tokens_sha256) of every
    record, as its place in the flat files says."""
    kind = record_type(length)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = int(batch.column(0)[i].as_py())
                data = batch.column(1)[i].as_buffer()
                for lo in range(0, len(data) // kind.itemsize, 4096):
                    rec = np.frombuffer(data, kind, min(4096, len(data) // kind.itemsize - lo), lo * kind.itemsize)
                    place = lo + np.arange(len(rec))
                    sha = [hashlib.sha256(t[:n].tobytes()).hexdigest() for t, n in zip(rec["tokens"], rec["n"])]
                    cols = (shard * shard_slots + place, np.full(len(rec), shard), place, rec["doc_id"].astype(np.int64), rec["seq"].astype(np.int64), rec["n"].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in cols), pa.array(sha)], ["slot", "shard", "position", "doc_id", "seq", "n_tokens", "tokens_sha256"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    named = files.select(F.regexp_extract("path", r"shard=(\d+)/", 1).cast("long").alias("shard"), "content")
    return named.mapInArrow(run, "slot long, shard long, position long, doc_id long, seq long, n_tokens long, tokens_sha256 string")


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over every whole text of ``documents``: the records as read
    back from the written shards."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/training-order/{uuid.uuid4().hex}"
    write_training_order(documents(spark, sf_dir), path, tokenizer=TF.TOKENIZER)
    return read_training_order(spark, path)
