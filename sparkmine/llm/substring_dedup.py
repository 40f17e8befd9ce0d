"""Operator 3: substring dedup by repeated windows of ``k`` words.

Every word position that has ``k`` words left in its document starts a suffix, of
which only the first ``k`` words are kept, as a 64-bit hash (its path).  This stands
in for suffix trees: there is no suffix order beyond ``k`` words and no maximal
repeat; a longer shared passage is the union of its windows.

1. *Prefixes.* One pass counts the suffixes under hashed prefixes of 1, 2, 4 and
   ``k`` words.  A suffix belongs to the shortest prefix whose count fits
   ``max_group``, so groups have variable-length prefixes and fit in memory.
2. *Partition.* Suffixes travel packed: one row per (chunk of texts, group) with
   the documents, their suffix counts and the path hashes (about 10 bytes each).
   A prefix of full depth that is still too large is one hot passage: it is
   pre-aggregated to its smallest document per path, its suffixes are salted by
   document over several groups, and every salt gets the small pre-aggregate.
3. *Trees.* Each group sorts its paths; runs of equal paths are the nodes at
   depth ``k``, the deep internal ones have several leaves, and each carries the
   smallest doc_id below it.  Leaves of larger doc_ids are repeats.
4. *Removal.* Repeated paths go back to their document, whose windows are marked
   and whose covered words are left out.

Defined cases: null or blank text: no words, nothing removed, the hash of the
empty string; fewer than ``k`` words: nothing removed; rows that share a doc_id
are one document (neither removes words of the other); a null doc_id counts as
larger than all others.  Two different windows are taken as equal only if their
64-bit path hashes *and* their prefix groups agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm.common import cut_lineage, documents, text_bytes

WINDOW = 13
#: Suffixes of one group (about 16 bytes each while its tree is built).
MAX_GROUP = 2_000_000
#: Assumed bytes per word when the number of hashed prefixes is chosen from the size of the texts.
BYTES_PER_WORD = 6
NO_ID = np.iinfo(np.int64).max
_PACKED = "grp long, salt int, docs binary, counts binary, paths binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_KEPT = "doc_id long, n_words long, kept string, spans array<array<long>>"


def _depths(k: int) -> list[int]:
    return [d for d in (1, 2, 4) if d < k] + [k]


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def _suffixes(chunk: K.Chunk, k: int, bins: int):
    """For every window: its text index, and per depth the hash of its prefix."""
    h, doc = chunk.words()
    at, full = K.windows(h, doc, k)
    prefix = []
    for d in _depths(k)[:-1]:
        acc = np.zeros(len(h), dtype=np.uint64)
        for j in range(d):
            acc[: max(0, len(h) - j)] += h[j:] * K._COEF[32 + j]
        prefix.append(K.mix(acc[at], 40 + d) % K.U64(bins))
    return doc[at], full, [*prefix, K.mix(full, 77) % K.U64(bins)]


def _count_prefixes(k: int, bins: int):
    def run(batches):
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                _, _, prefix = _suffixes(chunk, k, bins)
                for depth, p in enumerate(prefix):
                    b, n = np.unique(p, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), depth, np.int32)), pa.array(b.astype(np.int64)), pa.array(n.astype(np.int64))], ["depth", "bin", "n"])

    return run


def _group_of(prefix: list[np.ndarray], heavy: list[np.ndarray], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, whether it is a hot passage): the shortest prefix that is not heavy."""
    group = prefix[-1].astype(np.int64) + (len(prefix) - 1) * bins
    hot = np.isin(prefix[-1], heavy[-1]) if len(heavy[-1]) else np.zeros(len(group), dtype=bool)
    for depth in range(len(prefix) - 2, -1, -1):
        light = ~np.isin(prefix[depth], heavy[depth])
        group[light] = prefix[depth][light].astype(np.int64) + depth * bins
        hot &= ~light
    return group, hot


def _packed(key: np.ndarray, salt: np.ndarray, doc: np.ndarray, ids: np.ndarray, paths: np.ndarray):
    """One row per (key, salt): documents, their counts, their path hashes."""
    _, label = np.unique(key * 4096 + salt, return_inverse=True)
    if len(label) and label.max() < 65536:
        label = label.astype(np.uint16)  # radix sort
    order = np.argsort(label, kind="stable")
    label, doc = label[order], doc[order]
    cut = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
    run = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (doc[1:] != doc[:-1]))))
    size = np.diff(np.append(run, len(doc))).astype(np.int32)
    at = np.append(np.searchsorted(run, cut), len(run))
    owner, body, ends = ids[doc[run]], paths[order], np.append(cut, len(doc))
    rows = [(owner[at[i] : at[i + 1]].tobytes(), size[at[i] : at[i + 1]].tobytes(), body[ends[i] : ends[i + 1]].tobytes()) for i in range(len(cut))]
    first = order[cut]
    return pa.RecordBatch.from_arrays(
        [pa.array(key[first]), pa.array(salt[first].astype(np.int32)), *(pa.array([r[j] for r in rows], pa.binary()) for j in range(3))],
        ["grp", "salt", "docs", "counts", "paths"],
    )


def _partition(k: int, bins: int, heavy: list[np.ndarray], salts: int):
    def run(batches):
        for batch in batches:
            ids = _ids(batch)
            for chunk in K.chunks(batch.column(1)):
                doc, full, prefix = _suffixes(chunk, k, bins)
                if len(doc):
                    key, hot = _group_of(prefix, heavy, bins)
                    own = ids[chunk.lo : chunk.hi]
                    salt = np.where(hot, (K.mix(own.view(np.uint64), 9) % K.U64(salts)).astype(np.int64)[doc], 0)
                    yield _packed(key, salt, doc, own, full)

    return run


def _hot_minima(k: int, bins: int, heavy: list[np.ndarray]):
    """Smallest doc_id per path of the hot passages of each chunk."""

    def run(batches):
        for batch in batches:
            ids = _ids(batch)
            for chunk in K.chunks(batch.column(1)):
                doc, full, prefix = _suffixes(chunk, k, bins)
                key, hot = _group_of(prefix, heavy, bins)
                if hot.any():
                    key, path, own = key[hot], full[hot], ids[chunk.lo : chunk.hi][doc[hot]]
                    order = np.lexsort((own, path))
                    path, own, key = path[order], own[order], key[order]
                    first = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1])))
                    yield pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(path[first].view(np.int64)), pa.array(own[first])], ["grp", "path", "doc"])

    return run


def _pack_minima(batches):
    for batch in batches:
        key, path, own, salt = (batch.column(j).to_numpy(zero_copy_only=False) for j in range(4))
        n = len(key)
        if n:
            yield _packed(key, salt.astype(np.int64), np.arange(n), own, path.view(np.uint64))


def _trees(rows: pd.DataFrame) -> pd.DataFrame:
    """Deep internal nodes of one group: the leaves that also start in a
    document with a smaller id, one row each."""
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in rows["docs"]])
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in rows["counts"]])
    paths = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["paths"]])
    order = np.argsort(paths)
    paths = paths[order]
    leaf = np.repeat(docs, counts)[order]
    del order
    node = np.flatnonzero(np.concatenate(([True], paths[1:] != paths[:-1])))
    smallest = np.minimum.reduceat(leaf, node)
    repeat = leaf > np.repeat(smallest, np.diff(np.append(node, len(leaf))))
    return pd.DataFrame({"doc_id": leaf[repeat], "path": paths[repeat].view(np.int64)})


def _remove(k: int, texts_too: bool = False):
    def run(batches):
        for batch in batches:
            texts, repeats, given = batch.column(1), batch.column(2), batch.column(0)
            total, removed, digest, kept, spans = [], [], [], [], []
            for chunk in K.chunks(texts):
                some = [repeats[i].values.to_numpy().view(np.uint64) if repeats[i].is_valid else None for i in range(chunk.lo, chunk.hi)]
                at = full = None
                if any(x is not None for x in some):
                    h, doc = chunk.words()
                    at, full = K.windows(h, doc, k)
                    first = np.searchsorted(doc, np.arange(chunk.hi - chunk.lo + 1))
                    wfirst = np.searchsorted(at, first)
                raw = chunk.buf.tobytes()
                for i in range(chunk.hi - chunk.lo):
                    w = raw[chunk.offsets[i] : chunk.offsets[i + 1]].split()
                    gone, cuts = 0, []
                    if some[i] is not None:
                        hit = at[wfirst[i] : wfirst[i + 1]][np.isin(full[wfirst[i] : wfirst[i + 1]], some[i])] - first[i]
                        step = np.zeros(len(w) + 1, dtype=np.int64)
                        np.add.at(step, hit, 1)
                        np.add.at(step, hit + k, -1)
                        keep = np.cumsum(step[:-1]) == 0
                        gone = len(w) - int(keep.sum())
                        w_kept = [x for x, y in zip(w, keep.tolist()) if y]
                        cuts = np.flatnonzero(np.diff(np.concatenate(([True], keep, [True])).astype(np.int8))).reshape(-1, 2).tolist()
                    else:
                        w_kept = w
                    total.append(len(w))
                    removed.append(gone)
                    left = b" ".join(w_kept)
                    if texts_too:
                        kept.append(left.decode())
                        spans.append(cuts)
                    else:
                        digest.append(hashlib.sha256(left).hexdigest())
            if texts_too:
                yield pa.RecordBatch.from_arrays([given, pa.array(total, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["doc_id", "n_words", "kept", "spans"])
                continue
            yield pa.RecordBatch.from_arrays([given, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def repeated_paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, path): the hash of every ``k``-word window that also starts in a
    document with a smaller id."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = text_bytes(src) // BYTES_PER_WORD
    bins = 1 << max(2, (total // max_group).bit_length())
    counted = src.mapInArrow(_count_prefixes(k, bins), "depth int, bin long, n long").groupBy("depth", "bin").agg(F.sum("n").alias("n"))
    # at most total / max_group bins of each depth can be heavy
    over = counted.where(F.col("n") > 2 * max_group).collect()
    heavy = [np.array(sorted(r["bin"] for r in over if r["depth"] == d), dtype=np.uint64) for d in range(len(_depths(k)))]
    most = max([r["n"] for r in over if r["depth"] == len(heavy) - 1], default=0)
    salts = min(4096, 1 + most // max_group)
    packed = src.mapInArrow(_partition(k, bins, heavy, salts), _PACKED)
    if most:
        minima = src.mapInArrow(_hot_minima(k, bins, heavy), "grp long, path long, doc long").groupBy("grp", "path").agg(F.min("doc").alias("doc"))
        salted = minima.select("grp", "path", "doc", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        packed = packed.unionByName(salted.mapInArrow(_pack_minima, _PACKED))
    return packed.groupBy("grp", "salt").applyInPandas(_trees, "doc_id long, path long")


def _with_repeats(docs: DataFrame, id_col: str, text_col: str, k: int, max_group: int) -> DataFrame:
    """(doc_id, text, repeats): every document with its repeated paths."""
    repeats = repeated_paths(docs, id_col, text_col, k, max_group).groupBy("doc_id").agg(F.collect_set("path").alias("repeats"))
    repeats = cut_lineage(repeats).withColumnRenamed("doc_id", "owner")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    owner = F.coalesce(F.col("doc_id"), F.lit(int(NO_ID)))
    return src.join(repeats, owner == F.col("owner"), "left").select("doc_id", "text", "repeats")


def substring_kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW, max_group: int = MAX_GROUP) -> DataFrame:
    """Per document: doc_id, n_words, the kept words joined by one space, and the
    removed spans as [first word, word after the last]."""
    return _with_repeats(docs, id_col, text_col, k, max_group).mapInArrow(_remove(k, texts_too=True), _KEPT)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW, max_group: int = MAX_GROUP) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and the SHA-256 of the text that
    ``substring_kept`` gives."""
    return _with_repeats(docs, id_col, text_col, k, max_group).mapInArrow(_remove(k), _RESULT)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over every whole text of ``documents``."""
    return substring_dedup(documents(spark, sf_dir))
