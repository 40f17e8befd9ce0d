"""Operator 2: benchmark decontamination with SimHash windows.

Words are lower-cased (A-Z) and stripped of ASCII punctuation.  For a benchmark
item of L words the windows are the L-word windows of a document (the whole
document if it is shorter) that share at least one 5-word shingle with the item;
any other window has similarity 0.

1. Every window gets a 64-bit SimHash of its words.
2. A multi-index over the items' fingerprints cuts them into RADIUS + 1 blocks:
   fingerprints within RADIUS bits agree in a block, so looking up each block and
   testing the Hamming distance finds all of them.
3. Candidates are verified exactly: weighted Jaccard of the shingle multisets,
   where a shingle weighs log(1 + items / items that contain it); the threshold
   is 0.8.

Items and items per shingle are counted once over the whole benchmark.  The items
are read in blocks of a fixed number and each block goes over all documents once,
so what a task holds of the benchmark is bounded.  With several blocks a window may
hold shingles of another block's items, whose weights the task lacks: candidates
that can still reach the threshold are written with those shingles, which then
meet their counts in a join.  Results do not depend on the size of the blocks.

Defined cases: null or blank texts match nothing; items of fewer than five words
are ignored; of several equally good windows the first is given; rows with equal
ids are judged one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm.common import cut_lineage, documents

SHINGLE = 5
RADIUS = 12
SIMILARITY = 0.8
#: Items held by a task at once (about 1 KB each).
ITEM_BLOCK = 20_000
_BITS = 1 << 20


def _signs(words: np.ndarray) -> np.ndarray:
    """(words, 64) array of +1 and -1: each word's vote per fingerprint bit."""
    bits = np.unpackbits(K.mix(words, 11).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def simhash(votes: np.ndarray) -> np.ndarray:
    """Fingerprints of summed votes (one row per window)."""
    return np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _blocks() -> list[tuple[int, int]]:
    cuts = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]


class Items:
    """The benchmark items of one block: shingles, weights and the multi-index.
    ``total`` and ``counts`` (shingle -> items) are those of the whole benchmark
    if this is a block of several."""

    def __init__(self, ids: list, texts: list[str | None], total: int | None = None, counts: dict[int, int] | None = None):
        self.ids, self.length, self.shingles, prints = [], [], [], []
        at = 0
        for chunk in K.chunks(pa.array(texts, pa.string())):
            h, doc = chunk.drop_punctuation().words(lower=True)
            for i in range(chunk.hi - chunk.lo):
                w = h[doc == i]
                if len(w) >= SHINGLE:
                    self.ids.append(ids[at + i])
                    self.length.append(len(w))
                    self.shingles.append(K.windows(w, np.zeros(len(w)), SHINGLE)[1])
                    prints.append(simhash(_signs(w).sum(axis=0, keepdims=True))[0])
            at += chunk.hi - chunk.lo
        self.length = np.array(self.length, dtype=np.int64)
        self.prints = np.array(prints, dtype=np.uint64)
        pairs = [(s, i) for i, x in enumerate(self.shingles) for s in set(x.tolist())]
        pairs.sort()
        self.key = np.array([p[0] for p in pairs], dtype=np.uint64)
        self.item = np.array([p[1] for p in pairs], dtype=np.int64)
        self.known, n = np.unique(self.key, return_counts=True)
        if counts is not None:
            n = np.array([counts[x] for x in self.known.view(np.int64).tolist()], dtype=np.int64)
        self.whole = counts is None
        total = len(self.ids) if total is None else total
        self.weight = np.log1p(total / n) if len(n) else np.zeros(0)
        self.other = float(np.log1p(total))
        self.mark = np.zeros(_BITS, dtype=bool)
        self.mark[self.key & K.U64(_BITS - 1)] = True
        self.index = []
        for shift, mask in _blocks():
            value = (self.prints >> K.U64(shift)) & K.U64(mask)
            order = np.argsort(value, kind="stable")
            self.index.append((value[order], order))

    def near(self, prints: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS where ``wanted[item]``."""
        found = []
        for (shift, mask), (value, order) in zip(_blocks(), self.index):
            own = (prints >> K.U64(shift)) & K.U64(mask)
            lo, hi = np.searchsorted(value, own, "left"), np.searchsorted(value, own, "right")
            n = hi - lo
            win = np.repeat(np.arange(len(prints)), n)
            item = order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            ok = wanted[item]
            found.append(win[ok] * len(self.ids) + item[ok])
        pair = np.unique(np.concatenate(found))
        win, item = pair // len(self.ids), pair % len(self.ids)
        ok = np.bitwise_count(prints[win] ^ self.prints[item]) <= RADIUS
        return win[ok], item[ok]

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        return np.where(self.known[at] == shingles, self.weight[at], self.other)

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard of two shingle multisets."""
        a, na = np.unique(window, return_counts=True)
        b, nb = np.unique(self.shingles[item], return_counts=True)
        both, x, y = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        shared = float((self.weights(both) * np.minimum(na[x], nb[y])).sum())
        return round(shared / (float((self.weights(a) * na).sum()) + float((self.weights(b) * nb).sum()) - shared), 12)

    def partial(self, window: np.ndarray, item: int) -> tuple[float, float, np.ndarray] | None:
        """Weight of the intersection, of the union without the shingles this block
        does not know, and those shingles; None if the similarity cannot reach the threshold."""
        strange = window[~np.isin(window, self.known)]
        a, na = np.unique(window[np.isin(window, self.known)], return_counts=True)
        b, nb = np.unique(self.shingles[item], return_counts=True)
        both, x, y = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        shared = float((self.weights(both) * np.minimum(na[x], nb[y])).sum())
        union = float((self.weights(a) * na).sum()) + float((self.weights(b) * nb).sum()) - shared
        # no weight is below log(2); the margin is for rounding
        return (shared, union, strange) if shared >= (SIMILARITY - 1e-9) * (union + len(strange) * np.log(2)) else None

    def matches(self, words: np.ndarray, shingles: np.ndarray, hits: np.ndarray):
        """(item, similarity, first word, window words) of the best window of every
        item that a document matches; ``hits``: positions of shingles known to the items.
        For a block of several: (item, ``partial``, first word, words) of every candidate."""
        n = len(words)
        lo, hi = np.searchsorted(self.key, shingles[hits], "left"), np.searchsorted(self.key, shingles[hits], "right")
        items = np.unique(np.concatenate([self.item[a:b] for a, b in zip(lo, hi)]))
        votes = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_signs(words), axis=0, dtype=np.int32)))
        best: dict[int, tuple] = {}
        open_ = []
        for length in np.unique(self.length[items]):
            wanted = np.zeros(len(self.ids), dtype=bool)
            wanted[items[self.length[items] == length]] = True
            size = int(min(length, n))
            # windows that contain a shared shingle of an item of this length
            at = np.array([p for p, a, b in zip(hits, lo, hi) if wanted[self.item[a:b]].any()])
            step = np.zeros(n - size + 2, dtype=np.int64)
            np.add.at(step, np.maximum(0, at - (size - SHINGLE)), 1)
            np.add.at(step, np.minimum(at, n - size) + 1, -1)
            start = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            win, item = self.near(simhash(votes[start + size] - votes[start]), wanted)
            for s, i in zip(start[win].tolist(), item.tolist()):
                if not self.whole:
                    part = self.partial(shingles[s : s + size - SHINGLE + 1], i)
                    if part is not None:
                        open_.append((i, part, s, size))
                    continue
                sim = self.similarity(shingles[s : s + size - SHINGLE + 1], i)
                if sim >= SIMILARITY and (i not in best or (-sim, s) < (-best[i][0], best[i][1])):
                    best[i] = (sim, s, size)
        return [(i, *best[i]) for i in sorted(best)] if self.whole else open_


def _scan(items: Items, texts: pa.Array):
    """(row, item, similarity, first word, words) over the texts of a batch."""
    if not items.ids:
        return
    for chunk in K.chunks(texts):
        h, doc = chunk.drop_punctuation().words(lower=True)
        at, w = K.windows(h, doc, SHINGLE)
        maybe = np.flatnonzero(items.mark[w & K.U64(_BITS - 1)])
        maybe = maybe[np.isin(w[maybe], items.known)]
        owner = doc[at[maybe]]
        for i in np.unique(owner):
            first, last = np.searchsorted(doc, (i, i + 1))
            wfirst, wlast = np.searchsorted(at, (first, last))
            for m in items.matches(h[first:last], w[wfirst:wlast], maybe[owner == i] - wfirst):
                yield (chunk.lo + int(i), *m)


def _shingles_of(batches):
    """(item's number of words is enough, its distinct shingles) of every text."""
    for batch in batches:
        for chunk in K.chunks(batch.column(0)):
            h, doc = chunk.drop_punctuation().words(lower=True)
            at, w = K.windows(h, doc, SHINGLE)
            own = doc[at]
            each = [np.unique(w[own == i]).view(np.int64) for i in np.unique(own)]
            yield pa.RecordBatch.from_arrays([pa.array(each, pa.list_(pa.int64()))], ["shingles"])


def _frequencies(bench: DataFrame, text_col: str) -> tuple[int, DataFrame]:
    """Items of the whole benchmark, and (shingle, n): items that contain it."""
    items = cut_lineage(bench.select(text_col).mapInArrow(_shingles_of, "shingles array<long>"))
    return items.count(), cut_lineage(items.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n")))


def _item_blocks(rows: DataFrame, n: int, frequencies: tuple[int, DataFrame] | None):
    """The benchmark (item_id, text) in ``n`` blocks."""
    for b in range(n):
        block = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b)
        part = block.collect()
        ids, texts = [r["item_id"] for r in part], [r["text"] for r in part]
        if frequencies is None:
            yield Items(ids, texts)
        else:
            own = block.select("text").mapInArrow(_shingles_of, "shingles array<long>").select(F.explode("shingles").alias("shingle")).distinct()
            counts = {r["shingle"]: r["n"] for r in frequencies[1].join(own, "shingle").collect()}  # bounded by the block
            yield Items(ids, texts, frequencies[0], counts)


_CANDIDATE = "doc_id long, k1 long, k2 long, item_id long, place long, shared double, known double, strange array<long>, start_word long, window_words long"


def _verified(src: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """(doc_id, k1, k2, item_id, similarity, start_word, window_words) by several
    blocks; ``k1`` and ``k2`` are hashes of the text."""
    frequencies = _frequencies(rows, "text")
    keyed = src.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2"))
    found = None
    for block, items in enumerate(_item_blocks(rows, n, frequencies)):

        def run(batches, items=items, block=block):
            # an item and a document row by their places in this scan
            seen, task = 0, TaskContext.get().partitionId()
            for batch in batches:
                got = list(_scan(items, batch.column(1)))
                at = pa.array([g[0] for g in got], pa.int64())
                place = pa.array([(task << 33) + seen + g[0] for g in got], pa.int64())
                seen += batch.num_rows
                own = [batch.column(j).take(at) for j in (0, 2, 3)]
                item = pa.array([items.ids[g[1]] for g in got], pa.int64())
                more = [pa.array([g[2][0] for g in got], pa.float64()), pa.array([g[2][1] for g in got], pa.float64()), pa.array([g[2][2].view(np.int64) for g in got], pa.list_(pa.int64()))]
                number = pa.array([block << 32 | g[1] for g in got], pa.int64())
                words = [pa.array([g[j] for g in got], pa.int64()) for j in (3, 4)]
                yield pa.RecordBatch.from_arrays([*own, item, place, *more, *words, number], ["doc_id", "k1", "k2", "item_id", "place", "shared", "known", "strange", "start_word", "window_words", "number"])

        # written block by block, so one plan never holds more than one block of items
        one = cut_lineage(keyed.mapInArrow(run, f"{_CANDIDATE}, number long"))
        found = one if found is None else found.unionByName(one)
    total, counts = frequencies
    key = ["number", "place", "start_word", "window_words"]
    strange = found.select(*key, F.explode("strange").alias("shingle")).join(counts, "shingle", "left")
    extra = strange.groupBy(*key).agg(F.sum(F.log1p(F.lit(float(total)) / F.coalesce("n", F.lit(1)))).alias("extra"))
    scored = found.join(extra, key, "left").withColumn("similarity", F.round(F.col("shared") / (F.col("known") + F.coalesce("extra", F.lit(0.0))), 12))
    best = F.min_by(F.struct("doc_id", "k1", "k2", "item_id", "similarity", "start_word", "window_words"), F.struct(-F.col("similarity"), F.col("start_word"))).alias("best")
    return scored.where(F.col("similarity") >= SIMILARITY).groupBy("number", "place").agg(best).select("best.*")


def _benchmark(bench: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, int]:
    """(item_id, text) and the number of blocks of about ``size`` items."""
    rows = bench.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return rows, 1 + rows.count() // size


def find_contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, window_words): the best window
    of every item that a document holds."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, n = _benchmark(bench, item_id, item_text, item_block)
    if n > 1:
        return _verified(src, rows, n).select("doc_id", "item_id", "similarity", "start_word", "window_words")
    out = None
    for items in _item_blocks(rows, n, None):

        def run(batches, items=items):
            for batch in batches:
                got = list(_scan(items, batch.column(1)))
                rows = [g[0] for g in got]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array([items.ids[g[1]] for g in got], pa.int64()),
                        pa.array([g[2] for g in got], pa.float64()),
                        pa.array([g[3] for g in got], pa.int64()),
                        pa.array([g[4] for g in got], pa.int64()),
                    ],
                    ["doc_id", "item_id", "similarity", "start_word", "window_words"],
                )

        found = src.mapInArrow(run, "doc_id long, item_id long, similarity double, start_word long, window_words long")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""
    rows, n = _benchmark(bench, item_id, item_text, item_block)
    if n > 1:
        # whether a row matches depends on its text only
        text = F.col(f"`{text_col}`")
        leaks = cut_lineage(_verified(docs.select(F.lit(None).cast("long").alias("doc_id"), text.alias("text")), rows, n).select("k1", "k2").distinct())
        own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2"))
        return own.join(leaks, ["k1", "k2"], "left_anti").select("_row.*")
    place = docs.columns.index(text_col)
    out = docs
    for items in _item_blocks(rows, n, None):

        def run(batches, items=items):
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in _scan(items, batch.column(place)):
                    clean[row] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: every whole text of ``documents`` against all of ``benchmark``."""
    return find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
