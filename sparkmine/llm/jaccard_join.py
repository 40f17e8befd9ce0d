"""Operator 6: n-gram Jaccard join with parity sketches.

A document's set holds its distinct 5-word shingles (64-bit hashes; the whole
word sequence as one shingle when there are fewer words).  Documents link when
their sets' Jaccard similarity is at least 0.8.

A parity sketch XORs every element into a bit vector; elements that two sets
share cancel, so the Hamming distance of two sketches never exceeds the sets'
symmetric difference, which for linked sets is at most (|A| + |B|) / 9.

1. *Size bands.* Band [l, u) holds the sizes from l to u - 1 and takes in smaller
   sets that can still link upwards (size >= 0.8 l), so linked sets meet in a band.
2. *Pigeonhole.* In a band two linked sets differ in at most D = floor(2(u-1)/9)
   elements.  The (very wide, hence sparse) sketch is cut into m = D + 1 + z
   blocks, so at least z + 1 blocks are equal.  A block's signature is the XOR of
   its elements' 64-bit hashes.  Empty blocks have none.  A set whose elements fall in
   at most D blocks is thin: two thin sets may agree in empty blocks only, so a
   thin set also emits the blocks of another hash, and so on until it is not thin
   (each time for about one small set in fifty).  Of two linked sets that reach a
   hash, either one is not thin there and they share a block with elements, or both
   go on; sets still thin after LEVELS hashes emit their empty blocks too.
3. *Buckets.* Signatures travel packed (six bytes each) to buckets of bounded
   size.  Sets that agree in a signature and in their whole-set hash are one
   class, represented by its smallest doc_id.  Each signature shared by several
   classes gives a star around its smallest one.
4. *Verify.* Star pairs pass a size and 2,048-bit sketch test, long sets also the
   test of a sketch as wide as the set, and then an exact comparison of the sets.
   Connected components contract what they link.
5. *Rest.* Within a shared signature, classes that are not yet connected are
   compared with each other: the pair must lie in different components and pass
   the sketch test before it is formed, and is verified exactly.  So every pair
   that links is either verified or already connected.

Defined cases: null or blank text: empty set, linked with nothing; exact copies
(any number) link through their class, and only one of a heavy class emits; a row with a null doc_id links with
nothing and has a null component; with repeated doc_ids every row keeps its own
n_shingles and its component follows its own set.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm.common import cut_lineage, documents, text_bytes
from sparkmine.llm.components import connected_components

SHINGLE = 5
#: Signatures of one bucket (about 30 bytes each while it is joined).
MAX_BUCKET = 2_000_000
#: Words of the verification sketch (64 bits each).
SKETCH = 32
#: Sets with more elements than that sketch has bits get a wider one as well.
LONG = 64 * SKETCH
#: Hashes that deal a thin set's elements to blocks before its empty blocks are emitted.
LEVELS = 6
#: A class with at least 1 / HEAVY_PARTS of the documents emits from one id only.
HEAVY_PARTS = 4096
#: log2 of the bits of the candidates' bitmap.
MARK_BITS = 25


def _bands(limit: int) -> list[tuple[int, int, int]]:
    """(lower size, D, blocks) of every band up to ``limit``; the ratio is 1.5."""
    out, low = [], 1
    while low <= limit:
        high = max(low + 1, -(-3 * low // 2))
        d = 2 * (high - 1) // 9
        out.append((low, d, d + 1 + (0 if d == 0 else 2 + d // 4)))
        low = high
    return out


_BANDS = _bands(1 << 40)
_LOWS = np.array([b[0] for b in _BANDS])


def band_signatures(shingles: np.ndarray) -> np.ndarray:
    """64-bit signatures of a sorted set's blocks, for each band it belongs to."""
    n = len(shingles)
    if not n:
        return shingles
    band = int(np.searchsorted(_LOWS, n, "right")) - 1
    zobrist, out = K.mix(shingles, 5), []
    for b in (band, band + 1):
        low, d, m = _BANDS[b]
        if b > band and 5 * n < 4 * low:
            break
        for level in range(LEVELS):
            place = shingles if level == 0 else K.mix(shingles, 60 + level)
            block = ((place >> K.U64(32)) * K.U64(m)) >> K.U64(32)
            order = slice(None) if level == 0 else np.argsort(block, kind="stable")  # shingles are sorted
            block = block[order]
            cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            parity, at = np.bitwise_xor.reduceat(zobrist[order], cut), block[cut]
            thin = len(cut) <= d  # all equal blocks may be empty ones
            if thin and level == LEVELS - 1:
                empty = np.setdiff1d(np.arange(m, dtype=np.uint64), at)
                parity, at = np.concatenate((parity, np.zeros(len(empty), np.uint64))), np.concatenate((at, empty))
            out.append(K.mix(parity ^ K.mix(at + K.U64((level << 56) + (b << 40)), 6)))
            if not thin:
                break
    return np.concatenate(out)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity sketch of 64 * SKETCH bits."""
    bit = K.mix(shingles, 8) % K.U64(64 * SKETCH)
    odd = (np.bincount(bit.astype(np.int64), minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def wide_sketch(shingles: np.ndarray) -> bytes | None:
    """Parity sketch of a long set, of the least power of two of bits that is not
    below its size (an eighth to a quarter of a byte per element)."""
    n = len(shingles)
    if n <= LONG:
        return None
    bits = 1 << (n - 1).bit_length()
    bit = (K.mix(shingles, 8) & K.U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def wide_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two wide sketches; the wider one is folded."""
    x, y = sorted((np.frombuffer(v, np.uint64) for v in (x, y)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    return int(K.mix(shingles, 1).sum(dtype=np.uint64).view(np.int64)), int(K.mix(shingles, 2).sum(dtype=np.uint64).view(np.int64))


def _profile(k: int):
    def run(batches):
        for batch in batches:
            n, key, marks, wide = [], [], [], []
            for chunk in K.chunks(batch.column(1)):
                for s in K.shingle_sets(chunk, k):
                    n.append(len(s))
                    key.append(_set_key(s))
                    marks.append(sketch(s))
                    wide.append(wide_sketch(s))
            key = np.array(key, dtype=np.int64).reshape(-1, 2)
            marks = np.array(marks, dtype=np.uint64).reshape(-1, SKETCH).view(np.int64)
            columns = [*key.T, *marks.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in columns), pa.array(wide, pa.binary())], [*_PROFILE_NAMES, "wide"])

    return run


def _heavy_classes(profile: DataFrame) -> dict[int, int]:
    """Set key -> smallest doc_id of the classes that hold at least 1 / HEAVY_PARTS of
    the documents; there are at most HEAVY_PARTS."""
    counts = profile.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "k1", "k2").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("doc_id"))
    least = max(2, -(-profile.count() // HEAVY_PARTS))
    found: dict[int, int] = {}
    for r in counts.where(F.col("rows") >= least).select("k1", "doc_id").collect():
        found[r["k1"]] = min(r["doc_id"], found.get(r["k1"], r["doc_id"]))
    return found


def _emit(k: int, buckets: int, heavy: dict[int, int]):
    """Packed rows (bucket, documents, set keys, counts, signatures).  A class has one
    set, so of a heavy class only the smallest doc_id emits, and of equal ids and sets
    in a chunk of texts only the first."""

    def run(batches):
        for batch in batches:
            given = batch.column(0)
            known = given.is_valid().to_numpy(zero_copy_only=False)
            ids = given.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for chunk in K.chunks(batch.column(1)):
                sigs, keys, own, seen = [], [], [], set()
                for i, s in enumerate(K.shingle_sets(chunk, k), chunk.lo):
                    if len(s) and known[i]:
                        mine = (int(ids[i]), _set_key(s)[0])
                        if mine in seen or heavy.get(mine[1], mine[0]) != mine[0]:
                            continue
                        seen.add(mine)
                        sigs.append(band_signatures(s))
                        keys.append(mine[1])
                        own.append(mine[0])
                if not own:
                    continue
                size = np.array([len(x) for x in sigs])
                sig, doc = np.concatenate(sigs), np.repeat(np.arange(len(own)), size)
                keys, own = np.array(keys, dtype=np.int64), np.array(own, dtype=np.int64)
                bucket = (K.mix(sig, 3) % K.U64(buckets)).astype(np.int64)
                order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
                bucket, doc = bucket[order], doc[order]
                low = sig[order].view(np.uint8).reshape(-1, 8)[:, :6]
                cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                run_ = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1]))))
                count = np.diff(np.append(run_, len(doc))).astype(np.int32)
                at, ends, who = np.append(np.searchsorted(run_, cut), len(run_)), np.append(cut, len(doc)), doc[run_]
                cols = [[], [], [], []]
                for i in range(len(cut)):
                    d = slice(at[i], at[i + 1])
                    for c, x in zip(cols, (own[who[d]], keys[who[d]], count[d], low[ends[i] : ends[i + 1]])):
                        c.append(x.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), *(pa.array(c, pa.binary()) for c in cols)], ["bucket", "docs", "set_keys", "counts", "sigs"])

    return run


_PROFILE_NAMES = ["doc_id", "n", "k1", "k2", *(f"s{j}" for j in range(SKETCH))]
_SHARED = "grp long, pivot long, doc_id long"


def _stars(rows: pd.DataFrame) -> pd.DataFrame:
    """Signatures of one bucket that several classes share, as stars around the
    smallest class; of signatures shared by the same classes one is kept.  ``grp``
    is a hash of these classes, so that other buckets' copies can go as well."""
    docs, keys = (np.concatenate([np.frombuffer(x, np.int64) for x in rows[c]]) for c in ("docs", "set_keys"))
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in rows["counts"]])
    low = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["sigs"]]).reshape(-1, 6)
    sig = np.zeros((len(low), 8), dtype=np.uint8)
    sig[:, :6] = low
    sig = sig.view(np.int64).ravel()
    del low
    order = np.argsort(sig)
    sig = sig[order]
    same = sig[1:] == sig[:-1]
    multi = np.concatenate((same, [False])) | np.concatenate(([False], same))
    who = np.repeat(np.arange(len(docs)), counts)[order[multi]]
    sig, doc, key = sig[multi], docs[who], keys[who]
    order = np.lexsort((doc, key, sig))
    sig, doc, key = sig[order], doc[order], key[order]
    first = np.concatenate(([True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]))) if len(sig) else np.zeros(0, bool)
    sig, doc = sig[first], doc[first]
    start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(sig)))
    pivot, members = (np.minimum.reduceat(doc, start), np.add.reduceat(K.mix(doc.view(np.uint64), 4), start)) if len(sig) else (doc, doc.view(np.uint64))
    _, kept = np.unique(np.where(size > 1, members, 0), return_index=True)
    keep = np.zeros(len(start), dtype=bool)
    keep[kept] = True
    keep &= size > 1
    sel, pivot = np.repeat(keep, size), np.repeat(pivot, size)
    sel &= doc != pivot
    grp = np.repeat(members, size).view(np.int64)
    return pd.DataFrame({"grp": grp[sel], "pivot": pivot[sel], "doc_id": doc[sel]})


def _exact(k: int, threshold: int):
    """Keep pairs whose texts' shingle sets meet the threshold (in percent)."""

    def sets(texts):
        for chunk in K.chunks(texts):
            yield from K.shingle_sets(chunk, k)

    def run(batches):
        for batch in batches:
            keep = []
            for p, q in zip(sets(batch.column(2)), sets(batch.column(3))):
                shared = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * shared >= threshold * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _may_link(x: str, y: str, threshold: int) -> Column:
    """Size test and sketch test: what no linked pair fails."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    apart = sum((F.bit_count(F.col(f"{x}.s{j}").bitwiseXOR(F.col(f"{y}.s{j}"))) for j in range(1, SKETCH)), F.bit_count(F.col(f"{x}.s0").bitwiseXOR(F.col(f"{y}.s0"))))
    return (F.lit(100) * F.least(nx, ny) >= F.lit(threshold) * F.greatest(nx, ny)) & (F.lit(100 + threshold) * apart <= F.lit(100 - threshold) * (nx + ny))


def _wide_test(threshold: int):
    """Leave out pairs of long sets whose wide sketches are too far apart to link."""

    def run(batches):
        for batch in batches:
            nx, x, ny, y = (batch.column(j).to_pylist() for j in range(2, 6))
            keep = [u is None or v is None or (100 + threshold) * wide_distance(u, v) <= (100 - threshold) * (m + n) for m, u, n, v in zip(nx, x, ny, y)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _marked(src: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``src`` whose doc_id may be in ``ids``, by a broadcast bitmap of
    2**MARK_BITS bits (4 MB, whatever the number of ids); others may stay, none is lost."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MARK_BITS))
    bits = ids.select(slot.alias("slot")).select(F.shiftright("slot", 15).alias("page"), F.col("slot").bitwiseAND(32767).alias("at")).groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits"))
    own = src.withColumn("slot", slot).withColumn("page", F.shiftright("slot", 15)).join(F.broadcast(bits), "page")
    at = F.col("slot").bitwiseAND(32767).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return own.where(F.call_function("getbit", byte, at.bitwiseAND(7)) == 1).select(*src.columns)


def _near(pairs: DataFrame, marks: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that pass the size and sketch tests."""
    return pairs.join(marks.alias("x"), F.col("a") == F.col("x.doc_id")).join(marks.alias("y"), F.col("b") == F.col("y.doc_id")).where(_may_link("x", "y", threshold)).select("a", "b").distinct()


def _long(profile: DataFrame) -> DataFrame:
    """Wide sketches by doc_id; an id with several rows has several sets and gets none."""
    repeated = profile.groupBy("doc_id").count().where("count > 1")
    return profile.where(F.col("wide").isNotNull()).join(repeated, "doc_id", "left_anti").select("doc_id", "n", "wide")


def _verified(near: DataFrame, long: DataFrame, src: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose texts link; ``near`` has passed the sketch test."""
    near = cut_lineage(near)
    x, y = (long.select(F.col("doc_id").alias(own), F.col("n").alias(f"n{own}"), F.col("wide").alias(f"wide_{own}")) for own in ("a", "b"))
    tested = near.join(x, "a", "left").join(y, "b", "left").select("a", "b", "na", "wide_a", "nb", "wide_b")
    near = cut_lineage(tested.mapInArrow(_wide_test(threshold), "a long, b long").distinct())
    # only texts of candidates are shuffled
    held = cut_lineage(_marked(src, near.select(F.col("a").alias("doc_id")).union(near.select("b"))))
    texts = near.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("p")), "a").join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("q")), "b")
    return texts.select("a", "b", "p", "q").mapInArrow(_exact(k, threshold), "a long, b long").distinct()


def shingle_profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """Per document (written table): doc_id, set size n, two set keys, sketch,
    wide sketch (null unless the set is long)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut_lineage(src.mapInArrow(_profile(k), ", ".join(f"{c} long" for c in _PROFILE_NAMES) + ", wide binary"))


def jaccard_links(docs: DataFrame, profile: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) between class representatives that connect every pair of
    different sets with a Jaccard similarity of at least 0.8.  ``profile`` is
    the documents' ``shingle_profile``."""
    threshold = 80  # the pigeonhole numbers above hold for this similarity
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # 0.6 signatures a word are expected at 6 bytes a word
    buckets = 1 + text_bytes(src) // 10 // max_bucket
    packed = src.mapInArrow(_emit(k, buckets, _heavy_classes(profile)), "bucket long, docs binary, set_keys binary, counts binary, sigs binary")
    shared = cut_lineage(packed.groupBy("bucket").applyInPandas(_stars, _SHARED).distinct())
    long = _long(profile)
    marks = profile.where("n > 0").drop("k1", "k2", "wide")
    links = cut_lineage(_verified(_near(shared.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct(), marks, threshold), long, src, k, threshold))
    part = connected_components(links)
    labelled = (
        shared.join(part, F.col("doc_id") == F.col("node"), "left")
        .select("grp", "pivot", "doc_id", F.coalesce("component", "doc_id").alias("label"))
        .join(part.select(F.col("node").alias("pivot_node"), F.col("component").alias("pivot_component")), F.col("pivot") == F.col("pivot_node"), "left")
        .select("grp", "doc_id", "label", F.coalesce("pivot_component", "pivot").alias("pivot_label"))
    )
    mixed = labelled.groupBy("grp").agg(F.max(F.col("label") != F.col("pivot_label")).alias("open")).where("open").select("grp")
    rest = labelled.select("grp", "doc_id", "label").join(mixed, "grp", "left_semi").join(marks, "doc_id")
    more = (
        rest.alias("x")
        .join(rest.alias("y"), (F.col("x.grp") == F.col("y.grp")) & (F.col("x.doc_id") < F.col("y.doc_id")) & (F.col("x.label") != F.col("y.label")) & _may_link("x", "y", threshold))
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        .distinct()
    )
    return links.unionByName(_verified(more, long, src, k, threshold)).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest doc_id
    reachable by links."""
    profile = shingle_profile(docs, id_col, text_col, k)
    key = ["n", "k1", "k2"]
    classes = profile.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("class"))
    found = connected_components(jaccard_links(docs, profile, id_col, text_col, k, max_bucket))
    classes = classes.join(found, F.col("class") == F.col("node"), "left").select(*key, F.coalesce("component", "class").alias("component"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return profile.join(classes, key, "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over every whole text of ``documents``."""
    return jaccard_components(documents(spark, sf_dir))
