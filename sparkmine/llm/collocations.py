"""Operator 12: phrase collocations by marginalising the longest windows.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those
into words ``[^\\x20\\x09]+``; everything is counted per language.

1. *Lead windows.* Every word position gives one window: the word and the next ones,
   ORDER words in all, padded with 0 beyond the end of its piece.  No shorter n-gram
   is ever formed.  Words are 64-bit hashes.
2. *Counts of the windows.* A task packs its windows by first word into groups (one
   row per group: the words' hashes and 2- or 4-byte codes into them), after equal
   windows have met.  A first pass counts hashed prefixes of one and two words; a
   first word whose group would exceed ``max_group`` is dealt by two words, and a
   pair beyond it by the whole window, whose copies have met already.
3. *Folding.* No phrase below ``min_count`` is a candidate or part of one.  A group
   therefore pads the rare ends of its windows (and adds equal ones up): the last
   word of a window that is too rare, then the second of a pair.  It pads only what
   the group holds whole, so the sums over prefixes stay exact.
4. *ROLLUP.* Spark sums the padded windows over (lang, w1, w2, w3): the subtotals
   are all counts of one-, two- and three-word phrases and of the languages' words.
5. *Scores* are exact decimals; longer candidates join their parts to drop them.
   Places are taken in hashed parts of a language first, then in what they leave.
6. *Strings.* A second scan fetches the words of the phrases that are left, found by
   a bitmap of fixed size, and the ranks are settled by the phrases' bytes.

Defined cases: null text: no words; null lang: ``und`` (as a lang of that name); an
empty table gives an empty result; equal rows count as often as they stand; other
columns are not read, whatever their names; ties in score and count go by the phrase.
A task holds FLUSH words and their windows; a longer text is cut at word borders,
with the windows across the cut kept whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm.common import cut_lineage, documents, text_bytes

ORDER = 3
MIN_COUNT = 10
TOP = 2000
DROP_PERCENT = 50
#: Words whose windows a task packs at once.
FLUSH = 600_000
#: Windows of one group (about 60 bytes each while it is counted).
MAX_GROUP = 600_000
#: Assumed bytes per word when the number of groups is chosen from the size of the texts.
BYTES_PER_WORD = 6
#: Text bytes handled at once (a longer text is one piece): bounds the scratch arrays.
CHUNK_BYTES = 1 << 19
#: log2 of the bits of the wanted words' bitmap (4 MB).
MARK_BITS = 25

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_PACKED = "lang string, depth int, bin long, ids binary, codes binary, counts binary"
_WINDOWS = "lang string, w1 long, w2 long, w3 long, n long"


class Words:
    """The words of a chunk of texts: hash, text, piece and byte range of each."""

    def __init__(self, chunk: K.Chunk):
        buf, n = chunk.buf, len(chunk.buf)
        self.buf = buf
        word = ~_GAPS[buf]
        edge = np.zeros(n + 1, dtype=bool)
        edge[chunk.offsets] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last[:-1] &= ~word[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(chunk.offsets, self.start, "right") - 1
        # a piece ends at its separator or where the text does
        breaks = np.concatenate(([0], np.cumsum(_ENDS[buf] if n else np.zeros(0, dtype=np.int64))))
        self.piece = breaks[self.start] + self.text
        acc = np.zeros(n + 1, dtype=np.uint64)
        if n:
            np.cumsum(K._LOWER[buf] * K._power(n, False), out=acc[1:])
        self.hash = np.maximum(K.mix((acc[self.end] - acc[self.start]) * K._power(n + 1, True)[self.start]), K.U64(1))


def _windows(word: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
    """The ORDER lead-window columns of hashes or codes, 0 beyond the piece."""
    out = [word]
    for j in range(1, ORDER):
        col = np.zeros_like(word)
        if len(word) > j:
            col[:-j] = np.where(piece[j:] == piece[:-j], word[j:], 0)
        out.append(col)
    return out


def _bins(w: list[np.ndarray], bins: int) -> list[np.ndarray]:
    """Bins of the prefixes of 1, 2, .. words of the windows."""
    out, acc = [], np.zeros(len(w[0]), dtype=np.uint64)
    for j, col in enumerate(w):
        acc = K.mix(acc ^ col, 60 + j)
        out.append((acc % K.U64(bins)).astype(np.int64))
    return out


def _langs(column) -> tuple[np.ndarray, list[str]]:
    """(code per row, names): null counts as ``und``."""
    coded = column.cast(pa.string()).fill_null("und").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def _count_prefixes(bins: int):
    """(depth, bin, n): windows under the hashed prefixes of one and two words."""

    def run(batches):
        total = [np.zeros(bins, dtype=np.int64) for _ in range(ORDER - 1)]
        for batch in batches:
            for chunk in K.chunks(batch.column(1), CHUNK_BYTES):
                found = Words(chunk)
                for depth, b in enumerate(_bins(_windows(found.hash, found.piece)[: ORDER - 1], bins)):
                    total[depth] += np.bincount(b, minlength=bins)
        for depth, n in enumerate(total):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), depth, np.int32)), pa.array(at), pa.array(n[at])], ["depth", "bin", "n"])

    return run


def _pack(lang: str, word: np.ndarray, piece: np.ndarray, n: int, bins: int, heavy: list[np.ndarray]):
    """One row per group of the windows that start at the first ``n`` words."""
    ids, code = np.unique(word, return_inverse=True)
    ids = np.concatenate((np.zeros(1, dtype=np.uint64), ids))
    code = code.reshape(-1).astype(np.int32) + np.int32(1)
    bits = int(len(ids) - 1).bit_length()
    if ORDER * bits > 63:
        raise ValueError("too many different words in one flush")
    key = np.zeros(n, dtype=np.int64)
    for col in _windows(code, piece):
        key = key << bits | col[:n]
    key, counts = np.unique(key, return_counts=True)
    code = [(key >> bits * (ORDER - 1 - j) & (1 << bits) - 1).astype(np.int32) for j in range(ORDER)]
    del key
    prefix = _bins([ids[c] for c in code], bins)
    depth, group = np.zeros(len(counts), dtype=np.int64), prefix[0]
    for j in range(1, ORDER):
        deeper = (depth == j - 1) & np.isin(prefix[j - 1], heavy[j - 1])
        depth[deeper] = j
        group = np.where(deeper, prefix[j], group)
    _, label = np.unique(depth * bins + group, return_inverse=True)
    order = np.argsort(label.astype(np.uint16) if len(label) and label.max() < 65536 else label, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(label[order]) != 0)))
    rows = []
    for lo, hi in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist()):
        at = order[lo:hi]
        used, body = np.unique(np.concatenate([c[at] for c in code]), return_inverse=True)
        body = body.astype(np.uint16 if len(used) <= 65536 else np.uint32)
        rows.append((ids[used].tobytes(), body.tobytes(), counts[at].astype(np.uint32).tobytes()))
    first = order[cut]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(rows), pa.string()),
            pa.array(depth[first].astype(np.int32)),
            pa.array(group[first]),
            *(pa.array([r[j] for r in rows], pa.binary()) for j in range(3)),
        ],
        ["lang", "depth", "bin", "ids", "codes", "counts"],
    )


def _partition(bins: int, heavy: list[np.ndarray], flush: int):
    def run(batches):
        held: dict[str, list] = {}
        size = pieces = 0

        def packed():
            for lang, parts in held.items():
                word, piece = (np.concatenate(x) for x in zip(*parts))
                for lo in range(0, len(word), flush):
                    hi = min(lo + flush, len(word))
                    yield _pack(lang, word[lo : hi + ORDER - 1], piece[lo : hi + ORDER - 1], hi - lo, bins, heavy)
            held.clear()

        for batch in batches:
            lang, names = _langs(batch.column(0))
            for chunk in K.chunks(batch.column(1), CHUNK_BYTES):
                found = Words(chunk)
                if not len(found.hash):
                    continue
                own, piece = lang[chunk.lo : chunk.hi][found.text], found.piece + pieces
                pieces = int(piece[-1]) + 1
                for code in np.unique(own).tolist():
                    held.setdefault(names[code], []).append((found.hash[own == code], piece[own == code]))
                size += len(own)
                if size >= flush:
                    yield from packed()
                    size = 0
        yield from packed()

    return run


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal windows added up, in order."""
    order = np.lexsort(keys[::-1])
    keys, n = [k[order] for k in keys], n[order]
    at = _starts(keys)
    return [k[at] for k in keys], np.add.reduceat(n, at)


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _fold(keys: list[np.ndarray], n: np.ndarray, least: int, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal windows added up, and the rare ends padded of all prefixes longer than
    ``depth`` words, which the group holds whole; from the longest to the shortest."""
    keys, n = _summed(keys, n)
    for words in range(ORDER, depth, -1):
        at = _starts(keys[:words])
        rare = np.repeat(np.add.reduceat(n, at) < least, np.diff(np.append(at, len(n))))
        keys[words - 1] = np.where(rare, K.U64(0), keys[words - 1])
    return _summed(keys, n)


def _count_group(least: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lang, depth = rows["lang"].iloc[0], int(rows["depth"].iloc[0])
        cols, counts = [[] for _ in range(ORDER)], []
        for ids, codes, n in zip(rows["ids"], rows["codes"], rows["counts"]):
            ids, n = np.frombuffer(ids, np.uint64), np.frombuffer(n, np.uint32)
            codes = np.frombuffer(codes, np.uint16 if len(ids) <= 65536 else np.uint32).reshape(ORDER, -1)
            for j in range(ORDER):
                cols[j].append(ids[codes[j]])
            counts.append(n)
        for j in range(ORDER):
            cols[j] = np.concatenate(cols[j])
        keys, n = _fold(cols, np.concatenate(counts).astype(np.int64), least, depth)
        return pd.DataFrame({"lang": lang, **{f"w{j + 1}": k.view(np.int64) for j, k in enumerate(keys)}, "n": n})

    return run


def folded_windows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_group: int = MAX_GROUP, flush: int = FLUSH) -> DataFrame:
    """(lang, w1, w2, w3, n): the counted padded windows, their rare ends padded too.
    A window may stand in several rows."""
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    total = text_bytes(src) // BYTES_PER_WORD
    bins = 1 << max(2, (total // max_group).bit_length())
    counted = src.mapInArrow(_count_prefixes(bins), "depth int, bin long, n long").groupBy("depth", "bin").agg(F.sum("n").alias("n"))
    # at most total / max_group bins of each depth can be heavy
    over = counted.where(F.col("n") > 2 * max_group).collect()
    heavy = [np.array(sorted(r["bin"] for r in over if r["depth"] == d), dtype=np.int64) for d in range(ORDER - 1)]
    return src.mapInArrow(_partition(bins, heavy, flush), _PACKED).groupBy("lang", "depth", "bin").applyInPandas(_count_group(min_count), _WINDOWS)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_group: int = MAX_GROUP, flush: int = FLUSH) -> DataFrame:
    """(lang, k, w1, w2, w3, n) for k = 0 (all words of the language) and every phrase
    of k = 1 to 3 words that occurs at least ``min_count`` times; words as hashes."""
    cols = [f"w{j + 1}" for j in range(ORDER)]
    sums = folded_windows(docs, text_col, lang_col, min_count, max_group, flush).rollup("lang", *cols).agg(F.sum("n").alias("n"), F.grouping_id().alias("gid"))
    k = sum((F.when(F.col("gid") == (1 << ORDER - j) - 1, F.lit(j)).otherwise(F.lit(0)) for j in range(1, ORDER + 1)), F.lit(0))
    # a subtotal over a pad is no phrase
    held = [F.when(F.col("k") >= j + 1, F.col(c) != 0).otherwise(F.lit(True)) for j, c in enumerate(cols)]
    real = held[0] & held[1] & held[2] & ((F.col("k") == 0) | (F.col("n") >= min_count))
    return sums.where(F.col("gid") < (1 << ORDER + 1) - 1).withColumn("k", k).where(real).select("lang", "k", *cols, "n")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exact."""
    d = lambda c: f"cast({c} as decimal(16, 0))"
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * ({d(a)} * {d(a)})) div ({d(left)} * {d(right)})")


def scored_phrases(counts: DataFrame, drop_percent: int = DROP_PERCENT) -> DataFrame:
    """(lang, k, w1, w2, w3, a, l, r, score) of the candidates (two and three
    words), by their lowest-scoring cut, without those that a longer one covers."""

    def part(k: int, names: list[str], n: str) -> DataFrame:
        return counts.where(F.col("k") == k).select("lang", *(F.col(f"w{j + 1}").alias(c) for j, c in enumerate(names)), F.col("n").alias(n))

    pairs = part(2, ["w1", "w2"], "a")
    threes = part(3, ["w1", "w2", "w3"], "a")
    # pairs: one cut; dropped where a three holds at least the share of their occurrences
    inside = threes.select("lang", "w1", "w2", "a").unionByName(threes.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    two = (
        pairs.join(longest, ["lang", "w1", "w2"], "left")
        .where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(drop_percent) * F.col("a"), F.lit(True)))
        .join(part(1, ["w1"], "l"), ["lang", "w1"])
        .join(part(1, ["w2"], "r"), ["lang", "w2"])
        .select("lang", F.lit(2).alias("k"), "w1", "w2", F.lit(0).cast("long").alias("w3"), "a", F.struct(_score("a", "l", "r").alias("score"), F.lit(1).alias("cut"), "l", "r").alias("best"))
    )
    three = (
        threes.join(part(1, ["w1"], "l1"), ["lang", "w1"])
        .join(part(2, ["w2", "w3"], "r1"), ["lang", "w2", "w3"])
        .join(part(2, ["w1", "w2"], "l2"), ["lang", "w1", "w2"])
        .join(part(1, ["w3"], "r2"), ["lang", "w3"])
    )
    cuts = [F.struct(_score("a", f"l{c}", f"r{c}").alias("score"), F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in (1, 2)]
    three = three.select("lang", F.lit(3).alias("k"), "w1", "w2", "w3", "a", F.least(*cuts).alias("best"))
    return two.unionByName(three).select("lang", "k", "w1", "w2", "w3", "a", "best.l", "best.r", "best.score")


def _first(df: DataFrame, top: int, place: Column, order: list[Column]) -> DataFrame:
    """The rows of the first ``top`` places of each language, and ``place``: first
    within hashed parts of a language, then of what the parts leave."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(parts)))
    for keys in (["lang", "part"], ["lang"]):
        dealt = dealt.withColumn("place", place.over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= top)
    return dealt.drop("part")


def _spell(bitmap):
    """(id, word) of the words whose hash the bitmap holds, once per task."""

    def run(batches):
        marks = np.frombuffer(bitmap.value, dtype=np.uint64)
        seen = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for chunk in K.chunks(batch.column(0), CHUNK_BYTES):
                found = Words(chunk)
                bit = found.hash >> K.U64(64 - MARK_BITS)
                at = np.flatnonzero(marks[(bit >> K.U64(6)).astype(np.int64)] >> (bit & K.U64(63)) & K.U64(1))
                ids, first = np.unique(found.hash[at], return_index=True)
                new = ~np.isin(ids, seen, assume_unique=True)
                if new.any():
                    where = at[first[new]]
                    raw = [found.buf[s:e].tobytes().lower().decode() for s, e in zip(found.start[where].tolist(), found.end[where].tolist())]
                    seen = np.union1d(seen, ids[new])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[new].view(np.int64)), pa.array(raw, pa.string())], ["id", "word"])

    return run


def spelled(docs: DataFrame, ids: DataFrame, text_col: str = "text") -> DataFrame:
    """(id, word) for the word hashes in ``ids`` (id), by one scan of the texts."""
    spark = docs.sparkSession
    bit = F.shiftrightunsigned("id", 64 - MARK_BITS)
    marked = ids.select(F.shiftright(bit, 6).alias("slot"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(id, {64 - MARK_BITS}) & 63 as int))").alias("bit"))
    # at most 2 ** (MARK_BITS - 6) rows of eight bytes, whatever the number of ids
    bitmap = np.zeros(1 << MARK_BITS - 6, dtype=np.uint64)
    for r in marked.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        bitmap[r["slot"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_spell(spark.sparkContext.broadcast(bitmap.tobytes())), "id long, word string")
    return found.join(ids.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("word").alias("word"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    min_count: int = MIN_COUNT,
    drop_percent: int = DROP_PERCENT,
    max_group: int = MAX_GROUP,
    flush: int = FLUSH,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = cut_lineage(phrase_counts(docs, text_col, lang_col, min_count, max_group, flush))
    by_score = [F.col("score").desc(), F.col("a").desc()]
    # rank() keeps all ties of the last place
    near = _first(scored_phrases(counts, drop_percent), top, F.rank(), by_score).drop("place")
    near = cut_lineage(near.join(counts.where(F.col("k") == 0).select("lang", "n"), "lang"))
    cols = [f"w{j + 1}" for j in range(ORDER)]
    long = near.select(*near.columns, F.posexplode(F.slice(F.array(*cols), 1, F.col("k"))).alias("pos", "id"))
    names = spelled(docs, long.select("id").distinct(), text_col)
    parts = long.join(names, "id").groupBy("lang", "k", *cols, "a", "l", "r", "n", "score").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
    phrases = parts.withColumn("phrase", F.array_join(F.transform("words", lambda x: x["word"]), " "))
    final = _first(phrases, top, F.row_number(), [*by_score, F.col("phrase").asc()])
    return final.select("lang", F.col("place").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over every whole text of ``documents``."""
    return collocations(documents(spark, sf_dir))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), f AS (
  SELECT lang, g, count(*) AS c FROM (
    SELECT lang, unnest(list_concat(
      list_transform(range(1, len(ws) + 1), lambda i: ws[i:i]),
      list_transform(range(1, len(ws)), lambda i: ws[i:i + 1]),
      list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2]))) AS g
    FROM w) GROUP BY ALL
), total AS (
  SELECT lang, sum(c) AS n FROM f WHERE len(g) = 1 GROUP BY lang
), cand AS (
  SELECT lang, g, c AS a FROM f WHERE len(g) >= 2 AND c >= 10
), cuts AS (
  SELECT x.lang, x.g, a, k, p.c AS l, s.c AS r,
    (1000000::HUGEINT * a * a) // (p.c::HUGEINT * s.c) AS score
  FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM cand) x
  JOIN f p ON p.lang = x.lang AND p.g = x.g[1:k] JOIN f s ON s.lang = x.lang AND s.g = x.g[k + 1:]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), cover AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, a, g[1:2] AS p FROM cand WHERE len(g) = 3 UNION ALL SELECT lang, a, g[2:3] FROM cand WHERE len(g) = 3)
  GROUP BY lang, p
), ranked AS (
  SELECT b.lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score
  FROM best b JOIN total USING (lang) LEFT JOIN cover c ON c.lang = b.lang AND c.p = b.g
  WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked QUALIFY rank <= 2000
"""
