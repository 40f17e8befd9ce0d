"""Operator 13: periodic runs of words by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least max(6, 4 q) words that no neighbouring word extends.

1. *Stretches.* A run of period q has at least 3 q - 2 consecutive positions (3 for
   q = 1) whose three words occur earlier in the text, no more than q words back.
   One vectorised pass over 64-bit hashes finds the stretches for which some q
   allows this; every run lies within one (equal hashes can only add stretches).
2. *Automaton.* The words of a stretch are appended one by one to a suffix
   automaton.  Its suffix links form a tree, kept as a link-cut forest of splay
   trees: a preferred path holds the states whose last occurrence ended at the same
   word, its colour.  Appending word i accesses the state of the whole prefix, so
   the path to the root takes colour i.  Each path segment met on the way has an
   earlier colour c and a longest state of L words: these L words end at c and at i.
   With d = i - c <= L the d words before i stand there twice, a square, and the
   period d reaches back over L + d words.
3. *Runs.* The longest state of the segment makes L + d maximal to the left, and c is
   the latest earlier end, so d is the smallest period once L >= 3 d.  The square
   whose next word breaks the period gives the run's end.

A task holds one chunk of texts and the automaton of one stretch (about 1 kB a word
of the stretch, nothing for words outside stretches); documents are never moved, so
a hot key has no effect and a lost task reads its rows again.

Defined cases: null, empty or blank text: no words, no runs, empty kept text; rows are
judged one by one, so repeated rows or ids get equal results; an empty table gives an
empty result; of the input only the two named columns are read, whatever others exist.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm.common import documents, words

#: A run has at least MIN_WORDS words and EXPONENT periods.
MIN_WORDS = 6
EXPONENT = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string"


def _period_classes(limit: int) -> list[tuple[int, int]]:
    """(smallest, largest) period of every class up to ``limit``; the ratio is at most 1.25 beyond 8."""
    out, low = [], 1
    while low <= limit:
        high = max(low, low * 5 // 4 if low > 8 else low)
        out.append((low, high))
        low = high + 1
    return out


def _stretches(h: np.ndarray, doc: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint [start, end) word ranges, each within one text, that together
    contain every run.  ``first`` is the first word of every text, and the end."""
    at, gram = K.windows(h, doc, 3)
    if len(at) < 3:
        return []
    gram = gram ^ K.mix(doc[at].astype(np.uint64), 13)
    order = np.argsort(gram, kind="stable")
    same = np.flatnonzero(gram[order[1:]] == gram[order[:-1]])
    if not len(same):
        return []
    here, before = at[order[same + 1]], at[order[same]]
    by = np.argsort(here)
    here, back = here[by], (here - before)[by]
    found = []
    for low, high in _period_classes(int(np.diff(first).max()) // EXPONENT + 1):
        near = here[back <= high]
        if not len(near):
            continue
        cut = np.flatnonzero(np.diff(near) != 1) + 1
        lo, hi = near[np.concatenate(([0], cut))], near[np.append(cut, len(near)) - 1]
        long = hi - lo + 1 >= max(3, 3 * low - 2)
        if long.any():
            lo, hi = lo[long], hi[long]
            text = doc[lo]
            found.append(np.stack((np.maximum(lo - high, first[text]), np.minimum(hi + 3, first[text + 1])), axis=1))
    if not found:
        return []
    spans = np.concatenate(found)
    out: list[list[int]] = []
    for lo, hi in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and lo < out[-1][1] and doc[lo] == doc[out[-1][0]]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


class LinkCutAutomaton:
    """Suffix automaton whose suffix-link tree is a link-cut forest.

    ``append(word)`` returns the (distance, length) of every path segment that the
    access recolours: the last ``length`` words also ended ``distance`` words ago.
    State 0 stands for none, state 1 is the empty word."""

    def __init__(self):
        self.next = [{}, {}]
        self.link = [0, 0]
        self.size = [0, 0]
        self.up = [0, 0]  # parent in the splay tree, or the path's parent state at its top
        self.left = [0, 0]  # shallower states of the path
        self.right = [0, 0]  # deeper states of the path
        self.colour = [-1, -1]  # held at the root of each splay tree
        self.last = 1
        self.n = 0

    def _state(self, size: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.size.append(size)
        self.up.append(0)
        self.left.append(0)
        self.right.append(0)
        self.colour.append(-1)
        return len(self.size) - 1

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree, which keeps its colour."""
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            turns = (x,) if not inner else (y, x) if (left[z] == y) == (left[y] == x) else (x, x)
            for v in turns:
                p = up[v]
                g = up[p]
                if g and left[g] == p:
                    left[g] = v
                elif g and right[g] == p:
                    right[g] = v
                else:
                    colour[v] = colour[p]
                if left[p] == v:
                    b = left[p] = right[v]
                    right[v] = p
                else:
                    b = right[p] = left[v]
                    left[v] = p
                if b:
                    up[b] = p
                up[p] = v
                up[v] = g

    def _access(self, x: int) -> list[tuple[int, int]]:
        up, right, colour, now = self.up, self.right, self.colour, self.n
        met, below = [], 0
        while x:
            self._splay(x)
            c, deeper = colour[x], right[x]
            if deeper:
                colour[deeper] = c
            if c >= 0 and self.size[x]:
                met.append((now - c, self.size[x]))
            right[x] = below
            below, x = x, up[x]
        colour[below] = now
        return met

    def append(self, word) -> list[tuple[int, int]]:
        nxt, link, size = self.next, self.link, self.size
        cur = self._state(size[self.last] + 1, {})
        p = self.last
        while p and word not in nxt[p]:
            nxt[p][word] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = nxt[p][word]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                # the clone enters the path of q just above it: both last ended at the same word
                clone = self._state(size[p] + 1, dict(nxt[q]))
                link[clone], link[q], link[cur] = link[q], clone, clone
                self._splay(q)
                above = self.left[q]
                self.left[clone] = above
                if above:
                    self.up[above] = clone
                self.left[q] = clone
                self.up[clone] = q
                while p and nxt[p].get(word) == q:
                    nxt[p][word] = clone
                    p = link[p]
        self.up[cur] = link[cur]
        self.last = cur
        met = self._access(cur)
        self.n += 1
        return met


def stretch_runs(text: list, lo: int, hi: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``text`` that lie in [lo, hi)."""
    tree, out, n = LinkCutAutomaton(), set(), len(text)
    for i in range(lo, hi):
        for d, size in tree.append(text[i]):
            if size >= (EXPONENT - 1) * d and size + d >= MIN_WORDS and (i + 1 == n or text[i + 1] != text[i + 1 - d]):
                start = i + 1 - size - d
                while start and text[start - 1] == text[start - 1 + d]:
                    start -= 1
                out.add((start, i + 1 - start, d))
    return out


def _find(batches):
    for batch in batches:
        given, texts = batch.column(0), batch.column(1)
        total, found, kept = [], [], []
        for chunk in K.chunks(texts):
            h, doc = chunk.words()
            first = np.concatenate(([0], np.cumsum(chunk.counts(doc))))
            spans: dict[int, list] = {}
            for lo, hi in _stretches(h, doc, first):
                spans.setdefault(int(doc[lo]), []).append((lo, hi))
            raw = chunk.buf.tobytes()
            for i in range(chunk.hi - chunk.lo):
                w = raw[chunk.offsets[i] : chunk.offsets[i + 1]].split()
                runs, base = set(), int(first[i])
                for lo, hi in spans.get(i, ()):
                    runs |= stretch_runs(w, lo - base, hi - base)
                total.append(len(w))
                found.append([{"start": s, "length": m, "period": q} for s, m, q in sorted(runs, key=lambda r: (r[0], r[2]))])
                if runs:
                    step = np.zeros(len(w) + 1, dtype=np.int64)
                    for s, m, q in runs:
                        step[s + q] += 1
                        step[s + m] -= 1
                    w = [x for x, c in zip(w, np.cumsum(step).tolist()) if not c]
                kept.append(b" ".join(w).decode())
        yield pa.RecordBatch.from_arrays(
            [given, pa.array(total, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "runs", "kept"],
        )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, its runs (start, length, period) by start and
    period, and the words that are left, joined by one space, when each run keeps
    only its first period."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_find, _RESULT)


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by CRC-32 of the id, made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    step1 = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    g, n = F.floor(F.col("h") / 10).cast("long"), F.size("w")
    step2 = step1.select("doc_id", "text", "w", n.alias("n"), F.when(n > 0, F.pmod(g, n)).alias("a"), (F.lit(3) + g % 8).alias("parts"))
    p = F.lit(1) + F.floor((F.col("n") - F.col("a")) / F.col("parts")).cast("long")
    step3 = step2.withColumn("p", p)
    moved = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.element_at("w", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int"))))
    return step3.select("doc_id", F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over every whole text of ``documents``, a tenth of them made periodic."""
    runs = periodic_runs(_planted(documents(spark, sf_dir)))
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("m"), r["start"].alias("s"), r["period"].alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = runs.withColumns({"top": top, "lines": F.array_join(lines, "")})
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.s").alias("start"),
        (-F.col("top.m")).alias("length"),
        F.col("top.q").alias("period"),
        F.expr("(-top.m * 1000) div top.q").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


#: Runs by joining equal words of a document q apart and cutting the matches into stretches.
OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM documents
), crc AS (
  SELECT rid, doc_id, w, len(w) AS n, xor(CAST(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda acc, b:
      list_reduce(list_prepend(xor(acc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda c, z:
        xor(c >> 1, (c & 1) * 3988292384))) AS BIGINT), CAST(4294967295 AS BIGINT)) AS h
  FROM d
), cut AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM crc
), per AS (
  SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + (h // 10) % 8) END AS p FROM cut
), words AS (
  SELECT rid, n, unnest(range(n)) AS i, unnest(list_transform(range(n), lambda i:
    w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END])) AS word
  FROM per WHERE n > 0
), pairs AS (
  SELECT x.rid, y.i - x.i AS q, x.i AS i
  FROM words x JOIN words y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT rid, q, min(i) AS start, max(i) + 1 + q AS stop
  FROM (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM pairs)
  GROUP BY rid, q, g
), long AS (
  SELECT rid, start, stop - start AS length, q AS period, stop FROM islands WHERE stop - start >= greatest(6, 4 * q)
), runs AS (
  SELECT rid, start, length, period FROM long l
  WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.rid = l.rid AND s.period < l.period AND s.start <= l.start AND s.stop >= l.stop)
), summary AS (
  SELECT rid, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first(struct_pack(s := start, m := length, q := period) ORDER BY length DESC, start, period) AS top
  FROM runs GROUP BY rid
), gone AS (
  SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS txt FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(top.s AS BIGINT) AS start,
  CAST(top.m AS BIGINT) AS length, CAST(top.q AS BIGINT) AS period,
  CAST(1000 * top.m // top.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(txt, '')) AS collapsed_sha256
FROM d LEFT JOIN summary USING (rid) LEFT JOIN kept USING (rid)
"""
