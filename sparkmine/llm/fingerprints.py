"""Operator 11: document fingerprints by a threshold-scaled sketch, in built-in functions only.

A document's shingles are its runs of five words (the whole sequence as one when it
has fewer words).  A shingle's hash is the first 12 hex digits (48 bits) of its MD5.  The
sketch keeps every hash below a fixed fraction of the hash range, here an eighth, so
its size follows the document and sketches of very unequal documents stay
comparable: what one keeps of a shared passage, the other keeps as well.  A sketch
that would hold fewer than FLOOR hashes keeps the document's FLOOR smallest ones, so
that a short text has a fingerprint at all.

A sketch therefore holds every hash of its document up to ``bound``: the fraction's
limit, or its largest hash if that is higher, or the whole range when it holds fewer
than FLOOR.  Two sketches are compared below the smaller of their bounds, where both
are complete; ``merged`` gives the sketch of the union of two documents.

The fingerprint is the sketch's hashes in ascending order, 12 digits each, joined.

Neighbours (the edited text of the query) need the order of all documents: only ids,
lengths and hashes are ordered (range partitions, no global window).  Each distinct
(doc_id, text) is shuffled once, with its sketch, and meets its own row of that
order; to the document before it go its sketch and the first code points needed there.

Defined cases: null and empty texts have an empty sketch and the empty fingerprint;
two empty sketches have likeness 1, an empty and a filled one 0; rows that share a
doc_id are ordered by the hash of their text, equal rows follow each other; a null
doc_id comes last; an empty table gives an empty result; other columns are not read,
whatever their names.  One text's words and hashes (some 150 bytes a word) must fit
in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import cut_lineage, documents, words
from sparkmine.session import maybe_broadcast

SHINGLE = 5
#: Hashes below this many sixteenths of the range are kept: an eighth.
SIXTEENTHS = 2
#: Least number of hashes of a sketch, if the document has as many.
FLOOR = 32
_DIGITS = 12
_LIMIT = f"{SIXTEENTHS - 1:x}".ljust(_DIGITS, "f")
_ALL = "f" * _DIGITS


def shingle_hashes(w: Column, k: int = SHINGLE) -> Column:
    """Distinct hashes of the k-word shingles of an array of words, ascending."""
    digest = lambda x: F.substring(F.md5(F.array_join(x, " ")), 1, _DIGITS)
    many = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: digest(F.slice(w, i, k)))
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.when(F.size(w) >= k, many).when(F.size(w) > 0, F.array(digest(w))).otherwise(none)))


def kept(hashes: Column, floor: int = FLOOR) -> Column:
    """The sketch of ascending distinct hashes: those below the fraction, at least ``floor``."""
    below = F.size(F.filter(hashes, lambda h: h <= _LIMIT))
    return F.slice(hashes, 1, F.greatest(below, F.lit(floor)))


def bound(sketch: Column, floor: int = FLOOR) -> Column:
    """The sketch holds every hash of its document up to this one."""
    return F.when(F.size(sketch) < floor, F.lit(_ALL)).otherwise(F.greatest(F.lit(_LIMIT), F.element_at(sketch, -1)))


def merged(a: Column, b: Column, floor: int = FLOOR) -> Column:
    """The sketch of the union of two documents' shingles, from their sketches."""
    limit = F.least(bound(a, floor), bound(b, floor))
    return kept(F.array_sort(F.filter(F.array_union(a, b), lambda h: h <= limit)), floor)


def _common(a: Column, b: Column, floor: int) -> tuple[Column, Column, Column]:
    """Hashes of a, of b and of both, below the bound of both."""
    limit = F.least(bound(a, floor), bound(b, floor))
    below = lambda x: F.size(F.filter(x, lambda h: h <= limit))
    return below(a), below(b), below(F.array_intersect(a, b))


def likeness(a: Column, b: Column, floor: int = FLOOR) -> Column:
    """Estimated Jaccard similarity of the shingles of two sketches' documents (0 to 1)."""
    na, nb, both = _common(a, b, floor)
    return F.when(na + nb == 0, F.lit(1.0)).otherwise(both / (na + nb - both))


def containment(a: Column, b: Column, floor: int = FLOOR) -> Column:
    """Estimated share of a's shingles that b holds too (1 where a has none)."""
    na, _, both = _common(a, b, floor)
    return F.when(na == 0, F.lit(1.0)).otherwise(both / na)


def fingerprint(sketch: Column) -> Column:
    return F.array_join(sketch, "")


def sketch_of(print_: Column) -> Column:
    """The sketch that a fingerprint writes out."""
    n = (F.char_length(print_) / _DIGITS).cast("int")
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(print_, (i - 1) * _DIGITS + 1, F.lit(_DIGITS)))
    return F.when(n > 0, parts).otherwise(F.array().cast("array<string>"))


def with_sketch(df: DataFrame, text_col: str, out_col: str, k: int = SHINGLE, floor: int = FLOOR) -> DataFrame:
    """``df`` plus the sketch of a text column (array of strings) as ``out_col``."""
    w, h = f"{out_col}_words", f"{out_col}_hashes"
    step = df.withColumn(w, words(F.col(text_col))).withColumn(h, shingle_hashes(F.col(w), k))
    return step.withColumn(out_col, kept(F.col(h), floor)).drop(w, h)


_KEY = ["id", "none", "h"]


def _neighbours(slim: DataFrame) -> DataFrame:
    """``slim`` (id, none, h, n_chars, copies) plus the keys and lengths of the rows
    before and after it in (none, id, h) order; the first row follows the last.

    Rows are range-partitioned and written once; windows run inside the written
    ranges, and the ranges' ends are stitched from one row per range."""
    parts = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["none", "id", "h"]
    me, place = F.struct(*_KEY, "n_chars"), F.struct(*order)
    # the range is written with the rows: later passes must not deal them anew
    ranged = cut_lineage(slim.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    # one row per range
    w = Window.orderBy("part")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ranged.groupBy("part").agg(F.min_by(me, place).alias("low"), F.max_by(me, place).alias("high"))
    ends = ends.select(
        F.col("part").alias("of"),
        F.coalesce(F.lag("high").over(w), F.last("high").over(every)).alias("before_part"),
        F.coalesce(F.lead("low").over(w), F.first("low").over(every)).alias("after_part"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    near = ranged.withColumns({"before": F.lag(me).over(inside), "after": F.lead(me).over(inside)})
    joined = near.join(maybe_broadcast(ends, parts, 256), F.col("part") == F.col("of"))
    return joined.select(*_KEY, "n_chars", "copies", F.coalesce("before", "before_part").alias("before"), F.coalesce("after", "after_part").alias("after"))


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, floor: int = FLOOR) -> DataFrame:
    """Per distinct (doc_id, text) and follower: doc_id, n_chars, ``print`` (its
    fingerprint), ``next_print`` (that of the following document), ``edited`` (its
    text with the last floor(n_chars / 2) code points replaced by as many first
    ones, or all, of the following document) and ``rows``, how often it stands in the table."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    # a null id is a flag beside the id, so that keys are plain equalities
    keyed = src.select(F.coalesce("id", F.lit(0)).cast("long").alias("id"), F.col("id").isNull().alias("none"), F.xxhash64("text").alias("h"), "text")
    slim = keyed.groupBy(*_KEY).agg(F.max(F.char_length("text").cast("long")).alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    order = cut_lineage(_neighbours(slim)).withColumnsRenamed({c: f"o_{c}" for c in _KEY})
    # copies of a row meet in the map-side aggregate; this is the one shuffle of whole texts
    sketched = with_sketch(keyed, "text", "sketch", k, floor).select(*_KEY, "text", F.unhex(fingerprint(F.col("sketch"))).alias("print"))
    each = sketched.groupBy(*_KEY).agg(F.first("text").alias("text"), F.first("print").alias("print"))
    same = lambda p: [F.col(c) == F.col(f"{p}_{c}") for c in _KEY]
    placed = each.join(order.hint("shuffle_hash"), same("o"))
    # the document before this one needs as many first code points as half its own length
    heads = placed.select(
        *(F.col(f"before.{c}").alias(f"to_{c}") for c in _KEY),
        F.expr("substring(text, 1, cast(before.n_chars div 2 as int))").alias("head"),
        F.col("print").alias("head_print"),
    )
    met = placed.join(heads, same("to"))
    half = F.expr("cast(n_chars div 2 as int)")
    start = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    # of equal rows, all but the last are followed by their own copy
    last = F.struct(F.concat(start, F.col("head")).alias("edited"), F.col("head_print").alias("next_print"), F.lit(1).cast("long").alias("rows"))
    own = F.struct(F.concat(start, F.substring("text", F.lit(1), half)).alias("edited"), F.col("print").alias("next_print"), (F.col("copies") - 1).alias("rows"))
    kinds = F.explode(F.when(F.col("copies") > 1, F.array(last, own)).otherwise(F.array(last)))
    out = met.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_chars", F.lower(F.hex("print")).alias("print"), kinds.alias("x"))
    return out.select("doc_id", "n_chars", "print", F.lower(F.hex("x.next_print")).alias("next_print"), "x.edited", "x.rows")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, floor: int = FLOOR) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, the fingerprints of the
    text and of its edited form, and the likeness of the text's sketch to those of
    the edited text and of the next document."""
    made = with_sketch(with_edited(docs, id_col, text_col, k, floor), "edited", "edited_sketch", k, floor)
    made = made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "print", "edited_sketch", "rows",
        sketch_of(F.col("print")).alias("sketch"), sketch_of(F.col("next_print")).alias("next_sketch"),
    )
    out = made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("print").alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), floor).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), floor).alias("near_next"),
        "rows",
    )
    # equal rows of the table are counted until here
    many = F.when(F.col("rows") > 1, F.sequence(F.lit(1).cast("long"), F.col("rows"))).otherwise(F.array(F.lit(1).cast("long")))
    return out.withColumn("row", F.explode(many)).drop("rows", "row")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over every whole text of ``documents``."""
    return edited_fingerprints(documents(spark, sf_dir))


_SKETCH = """list_sort(list_distinct(CASE WHEN len({w}) >= 5 THEN
      list_transform(range(1, len({w}) - 3), lambda i: substr(md5(array_to_string({w}[i:i + 4], ' ')), 1, 12))
    WHEN len({w}) > 0 THEN [substr(md5(array_to_string({w}, ' ')), 1, 12)] ELSE CAST([] AS VARCHAR[]) END))"""
_KEPT = f"list_slice({{h}}, 1, greatest(len(list_filter({{h}}, lambda x: x <= '{_LIMIT}')), {FLOOR}))"
_BOUND = f"CASE WHEN len({{s}}) < {FLOOR} THEN '{_ALL}' ELSE greatest('{_LIMIT}', {{s}}[-1]) END"
_NEAR = """CASE WHEN len(list_filter({a}, lambda x: x <= {t})) + len(list_filter({b}, lambda x: x <= {t})) = 0 THEN 1.0 ELSE
    CAST(len(list_filter(list_intersect({a}, {b}), lambda x: x <= {t})) AS DOUBLE) /
    len(list_distinct(list_filter(list_concat({a}, {b}), lambda x: x <= {t}))) END"""

OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents
), o AS (
  SELECT *, coalesce(lead(t) OVER w, first(t) OVER w) AS nt
  FROM d WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT *, substr(t, 1, n - n // 2) || substr(nt, 1, n // 2) AS et FROM o
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS wt, regexp_extract_all(et, '[^\\x20\\x09-\\x0D]+') AS we FROM e
), h AS (
  SELECT *, {_SKETCH.format(w="wt")} AS ht, {_SKETCH.format(w="we")} AS he FROM w
), s AS (
  SELECT *, {_KEPT.format(h="ht")} AS st, {_KEPT.format(h="he")} AS se FROM h
), b AS (
  SELECT *, {_BOUND.format(s="st")} AS bt, {_BOUND.format(s="se")} AS be FROM s
), x AS (
  SELECT *, coalesce(lead(st) OVER w, first(st) OVER w) AS sn, coalesce(lead(bt) OVER w, first(bt) OVER w) AS bn
  FROM b WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(et) AS edited_sha256,
  array_to_string(st, '') AS fingerprint, array_to_string(se, '') AS edited_fingerprint,
  {_NEAR.format(a="st", b="se", t="least(bt, be)")} AS near_edited,
  {_NEAR.format(a="st", b="sn", t="least(bt, bn)")} AS near_next
FROM x
"""
