"""Operator 1: quality rules as a short-circuit cascade, in built-in functions only.

The base counts (words, symbols, repeated lines and 5-word windows) come first,
since they are part of the result; a document that fails on them meets no other
rule.  The remaining rules are measured on a sample: seconds to evaluate (cost,
over several copies of the sample, less a run without a rule) and the rows
rejected that no earlier rule rejects (selectivity).  They run in the order of
such rejections per cost, the cheaper first where these are equal, as one CASE
expression, whose later branches are not evaluated once a branch holds.  The order
never changes which documents are kept.

No rule depends on the length of a text: distinct words are counted in windows of
``DISTINCT_WINDOW`` words.  Characters of scripts written without spaces do not
count as word length.

Defined cases: null text has no words and fails the base; rows are judged one by
one, so repeated rows get equal verdicts; an empty table gives an empty result; a
very long text is judged whole, by the same rules; ``quality_filter`` takes any
column names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.common import cut_lineage, documents, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
DISTINCT_WINDOW = 1000
#: Scripts written without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
#: Rows (by hash of the text) on which the rules' cost and selectivity are measured.
SAMPLE_ROWS = 2000
#: Copies of the sample over which a rule is timed, so that its own work outweighs that of the job.
TIMED_COPIES = 4


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``rejects`` holds; it may use the text
    column ``text`` and the base columns."""

    name: str
    rejects: Column


def _repeat_words(w: Column) -> Column:
    """Words inside a 5-word window that occurs twice or more in the array."""
    h = F.transform(w, lambda x: F.xxhash64(x))
    grams = F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*(F.element_at("_h", i + j) for j in range(WINDOW)))))
    return h, grams


def base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and base_failed, in one struct column ``_base``; 64-bit hashes stand for the words of a window."""
    t = F.coalesce(text, F.lit(""))
    spaces = " \t\n\x0b\f\r"
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    h, grams = _repeat_words(F.col("_words"))
    step1 = docs.withColumn("_text", t).withColumns({"_words": words(t), "_lines": lines})
    step2 = step1.withColumn("_h", h)
    step3 = step2.withColumn("_grams", grams)
    # positions (0-based) of windows that occur more than once, found by sorting (hash, position)
    ordered = F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    step4 = step3.withColumn("_sorted", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), ordered))
    same = lambda x, i, j: F.coalesce(F.get("_sorted", i + j)["g"] == x["g"], F.lit(False))
    again = F.filter("_sorted", lambda x, i: same(x, i, -1) | same(x, i, 1))
    step5 = step4.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        "_again",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    n = F.size("_words")
    repeat = F.coalesce(covered, F.lit(0)).cast("long")
    base = step5.withColumn(
        "_base",
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.translate("_text", spaces, "")).cast("long").alias("word_chars"),
            (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size("_lines").cast("long").alias("n_lines"),
            repeat.alias("n_repeat_words"),
        ),
    )
    return base.withColumn("_failed", (F.col("_base.n_words") < MIN_WORDS) | (100 * F.col("_base.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_base.n_words")))


def default_rules() -> list[Rule]:
    """The method's rules beyond the base, as ``OP1_SQL`` states them."""
    b = lambda c: F.col(f"_base.{c}")
    n = b("n_words")
    shouting = F.size(F.filter("_words", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1)))
    alphabetic = F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))
    starts = F.sequence(F.lit(0), F.floor((F.size("_words") - 1) / DISTINCT_WINDOW).cast("int"))
    distinct = F.aggregate(starts, F.lit(0), lambda a, i: a + F.size(F.array_distinct(F.slice("_words", i * DISTINCT_WINDOW + 1, DISTINCT_WINDOW))))
    unspaced = F.length("_text") - F.length(F.regexp_replace("_text", UNSPACED, ""))
    return [
        Rule("symbols", 100 * b("n_symbols") > 5 * b("word_chars")),
        Rule("repeated_lines", (2 * b("n_dup_lines") > b("n_lines")) & (b("n_dup_lines") >= 3)),
        Rule("word_length", (b("word_chars") < 2 * n) | ((b("word_chars") > 25 * n) & (b("word_chars") - unspaced > 25 * n))),
        Rule("shouting", 2 * shouting > n),
        Rule("no_letters", 2 * alphabetic < n),
        Rule("few_distinct_words", (n >= 100) & (10 * distinct < n)),
        Rule("undecodable", 20 * (F.length("_text") - F.length(F.translate("_text", "�\x00", ""))) > F.length("_text")),
    ]


def length_free_rules() -> list[Rule]:
    """The name under which the pipeline's first stage asks for the rules."""
    return default_rules()


@dataclass(frozen=True)
class Measured:
    """A rule with its seconds on the sample and the share of the sample that it
    rejects and no rule before it."""

    rule: Rule
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / self.seconds


def order_rules(docs: DataFrame, text_col: str, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Each rule's cost and selectivity on a sample, best rejections per cost first."""
    total = docs.count()
    share = max(1, total // max(1, sample_rows))
    picked = docs.select(F.col(text_col).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).limit(2 * sample_rows)
    keep = ["_text", "_words", "_base", "_failed"]
    sample = cut_lineage(base_counts(picked, F.col("text")).select(*keep)).where(~F.col("_failed"))
    bits = [F.when(r.rejects, F.lit(1 << i)).otherwise(0) for i, r in enumerate(rules)]
    # one row per set of rules that reject the same rows: at most the rows of the sample
    left = {r["hit"]: r["n"] for r in sample.groupBy(F.aggregate(F.array(F.lit(0), *bits), F.lit(0), lambda a, x: a + x).alias("hit")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(left.values())
    copies = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(TIMED_COPIES))))

    def timed(condition: Column) -> float:
        """Seconds of the second of two runs: the first compiles."""
        for _ in range(2):
            began = time.perf_counter()
            copies.agg(F.count_if(condition)).head()
        return time.perf_counter() - began

    idle = timed((F.size("_words") < 0) | (F.octet_length("_text") < 0) | (F.col("_base.n_words") < 0))
    cost = [max(timed(r.rejects) - idle, idle / 100) for r in rules]
    out, open_rules = [], list(range(len(rules)))
    while open_rules:
        share = {i: sum(c for hit, c in left.items() if hit >> i & 1) / max(n, 1) for i in open_rules}
        best = min(open_rules, key=lambda i: (-share[i] / cost[i], cost[i], rules[i].name))
        out.append(Measured(rules[best], cost[best], share[best]))
        open_rules.remove(best)
        left = {hit: c for hit, c in left.items() if not hit >> best & 1}
    return out


def judge(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``_base`` (counts), ``_failed`` (base verdict) and ``_rule``,
    the first rule of the cascade that rejects the document (null: kept)."""
    ordered = [m.rule for m in order_rules(docs, text_col, default_rules() if rules is None else rules)]
    cascade = F.when(F.col("_failed"), F.lit("base"))
    for rule in ordered:
        cascade = cascade.when(rule.rejects, F.lit(rule.name))
    return base_counts(docs, F.col(text_col)).withColumn("_rule", cascade)


def quality_filter(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that every rule accepts, with their own columns."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    judged = judge(docs.select(own, F.col(f"`{text_col}`").alias("_given")), "_given", rules)
    # a filter is not pushed below a row number, so the counts it rests on are computed once
    numbered = judged.select("_row", "_rule", F.monotonically_increasing_id().alias("_at"))
    return numbered.where(F.col("_rule").isNull() & (F.col("_at") >= 0)).select("_row.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over every whole text of ``documents``."""
    judged = judge(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.col(f"_base.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, F.col("_failed").alias("base_failed"), F.col("_rule").isNull().alias("kept"))


#: The rules above in DuckDB; their order does not matter for ``kept``.
OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
ws AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
g AS (
  SELECT r, p, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS gram
  FROM ws WINDOW o AS (PARTITION BY r ORDER BY p)),
again AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS c FROM g WHERE gram IS NOT NULL) WHERE c > 1),
cover AS (
  SELECT r, sum(least(5, coalesce(p - before, 5))) AS n
  FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM again) GROUP BY r),
s AS (
  SELECT doc_id, t, w, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN cover USING (r)),
b AS (
  SELECT *, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         list_sum(list_transform(range(0, n_words, 1000), lambda i: len(list_distinct(w[i + 1:i + 1000])))) AS n_distinct,
         length(t) - length(regexp_replace(t, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]', '', 'g')) AS n_unspaced
  FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed
            OR 100 * n_symbols > 5 * word_chars
            OR (2 * n_dup_lines > len(ls) AND n_dup_lines >= 3)
            OR word_chars < 2 * n_words OR word_chars - n_unspaced > 25 * n_words
            OR 2 * len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) > n_words
            OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < n_words
            OR (n_words >= 100 AND 10 * n_distinct < n_words)
            OR 20 * (length(t) - length(replace(t, chr(65533), ''))) > length(t)) AS kept
FROM b
"""
